"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_P1_KEYS = r"""
WITH folded AS (
  SELECT record_id, lower(commodity_id) AS name,
         regexp_replace(regexp_replace(lower(original_text), '(\d),(\d\d\d)($|[^\d])', '\1\2\3', 'g'), '(\d),(\d\d\d)($|[^\d])', '\1\2\3', 'g') AS t
  FROM normalized WHERE original_text IS NOT NULL),
keyed AS (
  SELECT record_id,
         list_sort(list_filter(list_transform(regexp_split_to_array(t, '[;|\r\n]+'),
           lambda f: array_to_string(regexp_extract_all(f, '\d+(?:\.\d+)*|\p{L}+|\p{Sc}'), ' ')), lambda f: f <> '')) AS fields,
         list_sort(regexp_extract_all(coalesce(name, ''), '[\p{L}\d]+')) AS words
  FROM folded),
classes AS (
  SELECT fields, words, min(record_id) AS first_id, count(*) AS n_copies FROM keyed WHERE len(fields) > 0 GROUP BY ALL HAVING count(*) > 1)
"""

ORACLES = {
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p1_found": _P1_KEYS + "SELECT first_id, record_id AS copy_id FROM keyed JOIN classes USING (fields, words) WHERE record_id <> first_id",
    "p1_records": _P1_KEYS + """, later AS (SELECT record_id FROM keyed JOIN classes USING (fields, words) WHERE record_id <> first_id)
SELECT n.record_id, coalesce(c.n_copies, 1) AS n_copies FROM normalized n LEFT JOIN classes c ON n.record_id = c.first_id
WHERE n.record_id NOT IN (SELECT record_id FROM later)""",
    # groups of up to 1,024 values are answered exactly, so the exact percentile is the same value
    "p6_percentiles": "SELECT commodity_id, year, count(*) AS n, "
    + ", ".join(f"quantile_disc(price_per_unit_usd, {p / 100}) AS p{p:02d}" for p in (5, 10, 25, 50, 75, 90, 95, 99))
    + " FROM normalized WHERE price_per_unit_usd IS NOT NULL GROUP BY commodity_id, year",
}
