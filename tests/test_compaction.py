import glob
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerloom.operators import compaction
from ledgerloom.sources import parquet_blocks as pb


def write(path, table, **kw):
    pq.write_table(table, path, **kw)
    return path


@pytest.fixture
def small_files(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    rows = []
    for i in range(30):
        part = [{"id": f"r{i}-{j}", "x": None if j % 3 == 0 else i + j / 7, "tags": ["a"] * (j % 3), "s": {"k": j}} for j in range(i % 5 * 4)]
        schema = pa.schema([("id", pa.string()), ("x", pa.float64()), ("tags", pa.list_(pa.string())), ("s", pa.struct([("k", pa.int64())]))])
        write(src / f"f{i}.parquet", pa.Table.from_pylist(part, schema), row_group_size=3, compression=["snappy", "zstd", "none"][i % 3])
        rows += part
    return src, rows


def test_blocks_are_copied_without_loss(small_files):
    src, rows = small_files
    parts = [open(p, "rb").read() for p in sorted(glob.glob(f"{src}/*.parquet"))]
    out, n = pb.join_files(parts)
    back = pq.read_table(pa.BufferReader(out)).to_pylist()
    key = lambda r: r["id"]
    assert sorted(back, key=key) == sorted(rows, key=key)
    assert n == {"files": 30, "blocks": sum(pb.counts(pb.split_footer(x))[0] for x in parts), "rows": len(rows)}


def test_footer_is_written_as_it_was_read(small_files):
    src, _ = small_files
    data = open(f"{src}/f4.parquet", "rb").read()
    footer = pb.split_footer(data)
    size = int.from_bytes(data[-8:-4], "little")
    assert pb._encode(pb.STRUCT, footer) == data[-8 - size : -8]


def test_schemas_must_agree(tmp_path):
    a = open(write(tmp_path / "a.parquet", pa.table({"x": [1]})), "rb").read()
    b = open(write(tmp_path / "b.parquet", pa.table({"x": ["1"]})), "rb").read()
    with pytest.raises(pb.BlockError):
        pb.join_files([a, b])
    with pytest.raises(pb.BlockError):
        pb.join_files([])
    for bad in (b"", b"PAR1junk", a[:-9]):
        with pytest.raises(pb.BlockError):
            pb.split_footer(bad)


def test_compact_parquet_bins_by_size_and_schema(spark, small_files, tmp_path):
    src, rows = small_files
    write(src / "odd.parquet", pa.table({"other": [1, 2, 3]}))
    total = sum(len(open(p, "rb").read()) for p in glob.glob(f"{src}/*.parquet"))
    report = compaction.compact_parquet(spark, str(src), str(tmp_path / "out"), target_bytes=total // 3).collect()
    assert sum(r.n_rows for r in report) == len(rows) + 3 and sum(r.n_files for r in report) == 31
    assert len({r.schema_key for r in report}) == 2 and len(report) <= 6
    mine = [r.output for r in report if r.schema_key != min(r2.schema_key for r2 in report if r2.n_rows == 3)]
    got = spark.read.parquet(*[f"file://{p}" if p.startswith("/") else p for p in mine]).select("id").collect()
    assert sorted(r.id for r in got) == sorted(r["id"] for r in rows)


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert compaction.compact_parquet(spark, str(tmp_path / "none"), str(tmp_path / "out")).count() == 0


def test_records_of_bodies(spark):
    good = {"record_id": "a", "ref": "n/1", "year": 1800, "unit": None, "price_per_unit_usd": 1.5}
    bodies = [
        "﻿" + json.dumps(good) + "\r\n" + json.dumps({"ref": "n/2", "record_id": "b"})[:-3],  # the second line is cut off
        json.dumps(good | {"note": "late"}, separators=(",", ":")) + "\r" + json.dumps({"record_id": "c", "ref": "n/3", "year": "1801", "extra": [1]}),
        "\n \n[]\n7\nnull\n" + json.dumps({"ref": "n/4"}) + "\n",
        "",
        None,
    ]
    files = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "body string, line int")  # a column named like an inner one
    got = {r.record_id: r for r in compaction.records_of_bodies(files).collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"].ref, got["a"].note, got["a"].price_per_unit_usd, got["c"].year) == ("n/1", "late", 1.5, 1801)
    assert compaction.records_of_bodies(files.limit(0)).count() == 0


def test_consolidate_bodies(spark):
    rows = [("\n".join(json.dumps({"record_id": f"r{i}", "ref": f"n/{i}"}) for i in range(k, k + 3)),) for k in range(20)]
    records, report = compaction.consolidate_bodies(spark, spark.createDataFrame(rows, "body string"))
    assert sorted(r.record_id for r in records.collect()) == sorted(f"r{i}" for i in range(22))
    assert report.agg({"n_rows": "sum"}).first()[0] == 22
    empty, _ = compaction.consolidate_bodies(spark, spark.createDataFrame([], "body string"))
    assert empty.count() == 0


def test_of_differing_copies_one_whole_copy_is_kept(spark):
    a = {"record_id": "a", "ref": "n/1", "unit": "lb", "note": "first", "year": 1800}
    b = {"record_id": "a", "ref": "n/1", "unit": "bu", "year": 1801}
    c = {"record_id": "a", "unit": "zz", "note": "zz"}  # the latest, but without its page
    rows = [(json.dumps(c), 3, "x"), (json.dumps(a), 1, "z"), (json.dumps(b) + "\n" + json.dumps(b | {"confidence": 0.5}), 2, "a")]
    got = compaction.records_of_bodies(spark.createDataFrame(rows, "body string, modified_at int, file_path string")).collect()
    assert [(r.ref, r.unit, r.note, r.year, r.confidence) for r in got] == [("n/1", "bu", None, 1801, 0.5)]


def test_outputs_are_packed_by_size(spark, small_files, tmp_path):
    src, rows = small_files
    sizes = [len(open(p, "rb").read()) for p in glob.glob(f"{src}/*.parquet")]
    target = max(sizes) * 4
    report = compaction.compact_parquet(spark, str(src), str(tmp_path / "packed"), target_bytes=target).collect()
    assert sum(r.n_rows for r in report) == len(rows) and sum(r.n_files for r in report) == len(sizes)
    assert all(r.n_bytes <= target for r in report) and len(report) <= 1 + 2 * sum(sizes) // target
