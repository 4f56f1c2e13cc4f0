"""Explicit schemas; nothing is ever inferred."""

PRICES = (
    "record_id string, ref string, date string, year int, item_raw string, price_raw string, note string, original_text string, location string, "
    "commodity_id string, commodity_name string, category_l1 string, category_l2 string, category_l3 string, unit string, quantity double, "
    "time_unit string, price_numeric double, currency_original string, price_usd double, price_per_unit_usd double, confidence double, "
    "reverified boolean, reverify_reason string, reverify_fixed boolean"
)
MENTION_PRICE = "t string, item string, price string, note string, ref string"
MENTION_PEOPLE = "t string, names array<string>, rel string, ref string"
UNRESOLVED = "ref string, date string, year int, item_raw string, price_raw string, note string, reason string, confidence double, permanent boolean, flagged_outlier boolean"
FAILED = MENTION_PRICE + ", _failed_reason string, _halving_depth int"
ISSUES = "lccn string, date string, url string, state string, title string"
PAGE_MANIFEST = "seq int, xml_url string"
DONE = "stage string, key string, ts timestamp"
ANSWER = (
    "idx int, commodity_id string, commodity_name string, category_l1 string, category_l2 string, category_l3 string, unit string, quantity double, "
    "time_unit string, price_numeric double, currency_original string, confidence double, unresolvable boolean, reason string"
)
VERDICT = "idx int, confirmed boolean, fixed boolean, confidence double, reason string, price_numeric double, unit string, quantity double"
