from ledgerlake.functions.columns import (
    blank_to,
    iso_date,
    iso_timestamp,
    item,
    months_before,
    repair_quotes,
    split_names,
    to_money,
)
from ledgerlake.functions.documents import (
    PROBLEMS,
    backfill_ingest_ts,
    conform,
    nested_to_json,
    normalize_extended_json,
    quality_split,
    split_conformed,
    with_ingest_ts,
)
from ledgerlake.functions.drift import observed_schemas, schema_drift

__all__ = [
    "observed_schemas",
    "schema_drift",
    "PROBLEMS",
    "backfill_ingest_ts",
    "blank_to",
    "conform",
    "iso_date",
    "iso_timestamp",
    "item",
    "months_before",
    "nested_to_json",
    "normalize_extended_json",
    "quality_split",
    "repair_quotes",
    "split_conformed",
    "split_names",
    "to_money",
    "with_ingest_ts",
]
