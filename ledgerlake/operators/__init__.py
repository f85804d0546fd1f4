from ledgerlake.operators.aggregates import (
    count_by,
    count_distinct,
    document_metrics,
    joined_names,
    money_totals,
    month_index,
    profile,
    rolling_months,
    stack_roles,
    top_k,
)
from ledgerlake.operators.bucketed import BucketedTable, buckets_for, write_bucketed
from ledgerlake.operators.dedup import (
    canonical_attribute,
    dedup_subset,
    keep_latest,
    keep_top,
    split_null_keys,
    state_as_of,
)
from ledgerlake.operators.flatten import explode_lines, explode_names
from ledgerlake.operators.joins import enrich, join_splittable, only_known
from ledgerlake.operators.retention import compaction_plan, orphan_files, snapshots_to_expire
from ledgerlake.operators.tables import KeyedTable
from ledgerlake.operators.upsert import apply_changes, merge_into_catalog, replace_groups, upsert
from ledgerlake.operators.versions import as_of, validity
from ledgerlake.operators.distinct import day_bitmaps, day_sketches, distinct_in_spans, estimated_in_spans
from ledgerlake.operators.pruning import key_bitmap, split_by_keys

__all__ = [
    "BucketedTable",
    "buckets_for",
    "write_bucketed",
    "day_bitmaps",
    "day_sketches",
    "distinct_in_spans",
    "estimated_in_spans",
    "key_bitmap",
    "split_by_keys",
    "as_of",
    "validity",
    "KeyedTable",
    "apply_changes",
    "canonical_attribute",
    "compaction_plan",
    "count_by",
    "count_distinct",
    "dedup_subset",
    "document_metrics",
    "enrich",
    "explode_lines",
    "explode_names",
    "join_splittable",
    "joined_names",
    "keep_latest",
    "keep_top",
    "merge_into_catalog",
    "money_totals",
    "month_index",
    "only_known",
    "orphan_files",
    "profile",
    "replace_groups",
    "rolling_months",
    "snapshots_to_expire",
    "split_null_keys",
    "stack_roles",
    "state_as_of",
    "top_k",
    "upsert",
]
