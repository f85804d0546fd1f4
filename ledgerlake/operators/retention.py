"""Which snapshots to expire, which files nobody references, which partitions to compact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import keep_top

# Days to keep and number of snapshots to keep in any case.
DEFAULT_RETENTION = (30, 3)
RETENTION = {"gold": (90, 5)}
ORPHAN_GRACE_DAYS = 3
TARGET_FILE_BYTES = 536_870_912


def _per_class(class_col: str | None, policies: Mapping[str, tuple[int, int]], default: int, i: int) -> Column:
    value = F.lit(default)
    if class_col:
        for name, policy in policies.items():
            value = F.when(F.col(class_col) == name, policy[i]).otherwise(value)
    return value


def snapshots_to_expire(
    log: DataFrame,
    as_of,
    table_col: str = "table_name",
    id_col: str = "snapshot_id",
    ts_col: str = "committed_at",
    class_col: str | None = None,
    default: tuple[int, int] = DEFAULT_RETENTION,
    policies: Mapping[str, tuple[int, int]] = RETENTION,
) -> DataFrame:
    """Snapshots older than their table's cutoff and not among the last ones it must keep.

    The last ones are found as a top-n per table, which map tasks cut down themselves, and taken
    away by an anti join on the snapshot id; numbering each table's whole log in one task is not needed.
    """
    retain = _per_class(class_col, policies, default[1], 1)
    most = max([default[1], *[p[1] for p in policies.values()]])
    narrow = log.select(table_col, id_col, ts_col, *([class_col] if class_col else []))
    newest_first = [F.col(ts_col).desc_nulls_last(), F.col(id_col).desc_nulls_last()]
    kept = keep_top(narrow, [table_col], newest_first, most, rank="_place").where(F.col("_place") <= retain)
    days = _per_class(class_col, policies, default[0], 0)
    age_limit = F.lit(as_of).cast(log.schema[ts_col].dataType) - F.make_dt_interval(days=days)
    return log.where(F.col(ts_col) < age_limit).join(
        kept.select(table_col, id_col), [table_col, id_col], "left_anti"
    )


def orphan_files(
    listing: DataFrame, referenced: DataFrame, as_of, grace_days: int = ORPHAN_GRACE_DAYS, on: str = "path"
) -> DataFrame:
    """Listed files no table version references, older than the grace period (running writes are younger)."""
    bound = F.lit(as_of).cast(listing.schema["modified_at"].dataType) - F.make_dt_interval(days=F.lit(grace_days))
    return listing.where(F.col("modified_at") < bound).join(referenced.select(on), on, "left_anti")


def compaction_plan(listing: DataFrame, partition: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Files and bytes per partition, and how many files of the target size would hold them."""
    sized = listing.groupBy(partition).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").cast("bigint").alias("total_bytes")
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / F.lit(target_bytes))).cast("bigint")
    return sized.withColumn("target_files", wanted).withColumn("rewrite", F.col("file_count") > F.col("target_files"))
