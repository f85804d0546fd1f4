"""MERGE as DataFrame algebra, for tables whose format has no row-level commands.

An unconditional merge is ``source + (target without the source's keys)``. Only the source's *keys*
meet the target in a join; the source's rows are never shuffled, and when the keys are few Spark
broadcasts them and the target is not shuffled either. A full outer join would shuffle both sides
whole, and AQE cannot split a hot key in one.

Rules kept from SQL MERGE: columns resolve by name, null keys never match, and a target row matched
by more than one source row is an error (source rows that match nothing may repeat).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import keep_latest
from ledgerlake.operators.joins import join_splittable
from ledgerlake.operators.pruning import split_by_keys

_N, _TS, _SOURCE = "_matches", "_source_ts", "_source_row"


def _keyed(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _source_keys(source: DataFrame, keys: list[str], newer_by: str | None) -> DataFrame:
    """One row per source key: how often it occurs and, for newer-wins, how new it is."""
    aggs = [F.count(F.lit(1)).alias(_N)]
    if newer_by:
        aggs.append(F.max(newer_by).alias(_TS))
    return source.where(_keyed(keys)).groupBy(*keys).agg(*aggs)


def _untouched(target: DataFrame, touched: DataFrame, keys: list[str], newer_by: str | None) -> DataFrame:
    survives = F.col(_N).isNull()
    if newer_by:
        survives = survives | ~F.coalesce(F.col(_TS) > F.col(newer_by), F.lit(False))
    clash = F.raise_error(F.lit("upsert: more than one source row matches a target row"))
    kept = (
        target.where(_keyed(keys)).join(touched, keys, "left")
        .where(F.when(F.col(_N) > 1, clash.cast("boolean")).otherwise(survives))
        .select(*target.columns)
    )
    # null keys match nothing: round the join, in which they would all meet in one task
    return kept.unionByName(target.where(~_keyed(keys)))


def _winners(target: DataFrame, source: DataFrame, touched: DataFrame, keys: list[str], newer_by: str) -> DataFrame:
    """Source rows that are new or newer than the target row they match."""
    known = (
        target.select(*keys, newer_by)
        .join(touched.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.max(newer_by).alias("_target_ts"), F.lit(True).alias("_known"))
    )
    wins = F.col("_known").isNull() | F.coalesce(F.col(newer_by) > F.col("_target_ts"), F.lit(False))
    return join_splittable(source, known, keys, "left").where(wins).select(*target.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], newer_by: str | None = None, prune: bool = False, placed_by: str | None = None) -> DataFrame:
    """The target after merging ``source``: matched rows are replaced, the others inserted.

    With ``newer_by`` a matched row is replaced only by a source row whose ``newer_by`` is greater;
    an equal or null one leaves the target as it is. With ``prune`` target rows that a bitmap of the source's keys excludes
    go past the join: for a source whose keys are too many to broadcast but few beside the target's. The target is then read twice.
    ``placed_by`` names a column that follows from the keys: where both sides were shuffled by it and some of the keys, no row moves.
    """
    source = source.select(*target.columns)
    if placed_by:
        if newer_by or prune:
            raise ValueError("placed_by goes with neither newer_by nor prune")
        return _upsert_in_place(target, source, [*keys, placed_by])
    if prune:
        perhaps, untouched = split_by_keys(target, source, keys)
        return upsert(perhaps, source, keys, newer_by).unionByName(untouched)
    touched = _source_keys(source, keys, newer_by)
    kept = _untouched(target, touched, keys, newer_by)
    incoming = _winners(target, source, touched, keys, newer_by) if newer_by else source
    return kept.unionByName(incoming)


def _upsert_in_place(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One window over both sides in place of a join, which would shuffle them by all the keys."""
    rows = target.withColumn(_SOURCE, F.lit(0)).unionByName(source.withColumn(_SOURCE, F.lit(1)))
    matches = F.when(_keyed(keys), F.sum(_SOURCE).over(Window.partitionBy(*keys))).otherwise(0)
    clash = F.raise_error(F.lit("upsert: more than one source row matches a target row"))
    stays = F.when(F.col(_SOURCE) == 1, True).when(F.col(_N) > 1, clash.cast("boolean")).otherwise(F.col(_N) == 0)
    return rows.withColumn(_N, matches).where(stays).select(*target.columns)


def replace_groups(target: DataFrame, recomputed: DataFrame, affected: DataFrame, keys: list[str]) -> DataFrame:
    """Aggregates after their inputs changed: every affected group goes, the recomputed ones come.

    Unlike a merge this also removes groups whose last input row is gone.
    """
    kept = target.join(affected.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(recomputed.select(*target.columns))


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    op_col: str,
    deletes: tuple[str, ...] = ("delete",),
    marker: str | None = None,
) -> DataFrame:
    """The target after a change feed: per key only the last change counts, deletes remove the row.

    Where the target has the ``sequence`` columns, a change older than the row it meets is late and does nothing. Without
    ``marker`` a deleted row leaves nothing behind, so the feed must come in order, batch by batch. ``marker`` names a boolean
    column of the target: a deleted row stays with it true, and a late change cannot revive it; the others are the live rows.
    """
    last = keep_latest(changes.where(_keyed(keys)), keys, sequence)
    if set(sequence) <= set(target.columns):
        stored = target.where(_keyed(keys)).select(*keys, F.struct(*sequence).alias("_stored"))
        newer = last.select(*keys, F.struct(*sequence).alias("_sequence")).join(stored, keys).where("_sequence < _stored").select(*keys).distinct()
        last = last.join(newer, keys, "left_anti")
    kept = target.where(_keyed(keys)).join(last.select(*keys), keys, "left_anti").select(*target.columns).unionByName(target.where(~_keyed(keys)))
    gone = F.coalesce(F.col(op_col).isin(*deletes), F.lit(False))
    if marker:
        return kept.unionByName(last.withColumn(marker, gone).select(*target.columns))
    stays = ~gone
    return kept.unionByName(last.where(stays).select(*target.columns))


def merge_into_catalog(source: DataFrame, table: str, keys: list[str], newer_by: str | None = None) -> None:
    """The same merge as a row-level command, where the table's catalog supports those."""
    on = reduce(and_, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys])
    merge = source.alias("source").mergeInto(table, on)
    if newer_by:
        merge = merge.whenMatched(F.col(f"source.{newer_by}") > F.col(f"{table}.{newer_by}")).updateAll()
    else:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()
