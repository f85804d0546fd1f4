"""Versions of a dimension: validity intervals, and facts with the attributes that were valid at their time."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import keep_latest

_AT, _RANGE, _KIND, _VALUE, _FACT = "_at", "_range", "_kind", "_value", "_fact"


def validity(history: DataFrame, keys: list[str], since: str, attributes: list[str]) -> DataFrame:
    """The versions of each key with ``valid_from`` and ``valid_to`` (null while it holds), oldest load first.

    Loads that change no attribute make no version; of several loads at one time one counts, by a total order. Rows without a key
    or a time are left out.
    """
    known = history.where(reduce(and_, [F.col(c).isNotNull() for c in [*keys, since]])).select(*keys, since, *attributes)
    once = keep_latest(known, [*keys, since], [])
    by_time = Window.partitionBy(*keys).orderBy(since)
    value = F.struct(*attributes)
    changed = once.withColumn("_new", (F.row_number().over(by_time) == 1) | ~F.lag(value).over(by_time).eqNullSafe(value))
    begun = changed.where("_new").drop("_new")
    return begun.withColumn("valid_to", F.lead(since).over(by_time)).select(*keys, *attributes, F.col(since).alias("valid_from"), "valid_to")


def as_of(facts: DataFrame, history: DataFrame, keys: list[str], at: str, since: str, attributes: dict[str, str], unit: str = "month", spread: str | None = None) -> DataFrame:
    """``facts`` with the ``attributes`` (name there: name here) of their key that were valid at their time ``at``.

    Facts and versions are put in one order of time, in which the last version is carried on to the facts after it; a version
    from the very time of a fact counts. That is done apart for each ``unit`` of time, so that a key with a third of all facts
    is spread over as many tasks as it has units; what was valid when a unit begins is worked out from the versions and
    the units of a key alone. Facts without a key or a time, or before the first version, have nulls.

    ``spread`` names a column of the facts, never null, by which facts of one key are apart instead of by units of time. Facts that were
    shuffled by the keys and it are not shuffled again; the versions of a key go to each of its values, so it should have few but for hot keys.
    """
    versions = validity(history, keys, since, list(attributes)).select(*keys, F.col("valid_from").cast("timestamp").alias(_AT), F.struct(*attributes).alias(_VALUE))
    if spread:
        return _as_of_spread(facts, versions, keys, at, attributes, spread)
    whole = F.struct(*facts.columns).alias(_FACT)
    placed = facts.select(*keys, F.col(at).cast("timestamp").alias(_AT), whole).withColumn(_RANGE, F.date_trunc(unit, _AT))
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, _AT]])
    inside = placed.where(known)
    none = F.lit(None).cast(versions.schema[_VALUE].dataType).alias(_VALUE)
    begins = inside.select(*keys, F.col(_RANGE).alias(_AT)).distinct().select(*keys, _AT, none, F.lit(1).alias(_KIND))
    # a unit begins after the versions from its first moment
    carried = Window.partitionBy(*keys).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    first = versions.select(*keys, _AT, _VALUE, F.lit(0).alias(_KIND)).unionByName(begins).withColumn(_VALUE, F.last(_VALUE, True).over(carried))
    first = first.where(F.col(_KIND) == 1).select(*keys, F.col(_AT).alias(_RANGE), _AT, _VALUE, F.lit(0).alias(_KIND))
    later = versions.select(*keys, F.date_trunc(unit, _AT).alias(_RANGE), _AT, _VALUE, F.lit(0).alias(_KIND))
    no_fact = F.lit(None).cast(placed.schema[_FACT].dataType).alias(_FACT)
    rows = inside.select(*keys, _RANGE, _AT, none, F.lit(2).alias(_KIND), _FACT)
    for part in (first, later):
        rows = rows.unionByName(part.select("*", no_fact))
    order = Window.partitionBy(*keys, _RANGE).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    valued = rows.withColumn(_VALUE, F.last(_VALUE, True).over(order)).where(F.col(_KIND) == 2)
    found = valued.select(_FACT, _VALUE).unionByName(placed.where(~F.coalesce(known, F.lit(False))).select(_FACT, none))
    return found.select(f"{_FACT}.*", *[F.col(_VALUE).getField(a).alias(name) for a, name in attributes.items()])


def _as_of_spread(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, attributes: dict[str, str], spread: str) -> DataFrame:
    # facts keep their columns, each once, by which Spark knows that both sides of the union are shuffled alike
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, at]])
    none = F.lit(None).cast(versions.schema[_VALUE].dataType)
    inside = facts.where(known)
    everywhere = versions.join(inside.select(*keys, spread).distinct(), keys).repartition(*keys, spread)
    rows = inside.withColumns({_AT: F.col(at).cast("timestamp"), _VALUE: none, _KIND: F.lit(2)})
    rows = rows.unionByName(everywhere.withColumn(_KIND, F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy(*keys, spread).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    valued = rows.withColumn(_VALUE, F.last(_VALUE, True).over(order)).where(F.col(_KIND) == 2)
    found = valued.select(*facts.columns, _VALUE).unionByName(facts.where(~known).withColumn(_VALUE, none))
    return found.select(*facts.columns, *[F.col(_VALUE).getField(a).alias(name) for a, name in attributes.items()])
