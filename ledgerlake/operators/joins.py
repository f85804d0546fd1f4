"""Joins of facts, which may have hot keys, with one row per key.

No side is hinted to be broadcast: Spark broadcasts one when its own size estimate, or under AQE its
measured shuffle size, is below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise sorts both.
The fact is always the left side, which AQE may split where one key is hot, given two conditions:

- Both inputs come straight from a shuffle made for the join. A right side that was just deduplicated
  by the join key is partitioned by it already, so Spark would join it in the same stage and AQE
  could split nothing; :func:`join_splittable` prevents that.
- No later operator relies on the join's partitioning. So deduplicate or aggregate the fact *before*
  enriching it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import keep_latest


def join_splittable(fact: DataFrame, unique: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join a fact with one row per key such that AQE can split a hot key of the fact.

    The digest of the keys, as one more join key, changes no match. It makes Spark shuffle the unique
    side, which is narrow and small beside the fact, once more by keys and digest.
    """
    digest = F.xxhash64(*on)
    joined = fact.withColumn("_digest", digest).join(unique.withColumn("_digest", digest), [*on, "_digest"], how)
    added = [c for c in unique.columns if c not in on] if how not in ("left_semi", "left_anti") else []
    return joined.select(*fact.columns, *added)


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    attributes: Mapping[str, str],
    latest_by: list[str] | None = None,
    tie_break: list[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Attach ``attributes`` (dimension column -> output name) to each fact row.

    The dimension is first reduced to one row per key, so an append-only dimension that was loaded
    several times does not multiply the fact.
    """
    narrow = dim.select(on, *attributes, *[c for c in (latest_by or []) if c not in attributes])
    unique = keep_latest(narrow, [on], latest_by or [], tie_break)
    return join_splittable(fact, unique.select(on, *[F.col(s).alias(d) for s, d in attributes.items()]), [on], how)


def only_known(fact: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Fact rows whose key ``known`` has: an inner join that needs no attribute."""
    return join_splittable(fact, known.select(on).distinct(), [on], "left_semi")
