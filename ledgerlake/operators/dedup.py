"""Keep-latest and its relatives. Every order is total, so results do not depend on partitioning.

``row_number() <= n`` becomes a partial and a final WindowGroupLimit: each map task keeps at most n
rows per key before the shuffle, so a key that holds a third of the input still reaches its reducer
as n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank"


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _descending(df: DataFrame, name: str) -> Column:
    c = F.to_json(name) if _holds_map(df.schema[name].dataType) else F.col(name)
    return c.desc_nulls_last()


def total_order(df: DataFrame, keys: list[str], latest_by: list[str], tie_break: list[str] | None) -> list[Column]:
    """Latest first; ties fall to ``tie_break``, or to every other column when that is None."""
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in keys and c not in latest_by]
    return [_descending(df, c) for c in [*latest_by, *rest]]


def keep_top(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in the given (total) order; ``rank`` names a column for the place."""
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank or _RANK
    top = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return top if rank else top.drop(name)


def keep_latest(
    df: DataFrame, keys: list[str], latest_by: list[str], tie_break: list[str] | None = None
) -> DataFrame:
    """One row per key: the latest by ``latest_by``, nulls last."""
    return keep_top(df, keys, total_order(df, keys, latest_by, tie_break), 1)


def dedup_subset(df: DataFrame, subset: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """``dropDuplicates(subset)`` with a defined survivor."""
    return keep_latest(df, subset, [], tie_break)


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(keyed, unkeyed)``: a row without its key can be neither deduplicated nor merged."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.where(~missing), df.where(missing)


def state_as_of(
    history: DataFrame, keys: list[str], ts_col: str, as_of, tie_break: list[str] | None = None
) -> DataFrame:
    """The state an append-only history describes at ``as_of``; the time filter reaches the scan."""
    bound = F.lit(as_of).cast(history.schema[ts_col].dataType)
    return keep_latest(history.where(F.col(ts_col) <= bound), keys, [ts_col], tie_break)


def canonical_attribute(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """One spelling per key: the first in order. ``min`` combines before the shuffle."""
    return df.groupBy(key).agg(F.min(attribute).alias(attribute))
