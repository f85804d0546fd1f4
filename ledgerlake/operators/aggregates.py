"""Totals, per-document metrics, profiles, rolling sums and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import to_money
from ledgerlake.specs import MONEY


def money_totals(df: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """``total_<amount>`` per group, null amounts counting as zero; exact decimals."""
    zero = F.lit(0).cast(MONEY)
    return df.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(a), zero)).cast(MONEY).alias(f"total_{a}") for a in amounts]
    )


def count_by(df: DataFrame, keys: list[str], counted: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(counted).alias(out))


def count_distinct(df: DataFrame, keys: list[str], counted: str, out: str, approximate: bool = False) -> DataFrame:
    """Exact by default; ``approximate`` keeps a fixed-size sketch per group."""
    f = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(f(counted).alias(out))


def document_metrics(df: DataFrame, lines_col: str, amount: str, item: str, sample: int = 5) -> DataFrame:
    """Total, line count, distinct items and the first items of each document's own lines.

    One document per key is assumed (keep the latest first), so the metrics are functions of one
    row: nothing is exploded and nothing is shuffled. Documents without lines are dropped, as
    exploding them would.
    """
    lines = F.col(lines_col)
    amounts = F.array_compact(F.transform(lines, lambda x: to_money(x.getField(amount))))
    total = F.aggregate(amounts, F.lit(0).cast("decimal(28,2)"), lambda acc, x: (acc + x).cast("decimal(28,2)"))
    items = F.array_distinct(F.array_compact(F.transform(lines, lambda x: x.getField(item))))
    return (
        df.where(F.size(lines) > 0)
        .withColumn("_items", items)
        .select(
            *[c for c in df.columns if c not in (lines_col, "total_amount")],
            F.when(F.size(amounts) > 0, total.cast(MONEY)).alias("total_amount"),
            F.size(lines).cast("bigint").alias("line_count"),
            F.size("_items").cast("bigint").alias("distinct_item_count"),
            F.slice(F.array_sort("_items"), 1, sample).alias("first_items"),
        )
    )


def joined_names(df: DataFrame, keys: list[str], name: str, out: str, sep: str = ", ") -> DataFrame:
    """The distinct names of a group, sorted, as one text. Duplicates go before anything is collected."""
    pairs = df.select(*keys, name).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(name)), sep).alias(out))


def stack_roles(df: DataFrame, roles: dict[str, tuple[Column, Column]], who: str, value: str) -> DataFrame:
    """One row per filled role, from a single pass: ``roles`` maps a role to its (holder, value)."""
    entries = F.array(
        *[F.struct(F.lit(r).alias("role"), h.alias(who), v.alias(value)) for r, (h, v) in roles.items()]
    )
    return df.select(F.explode(entries).alias("_r")).select("_r.*").where(F.col(who).isNotNull())


def profile(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """count, mean, stddev, min and max per column, in long form, from one aggregation.

    Text, dates and the like have no mean or stddev; where such a column is among them, min and max are text.
    """
    numeric = {c: isinstance(df.schema[c].dataType, T.NumericType) for c in columns}
    as_text = not all(numeric.values())
    stats = []
    for c in columns:
        x = F.col(c).cast("double") if numeric[c] else F.lit(None).cast("double")
        low, high = (f(c).cast("string") if as_text else f(x) for f in (F.min, F.max))
        stats += [
            F.count(c).alias(f"{c}__n"),
            F.round(F.avg(x), digits).alias(f"{c}__mean"),
            F.round(F.stddev_samp(x), digits).alias(f"{c}__stddev"),
            low.alias(f"{c}__min"),
            high.alias(f"{c}__max"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__n").alias("row_count"),
                *[F.col(f"{c}__{s}").alias(s) for s in ("mean", "stddev", "min", "max")],
            )
            for c in columns
        ]
    )
    return df.agg(*stats).select(F.explode(rows).alias("_p")).select("_p.*")


def month_index(day: Column) -> Column:
    """Months since year 0, so that a range frame sees missing months as gaps."""
    return (F.year(day) * 12 + F.month(day)).cast("bigint")


def rolling_months(df: DataFrame, who: str, index: str, value: str, months: int, out: str) -> DataFrame:
    """Sum of ``value`` over the last ``months`` calendar months of each holder.

    Give it monthly totals: a holder then has one row per month, whatever the number of sales.
    """
    w = Window.partitionBy(who).orderBy(index).rangeBetween(-(months - 1), 0)
    return df.withColumn(out, F.sum(value).over(w))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The k first rows overall; each task keeps k of its own before they are merged."""
    return df.orderBy(*order).limit(k)
