"""Nested arrays and delimited lists to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import split_names


def explode_lines(
    df: DataFrame,
    array_col: str,
    fields: Mapping[str, str] | list[str],
    keep_empty: bool = False,
    line_no: str | None = None,
) -> DataFrame:
    """One row per array element with the chosen element fields as columns.

    Documents whose array is null or empty disappear, unless ``keep_empty``. ``line_no`` names a
    column for the position (from 1) that tells apart equal lines of one document.
    """
    wanted = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    kept = [c for c in df.columns if c != array_col]
    if line_no:
        generator = F.posexplode_outer if keep_empty else F.posexplode
        rows = df.select(*kept, generator(array_col).alias("_pos", "_line"))
        kept_cols = [*kept, (F.col("_pos") + 1).cast("bigint").alias(line_no)]
    else:
        generator = F.explode_outer if keep_empty else F.explode
        rows = df.select(*kept, generator(array_col).alias("_line"))
        kept_cols = kept
    return rows.select(*kept_cols, *[F.col(f"_line.{src}").alias(dst) for src, dst in wanted.items()])


def explode_names(df: DataFrame, list_col: str, out: str) -> DataFrame:
    """A delimited list in a string to one row per distinct member of that list."""
    names = F.array_distinct(split_names(list_col))
    return df.withColumn(out, F.explode(names)).drop(list_col)
