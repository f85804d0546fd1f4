"""Distinct counts that can be united: landed per day once, then put together over any span of days without the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKET, _BITS, _SKETCH = "bucket", "bits", "sketch"


def day_bitmaps(df: DataFrame, day: str, counted: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., day, bucket, bits) of an integer column: which of the bucket's 32768 numbers occur on the day. Exact; nulls do not count.

    A bitmap has 4 kB whatever the number of rows, so a hot day leaves every task as one row per bucket of numbers.
    """
    known = df.where(F.col(counted).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(counted)).alias(_BUCKET)
    return known.groupBy(*by, day, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(counted))).alias(_BITS))


def day_sketches(df: DataFrame, day: str, counted: str, by: tuple[str, ...] = (), lg_k: int = 14) -> DataFrame:
    """(by..., day, sketch) of a column of any type: HyperLogLog, with a standard error of about ``1.04 / sqrt(2 ** lg_k)`` (0.8 %)."""
    known = df.where(F.col(counted).isNotNull())
    return known.groupBy(*by, day).agg(F.hll_sketch_agg(F.col(counted).cast("string"), lg_k).alias(_SKETCH))


def _in_spans(daily: DataFrame, day: str, days: int) -> DataFrame:
    """Every day's row once for each span of ``days`` days, named by its last one, that it is in, if that is a day of the data."""
    ends = daily.select(F.col(day).alias("_end")).distinct()
    reach = F.explode(F.sequence(day, F.date_add(day, days - 1))).alias("_span")
    return daily.select("*", reach).join(ends, F.col("_span") == F.col("_end"), "left_semi")


def distinct_in_spans(daily: DataFrame, day: str, days: int, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., day, out): the distinct numbers of each day and the ``days - 1`` days before it, from :func:`day_bitmaps`."""
    united = _in_spans(daily, day, days).groupBy(*by, "_span", _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))
    return united.groupBy(*by, F.col("_span").alias(day)).agg(F.sum(F.bitmap_count(_BITS)).alias(out))


def estimated_in_spans(daily: DataFrame, day: str, days: int, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The same from :func:`day_sketches`, estimated."""
    return _in_spans(daily, day, days).groupBy(*by, F.col("_span").alias(day)).agg(F.hll_sketch_estimate(F.hll_union_agg(_SKETCH)).alias(out))
