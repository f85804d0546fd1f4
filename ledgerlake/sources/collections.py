"""Collection scans, lookups, counts and high-water-mark increments."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_collection(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a collection through whichever connector serves ``fmt``; the scan is parallel and lazy."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load()


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The document with this key; equality reaches the file scan."""
    return df.where(F.col(key) == F.lit(value)).limit(1)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One ``(table_name, row_count)`` row per table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def since_mark(df: DataFrame, mark_col: str, mark: Column | None, inclusive: bool = False) -> DataFrame:
    """Rows after the mark of the last run; every row if there was none.

    An increasing unique id is read strictly after its mark. Event times can tie, so read those
    with ``inclusive`` and let the upsert absorb the rows seen twice.
    """
    if mark is None:
        return df
    return df.where(F.col(mark_col) >= mark if inclusive else F.col(mark_col) > mark)


def next_mark(df: DataFrame, mark_col: str) -> DataFrame:
    """The mark to keep once the load of ``df`` is committed."""
    return df.agg(F.max(mark_col).alias("mark"))


class MarkStore:
    """Marks of finished loads in a small append-only table; write a mark after its load commits."""

    _schema = "collection string, run bigint, mark string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(self._schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._schema)

    def _last(self, collection: str):
        return (
            self._rows()
            .where(F.col("collection") == collection)
            .agg(F.max("run").alias("run"), F.max_by("mark", "run").alias("mark"))
            .first()
        )

    def get(self, collection: str, dtype: str = "string") -> Column | None:
        mark = self._last(collection).mark
        return None if mark is None else F.lit(mark).cast(dtype)

    def put(self, collection: str, mark) -> None:
        run = (self._last(collection).run or 0) + 1
        self.spark.createDataFrame([(collection, run, str(mark))], self._schema).coalesce(1).write.mode(
            "append"
        ).parquet(self.path)
