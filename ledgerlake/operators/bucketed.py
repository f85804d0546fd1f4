"""Bucketed tables that take small merges without being rewritten, and join by their keys without a shuffle.

``KeyedTable`` rewrites the partitions that a merge touches. Keys that are spread over the whole table touch all of them,
however few they are. Here a merge only adds its rows, bucketed like the table, beside it; reading puts the last row per
key in place of the stored one, bucket by bucket. Folding them in rewrites the table and is the caller's to time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import keep_top
from ledgerlake.operators.tables import COMPRESSION, _dynamic_overwrite, _in_buckets
from ledgerlake.operators.upsert import upsert
from ledgerlake.session import scratch

BATCH = "_batch"
ROWS_PER_BUCKET = 1_500_000


def buckets_for(rows: int, at_least: int = 1) -> int:
    """How many buckets keep the rows of each, which one task sorts, bounded: ``at_least`` times a power of two.

    So tables of either size join without a shuffle, as :meth:`BucketedTable.grown` says. Tables in use are split by that.
    """
    buckets = at_least
    while rows > buckets * ROWS_PER_BUCKET:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """A new table of one file per bucket, sorted by key: the shuffle places rows as the bucketing does."""
    _bucketed(df.repartition(buckets, *keys), keys, buckets).saveAsTable(name)


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrameWriter:
    return df.write.format("parquet").option("compression", COMPRESSION).bucketBy(buckets, *keys).sortBy(*keys)


class BucketedTable:
    """``name`` is that of a managed table, ``<name>_changes`` that of the merged rows not yet folded in.

    Keys are unique and not null, and ``newer_by`` is not null where it is named; a merge that breaks this fails and leaves
    the table as it was. With ``newer_by`` a row gives way only to one with a greater value, else to that of any later batch.
    """

    def __init__(self, spark: SparkSession, name: str, keys: list[str], buckets: int = 64, newer_by: str | None = None):
        self.spark = spark
        self.name = name
        self.changes = f"{name}_changes"
        self.keys = keys
        self.buckets = buckets
        self.newer_by = newer_by

    def create(self, df: DataFrame) -> None:
        with _in_buckets(df.sparkSession, self.buckets):
            _bucketed(self._checked(df), self.keys, self.buckets).saveAsTable(self.name)
        columns = self.spark.table(self.name).withColumn(BATCH, F.lit(0).cast("bigint")).limit(0)
        _bucketed(columns, self.keys, self.buckets).partitionBy(BATCH).saveAsTable(self.changes)

    def merge(self, source: DataFrame, batch: int) -> None:
        """Upsert by key. ``batch`` numbers the merge, as a stream does; repeating it writes over what it wrote before."""
        columns = self.spark.table(self.name).columns
        rows = self._checked(source.select(*columns)).withColumn(BATCH, F.lit(batch).cast("bigint"))
        with _dynamic_overwrite(self.spark), _in_buckets(rows.sparkSession, self.buckets):
            rows.write.mode("overwrite").insertInto(self.changes)

    def read(self) -> DataFrame:
        """The stored rows stay where they are in every join of this; only merged rows are ever shuffled."""
        changes = self.spark.table(self.changes)
        order = [F.col(self.newer_by).desc(), F.col(BATCH)] if self.newer_by else [F.col(BATCH).desc()]
        last = keep_top(changes, self.keys, order, 1).drop(BATCH)
        return upsert(self.spark.table(self.name), last, self.keys, self.newer_by)

    def fold(self) -> None:
        """Write the merged rows into the table. Broken off, it is mended by folding again, which applies them once more."""
        path = scratch(self.spark, "folded")
        batches = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.changes}").collect()]
        self.read().write.parquet(path)
        rows = self.spark.read.schema(self.spark.table(self.name).schema).parquet(path)
        rows.repartition(self.buckets, *self.keys).write.insertInto(self.name, overwrite=True)
        for batch in batches:
            self.spark.sql(f"ALTER TABLE {self.changes} DROP IF EXISTS PARTITION ({batch})")
        self.spark.catalog.refreshTable(self.name)
        self.spark.catalog.refreshTable(self.changes)

    def grown(self, name: str, times: int = 2) -> BucketedTable:
        """A copy under another name with ``times`` as many buckets: each is split, none mixed with another.

        The hash of a key modulo n is also that modulo ``times * n`` taken modulo n, so that both tables still join
        without a shuffle where ``spark.sql.bucketing.coalesceBucketsInJoin.enabled`` is set.
        """
        other = BucketedTable(self.spark, name, self.keys, self.buckets * times, self.newer_by)
        other.create(self.read())
        return other

    def _checked(self, df: DataFrame) -> DataFrame:
        """The rows, grouped by key to see that none is there twice; written :func:`_in_buckets`, that places them too."""
        wrong = F.count(F.lit(1)).over(Window.partitionBy(*self.keys)) > 1
        for c in [*self.keys, *([self.newer_by] if self.newer_by else [])]:
            wrong = wrong | F.col(c).isNull()
        clash = F.raise_error(F.lit("merge: a key is null or there twice, or what tells newer rows is null"))
        return df.withColumn("_wrong", wrong).where(F.when(F.col("_wrong"), clash.cast("boolean")).otherwise(True)).drop("_wrong")
