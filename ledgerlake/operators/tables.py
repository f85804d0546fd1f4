"""Keyed Parquet tables in the session's catalog, written by Spark's own commands: create, append, reload, merge.

Where a catalog has row-level commands, use :func:`ledgerlake.operators.upsert.merge_into_catalog`. Here a merge rewrites
the partitions it can change by a dynamic partition overwrite, which puts files in their place after all are written. Where it
may empty partitions, what they become is landed in the shared folder first, to know which. A merge that was broken off is
mended by repeating it. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.dedup import split_null_keys
from ledgerlake.operators.upsert import replace_groups, upsert
from ledgerlake.session import scratch

BUCKET = "_bucket"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_PARTITIONS = "spark.sql.shuffle.partitions"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForDistribution"
COMPRESSION = "zstd"


@contextmanager
def _settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (``__`` for the dots) for as long as something is written."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _dynamic_overwrite(spark: SparkSession):
    return _settings(spark, **{_OVERWRITE: "dynamic"})


def _in_buckets(spark: SparkSession, buckets: int):
    """Shuffles go by all their keys, into a multiple of ``buckets``, so that a partition by the keys holds rows of one bucket.

    What is grouped by the keys within this is fit to be written in buckets, and rows that were shuffled by them for a
    deduplication are not shuffled again. Partitions are no fewer than the session has.
    """
    partitions = str(-(-int(spark.conf.get(_PARTITIONS)) // buckets) * buckets)
    return _settings(spark, **{_PARTITIONS: partitions, _INITIAL: partitions, _ALL_KEYS: "true"})


def _literal(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class KeyedTable:
    """``name`` is that of a managed table. Without ``partition_by`` it is partitioned by a hash of its keys.

    ``buckets`` is the number of such partitions, the same for the table's life; give a large table more. Each of them is also a
    bucket, so a merge moves neither the rows of the table nor those of a source that was deduplicated by the keys. Tables whose
    partitions are no buckets, as they were made before, stay so. Empty text in a partition column counts as null, as Spark stores it.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        keys: list[str],
        partition_by: str | list[str] | None = None,
        buckets: int = 64,
    ):
        self.spark = spark
        self.name = name
        self.keys = keys
        columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        self.hashed = not columns
        self.partition_by = columns or [BUCKET]
        self.buckets = buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows.drop(BUCKET) if self.hashed else rows

    def append(self, df: DataFrame, balanced: bool = True) -> None:
        """Create the table or add rows to it; columns resolve by name."""
        self._save(self._placed(df), "append", balanced)

    def reload(self, df: DataFrame, balanced: bool = True) -> None:
        """Create the table or replace it whole."""
        self._save(self._placed(df), "overwrite", balanced)

    def replace_partitions(self, df: DataFrame, balanced: bool = True) -> None:
        """Create the table, or write over the partitions that the rows go to; the others stay. Repeating it changes nothing.

        Rows that all go to one partition need not be ``balanced``, which shuffles them: each task has one file.
        """
        if not self.exists():
            self.append(df, balanced)
            return
        placed = self._placed(df).select(*self.spark.table(self.name).columns)
        with _dynamic_overwrite(self.spark):
            (self._balanced(placed) if balanced else placed).write.mode("overwrite").insertInto(self.name)

    def merge(self, source: DataFrame, newer_by: str | None = None) -> None:
        """Upsert by key. A row whose partition value changes leaves its old partition, which is rewritten too."""
        if not self.exists():  # nothing to match
            rows = self._placed(source)
            self._save(self._clustered(rows) if self.hashed else rows, "append", balanced=not self.hashed)
            return
        with self._dropped():
            incoming = self._landed(self._placed(source), "incoming")
            stays = self._in_buckets() and newer_by is None
            change = lambda target: self._merged(target, incoming) if stays else upsert(target, incoming, self.keys, newer_by)
            self._rewrite(incoming, incoming, self.keys, change, stays)

    def replace_groups(self, recomputed: DataFrame, affected: DataFrame, keys: list[str]) -> None:
        """Every affected group goes and the recomputed ones come, within the partitions that hold either."""
        if not self.exists():
            self.append(recomputed)
            return
        with self._dropped():
            incoming = self._landed(self._placed(recomputed), "incoming")
            groups = self._landed(affected.select(*keys).distinct(), "affected")
            self._rewrite(incoming, groups, keys, lambda target: replace_groups(target, incoming, groups, keys))

    def _placed(self, df: DataFrame) -> DataFrame:
        if self.hashed:
            place = F.hash if self._in_buckets() else F.xxhash64  # Spark places rows in buckets by the former
            return df.withColumn(BUCKET, F.pmod(place(*self.keys), F.lit(self.buckets)).cast("int"))
        texts = [c for c in self.partition_by if isinstance(df.schema[c].dataType, T.StringType)]
        return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in texts}) if texts else df

    def _in_buckets(self) -> bool:
        return self.hashed and (not self.exists() or any(c.isBucket for c in self.spark.catalog.listColumns(self.name)))

    def _clustered(self, df: DataFrame) -> DataFrame:
        """The same rows, grouped by key; written :func:`_in_buckets`, that places them. Rows with null keys meet, as they are one bucket."""
        there = F.count(F.lit(1)).over(Window.partitionBy(*self.keys))
        return df.withColumn("_there", there).where("_there > 0").drop("_there")

    def _merged(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """:func:`upsert` of rows in buckets, none of which moves: what comes clustered is so in the result. Null keys match nothing."""
        (stored, others), (incoming, new) = (split_null_keys(df, self.keys) for df in (target, source))
        merged = upsert(self._clustered(stored), self._clustered(incoming), self.keys)
        return merged.unionByName(others).unionByName(new)

    def _writer(self, df: DataFrame, bucketed: bool) -> DataFrameWriter:
        writer = df.write.format("parquet").option("compression", COMPRESSION)
        return writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys) if bucketed else writer

    def _writing(self, df: DataFrame, bucketed: bool):
        # a stream's batches have a session of their own
        return _in_buckets(df.sparkSession, self.buckets) if bucketed else nullcontext()

    def _balanced(self, df: DataFrame) -> DataFrame:
        """Rebalancing splits a hot partition over several files and merges small ones."""
        return df.hint("rebalance", *map(F.col, self.partition_by))

    def _save(self, df: DataFrame, mode: str, balanced: bool = True) -> None:
        bucketed = self._in_buckets()
        writer = self._writer(self._balanced(df) if balanced else df, bucketed).mode(mode).partitionBy(*self.partition_by)
        with self._writing(df, bucketed):
            writer.saveAsTable(self.name)

    def _landed(self, df: DataFrame, name: str) -> DataFrame:
        """The rows as files, in buckets like those of the table if they have its keys."""
        path = scratch(self.spark, name)
        if not (self._in_buckets() and {BUCKET, *self.keys} <= set(df.columns)):
            df.write.option("compression", COMPRESSION).parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)
        beside = f"{self.name}_{name}_{uuid.uuid4().hex[:12]}"
        self._beside.append(beside)
        with self._writing(df, True):
            self._writer(self._clustered(df), True).option("path", path).saveAsTable(beside)
        return self.spark.table(beside)

    @contextmanager
    def _dropped(self) -> Iterator[None]:
        """Bucketed files need a name in the catalog, which goes when they are merged; the files stay, as all that is landed."""
        self._beside = []
        try:
            yield
        finally:
            for name in self._beside:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _same_partition(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(and_, [left[c].eqNullSafe(right[c]) for c in self.partition_by])

    def _within(self, touched: DataFrame, column: str) -> Column:
        """A filter that prunes partitions. Its values are fewer than the table's partitions, which the catalog lists."""
        values = [r[0] for r in touched.select(column).distinct().collect()]
        inside = F.col(column).isin([v for v in values if v is not None])
        return inside | F.col(column).isNull() if None in values else inside

    def _rewrite(
        self, incoming: DataFrame, changed: DataFrame, keys: list[str], change: Callable[[DataFrame], DataFrame], stays: bool = False
    ) -> None:
        """``stays``: what ``change`` makes is placed in buckets already."""
        parts, table, bucketed = self.partition_by, self.spark.table(self.name), self._in_buckets()
        touched = incoming.select(*parts)
        moves = not self.hashed or keys != self.keys
        if moves:  # else the keys name their partition
            now = table.select(*dict.fromkeys([*keys, *parts])).join(changed.select(*keys).distinct(), keys, "left_semi")
            touched = touched.union(now.select(*parts))
        touched = self._landed(touched.distinct(), "touched")
        target = table.where(reduce(and_, [self._within(touched, c) for c in parts]))
        if len(parts) > 1:
            target = target.join(touched, self._same_partition(target, touched), "left_semi")
        after = (self._landed(change(target), "after") if moves else change(target)).select(*table.columns)
        after = after if stays else self._balanced(after)
        with _dynamic_overwrite(self.spark), self._writing(after, bucketed):
            after.write.mode("overwrite").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        if not moves:  # a key stays where it was, so no partition is emptied
            return
        filled = after.select(*parts).distinct()
        emptied = touched.join(filled, self._same_partition(touched, filled), "left_anti")
        for row in emptied.select(*[F.col(c).cast("string") for c in parts]).collect():
            spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(parts, row, strict=True))
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.name)
