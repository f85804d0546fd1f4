"""Late changes told apart from fresh ones by a state that holds the last sequence of each key, and expires."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LATE = "late"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as timers need, and look at timers when changes come.

    With batches for timers alone a query that takes what is there would never end.
    """
    before = {key: spark.conf.get(key) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class _LastSequence(StatefulProcessor):
    def __init__(self, sequence: str, stored: T.StructType, idle_ms: int) -> None:
        self.sequence, self.stored, self.idle_ms = sequence, stored, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.stored)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        before, seen = self.last.get() if self.last.exists() else (None, now)
        if now - seen >= self.idle_ms:  # timers are run after the batch's changes
            before = None
        newest = before
        for row in rows:
            value = row[self.sequence]
            if newest is None or value > newest:
                newest = value
            yield Row(**row.asDict(), **{LATE: before is not None and value <= before})
        self.last.update((newest, now))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def mark_late(stream: DataFrame, keys: list[str], sequence: str, idle_ms: int) -> DataFrame:
    """Every change with ``late``: whether an earlier batch had one of its key with the same or a greater sequence.

    No change is lost: late ones are there to be written to an output of their own, or merged by newer-wins. The state is one
    sequence and one timer per key, and goes when the key was quiet for ``idle_ms`` (wall clock: with event time Spark would
    drop what is behind the watermark). A change of a key whose state is gone counts as fresh, so whatever takes the fresh
    ones still has to compare with what it stores. Changes without key or sequence have no order: late is null.
    Within a batch all changes newer than the state are fresh. Start the query inside :func:`timed_state`.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField(LATE, T.BooleanType())])
    stored = T.StructType([stream.schema[sequence], T.StructField("_seen", T.LongType())])
    ordered = reduce(and_, [F.col(c).isNotNull() for c in [*keys, sequence]])
    # rows, not pandas frames: those would turn whole numbers with nulls among them into floats
    marked = stream.where(ordered).groupBy(*keys).transformWithState(
        _LastSequence(sequence, stored, idle_ms), schema, "append", "processingTime"
    )
    return marked.unionByName(stream.where(~ordered).withColumn(LATE, F.lit(None).cast("boolean")))
