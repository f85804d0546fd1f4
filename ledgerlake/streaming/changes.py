"""Change feeds with Structured Streaming: raw change log, duplicate removal, upsert into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ledgerlake.operators.dedup import keep_latest, split_null_keys
from ledgerlake.operators.tables import KeyedTable

DELETED = "_deleted"


def dedup_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str | None = None) -> DataFrame:
    """Drop re-delivered changes.

    Without ``delay`` no change is lost, however late, and the state keeps every key for good: some dozens of bytes
    each, so give a long feed the RocksDB state store. With ``delay`` state is freed, and a change that comes later
    than ``delay`` behind the newest one is dropped: use it only where the feed rules that out or such changes reach
    the table another way.
    """
    if delay is None:
        return stream.dropDuplicates(keys)
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, **trigger
) -> StreamingQuery:
    """Land changes as they come. By default takes what is there and ends; pass ``processingTime`` to keep on."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def sync_stream(
    changes: DataFrame,
    table: KeyedTable,
    sequence: str,
    op_col: str,
    checkpoint: str,
    name: str,
    deletes: tuple[str, ...] = ("delete",),
    **trigger,
) -> StreamingQuery:
    """Keep ``table`` equal to the last change per key, whatever order and batches the changes come in.

    A batch is reduced to its last change per key and merged if that is newer than what the table
    has; only the partitions of its keys are rewritten. Deleted rows stay as markers (``_deleted``), so that a late
    change cannot revive them; read the table through :func:`live_rows`. A replayed batch changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        keyed, _ = split_null_keys(batch, table.keys)
        last = keep_latest(keyed, table.keys, [sequence])
        marked = last.withColumn(DELETED, F.coalesce(F.col(op_col).isin(*deletes), F.lit(False)))
        table.merge(marked, newer_by=sequence)

    writer = changes.writeStream.queryName(name).foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def live_rows(table: KeyedTable) -> DataFrame:
    return table.read().where(~F.col(DELETED)).drop(DELETED)
