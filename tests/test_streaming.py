from datetime import datetime, timedelta

import pytest
from support import values

from ledgerlake.operators import KeyedTable, apply_changes
from ledgerlake.session import scratch, scratch_database
from ledgerlake.streaming import append_stream, dedup_stream, mark_late, sync_stream, timed_state
from ledgerlake.streaming.changes import live_rows

DDL = "k int, seq int, op string, v string, at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def change(k, seq, op="upsert"):
    return (k, seq, op, f"{k}-{seq}", T0 + timedelta(minutes=seq))


# batches arrive out of order: the delete of 2 and the last value of 1 come before older changes
BATCHES = [
    [change(1, 1), change(2, 2), change(1, 9)],
    [change(2, 8, "delete"), change(3, 3), (None, 12, "upsert", "lost", T0)],
    [change(2, 5), change(1, 4), change(3, 6), change(3, 7, "delete"), change(4, 10)],
]


@pytest.fixture
def feed(spark):
    path = scratch(spark, "test-feed")
    for batch in BATCHES:
        spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(path)


def test_synced_table_equals_the_whole_feed_and_replays_are_harmless(spark, feed):
    table = KeyedTable(spark, f"{scratch_database(spark, 'state')}.t", ["k"], buckets=3)
    sync_stream(stream(spark, feed), table, "seq", "op", scratch(spark, "cp"), "s").awaitTermination()
    expected = [(1, 9, "1-9"), (4, 10, "4-10")]
    assert values(live_rows(table).select("k", "seq", "v")) == expected
    everything = spark.read.schema(DDL).parquet(feed)
    batch = apply_changes(everything.limit(0), everything, ["k"], ["seq"], "op")
    assert values(batch.select("k", "seq", "v")) == expected
    # a lost checkpoint replays all batches, which changes nothing
    sync_stream(stream(spark, feed), table, "seq", "op", scratch(spark, "cp"), "s").awaitTermination()
    assert values(live_rows(table).select("k", "seq", "v")) == expected


def test_raw_log_and_resume(spark, feed):
    path, checkpoint = scratch(spark, "log"), scratch(spark, "log-cp")
    append_stream(stream(spark, feed), path, checkpoint, "op").awaitTermination()
    spark.createDataFrame([change(5, 11)], DDL).write.mode("append").parquet(feed)
    append_stream(stream(spark, feed), path, checkpoint, "op").awaitTermination()
    assert spark.read.parquet(path).count() == sum(map(len, BATCHES)) + 1


def test_redelivered_changes_pass_once(spark, feed):
    path = scratch(spark, "once")
    twice = stream(spark, feed).union(stream(spark, feed))
    append_stream(dedup_stream(twice, ["seq"], "at", "1 day"), path, scratch(spark, "once-cp")).awaitTermination()
    rows = spark.read.parquet(path)
    assert rows.count() == rows.select("seq").distinct().count() == sum(map(len, BATCHES))


def test_a_late_change_is_not_lost(spark):
    path, out = scratch(spark, "late-feed"), scratch(spark, "late")
    days = [[61], [1], [62, 1]]  # the change of day 1 comes when the feed is two months on, and once more after that
    for batch in days:
        rows = [(1, d, "upsert", "v", T0 + timedelta(days=d)) for d in batch]
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)
    append_stream(dedup_stream(stream(spark, path), ["seq"], "at"), out, scratch(spark, "late-cp")).awaitTermination()
    assert values(spark.read.parquet(out).select("seq")) == [(1,), (61,), (62,)]


def run_late(spark, path, out, checkpoint, idle_ms):
    with timed_state(spark):
        append_stream(mark_late(spark.readStream.schema(DDL).parquet(path), ["k"], "seq", idle_ms), out, checkpoint).awaitTermination()


def late_rows(spark, idle_ms):
    """Each batch is a run of its own, taken up from the checkpoint."""
    path, out, checkpoint = scratch(spark, "mark-feed"), scratch(spark, "marked"), scratch(spark, "mark-cp")
    batches = [*BATCHES, [change(1, 9), change(2, 11), (5, None, "upsert", None, None)]]
    for batch in batches:
        spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").parquet(path)
        run_late(spark, path, out, checkpoint, idle_ms)
    assert spark.read.parquet(out).count() == sum(map(len, batches))  # no change is lost
    return values(spark.read.parquet(out).select("k", "seq", "late"))


def test_overtaken_changes_are_told_across_restarts(spark):
    late = {(1, 4), (2, 5), (1, 9)}
    got = late_rows(spark, 3_600_000)
    assert {(k, s) for k, s, x in got if x} == late
    assert [(k, s) for k, s, x in got if x is None] == [(5, None), (None, 12)]
    assert sorted(x for k, s, x in got if (k, s) == (1, 9)) == [False, True]  # the second delivery only


def test_state_of_quiet_keys_goes(spark):
    assert not any(x for _, _, x in late_rows(spark, 1))
