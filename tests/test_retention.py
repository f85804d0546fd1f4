from datetime import datetime

from support import plan, values

from ledgerlake import operators as op

LOG = "table_name string, table_class string, snapshot_id int, committed_at timestamp_ntz"


def test_cutoff_minimum_and_class_policy(spark):
    days = [datetime(2024, 1, d) for d in (1, 2, 3, 4, 5, 30)]
    rows = [(t, c, i, ts) for t, c in (("a", "raw"), ("g", "gold")) for i, ts in enumerate(days)]
    log = spark.createDataFrame(rows, LOG)
    due = op.snapshots_to_expire(log, "2024-02-05", class_col="table_class")
    assert values(due.select("table_name", "snapshot_id")) == [("a", 0), ("a", 1), ("a", 2)]
    due = op.snapshots_to_expire(log, "2024-06-01", class_col="table_class")
    assert values(due.select("table_name", "snapshot_id")) == [("a", 0), ("a", 1), ("a", 2), ("g", 0)]
    assert "WindowGroupLimit" in plan(due)


def test_orphans_are_unreferenced_and_old(spark):
    listing = spark.createDataFrame(
        [("f1", datetime(2024, 1, 1)), ("f2", datetime(2024, 1, 1)), ("f3", datetime(2024, 1, 9))],
        "path string, modified_at timestamp_ntz",
    )
    referenced = spark.createDataFrame([("f1",)], "path string")
    assert values(op.orphan_files(listing, referenced, "2024-01-10").select("path")) == [("f2",)]


def test_compaction_plan(spark):
    listing = spark.createDataFrame([("d1", 10), ("d1", 10), ("d1", 5), ("d2", 90)], "day string, bytes bigint")
    assert values(op.compaction_plan(listing, "day", target_bytes=20)) == [("d1", 3, 25, 2, True), ("d2", 1, 90, 5, False)]
