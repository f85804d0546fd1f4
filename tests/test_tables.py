import pytest
from support import plan, values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlake.operators import KeyedTable
from ledgerlake.session import scratch_database

DDL = "k int, day string, v string"


@pytest.fixture
def name(spark):
    return f"{scratch_database(spark, 'test')}.t"


@pytest.fixture
def table(spark, name):
    return KeyedTable(spark, name, ["k"], "day")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def rows(table):
    return values(table.read().select("k", "day", "v"))


def partitions(spark, name):
    return sorted(r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect())


def test_merge_moves_rows_between_partitions_and_leaves_others_alone(spark, table, name):
    table.merge(frame(spark, (1, "d1", "a"), (2, "d2", "b"), (3, "d3", "c"), (4, None, "n")))
    files = lambda: {r[0] for r in table.read().where("day = 'd3' OR day IS NULL").select(F.input_file_name()).collect()}
    before = files()
    table.merge(frame(spark, (1, "d2", "A"), (5, "d5", "e")))
    assert rows(table) == sorted([(1, "d2", "A"), (2, "d2", "b"), (3, "d3", "c"), (4, None, "n"), (5, "d5", "e")], key=repr)
    assert files() == before
    assert "day=d1" not in partitions(spark, name)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("odd", ["a:b", "a/b", "50%", "it's", "back\\slash", "07", "", None])
def test_partition_values_of_any_text(spark, table, odd):
    table.merge(frame(spark, (1, odd, "old"), (2, odd, "stays"), (3, "d3", "c")))
    table.merge(frame(spark, (1, odd, "new")))
    kept = odd or None  # empty text counts as null in a partition column
    assert rows(table) == sorted([(1, kept, "new"), (2, kept, "stays"), (3, "d3", "c")], key=repr)
    table.merge(frame(spark, (1, "d3", "moved"), (2, "d3", "moved")))
    assert rows(table) == [(1, "d3", "moved"), (2, "d3", "moved"), (3, "d3", "c")]
    table.append(frame(spark, (9, odd, "again")))  # nothing that left the partition comes back
    assert table.read().count() == 4


def test_several_partition_columns_and_repeated_merge(spark, name):
    t = KeyedTable(spark, name, ["k"], ["day", "v"])
    first = frame(spark, (1, "d1", "x"), (2, "d1", "y"), (3, "d2", "x"), (4, None, None))
    change = frame(spark, (1, "d2", "y"), (4, "d1", None))
    t.merge(first)
    for _ in range(2):
        t.merge(change)
        assert rows(t) == sorted([(1, "d2", "y"), (2, "d1", "y"), (3, "d2", "x"), (4, "d1", None)], key=repr)


def test_append_and_reload(spark, table):
    table.append(frame(spark, (1, "d1", "a")))
    table.append(frame(spark).select("v", "k", "day"))
    table.append(frame(spark, (2, "d1", "b")).select("v", "k", "day"))
    assert rows(table) == [(1, "d1", "a"), (2, "d1", "b")]
    table.reload(frame(spark, (3, "d2", "c")))
    assert rows(table) == [(3, "d2", "c")]
    with pytest.raises(AnalysisException):
        table.reload(table.read())


def test_without_partition_column_newer_wins(spark, name):
    t = KeyedTable(spark, name, ["k"], buckets=5)
    t.merge(frame(spark, (1, "d2", "a")), newer_by="day")
    t.merge(frame(spark, (1, "d1", "old"), (2, "d1", "b")), newer_by="day")
    assert rows(t) == [(1, "d2", "a"), (2, "d1", "b")] and t.read().columns == ["k", "day", "v"]


def test_groups_are_replaced(spark, table):
    table.replace_groups(frame(spark, (1, "d1", "a"), (2, "d1", "b"), (3, "d2", "c")), frame(spark), ["k"])
    gone = spark.createDataFrame([(1,), (3,), (1,)], "k int")
    table.replace_groups(frame(spark, (1, "d3", "A")), gone, ["k"])
    assert rows(table) == [(1, "d3", "A"), (2, "d1", "b")]


def test_partitions_are_pruned(spark, table):
    table.append(frame(spark, (1, "d1", "a"), (2, "d2", "b")))
    assert "PartitionFilters: [isnotnull(day" in plan(table.read().where(F.col("day") == "d1"))


def test_merge_by_hashed_keys_lands_only_what_comes(spark, name, monkeypatch):
    landed, land = [], KeyedTable._landed
    monkeypatch.setattr(KeyedTable, "_landed", lambda self, df, what: landed.append(what) or land(self, df, what))
    t = KeyedTable(spark, name, ["k"], buckets=4)
    t.merge(frame(spark, *[(k, "d", "old") for k in range(40)], (None, "d", "null")))
    assert landed == []  # a table that is not there yet holds nothing to match
    t.merge(frame(spark, *[(k, "d", "new") for k in range(5, 8)], (99, "d", "new"), (None, "d", "null")))
    assert landed == ["incoming", "touched"]
    expected = [(k, "d", "new" if 5 <= k < 8 else "old") for k in range(40)] + [(99, "d", "new"), (None, "d", "null"), (None, "d", "null")]
    assert values(t.read()) == sorted(expected, key=repr)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_merge_by_hashed_keys_moves_no_row(spark, name, monkeypatch):
    plans, merged = [], KeyedTable._merged

    def seen(self, target, source):
        rows = merged(self, target, source)
        plans.append(plan(rows))
        return rows

    monkeypatch.setattr(KeyedTable, "_merged", seen)
    t = KeyedTable(spark, name, ["k", "day"], buckets=3)
    old = [(k, f"d{k % 7}", "old") for k in range(100)] + [(None, "d", "null"), (1, None, "null")]
    new = [(k, f"d{k % 7}", "new") for k in range(50, 130)] + [(None, "d", "null")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t.merge(frame(spark, *old))
        for _ in range(2):
            t.merge(frame(spark, *new))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Exchange" not in p for p in plans)
    assert rows(t) == sorted([*old[:50], *new[:-1], *old[100:], *new[-1:] * 2], key=repr)
    assert all(r.tableName == "t" for r in spark.sql(f"SHOW TABLES IN {name.split('.')[0]}").collect())
    with pytest.raises(Exception, match="more than one source row"):
        t.merge(frame(spark, (60, "d4", "a"), (60, "d4", "b")))
    assert rows(t) == sorted([*old[:50], *new[:-1], *old[100:], *new[-1:] * 2], key=repr)


def test_hashed_tables_without_buckets_stay_as_they_are(spark, name):
    """As they were made before: partitioned by another hash of the keys."""
    old = frame(spark, *[(k, "d", "old") for k in range(30)])
    placed = old.withColumn("_bucket", F.pmod(F.xxhash64("k"), F.lit(4)).cast("int"))
    placed.write.format("parquet").partitionBy("_bucket").saveAsTable(name)
    t = KeyedTable(spark, name, ["k"], buckets=4)
    t.merge(frame(spark, *[(k, "d", "new") for k in range(20, 40)]))
    t.append(frame(spark, (99, "d", "new")))
    t.merge(frame(spark, (99, "e", "newer"), (20, "c", "older")), newer_by="day")
    expected = [(k, "d", "old" if k < 20 else "new") for k in range(40)] + [(99, "e", "newer")]
    assert rows(t) == sorted(expected, key=repr)
    assert spark.table(name).where(F.col("_bucket") != F.pmod(F.xxhash64("k"), F.lit(4))).isEmpty()
