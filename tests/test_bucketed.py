import re

import pytest
from support import plan, values
from pyspark.sql import functions as F

from ledgerlake.operators import BucketedTable, buckets_for, keep_latest, upsert
from ledgerlake.operators.bucketed import ROWS_PER_BUCKET
from ledgerlake.operators.tables import _in_buckets
from ledgerlake.session import scratch_database

DDL = "k int, v string, at int"


@pytest.fixture
def name(spark):
    return f"{scratch_database(spark, 'bucketed')}.t"


def files(spark, name):
    return {f.rsplit("/", 1)[1] for f in spark.table(name).inputFiles()}


def base(spark, n):
    return spark.range(n).selectExpr("cast(id as int) as k", "'old' as v", "5 as at")


@pytest.mark.parametrize("newer_by", [None, "at"])
def test_equal_to_merges_one_by_one(spark, name, newer_by):
    table = BucketedTable(spark, name, ["k"], 4, newer_by)
    table.create(base(spark, 20))
    expected = base(spark, 20)
    merges = [[(1, "a", 6), (2, "a", 4), (30, "a", 1)], [(1, "b", 6), (2, "b", 7), (30, "b", 0), (31, "b", 1)], [(30, "c", 9)], []]
    for i, rows in enumerate(merges):
        source = spark.createDataFrame(rows, DDL)
        for _ in range(2):  # a repeated batch changes nothing
            table.merge(source, i)
        expected = upsert(expected, source, ["k"], newer_by)
        assert values(table.read()) == values(expected)
    table.fold()
    assert values(table.read()) == values(expected) == values(spark.table(name))
    assert spark.table(table.changes).count() == 0 and len(files(spark, name)) == 4
    table.merge(spark.createDataFrame([(1, "late", 2), (32, "n", 0)], DDL), 9)
    expected = upsert(expected, spark.createDataFrame([(1, "late", 2), (32, "n", 0)], DDL), ["k"], newer_by)
    assert values(table.read()) == values(expected)


def test_few_keys_leave_the_files_and_the_stored_rows_in_place(spark, name):
    table = BucketedTable(spark, name, ["k"], 4)
    table.create(base(spark, 20_000))
    before = files(spark, name)
    table.merge(base(spark, 20_000).where("k % 1000 = 7").selectExpr("k", "'new' as v", "at"), 1)
    assert files(spark, name) == before
    assert table.read().where("v = 'new'").count() == 20 and table.read().count() == 20_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(table.read())
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_split_not_mixed(spark, name):
    table = BucketedTable(spark, name, ["k"], 3)
    table.create(base(spark, 300))
    table.merge(spark.createDataFrame([(1, "new", 1)], DDL), 1)
    grown = table.grown(f"{name}_grown")
    assert values(grown.read()) == values(table.read()) and grown.buckets == 6
    place = lambda name: {r.k: int(re.search(r"_(\d{5})\.", r.f).group(1)) for r in spark.table(name).selectExpr("k", "input_file_name() as f").collect()}
    old, new = place(name), place(f"{name}_grown")
    assert all(new[k] % 3 == old[k] for k in old) and len(set(new.values())) == 6


@pytest.mark.parametrize("rows", [[(1, "a", 1), (1, "b", 2)], [(None, "a", 1)], [(1, "a", None)]])
def test_rows_that_cannot_be_merged_fail_and_change_nothing(spark, name, rows):
    table = BucketedTable(spark, name, ["k"], 2, "at")
    table.create(base(spark, 5))
    with pytest.raises(Exception, match="a key is null or there twice"):
        table.merge(spark.createDataFrame(rows, DDL), 1)
    assert values(table.read()) == values(base(spark, 5))


def test_empty_table(spark, name):
    table = BucketedTable(spark, name, ["k"], 2)
    table.create(base(spark, 0))
    assert table.read().count() == 0
    table.fold()
    table.merge(base(spark, 3), 1)
    assert values(table.read()) == values(base(spark, 3))


def test_the_rows_of_a_bucket_are_bounded_whatever_the_table():
    assert [buckets_for(n, 8) for n in (0, 12_000_000, 12_000_001, 650_000_000)] == [8, 8, 16, 512]
    for rows in (10**6, 10**8, 10**10):
        assert rows <= buckets_for(rows) * ROWS_PER_BUCKET < 2 * rows + 2 * ROWS_PER_BUCKET


def test_rows_deduplicated_by_the_keys_are_not_shuffled_again(spark, name):
    table = BucketedTable(spark, name, ["k"], 3)
    rows = spark.range(3000).selectExpr("cast(id % 1000 as int) as k", "cast(id as string) as v", "cast(id as int) as at")
    latest = keep_latest(rows, ["k"], ["at"])
    with _in_buckets(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "6"  # a multiple of 3, no less than the 4 of the session
        assert plan(table._checked(latest)).count("Exchange") == 1
        by_part = latest.groupBy("k").agg(F.max("v").alias("v"), F.max("at").alias("at"))
        assert plan(BucketedTable(spark, name, ["k", "at"], 3)._checked(by_part)).count("Exchange") == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    table.create(latest)
    place = spark.table(name).select((F.pmod(F.hash("k"), F.lit(3))).alias("b"), F.input_file_name().alias("f")).distinct().collect()
    assert all(int(re.search(r"_(\d{5})\.", r.f).group(1)) == r.b for r in place) and all("zstd" in r.f for r in place)
    assert values(table.read()) == values(latest) and len(files(spark, name)) <= 6
