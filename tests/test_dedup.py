import pytest
from support import plan, values
from pyspark.sql import functions as F

from ledgerlake import operators as op

ROWS = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 0, "q"), (None, 5, "n")]


@pytest.fixture
def loads(spark):
    return spark.createDataFrame(ROWS, "k string, ts int, v string")


def test_latest_does_not_depend_on_order_or_partitioning(spark, loads):
    keyed, unkeyed = op.split_null_keys(loads, ["k"])
    expected = [("a", 2, "z"), ("b", 0, "q")]
    assert values(op.keep_latest(keyed, ["k"], ["ts"])) == expected
    for n in (1, 3):
        shuffled = keyed.orderBy(F.rand(n)).repartition(n)
        assert values(op.keep_latest(shuffled, ["k"], ["ts"])) == expected
    assert values(unkeyed) == [(None, 5, "n")]


def test_map_tasks_cut_groups_before_the_shuffle(loads):
    text = plan(op.keep_latest(loads, ["k"], ["ts"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_top_n_and_subset(loads):
    top = op.keep_top(loads.where("k = 'a'"), ["k"], [F.col("ts").desc(), F.col("v").asc()], 2, rank="place")
    assert values(top) == [("a", 2, "y", 1), ("a", 2, "z", 2)]
    assert values(op.dedup_subset(loads.where("k = 'a'"), ["k", "ts"])) == [("a", 1, "x"), ("a", 2, "z")]


def test_state_as_of_and_canonical(loads):
    assert values(op.state_as_of(loads.where("k = 'a'"), ["k"], "ts", 1)) == [("a", 1, "x")]
    assert values(op.canonical_attribute(loads.where("k is not null"), "k", "v")) == [("a", "x"), ("b", "p")]


def test_ties_on_maps_are_resolved(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS m UNION ALL SELECT 1, map('b', 2)")
    assert op.keep_latest(df, ["k"], []).first().m == {"b": 2}


def test_count_distinct_exact_and_sketched(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") % 10).alias("v"))
    assert values(op.count_distinct(df, ["g"], "v", "n")) == [(0, 5), (1, 5)]
    assert values(op.count_distinct(df, ["g"], "v", "n", approximate=True)) == [(0, 5), (1, 5)]
