"""One key holds a third of all rows: results stay whole and no task gets the whole group."""

import pytest
from support import plan
from pyspark.sql import functions as F

from ledgerlake import operators as op
from ledgerlake.operators.aggregates import money_totals

N = 60_000
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def fact(spark):
    i = F.col("id")
    return spark.range(0, N, 1, 8).select(
        i.alias("row_id"),
        F.when(i % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), i % 5000)).alias("account_id"),
        F.lit("1.00").cast("decimal(18,2)").alias("amount"),
        F.sha2(i.cast("string"), 256).alias("payload"),
    )


def final_plan(df, rows: int) -> str:
    """The plan as AQE changed it while the frame ran."""
    assert df.toArrow().num_rows == rows
    return plan(df)


def test_enrich_splits_the_hot_key(spark, small_partitions, fact):
    dim = fact.select("account_id", F.concat(F.lit("name "), "account_id").alias("name"))
    joined = op.enrich(fact, dim, "account_id", {"name": "account_name"})
    assert joined.columns == [*fact.columns, "account_name"]
    got = joined.agg(F.count("*"), F.count("account_name"), F.countDistinct("row_id")).first()
    assert tuple(got) == (N, N, N)
    assert "skew=true" in final_plan(joined, N)
    assert "skew=true" in final_plan(op.only_known(fact, dim, "account_id"), N)


def test_latest_and_totals_reduce_the_hot_key_before_the_shuffle(spark, small_partitions, fact):
    latest = op.keep_latest(fact, ["account_id"], ["row_id"])
    assert latest.where("account_id = 'HOT'").first().row_id == N - 3
    text = plan(latest)
    assert text.index("Exchange hashpartitioning") < text.index("Partial")
    totals = money_totals(fact, ["account_id"], ["amount"])
    assert totals.where("account_id = 'HOT'").first().total_amount == N // 3
    assert "partial_sum" in plan(totals)


def test_upsert_of_a_hot_unmatched_key_keeps_every_row(spark, small_partitions, fact):
    target = spark.createDataFrame([(-1, "one", None, "x")], fact.schema)
    source = fact.unionByName(spark.createDataFrame([(1, "one", None, "y")], fact.schema))
    assert op.upsert(target, source, ["account_id"]).count() == N + 1
    newer = op.upsert(target, source, ["account_id"], newer_by="row_id")
    assert "skew=true" in final_plan(newer, N + 1)
