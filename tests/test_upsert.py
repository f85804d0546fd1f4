import pytest
from support import plan, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake import operators as op

DDL = "k int, ts int, v string"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def test_unconditional_merge(spark):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    source = spark.createDataFrame([("B", 2, 0), ("c", 3, 0), ("m", None, 0)], "v string, k int, ts int")
    merged = op.upsert(target, source, ["k"])
    assert merged.columns == ["k", "ts", "v"]
    assert values(merged) == sorted([(1, 1, "a"), (2, 0, "B"), (3, 0, "c"), (None, 1, "n"), (None, 0, "m")], key=repr)


def test_newer_wins_keeps_the_target_on_ties_and_nulls(spark):
    target = frame(spark, [(1, 5, "a"), (2, 5, "b"), (3, 5, "c"), (4, None, "d"), (5, 5, "e")])
    source = frame(spark, [(1, 5, "A"), (2, 6, "B"), (3, None, "C"), (4, 9, "D"), (6, None, "F")])
    assert values(op.upsert(target, source, ["k"], "ts")) == sorted(
        [(1, 5, "a"), (2, 6, "B"), (3, 5, "c"), (4, None, "d"), (5, 5, "e"), (6, None, "F")], key=repr
    )


def test_duplicates_raise_only_where_they_match(spark):
    target = frame(spark, [(1, 1, "a")])
    twice = [(7, 1, "x"), (7, 1, "y")]
    assert op.upsert(target, frame(spark, twice), ["k"]).count() == 3
    for newer_by in (None, "ts"):
        with pytest.raises(Exception, match="more than one source row"):
            op.upsert(target, frame(spark, [(1, 2, "x"), (1, 3, "y")]), ["k"], newer_by).collect()


def test_source_rows_are_not_shuffled(spark):
    merged = op.upsert(frame(spark, [(1, 1, "a")]), frame(spark, [(1, 2, "x")]), ["k"])
    assert "FullOuter" not in plan(merged)
    assert all("v#" not in line for line in plan(merged).splitlines() if "Exchange hashpartitioning" in line)


row = st.tuples(st.integers(0, 6), st.integers(0, 3), st.sampled_from("pqrs"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=6), st.lists(row, max_size=6), st.booleans())
def test_merge_agrees_with_a_dictionary_and_is_idempotent(spark, old, new, newer):
    target, source = {r[0]: r for r in old}, {r[0]: r for r in new}
    expected = dict(target)
    for k, r in source.items():
        if k not in expected or not newer or r[1] > expected[k][1]:
            expected[k] = r
    t, s = frame(spark, list(target.values())), frame(spark, list(source.values()))
    by = "ts" if newer else None
    once = op.upsert(t, s, ["k"], by)
    assert values(once) == sorted(expected.values(), key=repr)
    assert values(op.upsert(once, s, ["k"], by)) == values(once)


def test_change_feed(spark):
    target = frame(spark, [(1, 0, "a"), (2, 0, "b"), (3, 0, "c")])
    feed = frame(
        spark,
        [(1, 1, "x", "upsert"), (1, 2, None, "delete"), (2, 2, "y", "upsert"), (2, 1, None, "delete"), (4, 1, "d", None)],
        DDL + ", op string",
    )
    assert values(op.apply_changes(target, feed, ["k"], ["ts"], "op")) == [(2, 2, "y"), (3, 0, "c"), (4, 1, "d")]


def test_groups_whose_rows_are_gone_disappear(spark):
    totals = frame(spark, [(1, 0, "10"), (2, 0, "20")])
    left = op.replace_groups(totals, frame(spark, []), frame(spark, [(1, 0, "")]), ["k"])
    assert values(left) == [(2, 0, "20")]


def test_catalog_merge_needs_a_catalog_that_can(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW plain_rows AS SELECT 1 AS k, 1 AS ts, 'a' AS v")
    with pytest.raises(Exception):
        op.merge_into_catalog(frame(spark, [(1, 2, "b")]), "plain_rows", ["k"])


def test_late_changes_do_not_overwrite_newer_rows(spark):
    target = spark.createDataFrame([(1, 9, "kept"), (2, 3, "old")], "k int, seq int, v string")
    feed = spark.createDataFrame([(1, 4, "late", "update"), (2, 5, "new", "update"), (2, 4, "x", "delete")], "k int, seq int, v string, op string")
    assert values(op.apply_changes(target, feed, ["k"], ["seq"], "op")) == [(1, 9, "kept"), (2, 5, "new")]
    assert values(op.apply_changes(target, feed.withColumn("op", F.lit("delete")), ["k"], ["seq"], "op")) == [(1, 9, "kept")]


def test_late_changes_do_not_revive_what_a_marker_keeps(spark):
    changes = [(1, 4, "upsert", "late"), (1, 9, "delete", None), (2, 1, "upsert", "a"), (2, 3, "upsert", "b"), (3, 2, "delete", None), (3, 5, "upsert", "back")]
    empty = spark.createDataFrame([], "k int, seq int, v string, gone boolean")
    for order in (changes, changes[::-1], [changes[i] for i in (1, 0, 3, 2, 5, 4)]):
        state = []
        for change in (order[:2], order[2:3], order[3:]):
            target = spark.createDataFrame(state, empty.schema)
            state = values(op.apply_changes(target, spark.createDataFrame(change, "k int, seq int, op string, v string"), ["k"], ["seq"], "op", marker="gone"))
        assert state == [(1, 9, None, True), (2, 3, "b", False), (3, 5, "back", False)]


def test_rows_placed_alike_are_merged_where_they_are(spark):
    ddl = "k int, j int, v string, part int"
    part = lambda k, j: j % 2 if k == 7 else 0  # a hot key is in two places
    old = [(k, j, "old", part(k, j)) for k in range(12) for j in range(k % 5 + 1)] + [(None, 1, "null", 0), (3, None, "null", 0)]
    new = [(k, j, "new", part(k, j)) for k in range(5, 15) for j in range(k % 4 + 1)] + [(None, 1, "null", 0), (3, None, "null", 0), (99, 1, "x", 0), (99, 1, "y", 0)]
    target, source = (spark.createDataFrame(rows, ddl).repartition("k", "part") for rows in (old, new))
    merged = op.upsert(target, source, ["k", "j"], placed_by="part")
    assert plan(merged).count("Exchange") == 2 and "Join" not in plan(merged)
    assert merged.columns == target.columns and values(merged) == values(op.upsert(target, source, ["k", "j"]))
    twice = source.unionByName(source.where("k = 5"))
    with pytest.raises(Exception, match="more than one source row"):
        op.upsert(target, twice, ["k", "j"], placed_by="part").collect()
    with pytest.raises(ValueError, match="placed_by"):
        op.upsert(target, source, ["k", "j"], newer_by="v", placed_by="part")
