"""Distinct counts over spans of days against sets, and the bitmap that spares the target a join."""

import random
from datetime import date, timedelta

from support import plan, values

from ledgerlake import operators as op

D0 = date(2024, 3, 1)


def test_spans_equal_sets(spark):
    r = random.Random(4)
    ids = [0, 1, 32767, 32768, 32769, 65535, 10**12, 7, 8, 9]
    rows = [(r.choice("ab"), D0 + timedelta(days=r.choice([0, 1, 2, 5, 30])), r.choice([*ids, None])) for _ in range(120)] + [("c", None, 5)]
    daily = op.day_bitmaps(spark.createDataFrame(rows, "kind string, day date, id bigint"), "day", "id", ("kind",))
    got = {(x.kind, x.day): x.n for x in op.distinct_in_spans(daily, "day", 3, "n", ("kind",)).collect()}
    days = {d for _, d, i in rows if d and i is not None}
    want = {}
    for kind in "abc":
        for d in days:
            found = {i for k, e, i in rows if k == kind and e and d - timedelta(days=2) <= e <= d and i is not None}
            if found:
                want[kind, d] = len(found)
    assert got == want
    assert op.distinct_in_spans(daily.limit(0), "day", 3, "n", ("kind",)).count() == 0


def test_sketches_are_near(spark):
    rows = spark.range(0, 30_000).selectExpr("date_add(DATE'2024-03-01', cast(id % 3 as int)) AS day", "concat('user ', id % 20000) AS id")
    got = values(op.estimated_in_spans(op.day_sketches(rows, "day", "id"), "day", 2, "n"))
    users = [{i % 20_000 for i in range(30_000) if i % 3 == day} for day in range(3)]
    want = [len(users[0]), len(users[0] | users[1]), len(users[1] | users[2])]
    assert len(got) == 3 and all(abs(n - w) <= 0.04 * w for (_, n), w in zip(got, want))


def test_the_bitmap_parts_the_target(spark):
    target = spark.range(0, 20_000).selectExpr("if(id % 100 = 99, null, id) AS k", "cast(id % 7 AS string) AS s", "'old' AS v")
    source = spark.range(5_000, 5_020).selectExpr("id AS k", "cast(id % 7 AS string) AS s", "'new' AS v")
    perhaps, no = op.split_by_keys(target, source, ["k", "s"], 1 << 16)
    assert 19 <= perhaps.count() <= 40 and perhaps.count() + no.count() == 20_000
    assert no.where("k IS NULL").count() == 200
    assert "hashpartitioning(k" not in plan(no)
    assert values(op.upsert(target, source, ["k", "s"], prune=True)) == values(op.upsert(target, source, ["k", "s"]))
    nothing, whole = op.split_by_keys(target, source.limit(0), ["k", "s"])
    assert nothing.count() == 0 and whole.count() == 20_000


def test_null_keys_of_the_target_stay(spark):
    target = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (1, None, "b"), (1, 1, "c")], "k int, seq int, v string")
    source = spark.createDataFrame([(None, 2, "x"), (1, 2, "y")], "k int, seq int, v string")
    once = target.where("v <> 'b'")
    assert values(op.upsert(once, source, ["k"])) == sorted([(None, 1, "a"), (None, 1, "a"), (None, 2, "x"), (1, 2, "y")], key=repr)
    changes = source.selectExpr("*", "'upsert' AS op")
    assert values(op.apply_changes(once, changes, ["k"], ["seq"], "op")) == sorted([(None, 1, "a"), (None, 1, "a"), (1, 2, "y")], key=repr)
