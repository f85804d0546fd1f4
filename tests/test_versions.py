"""Versions of a dimension and facts as of their time, against a search of all versions."""

import random
from datetime import datetime, timedelta

import pytest
from support import values

from ledgerlake.operators import as_of, validity

T0 = datetime(2024, 1, 1)
HISTORY = "k string, name string, kind string, since timestamp_ntz"
FACTS = "k string, at timestamp_ntz, n int"


def day(n):
    return T0 + timedelta(days=n)


def test_loads_that_change_nothing_make_no_version(spark):
    rows = [("a", "x", "t", day(0)), ("a", "x", "t", day(1)), ("a", "y", "t", day(2)), ("a", None, "t", day(3)), ("a", None, "t", day(4)), ("a", "x", "t", day(5)),
            ("b", "x", "t", day(0)), (None, "x", "t", day(0)), ("c", "x", "t", None)]
    got = values(validity(spark.createDataFrame(rows, HISTORY), ["k"], "since", ["name", "kind"]))
    assert got == sorted([
        ("a", "x", "t", day(0), day(2)), ("a", "y", "t", day(2), day(3)), ("a", None, "t", day(3), day(5)), ("a", "x", "t", day(5), None), ("b", "x", "t", day(0), None),
    ], key=repr)


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_facts_have_the_version_of_their_time(spark, unit):
    r = random.Random(unit)
    history = [(r.choice("ab"), r.choice(["x", "y", None]), "t", day(n)) for n in sorted(r.sample(range(5, 800), 25))] + [("c", "late", "t", day(790))]
    facts = [(r.choice(["a", "a", "a", "b", "c", "d", None]), r.choice([day(r.randint(0, 800)), history[r.randrange(25)][3], None]), i) for i in range(300)]
    facts += [facts[0], facts[1]]

    def expected(k, at):
        then = [h for h in history if h[0] == k and at is not None and h[3] <= at]
        return max(then, key=lambda h: h[3])[1:3] if then and k is not None else (None, None)

    got = values(as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY), ["k"], "at", "since", {"name": "k_name", "kind": "k_kind"}, unit))
    assert got == sorted([(*f, *expected(f[0], f[1])) for f in facts], key=repr)


def test_no_facts_or_no_versions(spark):
    history, facts = spark.createDataFrame([("a", "x", "t", day(0))], HISTORY), spark.createDataFrame([("a", day(1), 1)], FACTS)
    names = {"name": "name", "kind": "kind"}
    assert values(as_of(facts.limit(0), history, ["k"], "at", "since", names)) == []
    assert values(as_of(facts, history.limit(0), ["k"], "at", "since", names)) == [("a", day(1), 1, None, None)]


def test_facts_apart_by_a_column_have_the_version_of_their_time(spark):
    r = random.Random(3)
    history = spark.createDataFrame([(r.choice("ab"), r.choice(["x", "y", None]), "t", day(n)) for n in range(0, 300, 9)], HISTORY)
    facts = spark.createDataFrame([(r.choice(["a", "a", "b", "c", None]), r.choice([day(r.randint(-3, 300)), day(9), None]), i) for i in range(200)], FACTS)
    names = {"name": "k_name", "kind": "k_kind"}
    by_unit = as_of(facts, history, ["k"], "at", "since", names)
    apart = as_of(facts.selectExpr("*", "n % 3 as part"), history, ["k"], "at", "since", names, spread="part")
    assert apart.columns == ["k", "at", "n", "part", "k_name", "k_kind"] and values(apart.drop("part")) == values(by_unit)
    assert values(as_of(facts.selectExpr("*", "1 as part").limit(0), history, ["k"], "at", "since", names, spread="part")) == []
