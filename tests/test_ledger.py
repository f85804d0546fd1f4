"""Golden rows of small documents, and the traps of the ledger jobs."""

import glob
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from support import plan, values
from pyspark.sql import functions as F

from ledgerlake.operators import KeyedTable, as_of, upsert
from ledgerlake.plans import ledger, staging
from ledgerlake.session import scratch_database, shared_dir
from ledgerlake.sources import read_json_docs
from ledgerlake.specs import ACCOUNTS, CLOSE_TASKS, JOURNAL_ENTRIES

T0, T1 = datetime(2025, 9, 1), datetime(2025, 9, 2)
RAW = "_id string, entry_id string, date string, lines array<struct<account_id: string, debit: decimal(18,2), credit: decimal(18,2)>>, description string, ingest_ts timestamp_ntz"
ACCOUNT_DDL = "account_id string, name string, type string, ingest_ts timestamp_ntz"
TASK_DDL = "_id string, task_id string, name string, status string, due_date string, ingest_ts timestamp_ntz"


def entry(i, e, day, lines, ts, text="Van hire"):
    return (i, e, day, lines and [(a, Decimal(d), Decimal(c)) for a, d, c in lines], text, ts)


@pytest.fixture
def accounts(spark):
    rows = [("a10", "Old till", "own", T0), ("a10", "Till", "own", T1), ("b20", "Leases owed", "owed", T0)]
    return spark.createDataFrame(rows, ACCOUNT_DDL)


@pytest.fixture
def journal(spark):
    payment = [("a10", 320, 0), ("b20", 0, 320)]
    return spark.createDataFrame([entry("x", "E31", "2023-03-14", payment, T0)], RAW)


def test_golden_silver_and_gold(journal, accounts):
    silver = ledger.journal_silver(journal, accounts)
    picked = silver.select("entry_id", "entry_date", "description", "account_id", "account_name", "account_type", "debit", "credit")
    day = date(2023, 3, 14)
    assert values(picked) == [
        ("E31", day, "Van hire", "a10", "Till", "own", Decimal("320.00"), Decimal("0.00")),
        ("E31", day, "Van hire", "b20", "Leases owed", "owed", Decimal("0.00"), Decimal("320.00")),
    ]
    assert values(ledger.journal_gold(silver)) == [("E31", day, Decimal("320.00"), Decimal("320.00"))]


def test_golden_close_tasks(spark):
    raw = spark.createDataFrame(
        [
            ("1", "T1", "Count stock", "Open", "2023-04-02", T0),
            ("2", "T1", "Count stock", "Complete", "2023-04-02", T1),
            ("3", "T2", "Check leases", "In Progress", "soon", None),
            ("4", None, "lost", "Open", "2023-04-03", T1),
        ],
        TASK_DDL,
    )
    silver = ledger.close_tasks_silver(raw, F.lit("2025-10-01").cast("timestamp_ntz"))
    assert values(silver.select("task_id", "status", "due_date", "ingest_ts")) == [
        ("T1", "Complete", date(2023, 4, 2), T1),
        ("T2", "In Progress", None, datetime(2025, 10, 1)),
    ]


def test_sample_file_scans_as_an_array(spark, tmp_path):
    path = tmp_path / "journal.json"
    path.write_text(
        '[{"entry_id":"E31","date":"2023-03-14","lines":[{"account_id":"a10","debit":320,"credit":0},'
        '{"account_id":"b20","debit":0,"credit":320}],"description":"Van hire"}]'
    )
    docs = read_json_docs(spark, str(path), JOURNAL_ENTRIES.schema, json_array=True)
    assert docs.first()._id is None and len(docs.first().lines) == 2


def test_lines_of_one_account_merge_unless_kept_by_line(spark, accounts):
    raw = spark.createDataFrame([entry("x", "E", "2023-03-14", [("a10", 5, 0), ("a10", 7, 0)], T0)], RAW)
    assert ledger.journal_silver(raw, accounts).count() == 1
    assert values(ledger.journal_silver(raw, accounts, by_line=True).select("line_no", "debit")) == [
        (1, Decimal("5.00")),
        (2, Decimal("7.00")),
    ]


def test_empty_entries_vanish_or_stay_on_request(spark):
    raw = spark.createDataFrame([entry("x", "A", "2023-03-14", None, T0), entry("y", "B", "bad", [], T0)], RAW)
    assert ledger.journal_lines(raw).count() == 0
    assert values(ledger.journal_lines(raw, keep_empty=True, line_no="n").select("entry_id", "entry_date", "n")) == [
        ("A", date(2023, 3, 14), None),
        ("B", None, None),
    ]


def test_ingest_keeps_rejects(spark):
    docs = spark.createDataFrame(
        [('{"_id":{"$oid":"1"},"account_id":"a10","name":"Till","type":"own","x":1}',)], "doc string"
    )
    rows, rejects = ledger.ingest_documents(docs, "doc", ACCOUNTS, F.lit("2025-01-01").cast("timestamp_ntz"))
    assert values(rows) == [("1", "a10", "Till", "own", datetime(2025, 1, 1))]
    assert rejects.count() == 0


def test_what_cannot_be_read_is_rejected_with_its_text(spark):
    bad = ["not json at all", "", "[1]", '{"_id":"1","entry_id":"E","lines":"oops"}', '{"_id":"2","lines":[{"debit":"much"}]}']
    good = ['{"_id":"3","entry_id":"E","lines":[{"account_id":"a","debit":{"$numberDecimal":"1.5"},"credit":0}]}', '{"_id":"4"}']
    docs = spark.createDataFrame([(t,) for t in [*bad, *good, None]], "doc string")
    rows, rejects = ledger.ingest_documents(docs, "doc", JOURNAL_ENTRIES, F.lit("2025-01-01").cast("timestamp_ntz"))
    assert "_source" not in rows.columns
    assert values(rows.select("_id", "entry_id")) == [("3", "E"), ("4", None)]
    assert {r._source: r._problems for r in rejects.collect()} == {
        **{t: ["_document"] for t in [*bad[:4], None]},
        bad[4]: ["lines"],
    }


def test_lines_kept_apart_end_to_end(spark, accounts):
    db = scratch_database(spark, "curated")
    tasks = spark.createDataFrame([], TASK_DDL)
    raw = spark.createDataFrame([entry("x", "E", "2023-03-14", [("a10", 5, 0), ("a10", 3, 0), ("b20", 0, 8)], T0)], RAW)
    for _ in range(2):
        ledger.curate(spark, db, tasks, raw, accounts, datetime(2025, 10, 1), by_line=True)
        gold = KeyedTable(spark, f"{db}.journal_entries_gold", ["entry_id", "entry_date"], "entry_year").read()
        assert values(gold.select("total_credit", "total_debit")) == [(Decimal("8.00"), Decimal("8.00"))]


def test_reload_replaces_the_whole_collection_once(spark):
    path = f"{scratch_database(spark, 'raw')}.close_tasks"
    rows = spark.createDataFrame([("1", T0), ("2", T1)], "task_id string, ingest_ts timestamp_ntz")
    ledger.append_raw(spark, rows, path, CLOSE_TASKS)
    ledger.append_raw(spark, rows, path, CLOSE_TASKS)
    raw = KeyedTable(spark, path, ["task_id"], "ingest_date")
    assert raw.read().count() == 4
    ledger.append_raw(spark, rows, path, CLOSE_TASKS, reload=True)
    assert raw.read().count() == 2


def test_curating_twice_changes_nothing_and_corrections_replace_totals(spark, journal, accounts):
    db = scratch_database(spark, "curated")
    tasks = spark.createDataFrame([("1", "T1", "n", "Open", "2023-04-02", T0)], TASK_DDL)
    run = datetime(2025, 10, 1)

    def gold():
        t = KeyedTable(spark, f"{db}.journal_entries_gold", ["entry_id", "entry_date"], "entry_year")
        return values(t.read().select("entry_id", "entry_date", "total_credit", "total_debit"))

    for _ in range(2):
        ledger.curate(spark, db, tasks, journal, accounts, run)
        assert gold() == [("E31", date(2023, 3, 14), Decimal("320.00"), Decimal("320.00"))]
    # the entry moves to another day: its old total must not stay behind
    moved = spark.createDataFrame(
        [entry("x", "E31", "2026-06-01", [("a10", 600, 0), ("b20", 0, 600)], T1), entry("y", "JE2", "2026-01-01", [("a10", 1, 1)], T1)],
        RAW,
    )
    ledger.curate(spark, db, tasks, moved, accounts, run)
    assert gold() == [
        ("E31", date(2026, 6, 1), Decimal("600.00"), Decimal("600.00")),
        ("JE2", date(2026, 1, 1), Decimal("1.00"), Decimal("1.00")),
    ]


def test_entry_account_totals_count_a_document_once(spark, accounts):
    doc = entry("x", "E", "2023-03-14", [("a10", 5, 0), ("9999", 1, 0)], T0)
    raw = spark.createDataFrame([doc, doc], RAW)
    assert values(ledger.entry_account_totals(raw, accounts)) == [("E", "a10", Decimal("5.00"), Decimal("0.00"))]


def test_a_revision_takes_its_dropped_lines_along(spark, accounts):
    a, b, c = ("a10", 7, 0), ("b20", 0, 7), ("c30", 0, 7)
    rows = [entry("x", "E1", "2023-03-14", [a, b], T0), entry("x", "E1", "2023-03-14", [a, c], T1), entry(None, "E2", "2023-03-14", [a, b], T0)]
    raw = spark.createDataFrame(rows, RAW)
    gold = ledger.journal_gold(ledger.latest_lines(raw, by_line=True, revised=True))
    day = date(2023, 3, 14)
    assert values(gold) == [("E1", day, Decimal("7.00"), Decimal("7.00")), ("E2", day, Decimal("7.00"), Decimal("7.00"))]
    db = scratch_database(spark, "revised")
    tasks = spark.createDataFrame([], TASK_DDL)
    for load in (T0, T1, T1):
        ledger.curate(spark, db, tasks, raw.where(F.col("ingest_ts") == load), accounts, by_line=True, revised=True)
    lines = spark.table(f"{db}.journal_entries_silver").where("entry_id = 'E1'")
    assert sorted(r.account_id for r in lines.collect()) == ["a10", "c30"]
    totals = spark.table(f"{db}.journal_entries_gold").select("entry_id", "total_credit", "total_debit")
    assert values(totals) == [("E1", Decimal("7.00"), Decimal("7.00")), ("E2", Decimal("7.00"), Decimal("7.00"))]
    with pytest.raises(ValueError, match="by_line"):
        ledger.curate(spark, db, tasks, raw, accounts, revised=True)


LINE_DDL = "entry_id string, entry_date date, account_id string, credit decimal(18,2), debit decimal(18,2)"


def test_signed_changes_equal_totals_made_anew(spark):
    d = date(2023, 3, 14)
    line = lambda e, day, account, credit, debit: (e, day, account, Decimal(credit), None if debit is None else Decimal(debit))
    before = [line("E1", d, "a", 5, 0), line("E1", d, "b", 0, 5), line("E2", None, "a", 3, None), line("E3", d, "a", 1, 1), line(None, d, "a", 2, 2)]
    # one line changes, one moves to another day, one goes, and one comes without a date
    changed = {0: line("E1", d, "a", 9, 0), 1: line("E1", date(2023, 4, 1), "b", 0, 9), 3: None}
    after = [line("E2", None, "c", 4, 4)] + [changed.get(i, x) for i, x in enumerate(before) if changed.get(i, x)]
    frames = [spark.createDataFrame(rows, LINE_DDL) for rows in (before, after, [before[i] for i in changed], [x for x in [*changed.values(), after[0]] if x])]
    changes = ledger.signed_changes(*frames[2:])
    stored, want = ledger.journal_gold_counted(frames[0]), ledger.journal_gold_counted(frames[1])
    assert values(ledger.gold_after(stored, changes)) == values(want)
    assert values(want.drop("line_count")) == values(ledger.journal_gold(frames[1]))
    touched = {r.entry_id for r in ledger.gold_after(stored, changes, only_touched=True).collect()}
    assert touched == {"E1", "E2"}  # E3 has no line left, and nothing touches the entry without an id


def test_a_load_that_breaks_off_and_is_repeated_comes_once(spark, monkeypatch):
    db = scratch_database(spark, "loads")
    docs = spark.createDataFrame([('{"_id":"1","account_id":"a","name":"n","type":"t"}',), ("no json",), ('{"_id":"2","account_id":"b"}',)], "doc string")

    def load(name, frame=docs):
        return ledger.ingest_collections(spark, db, {"accounts": frame}, ts=T0, load=name)

    with monkeypatch.context() as m:
        m.setattr(ledger, "append_raw", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load("l1")
    assert not spark.catalog.tableExists(f"{db}.loads")
    for _ in range(2):
        assert load("l1") == [ledger.LoadCount("accounts", "l1", 3, 2, 1)]
    load("l2", docs.limit(0))
    load("l3")
    assert spark.table(f"{db}.raw_accounts").count() == 4
    assert spark.table(f"{db}.rejects_accounts").count() == 2
    assert values(spark.table(f"{db}.loads").select("load_id", "documents", "rows", "rejects")) == [("l1", 3, 2, 1), ("l2", 0, 0, 0), ("l3", 3, 2, 1)]
    assert "load_id" not in ledger.raw_table(spark, db, "accounts").columns


def test_only_rejects_are_landed_with_their_text(spark):
    frame = spark.createDataFrame([('{"account_id": "1", "name": "Cash"}',), ("no json",)], "doc string")
    db = scratch_database(spark, "texts")
    before = set(glob.glob(f"{shared_dir(spark)}/ledgerlake/ingest-accounts-*"))
    ledger.ingest_collections(spark, db, {"accounts": frame}, ts=T0, load="a")
    (landed,) = set(glob.glob(f"{shared_dir(spark)}/ledgerlake/ingest-accounts-*")) - before
    assert values(spark.read.parquet(landed).select("_fits", "_source")) == [(False, "no json"), (True, None)]
    assert [r._source for r in spark.table(f"{db}.rejects_accounts").collect()] == ["no json"]


@pytest.mark.parametrize("lines", [
    lambda raw, accounts: ledger.latest_lines(raw, by_line=True),
    lambda raw, accounts: ledger.entry_account_totals(raw, accounts),
])
def test_lines_known_by_their_document_are_not_shuffled_one_by_one(journal, accounts, lines):
    above, below = plan(lines(journal, accounts)).split("explode(lines", 1)
    assert "hashpartitioning(entry_id" in below
    assert not any("_id#" in keys.replace("entry_id#", "").replace("account_id#", "") for keys in re.findall(r"hashpartitioning\((.*)\)", above))


def test_null_ids_and_repeated_loads_by_line(spark):
    once = [("a10", 1, 0), ("a10", 2, 0)]
    rows = [
        entry(None, "E1", "2023-03-14", once, T0),
        entry(None, "E1", "2023-03-14", [("a10", 7, 0)], T1),
        entry("x", "E1", "2023-03-14", once, T0),
        entry("x", "E1", "2023-03-14", once, T1),
    ]
    found = ledger.latest_lines(spark.createDataFrame(rows, RAW), by_line=True).select("_id", "line_no", "ingest_ts", "debit")
    assert values(found) == sorted(
        [(None, 1, T1, Decimal(7)), (None, 2, T0, Decimal(2)), ("x", 1, T1, Decimal(1)), ("x", 2, T1, Decimal(2))], key=repr
    )


def test_jobs_on_lines_do_not_make_the_entries_without_lines(spark):
    raw = staging.raw_journal(spark, "/root/testdata/sf0.001")
    assert plan(ledger.journal_lines(raw)).count("lineitem.parquet") == 1
    assert "LeftAnti" in plan(ledger.journal_lines(raw, keep_empty=True))


def test_documents_are_shuffled_whole_by_entry_but_for_hot_entries(spark):
    docs = [entry(f"d{i:03}", "HOT", "2023-03-14", [(f"a{i % 40}", i, 0), ("TAX", 0, i)], T0) for i in range(200)]
    docs += [entry(f"x{i}", f"E{i % 20}", "2023-03-14", [("a1", i, 0), ("TAX", 0, i)], T1 if i % 3 else T0) for i in range(60)]
    docs += [entry("n", None, "2023-03-14", [("a1", 1, 0)], T0), entry("m", "E1", "soon", [(None, 1, 0)], T0), entry("e", "E1", None, [], T0), entry("l", "E1", None, None, T0)]
    raw = spark.createDataFrame(docs, RAW)
    lines = ledger.lines_by_entry(raw, hot=50)
    found = {r.entry_id: (r.places, r.n) for r in lines.groupBy("entry_id").agg(F.countDistinct("_split").alias("places"), F.count("*").alias("n")).collect()}
    assert found["HOT"] == (41, 400) and all(places == 1 for e, (places, _) in found.items() if e != "HOT")
    got = ledger.lines_by_entry(raw, hot=50).drop("_split")
    assert values(got) == values(ledger.journal_lines(raw.where("entry_id IS NOT NULL")))
    whole = ledger.latest_lines(raw, whole=True)
    assert whole.columns == ledger.latest_lines(raw).columns and values(whole) == values(ledger.latest_lines(raw))
    text = plan(whole)  # from the top: lines come of documents after the one shuffle of these
    assert text.index("explode(lines") < text.index("Exchange hashpartitioning(entry_id") and "hashpartitioning(entry_id#" in text
    accounts = spark.createDataFrame([("a1", "One", "own", T0)], ACCOUNT_DDL)
    assert "_split" in plan(ledger.journal_silver(raw, accounts))


def test_a_range_of_load_times_reaches_the_lines_and_leaves_none_out(spark, tmp_path):
    """Also lines without a load time of their own, orders without lines and lines without tax."""
    for name in ("orders", "lineitem"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumn("l_shipdate", F.when(F.col("l_partkey") % 3 > 0, F.col("l_shipdate")))
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    whole, parts = (staging.raw_journal(spark, str(tmp_path), by_load) for by_load in (False, True))
    assert whole.schema == parts.schema and whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()
    for late in (F.col("ingest_ts") < staging.ntz("1998-06-01"), F.col("ingest_ts") >= staging.ntz("1998-06-01")):
        a, b = (values(ledger.latest_lines(raw.where(late))) for raw in (whole, parts))
        assert a == b and a
        assert not re.search(r"PushedFilters: \[[^]]*(Less|Greater)[^]]*l_shipdate", plan(whole.where(late)))
        assert re.search(r"PushedFilters: \[[^]]*(Less|Greater)[^]]*l_shipdate", plan(parts.where(late)))


def test_documents_are_written_once_however_often_they_are_used(spark):
    docs = staging.extended_json_orders(spark, "/root/testdata/sf0.001")
    used = docs.where(~F.col("doc").contains("-1-")).select(F.col("doc").alias("a"), F.length("doc").alias("b"))
    assert plan(used).count("StructsToJsonEvaluator") == plan(docs).count("StructsToJsonEvaluator") > 0


def test_lines_of_the_latest_documents_are_not_shuffled_again(spark):
    """Also documents without an id, whose lines meet by entry, account and position."""
    rows = [
        entry("a", "E1", "2023-01-01", [("x", 1, 0), ("x", 2, 0), ("y", 3, 0)], T0),
        entry("a", "E1", "2023-01-02", [("x", 4, 0), ("x", 5, 0)], T1),
        entry("b", "E1", "2023-01-01", [("x", 6, 0)], T1),
        entry("b", "E2", "2023-01-01", [], datetime(2025, 9, 3)),
        entry(None, "E1", "2023-01-01", [("x", 7, 0), ("z", 8, 0)], T0),
        entry(None, "E1", "2023-01-03", [("x", 9, 0)], T1),
        entry("c", None, "2023-01-01", [("x", 10, 0)], T0),
        entry("d", "E3", "2023-01-01", [(None, 11, 0), ("x", 12, 0)], T0),
    ]
    raw = spark.createDataFrame(rows, RAW)
    found = ledger.latest_lines(raw, by_line=True, revised=True)
    assert values(found.select("_id", "entry_id", "account_id", "line_no", "debit")) == sorted(
        [("a", "E1", "x", 1, Decimal("4.00")), ("a", "E1", "x", 2, Decimal("5.00")), (None, "E1", "x", 1, Decimal("9.00")),
         (None, "E1", "z", 2, Decimal("8.00")), ("d", "E3", "x", 2, Decimal("12.00"))], key=repr
    )
    known = raw.where("_id IS NOT NULL").withColumn("_id", F.concat_ws("", "_id"))
    above_the_documents = plan(ledger.latest_lines(known, by_line=True, revised=True)).split("Scan")[0]
    assert above_the_documents.count("Exchange") == 1


def test_lines_are_shuffled_once_by_account_and_named_there(spark):
    days = [T0, T1, datetime(2025, 9, 5), None]
    docs = [entry(f"d{i:03}", f"E{i % 30}", "2023-03-14", [(f"a{i % 7}", i, 0), ("TAX", 0, i)], days[i % 4]) for i in range(200)]
    docs += [entry("n", None, "2023-03-14", [("a1", 1, 0)], T0), entry("m", "E1", "soon", [(None, 1, 0)], T0), entry("e", "E1", None, [], T0)]
    raw = spark.createDataFrame(docs, RAW)
    lines = ledger.latest_lines_by_account(raw, hot=50, parts=5)
    spread = {r.account_id: r.n for r in lines.groupBy("account_id").agg(F.countDistinct(ledger.SPREAD).alias("n")).collect()}
    assert spread["TAX"] == 5 and all(spread[f"a{i}"] == 1 for i in range(7))
    assert values(lines.drop(ledger.SPREAD)) == values(ledger.latest_lines(raw)) == values(ledger.latest_lines_by_account(raw).drop(ledger.SPREAD))
    history = spark.createDataFrame([("TAX", "old", "t", T0), ("TAX", "new", "t", T1), ("a1", "one", "t", T1), ("b", "other", "t", T0)], ACCOUNT_DDL)
    named = lambda **how: as_of(lines, history, ["account_id"], "ingest_ts", "ingest_ts", ledger.ACCOUNT_ATTRIBUTES, **how)
    assert named(spread=ledger.SPREAD).columns == named().columns
    assert values(named(spread=ledger.SPREAD)) == values(named()) and named().where("account_name = 'new'").count() > 0
    first = lambda df: next(line for line in plan(df).splitlines() if "Exchange" in line)
    assert "ENSURE_REQUIREMENTS" in first(named()) and "REPARTITION_BY_COL" in first(named(spread=ledger.SPREAD))


def test_halves_of_entries_placed_once_merge_where_they_are(spark):
    docs = [entry(f"d{i:03}", "HOT", "2023-03-14", [(f"a{i % 40}", i, 0), ("TAX", 0, i)], T0 if i % 3 else T1) for i in range(90)]
    docs += [entry(f"x{i}", f"E{i % 20}", "2023-03-14", [("a1", i, 0), ("TAX", 0, i)], T1 if i % 3 else T0) for i in range(60)]
    placed = ledger.lines_by_entry(spark.createDataFrame(docs, RAW), hot=30)
    target, source = (ledger.latest_of_entries(placed.where(c)) for c in (F.col("ingest_ts") < T1, F.col("ingest_ts") >= T1))
    merged = upsert(target, source, ["entry_id", "account_id"], placed_by=ledger.SPLIT)
    assert merged.select("entry_id", ledger.SPLIT).distinct().where("entry_id = 'HOT'").count() > 30
    assert values(merged) == values(upsert(target, source, ["entry_id", "account_id"]))
    assert "REPARTITION_BY_COL" in next(line for line in plan(merged).splitlines() if "Exchange" in line)


def test_lines_are_shuffled_to_their_orders_without_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ledger.journal_lines(staging.raw_journal(spark, "/root/testdata/sf0.001"))).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[next(i for i, line in enumerate(text) if "Exchange hashpartitioning(l_orderkey" in line) + 1]
    assert "AS returned" in below and "AS tax_rate" in below
