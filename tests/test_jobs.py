"""The sample documents through the command line, end to end."""

from datetime import date
from decimal import Decimal

import pytest
from support import values

from ledgerlake.jobs import parser, run
from ledgerlake.operators import KeyedTable
from ledgerlake.plans import commerce, crates
from ledgerlake.session import scratch, scratch_database
from ledgerlake.sources import flatten_invoices, read_delimited, read_json_docs
from ledgerlake.specs import CRATE_ORDERS, INVOICE_ENVELOPE

SAMPLES = {
    "accounts": [
        '{"_id":{"$oid":"a1"},"account_id":"a10","name":"Till","type":"own"}',
        '{"_id":{"$oid":"a2"},"account_id":"b20","name":"Leases owed","type":"owed"}',
    ],
    "close_tasks": [
        '{"task_id":"T1","name":"Count stock","assigned_to":"Noor","status":"Complete","due_date":"2023-04-02"}',
        '{"task_id":"T2","name":"Check leases","assigned_to":"Ivo","status":"In Progress","due_date":"2023-04-03"}',
    ],
    "journal_entries": [
        '{"_id":"x","entry_id":"E31","date":"2023-03-14","lines":[{"account_id":"a10","debit":320,"credit":0},'
        '{"account_id":"b20","debit":0,"credit":320}],"description":"Van hire"}',
        '{"_id":"bad","entry_id":"E32","date":"2023-03-14","lines":[{"account_id":"a10","debit":"much","credit":0}]}',
    ],
    "orders": [
        '{"order_id":"o1","customer_id":"c","order_date":"2025-01-02","status":"s","lines":'
        '[{"product_id":"p","quantity":1,"unit_price":"2.50","line_total":"2.50"}]}'
    ],
}
FIRST, LATER = "2023-05-04T03:02:01", "2023-05-05T00:00:00"


def job(spark, *argv):
    run(spark, parser().parse_args(list(argv)))


def where(spark):
    """A database of its own and where its marks go."""
    return scratch_database(spark, "warehouse"), scratch(spark, "marks")


@pytest.fixture
def files(tmp_path):
    for name, lines in SAMPLES.items():
        (tmp_path / f"{name}.json").write_text("\n".join(lines) + "\n")
    return [f"{name}={tmp_path}/{name}.json" for name in SAMPLES]


def test_sample_documents_to_gold(spark, files):
    db, root = where(spark)
    at = ["--root", root, "--database", db]
    for ts, how in ((FIRST, []), (LATER, ["--incremental"])):  # the second load brings the same documents again
        job(spark, "ingest", *files, *at, "--run-ts", ts)
        job(spark, "curate", *at, "--run-ts", ts, *how)
        job(spark, "orders", *at, "--run-ts", ts, *how)
    day = date(2023, 3, 14)
    silver = spark.table(f"{db}.journal_entries_silver")
    assert values(silver.select("entry_id", "entry_date", "account_name", "debit", "credit")) == [
        ("E31", day, "Leases owed", Decimal("0.00"), Decimal("320.00")),
        ("E31", day, "Till", Decimal("320.00"), Decimal("0.00")),
    ]
    gold = spark.table(f"{db}.journal_entries_gold")
    assert values(gold.select("entry_id", "entry_date", "total_credit", "total_debit")) == [
        ("E31", day, Decimal("320.00"), Decimal("320.00"))
    ]
    tasks = spark.table(f"{db}.close_tasks_silver")
    assert values(tasks.select("task_id", "due_date")) == [("T1", date(2023, 4, 2)), ("T2", date(2023, 4, 3))]
    orders = spark.table(f"{db}.orders_silver")
    assert values(orders.select("order_id", "total_amount", "line_count")) == [("o1", Decimal("2.50"), 1)]
    rejects = spark.table(f"{db}.rejects_journal_entries")
    assert [(r._id, r._problems) for r in rejects.collect()] == [("bad", '["lines"]')] * 2
    assert {r._source for r in rejects.collect()} == {SAMPLES["journal_entries"][1]}


def test_reports_from_files(spark, tmp_path):
    db, root = where(spark)
    header = ";".join(CRATE_ORDERS.schema.names)
    (tmp_path / "o.csv").write_text(f'{header}\no1;29.01.22;k;n;Plastic;"[{{""contact_name"":""A""}}]";"X, Y"\n')
    (tmp_path / "i.json").write_text(
        '{"data":{"invoices":[{"id":"i1","orderId":"o1","companyId":"k","grossValue":10000,"vat":0}]}}\n'
    )
    paths = ["--orders", f"{tmp_path}/o.csv", "--invoices", f"{tmp_path}/i.json"]
    job(spark, "report", *paths, "--as-of", "2022-02-01", "--root", root, "--database", db)
    totals = spark.table(f"{db}.salesowner_commission")
    assert values(totals) == [("X", Decimal("6.00")), ("Y", Decimal("2.50"))]
    orders = read_delimited(spark, f"{tmp_path}/o.csv", CRATE_ORDERS.schema)
    invoices = flatten_invoices(read_json_docs(spark, f"{tmp_path}/i.json", INVOICE_ENVELOPE))
    assert "training_last_12m" in crates.register_views(orders, invoices, "2022-02-01")
    assert spark.sql("SELECT order_count FROM training_last_12m WHERE salesowner = 'Y'").first()[0] == 1


def test_analytics_table_by_year_and_month(spark):
    name = f"{scratch_database(spark, 'flat')}.orders"
    row = ("1", "o", "e", "p", 2, Decimal("1.50"), "2024-02-03T04:05:06", "s", '{"city":"X"}', None)
    ddl = "_id string, order_id string, customer_email string, product string, quantity int, price decimal(18,2), order_date string, status string, shipping_address string, metadata string"
    commerce.publish_analytics(spark, name, spark.createDataFrame([row], ddl))
    table = KeyedTable(spark, name, ["_id"], ["order_year", "order_month"])
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["order_year=2024/order_month=2"]
    got = table.read().first()
    assert (got.total_amount, got.shipping_city, got.order_day) == (Decimal("3.00"), "X", 3)
    table.merge(table.read())
    assert table.read().count() == 1
