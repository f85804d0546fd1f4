"""Order documents and crate sales, one test per rule that is easy to get wrong."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from support import plan, values

from ledgerlake.plans import commerce, crates
from ledgerlake.sources import flatten_invoices, read_json_docs
from ledgerlake.specs import INVOICE_ENVELOPE

T0, T1 = datetime(2025, 1, 1), datetime(2025, 1, 2)
ORDER_DDL = "order_id string, customer_id string, order_date string, status string, lines array<struct<product_id: string, quantity: int, unit_price: string, line_total: string>>, ingest_ts timestamp_ntz"
CRATE_DDL = "order_id string, date string, company_id string, company_name string, crate_type string, contact_data string, salesowners string"


def test_metrics_of_the_latest_document(spark):
    lines = [(p, 1, "1", t) for p, t in (("p9", "1.10"), ("p1", "2.20"), ("p1", "x"), (None, "3"), ("p3", None), ("p4", "1"), ("p5", "1"), ("p6", "1"))]
    raw = spark.createDataFrame(
        [
            ("o1", "c", "2025-01-01", "old", [("z", 1, "1", "99")], T0),
            ("o1", "c", "2025-01-01", "new", lines, T1),
            ("o2", "c", "bad", "s", [("z", 1, "1", "n/a")], T0),
            ("o3", "c", "2025-01-01", "s", [], T0),
            ("o4", "c", "2025-01-01", "s", None, T0),
            (None, "c", "2025-01-01", "s", lines, T0),
        ],
        ORDER_DDL,
    )
    silver = commerce.orders_silver(raw)
    assert "Generate" not in plan(silver)
    picked = silver.select("order_id", "status", "order_date", "total_amount", "line_count", "distinct_product_count", "first_product_ids", "last_update_ts")
    assert values(picked) == [
        ("o1", "new", date(2025, 1, 1), Decimal("9.30"), 8, 6, ["p1", "p3", "p4", "p5", "p6"], T1),
        ("o2", "s", None, None, 1, 1, ["z"], T0),
    ]


@pytest.fixture
def orders(spark):
    full = '[{"contact_name":"Ann","contact_surname":"Lee","city":"Oslo","cp":"0150"},{"contact_name":"Bo"}]'
    return spark.createDataFrame(
        [
            (" o1 ", "29.01.22", "k1", "Snacks", "Plastic", full, "Zoe, Al,Bo , Cy"),
            ("o2", "15.02.22", "k1", "Snacks Co", "Plastic", '[{"contact_name":"Ann","city":"Oslo"}]', "Al"),
            ("o3", "xx", "k2", "Fruit", "Wood", "", "Al, Bo"),
            ("o4", "15.03.22", "k2", "Fruit", "Plastic", "not json", "Al, Al"),
        ],
        CRATE_DDL,
    )


def test_contacts(orders):
    picked = crates.order_contacts(orders).select("order_id", "contact_full_name", "contact_city", "contact_cp")
    assert values(picked) == [
        ("o1", "Ann Lee", "Oslo", "0150"),
        ("o2", "John Doe", "Oslo", "UNK00"),
        ("o3", "John Doe", "Unknown", "UNK00"),
        ("o4", "John Doe", "Unknown", "UNK00"),
    ]
    assert values(crates.order_contact_address(crates.order_contacts(orders)))[0] == ("o1", "Oslo,0150")
    assert crates.contact_rows(orders).count() == 5
    assert crates.order_contact_names(crates.order_contacts(orders)).count() == 4


def test_companies_have_one_name_and_orders_are_not_multiplied(orders):
    contacts = crates.order_contacts(orders)
    assert values(crates.company_crate_distribution(contacts)) == [
        ("k1", "Snacks", "Plastic", 2),
        ("k2", "Fruit", "Plastic", 1),
        ("k2", "Fruit", "Wood", 1),
    ]
    assert values(crates.crate_order_distribution(contacts)) == [("Plastic", 3), ("Wood", 1)]
    assert values(crates.company_salesowner_list(contacts)) == [("k1", "Snacks", "Al, Bo, Cy, Zoe"), ("k2", "Fruit", "Al, Bo")]
    assert crates.company_salesowners(contacts).count() == 6


def test_owner_lists_and_reports(orders):
    owners = crates.order_sales_owners(crates.order_contacts(orders))
    assert owners.where("order_id = 'o1'").count() == 4
    assert owners.where("order_id = 'o4'").count() == 1
    assert values(crates.training_last_12m(owners, "2023-02-01").select("salesowner", "crate_type", "order_count")) == [
        ("Al", "Plastic", 2)
    ]
    rolling = {(r.salesowner, str(r.sales_month)): (r.total_sales, r.rolling_sales) for r in crates.rolling_3m_sales(owners).collect()}
    assert rolling[("Al", "2022-03-01")] == (1, 3)
    best = crates.top_sellers_by_month(owners, n=1)
    assert values(best.select("sales_month", "salesowner", "place")) == [
        (date(2022, 1, 1), "Al", 1),
        (date(2022, 2, 1), "Al", 1),
        (date(2022, 3, 1), "Al", 1),
    ]
    assert crates.top_k_sellers(owners, k=2).count() == 2


def test_rolling_counts_calendar_months_not_rows(spark):
    rows = [("o1", date(2021, 1, 5)), ("o2", date(2021, 2, 5)), ("o3", date(2021, 6, 5)), ("o4", date(2022, 1, 5))]
    owners = spark.createDataFrame([(o, d, "Al", "Plastic") for o, d in rows], "order_id string, formatted_date date, salesowner string, crate_type string")
    got = values(crates.rolling_3m_sales(owners).select("sales_month", "rolling_sales"))
    assert [n for _, n in got] == [1, 2, 1, 1]


def test_commission_is_rounded_per_invoice(spark, orders, tmp_path):
    (tmp_path / "invoices.json").write_text(
        '{"data":{"invoices":[{"id":"i1","orderId":"o2","companyId":"k1","grossValue":1050,"vat":0},'
        '{"id":"i2","orderId":"o2","companyId":"k1","grossValue":1050,"vat":0}]}}'
    )
    envelopes = read_json_docs(spark, str(tmp_path), INVOICE_ENVELOPE)
    lines = crates.commission_lines(crates.order_contacts(orders), flatten_invoices(envelopes))
    row = lines.first()
    assert (row.primary_commission_euro, row.co_owner_1, row.co_owner_1_commission_euro) == (Decimal("0.63"), None, Decimal("0.00"))
    assert values(crates.salesowner_commission(lines)) == [("Al", Decimal("1.26"))]
