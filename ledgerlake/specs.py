"""Declared shapes of the collections: source schema, keys, event column, partition rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def strings(names: str, **typed: T.DataType) -> T.StructType:
    """A struct of string fields, followed by fields of other types."""
    fields = [T.StructField(n, T.StringType()) for n in names.split()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in typed.items()])


@dataclass(frozen=True)
class CollectionSpec:
    """What a pipeline has to know about one collection."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    event_col: str = "ingest_ts"
    partition_by: str | None = None


# Field names and types of the source documents.
JOURNAL_LINE = strings("account_id", debit=MONEY, credit=MONEY)
ORDER_LINE = strings("product_id", quantity=T.IntegerType(), unit_price=T.StringType(), line_total=T.StringType())
CONTACT = strings("contact_name contact_surname city cp")
INVOICE = strings("id orderId companyId", grossValue=T.LongType(), vat=T.IntegerType())

ACCOUNTS = CollectionSpec("accounts", strings("_id account_id name type"), ("account_id",))
CLOSE_TASKS = CollectionSpec(
    "close_tasks",
    strings("_id task_id name assigned_to status due_date"),
    ("task_id",),
    partition_by="due_month",
)
JOURNAL_ENTRIES = CollectionSpec(
    "journal_entries",
    strings("_id entry_id date", lines=T.ArrayType(JOURNAL_LINE), description=T.StringType()),
    ("entry_id", "account_id"),
    partition_by="entry_month",
)
ORDERS = CollectionSpec(
    "orders",
    strings(
        "_id order_id customer_id order_date status total_amount",
        lines=T.ArrayType(ORDER_LINE),
        ingest_ts=T.TimestampNTZType(),
    ),
    ("order_id",),
    partition_by="order_date",
)
CUSTOMERS = CollectionSpec(
    "customers", strings("_id customer_id name email created_at", ingest_ts=T.TimestampNTZType()), ("customer_id",)
)
PRODUCTS = CollectionSpec(
    "products", strings("_id product_id name category price", ingest_ts=T.TimestampNTZType()), ("product_id",)
)
FLAT_ORDERS = CollectionSpec(
    "flat_orders",
    strings(
        "_id order_id customer_email product",
        quantity=T.IntegerType(),
        price=MONEY,
        order_date=T.StringType(),
        status=T.StringType(),
        shipping_address=T.StringType(),
        metadata=T.StringType(),
    ),
    ("order_id",),
)
CRATE_ORDERS = CollectionSpec(
    "crate_orders",
    strings("order_id date company_id company_name crate_type contact_data salesowners"),
    ("order_id",),
    event_col="date",
)
CONTACTS = T.ArrayType(CONTACT)
INVOICE_ENVELOPE = strings("", data=strings("", invoices=T.ArrayType(INVOICE)))
#: Where an envelope has its invoices, and their fields by the names of the rows made of them.
INVOICE_ROWS = ("data.invoices", {"id": "invoice_id", "orderId": "order_id", "companyId": "company_id", "grossValue": "gross_value", "vat": "vat"})

COLLECTIONS = {
    spec.name: spec
    for spec in (ACCOUNTS, CLOSE_TASKS, JOURNAL_ENTRIES, ORDERS, CUSTOMERS, PRODUCTS, FLAT_ORDERS, CRATE_ORDERS)
}
