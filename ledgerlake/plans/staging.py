"""The driver's tables in the shape of the source documents.

Every document is built from one row, so no key, however frequent, is collected into one task. What
real feeds have is kept or put in: several loads of one key, entries without lines, missing keys and
load times, text that is no date or number, a tax account that takes part in most entries.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.specs import JOURNAL_ENTRIES, MONEY, strings

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become documents one by one; building and parsing them is the costly part."""
    return table(spark, sf_dir, name)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _posted_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(orders with their lines, orders without)``."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),  # the tax itself has more digits to shuffle
        (F.col("l_returnflag") == "R").alias("returned"),
        "l_shipdate",
    )
    # Not a left join: AQE can split a hot key on either side of an inner join, but never on the
    # optional side of an outer one.
    sold = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    keys = lines.select("l_orderkey").distinct()
    unsold = orders.join(keys, orders.o_orderkey == keys.l_orderkey, "left_anti")
    return sold, unsold


def raw_journal(spark: SparkSession, sf_dir: str, by_load: bool = False) -> DataFrame:
    """Double entries: part against supplier, and the tax account when there is tax. Returns swap sides.

    ``by_load`` makes the entries that have a load time of their own apart from those that have their order's, so that a
    range of load times reaches the lines before they are shuffled; that pays where loads are read one after the other.
    """
    zero = F.lit(0).cast(MONEY)
    returned = F.col("returned")

    def line(account: Column, debit: Column, credit: Column) -> Column:
        return F.struct(
            account.alias("account_id"),
            F.when(returned, credit).otherwise(debit).alias("debit"),
            F.when(returned, debit).otherwise(credit).alias("credit"),
        )

    amount = F.col("amount")
    tax = (amount * F.col("tax_rate")).cast(MONEY)
    base = [line(_text("P", F.col("l_partkey")), amount, zero), line(_text("S", F.col("l_suppkey")), zero, amount)]
    filled = F.when(tax > 0, F.array(*base, line(F.lit("TAX"), zero, tax))).otherwise(F.array(*base))

    def entries(rows: DataFrame, id_of: list[str], lines: Column, loaded: Column) -> DataFrame:
        return rows.select(
            F.concat_ws("-", *id_of).alias("_id"),
            _text("JE", F.col("o_orderkey")).alias("entry_id"),
            F.to_date("o_orderdate").cast("string").alias("date"),
            lines.cast(JOURNAL_ENTRIES.schema["lines"].dataType).alias("lines"),
            F.col("o_orderpriority").alias("description"),
            loaded.alias("ingest_ts"),
        )

    sold, unsold = _posted_lines(spark, sf_dir)
    line_ids = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    if by_load:
        journal = entries(sold.where("l_shipdate IS NOT NULL"), line_ids, filled, F.col("l_shipdate"))
        # a time of both tables, though it is the order's: no range reaches the orders, so both parts share their shuffle
        others = entries(sold.where("l_shipdate IS NULL"), line_ids, filled, F.coalesce("l_shipdate", "o_orderdate"))
        journal = journal.unionByName(others)
    else:
        journal = entries(sold, line_ids, filled, F.coalesce("l_shipdate", "o_orderdate"))
    # apart, so that their lines are constants and jobs that read only lines need not make these entries
    for rest, lines in ((1, F.array()), (0, F.lit(None))):
        without = unsold.where(F.coalesce(F.col("o_orderkey") % 2 == 1, F.lit(False)) == F.lit(bool(rest)))
        journal = journal.unionByName(entries(without, ["o_orderkey"], lines, F.col("o_orderdate")))
    return journal


def revised_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal, in which the documents of every third part had an earlier load with an account that they have no more."""
    now = raw_journal(spark, sf_dir)
    part = F.split_part("_id", F.lit("-"), F.lit(3)).try_cast("long")
    dropped = F.struct(F.lit("DROPPED").alias("account_id"), F.lit(5).cast(MONEY).alias("debit"), F.lit(0).cast(MONEY).alias("credit"))
    earlier = now.where((part % 3 == 0) & F.col("lines").isNotNull()).withColumns(
        {"lines": F.array_append("lines", dropped), "ingest_ts": F.col("ingest_ts") - F.expr("INTERVAL 1 DAY")}
    )
    return now.unionByName(earlier)


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a task as the lines of one array; the last is held back until it is known to be that."""
    begin, last = "[", None
    for batch in batches:
        if batch.num_rows:
            docs = batch.column(0)
            ready = docs.slice(0, len(docs) - 1)
            if last is not None:
                yield pa.RecordBatch.from_arrays([pa.array([f"{begin}{last},"])], ["line"])
                begin = ""
            if len(ready):
                lines = pc.binary_join_element_wise(ready, ",", "")
                if begin:
                    lines = pa.concat_arrays([pc.binary_join_element_wise(begin, lines.slice(0, 1), ""), lines.slice(1)])
                    begin = ""
                yield pa.RecordBatch.from_arrays([lines], ["line"])
            last = docs[len(docs) - 1].as_py()
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([f"{begin}{last}]"])], ["line"])


def write_array_files(docs: DataFrame, path: str) -> None:
    """Documents as JSON arrays, one file of each task and in it one array; a document ends its line. No row moves."""
    docs.select(F.to_json(F.struct("*")).alias("doc")).mapInArrow(_array_lines, "line string").write.text(path)


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as accounts, each loaded twice under two names."""
    parts = table(spark, sf_dir, "part").select(
        _text("P", F.col("p_partkey")).alias("account_id"), F.col("p_name").alias("name"), F.col("p_type").alias("type")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        _text("S", F.col("s_suppkey")).alias("account_id"), F.col("s_name").alias("name"), F.lit("SUPPLIER").alias("type")
    )
    loads = F.array(
        F.struct(_text("old ", F.col("name")).alias("name"), ntz("1994-01-01").alias("ingest_ts")),
        F.struct(F.col("name").alias("name"), ntz("1995-01-01").alias("ingest_ts")),
    )
    return (
        parts.unionByName(suppliers)
        .select("account_id", "type", F.explode(loads).alias("_load"))
        .select("account_id", "_load.name", "type", "_load.ingest_ts")
    )


def renamed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts, loaded again at times that depend on them: some with another name, some as they were, some never."""
    loads = raw_accounts(spark, sf_dir).where("ingest_ts >= DATE'1995-01-01'")
    turn = F.pmod(F.crc32(F.col("account_id").cast("binary")), F.lit(4))
    days = lambda n: F.col("ingest_ts") + F.expr(f"INTERVAL {n} DAY")
    again = F.array(
        F.struct(F.col("name"), days(900).alias("ingest_ts")),
        F.struct(_text("new ", F.col("name")).alias("name"), days(1500).alias("ingest_ts")),
        F.struct(F.col("name"), days(2000).alias("ingest_ts")),
    )
    later = loads.select("account_id", "type", turn.alias("_turn"), F.explode(again).alias("_load")).where("_turn > 0")
    return loads.unionByName(later.select("account_id", "_load.name", "type", "_load.ingest_ts"))


def raw_close_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task per user; some rows lack the task id, the load time or a proper due date."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        i.cast("string").alias("_id"),
        F.when(i % 97 != 0, _text("T", F.col("user_id"))).alias("task_id"),
        F.col("event_type").alias("name"),
        _text("user ", i % 7).alias("assigned_to"),
        F.when(F.col("event_type") == "purchase", "Complete").otherwise("In Progress").alias("status"),
        F.when(i % 50 == 0, "n/a").otherwise(F.to_date("ts").cast("string")).alias("due_date"),
        F.when(i % 31 != 0, F.col("ts")).alias("ingest_ts"),
        F.col("ts").alias("arrived_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of order documents; each brings as many lines as its line number. Amounts are text, some unreadable."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")

    def line(i: Column) -> Column:
        i = i.cast("bigint")
        bad = (part + i) % 41 == 0
        return F.struct(
            _text("P", part + (i % 3) * supp).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("amount").cast("string").alias("unit_price"),
            F.when(bad, "n/a").otherwise((F.col("amount") * i.cast("int")).cast(MONEY).cast("string")).alias("line_total"),
        )

    sold, unsold = _posted_lines(spark, sf_dir)
    return sold.unionByName(unsold, allowMissingColumns=True).select(
        F.concat_ws("-", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("_id"),
        _text("O", F.col("o_orderkey")).alias("order_id"),
        _text("C", F.col("o_custkey")).alias("customer_id"),
        F.to_date("o_orderdate").cast("string").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("total_amount"),
        F.when(F.col("l_orderkey").isNotNull(), F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), line)).alias(
            "lines"
        ),
        F.coalesce("l_shipdate", "o_orderdate").alias("ingest_ts"),
    )


def extended_json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as extended JSON text: odd line numbers wrapped, even ones plain, dates also as milliseconds.

    By part, some documents are no JSON, have a date that is none, text for lines, or a fraction of a second.
    """
    fault = F.col("l_partkey") % 40
    doc_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    price = F.col("l_extendedprice").cast(MONEY).cast("string")
    shipped = F.timestamp_millis(F.unix_millis(F.col("l_shipdate").cast("timestamp")) + F.when(fault == 4, 678).otherwise(0))
    iso = F.when(fault == 2, "not a date").when(fault == 4, F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    iso = iso.otherwise(F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    millis = F.when(fault == 2, "not a date").otherwise(F.unix_millis(shipped).cast("string"))
    qty = F.col("l_quantity").cast("int")

    def tag(name: str, c: Column) -> Column:
        return F.struct(c.alias(name))

    def lines(wrapped: bool) -> Column:
        def line(i: Column) -> Column:
            product = _text("P", F.col("l_partkey") + i)
            return F.struct(
                (tag("$oid", product) if wrapped else product).alias("product_id"),
                (tag("$numberInt", (qty + i).cast("string")) if wrapped else qty + i).alias("quantity"),
            )

        return F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), line)

    def doc(date: Column, wrapped: bool) -> Column:
        head = (
            (tag("$oid", doc_id) if wrapped else doc_id).alias("_id"),
            date.alias("shipped_at"),
            (tag("$numberDecimal", price) if wrapped else price).alias("total"),
        )
        text_for_lines = F.to_json(F.struct(*head, F.lit("oops").alias("lines")))
        whole = F.to_json(F.struct(*head, lines(wrapped).alias("lines")))
        return F.when(fault == 1, _text("not json ", doc_id)).when(fault == 3, text_for_lines).otherwise(whole)

    wrapped_doc = F.when(
        F.col("l_linenumber") % 4 == 1, doc(tag("$date", iso), True)
    ).otherwise(doc(tag("$date", tag("$numberLong", millis)), True))
    texts = F.when(F.col("l_linenumber") % 2 == 1, wrapped_doc).otherwise(doc(iso, False))
    # a generator of one row: of a plain projection every filter and projection above would write the text again
    return documents(spark, sf_dir, "lineitem").select(F.inline(F.array(F.struct(texts.alias("doc")))))


def text_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with every field as text, some of it unreadable, and a field no schema asks for."""
    return documents(spark, sf_dir, "lineitem").select(
        _text("O", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        F.when(F.col("l_linenumber") == 7, "seven").otherwise(F.col("l_quantity").cast("int").cast("string")).alias(
            "quantity"
        ),
        F.when(F.col("l_partkey") % 50 == 0, "not a date")
        .otherwise(F.to_date("l_shipdate").cast("string"))
        .alias("shipped_on"),
        F.array(
            F.struct(
                _text("P", F.col("l_partkey")).alias("product_id"),
                F.when(F.col("l_suppkey") % 30 == 0, "?")
                .otherwise(F.col("l_extendedprice").cast(MONEY).cast("string"))
                .alias("line_total"),
            )
        ).alias("lines"),
        F.col("l_returnflag").alias("flag"),
    )


TEXT_ORDER_SCHEMA = strings(
    "order_id",
    line_no=T.LongType(),
    quantity=T.LongType(),
    shipped_on=T.DateType(),
    lines=T.ArrayType(strings("product_id", line_total=MONEY)),
    note=T.StringType(),
)


def drifting_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents by year of their load: from 1997 on they change shape, a little more each year, and some are no JSON."""
    year = F.year("o_orderdate")
    line = F.struct(
        _text("P", F.col("o_custkey")).alias("product_id"),
        F.when(year < 1998, F.col("o_custkey").cast("int")).alias("quantity"),
        F.lit("1.50").alias("unit_price"),
        F.when(year >= 1997, F.lit(2)).alias("rebate"),
    )
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("_id"),
        _text("O", F.col("o_orderkey")).alias("order_id"),
        F.when(year < 2000, F.lit("C")).alias("customer_id"),
        F.to_date("o_orderdate").cast("string").alias("order_date"),
        F.when(year >= 1999, F.struct(F.lit("web").alias("channel"))).alias("origin"),
        F.array(line).alias("lines"),
    )
    # a status is text, later a number in some documents and text in others
    head = F.when((year >= 2000) & (F.col("o_orderkey") % 2 == 0), '{"status":7,').otherwise('{"status":"done",')
    amount = F.when(year >= 2001, '"total_amount":true,').otherwise('"total_amount":"9.99",')
    whole = F.concat(head, amount, F.substring(F.to_json(doc), 2, 1 << 20))
    return table(spark, sf_dir, "orders").select(year.alias("load_year"), F.when(F.col("o_orderkey") % 50 == 49, "{ no json").otherwise(whole).alias("doc"))


def flat_orders(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    """Flat orders with address and metadata objects, as JSON text unless ``nested``."""
    address = F.struct(
        _text(F.col("l_linenumber"), " Quay").alias("street"),
        _text("City ", F.col("l_suppkey")).alias("city"),
        F.col("l_returnflag").alias("state"),
    )
    metadata = F.struct(F.lit("kiosk").alias("source"), _text("DRIVE-", F.col("l_linenumber")).alias("campaign_id"))
    return documents(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("_id"),
        _text("F", F.col("l_orderkey")).alias("order_id"),
        _text("buyer", F.col("l_suppkey"), "@mail.test").alias("customer_email"),
        _text("P", F.col("l_partkey")).alias("product"),
        (F.when(F.col("l_linenumber") == 7, 0).otherwise(F.col("l_quantity").cast("int"))).alias("quantity"),
        F.when(F.col("l_linenumber") != 6, F.col("l_extendedprice").cast(MONEY)).alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("order_date"),
        F.col("l_linestatus").alias("status"),
        (address if nested else F.to_json(address)).alias("shipping_address"),
        (metadata if nested else F.to_json(metadata)).alias("metadata"),
    )


def _owner(n: Column) -> Column:
    return _text("Owner ", n)


def crate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crate orders of companies; contacts have gaps, owner lists one to four names with either spacing.

    Two-digit years are read as 20yy, so the days are moved twenty years on.
    """
    orders = documents(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    first, last = _text("Ann", F.col("c_nationkey")), _text("Lee", cust % 10)
    city, cp = _text("City ", F.col("c_nationkey")), F.lpad((cust % 100000).cast("string"), 5, "0")
    person = F.to_json(F.array(F.struct(*[c.alias(n) for c, n in zip((first, last, city, cp), CONTACT_FIELDS)])))
    no_surname = F.to_json(F.array(F.struct(first.alias("contact_name"), city.alias("city"), cp.alias("cp"))))
    no_city = F.to_json(F.array(F.struct(first.alias("contact_name"), last.alias("contact_surname"))))
    two = F.to_json(
        F.array(
            F.struct(*[c.alias(n) for c, n in zip((first, last, city, cp), CONTACT_FIELDS)]),
            F.struct(*[c.alias(n) for c, n in zip((last, first, city, cp), CONTACT_FIELDS)]),
        )
    )
    case = key % 6
    contacts = (
        F.when(case == 0, "")
        .when(case == 1, no_surname)
        .when(case == 2, no_city)
        .when(case == 3, "not json")
        .when(case == 4, two)
        .otherwise(person)
    )
    owners = F.array(_owner(cust % 89), _owner((cust + key) % 83), _owner(key % 79), _owner((key + 1) % 79))
    some = F.slice(owners, F.lit(1), (key % 4 + 1).cast("int"))
    priority = F.col("o_orderpriority")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        _text("CO", key).alias("order_id"),
        F.date_format(F.add_months("o_orderdate", 240), "dd.MM.yy").alias("date"),
        _text("K", cust).alias("company_id"),
        F.when(key % 2 == 1, _text(F.col("c_name"), " Co")).otherwise(F.col("c_name")).alias("company_name"),
        F.when(priority == "1-URGENT", "Plastic").when(priority == "2-HIGH", "Wood").otherwise("Metal").alias("crate_type"),
        contacts.alias("contact_data"),
        F.when(key % 3 == 0, F.array_join(some, ",")).otherwise(F.array_join(some, ", ")).alias("salesowners"),
    )


CONTACT_FIELDS = ("contact_name", "contact_surname", "city", "cp")


def invoice_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per order, with a second invoice for every third."""
    key = F.col("o_orderkey")
    cents = (F.col("o_totalprice").cast(MONEY) * 100).cast("bigint")

    def invoice(suffix: str, value: Column) -> Column:
        return F.struct(
            _text("I", key, suffix).alias("id"),
            _text("CO", key).alias("orderId"),
            _text("K", F.col("o_custkey")).alias("companyId"),
            value.alias("grossValue"),
            F.when(F.col("o_orderstatus") == "F", 19).otherwise(0).alias("vat"),
        )

    one, two = invoice("-1", cents), invoice("-2", cents % 100000)
    invoices = F.when(key % 3 == 0, F.array(one, two)).otherwise(F.array(one))
    return documents(spark, sf_dir, "orders").select(F.struct(invoices.alias("invoices")).alias("data"))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of user rows: an error event deletes the row, any other sets it."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        F.col("event_type").alias("last_event"),
        F.col("value").cast(MONEY).alias("last_value"),
        F.col("ts").alias("changed_at"),
    )


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits of many tables of three classes."""
    cls = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        _text("table_", F.col("user_id")).alias("table_name"),
        F.when(cls == 0, "raw").when(cls == 1, "silver").otherwise("gold").alias("table_class"),
        F.col("event_id").alias("snapshot_id"),
        F.col("ts").alias("committed_at"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files by day with size and change time; the files of click events are referenced."""
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        _text("data/day=", day, "/", F.col("event_id"), ".parquet").alias("path"),
        day.alias("day"),
        (F.col("value").cast(MONEY) * 1000000).cast("bigint").alias("bytes"),
        F.col("ts").alias("modified_at"),
        F.col("event_type"),
    )
