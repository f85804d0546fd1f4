"""The registered queries: each runs one operator or job over the whole tables of a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import functions as fn
from ledgerlake import operators as op
from ledgerlake import sources as src
from ledgerlake.plans import commerce, crates, ledger, staging
from ledgerlake.plans.staging import RUN_TS, ntz, table
from ledgerlake.session import scratch, scratch_database
from ledgerlake.specs import CRATE_ORDERS, INVOICE_ENVELOPE, JOURNAL_ENTRIES, MONEY, ORDERS, CollectionSpec, strings
from ledgerlake.streaming import append_stream, dedup_stream, mark_late, sync_stream, timed_state
from ledgerlake.streaming.changes import DELETED, live_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2021-08-01"
EVENTS_SPLIT = "2024-01-16"
ORDERS_SPLIT = "1998-06-01"
EXTENDED_ORDERS = CollectionSpec(
    "extended_orders",
    strings(
        "_id",
        shipped_at=T.TimestampNTZType(),
        total=MONEY,
        lines=T.ArrayType(strings("product_id", quantity=T.IntegerType())),
    ),
    ("_id",),
)


DRIFT_DECLARED = T.StructType([f for f in ORDERS.schema.fields if f.name != "ingest_ts"])


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _arrived(raw: DataFrame, col: str, split: str) -> tuple[DataFrame, DataFrame]:
    """What was loaded before ``split`` and what came after; together all rows."""
    return raw.where(F.col(col) < ntz(split)), raw.where(F.col(col) >= ntz(split))


# sources


def _entry_summary(docs: DataFrame) -> DataFrame:
    debits = F.aggregate("lines", F.lit(0).cast("decimal(28,2)"), lambda a, x: (a + x.debit).cast("decimal(28,2)"))
    return docs.select(
        "_id",
        "entry_id",
        "date",
        "description",
        F.size("lines").cast("bigint").alias("line_count"),
        debits.cast(MONEY).alias("total_debit"),
    )


@query
def scan_json_docs(spark, sf):
    path = scratch(spark, "journal-json")
    staging.raw_journal(spark, sf).drop("ingest_ts").write.json(path, compression="gzip")
    return _entry_summary(src.read_json_docs(spark, path, JOURNAL_ENTRIES.schema))


@query
def scan_json_array(spark, sf):
    """Files that hold one array each, every split of them read by a task."""
    path = scratch(spark, "journal-array")
    staging.write_array_files(staging.raw_journal(spark, sf).drop("ingest_ts"), path)
    return _entry_summary(src.read_json_array(spark, path, JOURNAL_ENTRIES.schema))


@query
def scan_json_inferred(spark, sf):
    """The schema comes from the documents; all are read."""
    path = scratch(spark, "invoices-inferred")
    staging.invoice_envelopes(spark, sf).write.json(path)
    docs = src.read_json_inferred(spark, path, 1.0)
    return src.flatten_invoices(docs)


@query
def invoices_flatten(spark, sf):
    path = scratch(spark, "invoices-json")
    staging.invoice_envelopes(spark, sf).write.json(path)
    return src.flatten_invoices(src.read_json_docs(spark, path, INVOICE_ENVELOPE)).withColumn(
        "vat", F.col("vat").cast("bigint")
    )


@query
def scan_csv_orders(spark, sf):
    path = scratch(spark, "crates-csv")
    staging.crate_orders(spark, sf).write.option("sep", ";").option("header", "true").option("escape", '"').csv(path)
    return src.read_delimited(spark, path, CRATE_ORDERS.schema)


@query
def read_collection(spark, sf):
    docs = src.read_collection(spark, "parquet", {"path": f"{sf}/customer.parquet"})
    return docs.select("c_custkey", "c_name", "c_mktsegment")


@query
def read_dump_range(spark, sf):
    """A range of keys from a dump that is in their order; documents are parsed by Spark."""
    path = scratch(spark, "customer-dump")
    customers = table(spark, sf, "customer").withColumn("_id", F.col("c_custkey"))
    docs = customers.select("_id", F.to_json(F.struct("_id", "c_name", "c_mktsegment", F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"))).alias("doc"))
    docs.orderBy("_id").select("doc").write.text(path)
    found = src.read_dump(spark, path, key_type="long", range_bytes=8 << 10).where("_id >= 100 AND _id < 900")
    parsed = F.from_json("doc", "c_name string, c_mktsegment string, c_acctbal decimal(18,2)")
    return found.select(F.col("_id").alias("c_custkey"), F.inline(F.array(parsed)))


@query
def incremental_since_mark(spark, sf):
    loaded, _ = _arrived(table(spark, sf, "events"), "ts", EVENTS_SPLIT)
    store = src.MarkStore(spark, scratch(spark, "marks"))
    store.put("events", src.next_mark(loaded, "event_id").first().mark)
    new = src.since_mark(table(spark, sf, "events"), "event_id", store.get("events", "bigint"))
    return new.select("event_id", "ts", "user_id", "event_type")


@query
def point_lookup(spark, sf):
    return src.point_lookup(table(spark, sf, "orders"), "o_orderkey", 7).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def row_counts(spark, sf):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return src.row_counts({n: table(spark, sf, n) for n in names})


# document normalisation


def _line_texts(c: str) -> Column:
    return F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x.product_id, x.quantity.cast("string"))), ","
    )


@query
def normalize_documents(spark, sf):
    docs = staging.extended_json_orders(spark, sf)
    return fn.normalize_extended_json(docs, "doc", EXTENDED_ORDERS.schema).withColumn("lines", _line_texts("lines"))


@query
def normalize_documents_str(spark, sf):
    docs = staging.extended_json_orders(spark, sf)
    rows = fn.normalize_extended_json(docs, "doc", EXTENDED_ORDERS.schema, leaf_mode="string")
    return rows.withColumn("lines", _line_texts("lines"))


@query
def raw_ingest(spark, sf):
    rows, _ = ledger.ingest_documents(staging.extended_json_orders(spark, sf), "doc", EXTENDED_ORDERS, ntz(RUN_TS))
    return rows.select("_id", "shipped_at", "total", F.size("lines").cast("bigint").alias("line_count"), "ingest_ts")


@query
def ingest_rejects(spark, sf):
    _, rejects = ledger.ingest_documents(staging.extended_json_orders(spark, sf), "doc", EXTENDED_ORDERS, ntz(RUN_TS))
    no_json = ~F.col("_source").startswith("{")
    return rejects.select(
        "_id",
        "shipped_at",
        "total",
        F.size("lines").cast("bigint").alias("line_count"),
        F.array_join("_problems", ",").alias("problems"),
        F.when(no_json, F.col("_source")).alias("source_text"),
        F.col("_source").contains("not a date").alias("source_has_date"),
    )


def _conformed(spark, sf):
    rows = staging.text_order_lines(spark, sf)
    good, rejects = fn.split_conformed(fn.conform(rows, staging.TEXT_ORDER_SCHEMA))
    return [
        df.withColumn("product_id", F.get("lines", F.lit(0)).product_id)
        .withColumn("line_total", F.get("lines", F.lit(0)).line_total)
        .drop("lines")
        for df in (good, rejects)
    ]


@query
def conform_good(spark, sf):
    return _conformed(spark, sf)[0]


@query
def conform_rejects(spark, sf):
    rejects = _conformed(spark, sf)[1]
    return rejects.withColumn("problems", F.array_join("_problems", ",")).drop("_problems")


@query
def schema_drift(spark, sf):
    """What the documents of each year have, lack or have otherwise than declared."""
    docs = staging.drifting_orders(spark, sf)
    return fn.schema_drift(docs, "doc", DRIFT_DECLARED, ["load_year"])


@query
def observed_documents(spark, sf):
    counted = fn.observed_schemas(staging.drifting_orders(spark, sf), "doc", ["load_year"])
    return counted.select("load_year", "documents", "unreadable", F.col("schema").contains("origin").alias("has_origin"))


@query
def nested_to_json(spark, sf):
    rows = fn.nested_to_json(staging.flat_orders(spark, sf, nested=True))
    return rows.select("_id", "shipping_address", "metadata")


@query
def raw_with_ingest_ts(spark, sf):
    return fn.with_ingest_ts(staging.raw_accounts(spark, sf).drop("ingest_ts"), ntz(RUN_TS))


@query
def backfill_ingest_ts(spark, sf):
    return fn.backfill_ingest_ts(staging.raw_close_tasks(spark, sf), ntz(RUN_TS)).select("_id", "task_id", "ingest_ts")


@query
def quality_filter(spark, sf):
    good, _ = fn.quality_split(staging.flat_orders(spark, sf), F.col("quantity") > 0, F.col("price") > 0)
    return good.select("_id", "order_id", F.col("quantity").cast("bigint").alias("quantity"), "price")


@query
def quality_rejects(spark, sf):
    _, rejects = fn.quality_split(staging.flat_orders(spark, sf), F.col("quantity") > 0, F.col("price") > 0)
    return rejects.select("_id", "order_id", F.col("quantity").cast("bigint").alias("quantity"), "price")


@query
def json_extract(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
    )


@query
def quote_repair(spark, sf):
    damaged = F.concat(F.lit('"'), F.regexp_replace("contact_data", '"', '""'), F.lit('"'))
    orders = staging.crate_orders(spark, sf)
    return orders.select("order_id", fn.repair_quotes(damaged).alias("contact_data"))


# ledger


@query
def journal_lines(spark, sf):
    return ledger.journal_lines(staging.raw_journal(spark, sf))


@query
def journal_lines_outer(spark, sf):
    return ledger.journal_lines(staging.raw_journal(spark, sf), keep_empty=True, line_no="line_no")


@query
def latest_close_tasks(spark, sf):
    return ledger.close_tasks_silver(staging.raw_close_tasks(spark, sf), ntz(RUN_TS)).drop("arrived_at")


@query
def journal_enriched(spark, sf):
    return op.enrich(
        ledger.journal_lines(staging.raw_journal(spark, sf)),
        staging.raw_accounts(spark, sf),
        "account_id",
        ledger.ACCOUNT_ATTRIBUTES,
        ["ingest_ts"],
    )


@query
def journal_silver(spark, sf):
    return ledger.journal_silver(staging.raw_journal(spark, sf), staging.raw_accounts(spark, sf))


@query
def journal_silver_by_line(spark, sf):
    return ledger.journal_silver(staging.raw_journal(spark, sf), staging.raw_accounts(spark, sf), by_line=True)


@query
def journal_as_loaded(spark, sf):
    """Lines with the name that their account had when they were loaded."""
    lines = ledger.latest_lines_by_account(staging.raw_journal(spark, sf))
    accounts = staging.renamed_accounts(spark, sf)
    named = op.as_of(lines, accounts, ["account_id"], "ingest_ts", "ingest_ts", ledger.ACCOUNT_ATTRIBUTES, spread=ledger.SPREAD)
    return named.drop(ledger.SPREAD)


@query
def account_versions(spark, sf):
    return op.validity(staging.renamed_accounts(spark, sf), ["account_id"], "ingest_ts", ["name", "type"])


@query
def journal_gold(spark, sf):
    return ledger.journal_gold(ledger.latest_lines(staging.raw_journal(spark, sf)))


@query
def journal_gold_by_line(spark, sf):
    return ledger.journal_gold(ledger.latest_lines(staging.raw_journal(spark, sf), by_line=True))


@query
def journal_gold_revised(spark, sf):
    """Lines that a later load of their document has dropped do not count."""
    return ledger.journal_gold(ledger.latest_lines(staging.revised_journal(spark, sf), by_line=True, revised=True))


@query
def journal_entry_detail(spark, sf):
    return ledger.journal_entry_detail(staging.raw_journal(spark, sf), staging.raw_accounts(spark, sf))


@query
def entry_account_totals(spark, sf):
    return ledger.entry_account_totals(staging.raw_journal(spark, sf), staging.raw_accounts(spark, sf))


@query
def dim_account(spark, sf):
    return ledger.dim_account(staging.raw_accounts(spark, sf))


@query
def fact_journal_line(spark, sf):
    return ledger.fact_journal_line(ledger.latest_lines(staging.raw_journal(spark, sf), whole=True))


@query
def upsert_close_tasks(spark, sf):
    old, new = _arrived(staging.raw_close_tasks(spark, sf), "arrived_at", EVENTS_SPLIT)
    target, source = (ledger.close_tasks_silver(raw, ntz(RUN_TS)).drop("arrived_at") for raw in (old, new))
    return op.upsert(target, source, ["task_id"])


def _journal_halves(spark, sf, by_load: bool = False):
    return [
        ledger.latest_lines(raw) for raw in _arrived(staging.raw_journal(spark, sf, by_load), "ingest_ts", ORDERS_SPLIT)
    ]


@query
def upsert_journal(spark, sf):
    target, source = _journal_halves(spark, sf)
    return op.upsert(target, source, ["entry_id", "account_id"])


@query
def upsert_pruned(spark, sf):
    """The same, the lines of unchanged entries not joined."""
    target, source = _journal_halves(spark, sf)
    return op.upsert(target, source, ["entry_id", "account_id"], prune=True)


@query
def upsert_idempotent(spark, sf):
    target, source = _journal_halves(spark, sf)
    once = op.upsert(target, source, ["entry_id", "account_id"])
    return op.upsert(once, source, ["entry_id", "account_id"])


@query
def journal_gold_refresh(spark, sf):
    """Lines are placed by their entries once, before the halves are told apart, so that hot entries are the same in both."""
    placed = _arrived(ledger.lines_by_entry(staging.raw_journal(spark, sf)), "ingest_ts", ORDERS_SPLIT)
    target, source = (ledger.latest_of_entries(lines) for lines in placed)
    silver = op.upsert(target, source, ["entry_id", "account_id"], placed_by=ledger.SPLIT)
    changed = source.select("entry_id").distinct()
    # totals are narrower than lines, and made where these are
    totals = op.only_known(ledger.journal_gold(silver), changed, "entry_id")
    return op.replace_groups(ledger.journal_gold(target), totals, changed, ["entry_id"])


@query
def journal_gold_deltas(spark, sf):
    """Gold brought up to date by signed changes: what the merge replaces, negative, and what it brings."""
    target, source = _journal_halves(spark, sf)
    keys = ["entry_id", "account_id"]
    replaced = target.join(source.select(*keys).distinct(), keys, "left_semi")
    return ledger.gold_after(ledger.journal_gold_counted(target), ledger.signed_changes(replaced, source))


@query
def load_counts(spark, sf):
    """Documents, rows and rejects of two loads, the second of which is repeated, as the writes have counted them."""
    docs = staging.extended_json_orders(spark, sf)
    halves = {"one": docs.where(F.col("doc").contains("-1-")), "two": docs.where(~F.col("doc").contains("-1-"))}
    database, specs = scratch_database(spark, "loads"), {EXTENDED_ORDERS.name: EXTENDED_ORDERS}
    for load in ("one", "two", "two"):
        ledger.ingest_collections(spark, database, {EXTENDED_ORDERS.name: halves[load]}, ts=ntz(RUN_TS), load=load, specs=specs)
    raw, rejects = (spark.table(f"{database}.{t}_{EXTENDED_ORDERS.name}") for t in ("raw", "rejects"))
    there = raw.select("load_id", F.lit(1).alias("r"), F.lit(0).alias("x")).union(rejects.select("load_id", F.lit(0), F.lit(1)))
    found = there.groupBy("load_id").agg(F.sum("r").alias("rows_found"), F.sum("x").alias("rejects_found"))
    return spark.table(f"{database}.loads").join(found, "load_id")


@query
def dedup_subset(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return op.dedup_subset(lines, ["l_orderkey", "l_linenumber"])


@query
def state_as_of(spark, sf):
    history = staging.raw_close_tasks(spark, sf).drop("ingest_ts")
    keyed, _ = op.split_null_keys(history, ["task_id"])
    return op.state_as_of(keyed, ["task_id"], "arrived_at", "2024-01-10 12:00:00", ["_id"])


@query
def raw_append_union(spark, sf):
    name = f"{scratch_database(spark, 'raw')}.close_tasks"
    raw = staging.raw_close_tasks(spark, sf).withColumn("ingest_date", F.to_date("arrived_at"))
    raw_table = op.KeyedTable(spark, name, ["task_id"], "ingest_date")
    for part in _arrived(raw, "arrived_at", EVENTS_SPLIT):
        raw_table.append(part)
    return raw_table.read().select("_id", "task_id", "due_date", "ingest_date")


# commerce


@query
def latest_orders(spark, sf):
    return commerce.latest_orders(staging.raw_orders(spark, sf)).select(
        "_id", "order_id", "customer_id", "order_date", "status", F.size("lines").cast("bigint").alias("line_count"), "ingest_ts"
    )


def _product_text(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("first_product_ids", F.array_join("first_product_ids", ","))


@query
def order_metrics(spark, sf):
    return _product_text(commerce.order_metrics(commerce.latest_orders(staging.raw_orders(spark, sf))))


@query
def orders_silver(spark, sf):
    old, new = _arrived(staging.raw_orders(spark, sf), "ingest_ts", ORDERS_SPLIT)
    merged = op.upsert(commerce.orders_silver(old), commerce.orders_silver(new), ["order_id"], "last_update_ts")
    return _product_text(merged)


@query
def upsert_newer_wins(spark, sf):
    """The later loads are there already; earlier ones, overlapping them by some months, arrive late."""
    raw = staging.raw_orders(spark, sf)
    target = commerce.orders_silver(raw.where(F.col("ingest_ts") >= ntz(ORDERS_SPLIT)))
    source = commerce.orders_silver(raw.where(F.col("ingest_ts") < ntz("1999-01-01")))
    return _product_text(op.upsert(target, source, ["order_id"], "last_update_ts"))


@query
def orders_analytics(spark, sf):
    rows, _ = commerce.orders_analytics(staging.flat_orders(spark, sf))
    return rows.withColumn("quantity", F.col("quantity").cast("bigint")).drop("shipping_address", "metadata")


@query
def partition_layout(spark, sf):
    path = scratch(spark, "orders-by-month")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        F.month("o_orderdate").cast("bigint").alias("order_month"),
    )
    rows.hint("rebalance", F.col("order_year"), F.col("order_month")).write.partitionBy("order_year", "order_month").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    return written.groupBy("order_year", "order_month").agg(
        F.count("o_orderkey").alias("order_count"), F.sum(F.col("o_totalprice").cast(MONEY)).cast(MONEY).alias("total")
    )


@query
def product_count_distinct(spark, sf):
    """Distinct products of each order status, exact."""
    lines = op.explode_lines(staging.raw_orders(spark, sf), "lines", ["product_id"])
    return op.count_distinct(lines, ["status"], "product_id", "product_count")


def _daily_users(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")


@query
def users_in_spans(spark, sf):
    """Distinct users of each event type and day and the six days before, from bitmaps landed per day."""
    path = scratch(spark, "day-bitmaps")
    op.day_bitmaps(_daily_users(spark, sf), "day", "user_id", ("event_type",)).write.parquet(path)
    return op.distinct_in_spans(spark.read.parquet(path), "day", 7, "users", ("event_type",))


@query
def users_estimated(spark, sf):
    """The same by sketches: whether each estimate is within five standard errors of the exact count."""
    daily = _daily_users(spark, sf)
    exact = op.distinct_in_spans(op.day_bitmaps(daily, "day", "user_id"), "day", 7, "users")
    near = op.estimated_in_spans(op.day_sketches(daily, "day", "user_id"), "day", 7, "estimate")
    close = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1), F.col("users") * 5 * 1.04 / 128)
    return exact.join(near, "day").select("day", "users", close.alias("is_close"))


@query
def profile_numeric(spark, sf):
    return op.profile(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def profile_columns(spark, sf):
    return op.profile(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_orderdate"])


# crate sales


@query
def contact_fields(spark, sf):
    parsed = crates.parse_contacts(staging.crate_orders(spark, sf))
    names = ("contact_name", "contact_surname", "contact_city", "contact_cp")
    return parsed.select("order_id", *[fn.item(n, 0).alias(n) for n in names], *[fn.item(n, 1).alias(f"second_{n}") for n in names])


@query
def contact_rows(spark, sf):
    return crates.contact_rows(staging.crate_orders(spark, sf))


@query
def order_contacts(spark, sf):
    return crates.order_contacts(staging.crate_orders(spark, sf))


@query
def order_contact_names(spark, sf):
    return crates.order_contact_names(order_contacts(spark, sf))


@query
def order_contact_address(spark, sf):
    return crates.order_contact_address(order_contacts(spark, sf))


@query
def canonical_company(spark, sf):
    return op.canonical_attribute(staging.crate_orders(spark, sf), "company_id", "company_name")


@query
def company_salesowners(spark, sf):
    return crates.company_salesowners(order_contacts(spark, sf))


@query
def company_salesowner_list(spark, sf):
    return crates.company_salesowner_list(order_contacts(spark, sf))


@query
def company_crate_distribution(spark, sf):
    return crates.company_crate_distribution(order_contacts(spark, sf))


@query
def crate_order_distribution(spark, sf):
    return crates.crate_order_distribution(order_contacts(spark, sf))


@query
def order_sales_owners(spark, sf):
    return crates.order_sales_owners(order_contacts(spark, sf))


@query
def owner_roles(spark, sf):
    return crates.owner_roles(staging.crate_orders(spark, sf))


@query
def commission_lines(spark, sf):
    invoices = src.flatten_invoices(staging.invoice_envelopes(spark, sf))
    return crates.commission_lines(staging.crate_orders(spark, sf), invoices).withColumn("vat", F.col("vat").cast("bigint"))


@query
def salesowner_commission(spark, sf):
    return crates.salesowner_commission(commission_lines(spark, sf))


@query
def training_last_12m(spark, sf):
    return crates.training_last_12m(order_sales_owners(spark, sf), AS_OF)


@query
def rolling_3m_sales(spark, sf):
    return crates.rolling_3m_sales(order_sales_owners(spark, sf))


@query
def top_sellers_by_month(spark, sf):
    return crates.top_sellers_by_month(order_sales_owners(spark, sf), AS_OF)


@query
def top_k_sellers(spark, sf):
    return crates.top_k_sellers(order_sales_owners(spark, sf), AS_OF)


# history, retention, tables


@query
def snapshots_to_expire(spark, sf):
    return op.snapshots_to_expire(staging.snapshot_log(spark, sf), "2024-04-15 00:00:00", class_col="table_class")


@query
def orphan_files(spark, sf):
    listing = staging.file_listing(spark, sf)
    referenced = listing.where(F.col("event_type") == "click")
    return op.orphan_files(listing, referenced, "2024-01-28 00:00:00").select("path", "bytes", "modified_at")


@query
def compaction_plan(spark, sf):
    return op.compaction_plan(staging.file_listing(spark, sf), "day")


@query
def table_merge(spark, sf):
    """Create, then merge a keyed table whose rows move between partitions."""
    tasks = op.KeyedTable(spark, f"{scratch_database(spark, 'merged')}.close_tasks", ["task_id"], "due_month")
    for raw in _arrived(staging.raw_close_tasks(spark, sf), "arrived_at", EVENTS_SPLIT):
        silver = ledger.close_tasks_silver(raw, ntz(RUN_TS)).drop("arrived_at")
        tasks.merge(silver.withColumn("due_month", F.trunc("due_date", "week")))
    return tasks.read()


@query
def catalog_upsert(spark, sf):
    """Journal lines merged into a catalog table that is partitioned by a hash of their keys."""
    buckets = op.buckets_for(3 * table(spark, sf, "lineitem").count(), 64)  # a document has three lines at most
    lines = op.KeyedTable(spark, f"{scratch_database(spark, 'journal')}.lines", ["entry_id", "account_id"], buckets=buckets)
    for half in _journal_halves(spark, sf, by_load=True):
        lines.merge(half)
    return lines.read()


@query
def bucketed_upsert(spark, sf):
    """The same lines in a bucketed table that takes the second half beside it."""
    before, after = _journal_halves(spark, sf, by_load=True)
    buckets = op.buckets_for(3 * table(spark, sf, "lineitem").count(), 8)  # a document has three lines at most
    lines = op.BucketedTable(spark, f"{scratch_database(spark, 'bucketed')}.lines", ["entry_id", "account_id"], buckets)
    lines.create(before)
    lines.merge(after, 1)
    return lines.read()


@query
def table_time_travel(spark, sf):
    """The state before the last load, made again of the raw table, which keeps every load."""
    raw_table = op.KeyedTable(spark, f"{scratch_database(spark, 'history')}.close_tasks", ["task_id"], "ingest_date")
    raw = staging.raw_close_tasks(spark, sf).withColumn("ingest_date", F.to_date("arrived_at"))
    for part in _arrived(raw, "arrived_at", EVENTS_SPLIT):
        raw_table.append(part)
    before = raw_table.read().where(F.col("ingest_date") < F.lit(EVENTS_SPLIT).cast("date"))
    return ledger.close_tasks_silver(before, ntz(RUN_TS)).drop("arrived_at", "ingest_date")


@query
def table_reload(spark, sf):
    """A clean reload replaces what earlier loads appended."""
    accounts = op.KeyedTable(spark, f"{scratch_database(spark, 'reloaded')}.accounts", ["account_id"])
    raw = staging.raw_accounts(spark, sf)
    accounts.append(raw)
    accounts.append(raw)
    accounts.reload(raw)
    return accounts.read()


# change feeds


@query
def cdc_apply(spark, sf):
    """A feed out of order: every third change comes after all others, deletes and what they deleted included."""
    feed = staging.change_feed(spark, sf)
    late = F.col("seq") % 3 == 0
    columns = ["user_id", "seq", "last_event", "last_value", "changed_at"]
    state = spark.createDataFrame([], feed.select(*columns, F.lit(False).alias(DELETED)).schema)
    for batch in (feed.where(~late), feed.where(late)):
        state = op.apply_changes(state, batch, ["user_id"], ["seq"], "op", marker=DELETED)
    return state.where(~F.col(DELETED)).drop(DELETED)


def _feed_files(spark, sf) -> DataFrame:
    """The change feed as files in the shared folder, read back as a stream of several batches."""
    path = scratch(spark, "feed")
    feed = staging.change_feed(spark, sf)
    for part in _arrived(feed, "changed_at", EVENTS_SPLIT):
        part.write.mode("append").parquet(path)
    return spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 4).parquet(path)


@query
def stream_cdc_state(spark, sf):
    state = op.KeyedTable(spark, f"{scratch_database(spark, 'state')}.users", ["user_id"])
    sync_stream(_feed_files(spark, sf), state, "seq", "op", scratch(spark, "state-cp"), "users").awaitTermination()
    return live_rows(state).drop("op")


@query
def stream_raw_log(spark, sf):
    path = scratch(spark, "changelog")
    feed = _feed_files(spark, sf).withColumn("change_date", F.to_date("changed_at"))
    append_stream(feed, path, scratch(spark, "changelog-cp"), "change_date").awaitTermination()
    return spark.read.schema(feed.schema).parquet(path)


@query
def stream_dedup(spark, sf):
    """Every change is delivered twice; the stream lets one of them through."""
    path = scratch(spark, "once")
    feed = _feed_files(spark, sf)
    once = dedup_stream(feed.unionByName(feed), ["seq"], "changed_at").drop("changed_at")
    append_stream(once, path, scratch(spark, "once-cp")).awaitTermination()
    return spark.read.schema(once.schema).parquet(path)


@query
def stream_late_changes(spark, sf):
    """Every third change comes in a second run of the stream, which tells those that others of their key have overtaken."""
    feed = staging.change_feed(spark, sf)
    path, out, checkpoint = (scratch(spark, name) for name in ("late-feed", "late", "late-cp"))
    third = F.col("seq") % 3 == 0
    for part in (feed.where(~third), feed.where(third)):
        part.write.mode("append").parquet(path)
        with timed_state(spark):
            marked = mark_late(spark.readStream.schema(feed.schema).parquet(path), ["user_id"], "seq", 3_600_000)
            append_stream(marked, out, checkpoint).awaitTermination()
    return spark.read.schema(marked.schema).parquet(out)
