"""Sales documents: nested orders to order metrics, flat orders to analytics rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import backfill_ingest_ts, iso_date, iso_timestamp, quality_split
from ledgerlake.operators import KeyedTable, document_metrics, keep_latest, split_null_keys
from ledgerlake.specs import MONEY, ORDERS


def latest_orders(raw: DataFrame, run_ts=None) -> DataFrame:
    """The latest load of each order document, its date typed."""
    keyed, _ = split_null_keys(raw, ["order_id"])
    typed = backfill_ingest_ts(keyed.withColumn("order_date", iso_date("order_date")), run_ts)
    return keep_latest(typed, ["order_id"], ["ingest_ts"])


def order_metrics(latest: DataFrame) -> DataFrame:
    """Amount, line count, products and a product sample per order."""
    orders = latest.select("order_id", "customer_id", "order_date", "status", "lines", "ingest_ts")
    return document_metrics(orders, "lines", amount="line_total", item="product_id").withColumnsRenamed(
        {"distinct_item_count": "distinct_product_count", "first_items": "first_product_ids"}
    )


def orders_silver(raw: DataFrame, run_ts=None) -> DataFrame:
    """The rows to merge, newer ones winning, into the orders table."""
    return order_metrics(latest_orders(raw, run_ts)).withColumn("last_update_ts", F.col("ingest_ts"))


def typed_flat_orders(raw: DataFrame) -> DataFrame:
    """Addresses and campaign out of their JSON text, amount and calendar columns."""
    ts = iso_timestamp("order_date")
    address = F.from_json("shipping_address", "city string, state string")
    rows = raw.withColumns({"order_date": ts, "_address": address})
    return rows.select(
        *[c for c in rows.columns if c not in ("_address",)],
        F.col("_address.city").alias("shipping_city"),
        F.col("_address.state").alias("shipping_state"),
        F.get_json_object("metadata", "$.campaign_id").alias("campaign_id"),
        (F.col("quantity") * F.col("price")).cast(MONEY).alias("total_amount"),
        F.year("order_date").cast("bigint").alias("order_year"),
        F.month("order_date").cast("bigint").alias("order_month"),
        F.dayofmonth("order_date").cast("bigint").alias("order_day"),
    )


def orders_analytics(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: an order needs a positive quantity and price."""
    good, rejects = quality_split(raw, F.col("quantity") > 0, F.col("price") > 0)
    return typed_flat_orders(good), rejects


def sync_orders(spark: SparkSession, name: str, raw: DataFrame, run_ts=None) -> None:
    """Merge newly loaded order documents into the orders table by day; older loads change nothing."""
    table = KeyedTable(spark, name, ["order_id"], ORDERS.partition_by)
    table.merge(orders_silver(raw, run_ts), newer_by="last_update_ts")


def publish_analytics(spark: SparkSession, name: str, raw: DataFrame) -> None:
    """Replace the flat-orders table, by year and month."""
    rows, _ = orders_analytics(raw)
    KeyedTable(spark, name, ["_id"], ["order_year", "order_month"]).reload(rows)
