"""Crate sales: contacts, sales owners, commissions and the sales reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import blank_to, iso_date, item, months_before, split_names
from ledgerlake.operators import (
    canonical_attribute,
    count_by,
    explode_names,
    joined_names,
    join_splittable,
    keep_top,
    month_index,
    rolling_months,
    stack_roles,
    top_k,
)
from ledgerlake.specs import CONTACTS, MONEY

# Formats, defaults and commission shares per cent of a cent amount.
DAY_FORMAT = "dd.MM.yy"
NO_NAME = "John Doe"
NO_CITY = "Unknown"
NO_POSTCODE = "UNK00"
PLASTIC = "Plastic"
SHARES = {"primary": "0.0006", "co_owner_1": "0.00025", "co_owner_2": "0.000095"}


def parse_contacts(orders: DataFrame) -> DataFrame:
    """Contact JSON to one array per field; text that is not JSON gives null arrays."""
    text = blank_to(F.col("contact_data"), NO_CITY)
    rows = orders.withColumn("order_id", F.trim("order_id")).withColumn("_contacts", F.from_json(text, CONTACTS))
    return rows.select(
        "order_id",
        "date",
        "company_id",
        "company_name",
        "crate_type",
        F.col("_contacts.contact_name").alias("contact_name"),
        F.col("_contacts.contact_surname").alias("contact_surname"),
        F.col("_contacts.city").alias("contact_city"),
        F.col("_contacts.cp").alias("contact_cp"),
        "salesowners",
    )


def contact_rows(orders: DataFrame) -> DataFrame:
    """One row per contact; an order without any keeps one row."""
    rows = orders.select("order_id", F.explode_outer(F.from_json("contact_data", CONTACTS)).alias("_c"))
    return rows.select("order_id", "_c.contact_name", "_c.contact_surname", "_c.city", "_c.cp")


def order_contacts(orders: DataFrame) -> DataFrame:
    """Orders with their first contact. A full name needs both parts."""
    c = parse_contacts(orders)
    name, surname = item("contact_name", 0), item("contact_surname", 0)
    return c.select(
        "order_id",
        "date",
        "company_id",
        "company_name",
        "crate_type",
        name.alias("contact_name"),
        surname.alias("contact_surname"),
        F.coalesce(F.concat(name, F.lit(" "), surname), F.lit(NO_NAME)).alias("contact_full_name"),
        F.coalesce(item("contact_city", 0), F.lit(NO_CITY)).alias("contact_city"),
        F.coalesce(item("contact_cp", 0), F.lit(NO_POSTCODE)).alias("contact_cp"),
        "salesowners",
    )


def order_contact_names(contacts: DataFrame) -> DataFrame:
    return contacts.select("order_id", "contact_full_name").distinct()


def order_contact_address(contacts: DataFrame) -> DataFrame:
    return contacts.select("order_id", F.concat_ws(",", "contact_city", "contact_cp").alias("contact_address"))


def _company_names(contacts: DataFrame) -> DataFrame:
    """One name per company, of its orders that have owners."""
    return canonical_attribute(contacts.where(F.col("salesowners").isNotNull()), "company_id", "company_name")


def company_salesowners(contacts: DataFrame) -> DataFrame:
    """Distinct owners per company, under one company name."""
    pairs = explode_names(contacts.select("company_id", "salesowners"), "salesowners", "salesowner").distinct()
    named = join_splittable(pairs, _company_names(contacts), ["company_id"], "inner")
    return named.select("company_id", "company_name", "salesowner")


def company_salesowner_list(contacts: DataFrame) -> DataFrame:
    """All owners of a company, sorted, as one text."""
    owners = explode_names(contacts.select("company_id", "salesowners"), "salesowners", "salesowner")
    lists = joined_names(owners, ["company_id"], "salesowner", "list_salesowners")
    return lists.join(_company_names(contacts), "company_id").select("company_id", "company_name", "list_salesowners")


def company_crate_distribution(contacts: DataFrame) -> DataFrame:
    """Orders per company and crate type, under one company name; the orders are read once."""
    counted = contacts.groupBy("company_id", "crate_type").agg(
        F.count("order_id").alias("crate_type_distribution"), F.min("company_name").alias("company_name")
    )
    name = F.min("company_name").over(Window.partitionBy("company_id"))  # few rows: a company has one per crate type
    named = counted.where("company_id IS NOT NULL").withColumn("company_name", name).where("company_name IS NOT NULL")
    return named.select("company_id", "company_name", "crate_type", "crate_type_distribution")


def crate_order_distribution(contacts: DataFrame) -> DataFrame:
    return count_by(contacts, ["crate_type"], "order_id", "order_count")


def order_sales_owners(contacts: DataFrame) -> DataFrame:
    """One row per order and owner, the date typed."""
    day = iso_date("date", DAY_FORMAT)
    rows = contacts.withColumn("formatted_date", day).withColumn("month", F.month(day).cast("bigint")).drop("date")
    return explode_names(rows, "salesowners", "salesowner").distinct()


def owner_roles(orders: DataFrame) -> DataFrame:
    """The first three owners of the ordered list by role; short lists leave the later roles null."""
    names = orders.withColumn("_owners", split_names("salesowners"))
    return names.select(
        "order_id",
        "company_id",
        "company_name",
        item("_owners", 0).alias("primary_owner"),
        item("_owners", 1).alias("co_owner_1"),
        item("_owners", 2).alias("co_owner_2"),
    )


def _share(holder: str, share: str, base: str) -> Column:
    euro = F.round(F.col(base) * F.lit(share).cast("decimal(7,6)"), 2).cast(MONEY)
    return F.when(F.col(holder).isNotNull(), euro).otherwise(F.lit(0).cast(MONEY))


def commission_lines(orders: DataFrame, invoices: DataFrame, base: str = "gross_value") -> DataFrame:
    """Invoices with the commission in euro of each role, rounded per invoice. Amounts come in cents."""
    billed = owner_roles(orders).join(
        invoices.select("order_id", "invoice_id", "gross_value", "vat"), "order_id"
    )
    return billed.select(
        *billed.columns,
        _share("primary_owner", SHARES["primary"], base).alias("primary_commission_euro"),
        _share("co_owner_1", SHARES["co_owner_1"], base).alias("co_owner_1_commission_euro"),
        _share("co_owner_2", SHARES["co_owner_2"], base).alias("co_owner_2_commission_euro"),
    )


def salesowner_commission(lines: DataFrame) -> DataFrame:
    """Total commission per owner over all roles; the lines are read once for the three roles."""
    roles = {
        "primary": (F.col("primary_owner"), F.col("primary_commission_euro")),
        "co_owner_1": (F.col("co_owner_1"), F.col("co_owner_1_commission_euro")),
        "co_owner_2": (F.col("co_owner_2"), F.col("co_owner_2_commission_euro")),
    }
    return (
        stack_roles(lines, roles, "sales_owner", "commission")
        .groupBy("sales_owner")
        .agg(F.sum("commission").cast(MONEY).alias("total_commission"))
        .orderBy(F.col("total_commission").desc(), "sales_owner")
    )


def _last_year(owners: DataFrame, as_of) -> DataFrame:
    return owners.where(F.col("formatted_date") >= months_before(as_of, 12))


def training_last_12m(owners: DataFrame, as_of) -> DataFrame:
    """Orders per owner and crate type over the twelve months before ``as_of``."""
    return count_by(_last_year(owners, as_of), ["salesowner", "crate_type"], "order_id", "order_count")


def monthly_sales(owners: DataFrame, as_of=None, crate_type: str | None = PLASTIC) -> DataFrame:
    """Orders per owner and calendar month, with a month number that counts across years."""
    rows = owners if as_of is None else _last_year(owners, as_of)
    rows = rows if crate_type is None else rows.where(F.col("crate_type") == crate_type)
    rows = rows.where(F.col("formatted_date").isNotNull())
    return (
        rows.withColumn("sales_month", F.trunc("formatted_date", "month"))
        .groupBy("salesowner", "sales_month")
        .agg(F.count("order_id").alias("total_sales"))
        .withColumn("month_no", month_index(F.col("sales_month")))
    )


def rolling_3m_sales(owners: DataFrame, as_of=None, crate_type: str | None = PLASTIC) -> DataFrame:
    """Each owner's monthly sales with the sum over that month and the two before it."""
    monthly = monthly_sales(owners, as_of, crate_type)
    return rolling_months(monthly, "salesowner", "month_no", "total_sales", 3, "rolling_sales").drop("month_no")


def top_sellers_by_month(owners: DataFrame, as_of=None, n: int = 5) -> DataFrame:
    """The n best owners of each month by their rolling three-month sales."""
    best_first = [F.col("rolling_sales").desc(), F.col("total_sales").desc(), F.col("salesowner").asc()]
    return keep_top(rolling_3m_sales(owners, as_of), ["sales_month"], best_first, n, rank="place").withColumn(
        "place", F.col("place").cast("bigint")
    )


def top_k_sellers(owners: DataFrame, as_of=None, k: int = 5) -> DataFrame:
    """The k best single months of any owner."""
    best_first = [F.col("total_sales").desc(), F.col("sales_month").asc(), F.col("salesowner").asc()]
    return top_k(monthly_sales(owners, as_of).drop("month_no"), best_first, k)


def parsed(invoices: DataFrame) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """What the reports read, by name: contacts of the orders, then owners and commissions of the contacts."""
    return {
        "order_contacts": order_contacts,
        "order_sales_owners": order_sales_owners,
        "commission_lines": lambda contacts: commission_lines(contacts, invoices),
    }


def reports(contacts: DataFrame, owners: DataFrame, commissions: DataFrame, as_of) -> dict[str, DataFrame]:
    """All crate reports by name, over the tables of :func:`parsed`."""
    return {
        "company_salesowners": company_salesowners(contacts),
        "company_crate_distribution": company_crate_distribution(contacts),
        "crate_order_distribution": crate_order_distribution(contacts),
        "order_contact_names": order_contact_names(contacts),
        "order_contact_address": order_contact_address(contacts),
        "company_salesowner_list": company_salesowner_list(contacts),
        "salesowner_commission": salesowner_commission(commissions),
        "training_last_12m": training_last_12m(owners, as_of),
        "top_sellers_by_month": top_sellers_by_month(owners, as_of),
        "top_k_sellers": top_k_sellers(owners, as_of),
    }


def register_views(orders: DataFrame, invoices: DataFrame, as_of) -> list[str]:
    """The reports as temporary views, for use from SQL."""
    contacts = order_contacts(orders)
    named = {name: make(orders if name == "order_contacts" else contacts) for name, make in parsed(invoices).items()}
    named |= reports(*named.values(), as_of)
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return list(named)
