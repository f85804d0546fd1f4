"""Command line for ``spark-submit``: ingest documents, curate the ledger, sync orders, write the reports."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import commerce, crates, ledger
from ledgerlake.session import build_session, open_database
from ledgerlake.sources import MarkStore, flatten_invoices, next_mark, read_delimited, read_json_docs, since_mark
from ledgerlake.specs import CRATE_ORDERS, INVOICE_ENVELOPE


def _named(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def _documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "doc")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake", description=__doc__)
    jobs = p.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="land JSON-lines documents, one document a line")
    ingest.add_argument("collections", nargs="+", metavar="NAME=PATH")
    ingest.add_argument("--reload", action="store_true", help="replace the collections instead of adding to them")
    curate = jobs.add_parser("curate", help="merge raw accounts, close tasks and journal entries into silver and gold")
    curate.add_argument("--by-line", action="store_true", help="keep several lines of an entry on one account apart")
    curate.add_argument("--revised", action="store_true", help="a later load of a document replaces all its lines (with --by-line)")
    orders = jobs.add_parser("orders", help="merge raw order documents into the orders table")
    report = jobs.add_parser("report", help="write the crate sales reports")
    report.add_argument("--orders", required=True, help="crate orders, delimited text")
    report.add_argument("--invoices", required=True, help="invoice envelopes, JSON lines")
    report.add_argument("--as-of", default=date.today().isoformat())
    for job in (curate, orders):
        job.add_argument(
            "--incremental",
            action="store_true",
            help="only rows loaded since the last run; account changes then reach new lines only",
        )
    for job in (ingest, curate, orders, report):
        job.add_argument("--root", required=True, help="folder of the database, if it has to be made, and of the marks")
        job.add_argument("--database", default="ledgerlake", help="in the session's catalog, which must outlive the job")
        job.add_argument("--run-ts", help="load time to record, ISO; now if absent")
    return p


@contextmanager
def _increments(spark: SparkSession, args: argparse.Namespace, *names: str) -> Iterator[list[DataFrame]]:
    """Raw rows to process; the marks move on only if the processing succeeds.

    Load times can tie, so the last one is read again; the merges absorb what was seen before.
    """
    marks = MarkStore(spark, f"{args.root}/marks")
    rows, ends = [], []
    for name in names:
        raw = ledger.raw_table(spark, args.database, name)
        ends.append(next_mark(raw, "ingest_ts").first().mark)
        mark = marks.get(name, "timestamp") if args.incremental else None
        if mark is not None:
            raw = raw.where(F.col("ingest_date") >= F.to_date(mark))
        rows.append(since_mark(raw, "ingest_ts", mark, inclusive=True))
    yield rows
    for name, end in zip(names, ends):
        if end is not None:
            marks.put(name, end)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    now = datetime.fromisoformat(args.run_ts) if args.run_ts else datetime.now(timezone.utc).replace(tzinfo=None)
    open_database(spark, args.database, args.root)
    if args.job == "ingest":
        docs = {name: _documents(spark, path) for name, path in _named(args.collections).items()}
        for c in ledger.ingest_collections(spark, args.database, docs, ts=now, reload=args.reload, load=f"{now:%Y%m%dT%H%M%S%f}"):
            print(f"{c.collection}: {c.documents} documents, {c.rows} rows, {c.rejects} rejects, load {c.load_id}")
    elif args.job == "curate":
        accounts = ledger.raw_table(spark, args.database, "accounts")
        with _increments(spark, args, "close_tasks", "journal_entries") as (tasks, journal):
            ledger.curate(spark, args.database, tasks, journal, accounts, now, args.by_line, args.revised)
    elif args.job == "orders":
        with _increments(spark, args, "orders") as (raw,):
            commerce.sync_orders(spark, f"{args.database}.orders_silver", raw, now)
    else:
        orders = read_delimited(spark, args.orders, CRATE_ORDERS.schema)
        invoices = flatten_invoices(read_json_docs(spark, args.invoices, INVOICE_ENVELOPE))
        landed = {}
        for name, make in crates.parsed(invoices).items():  # each is landed once, and the next ones read it
            source = landed.get("order_contacts", orders)
            make(source).write.format("parquet").mode("overwrite").saveAsTable(f"{args.database}.{name}")
            landed[name] = spark.table(f"{args.database}.{name}")
        for name, df in crates.reports(*landed.values(), args.as_of).items():
            df.write.format("parquet").mode("overwrite").saveAsTable(f"{args.database}.{name}")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"ledgerlake {args.job}")
    run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
