"""Accounting documents: accounts, close tasks and journal entries to silver and gold."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import astuple, dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import (
    PROBLEMS,
    backfill_ingest_ts,
    conform,
    iso_date,
    nested_to_json,
    normalize_extended_json,
    split_conformed,
    with_ingest_ts,
)
from ledgerlake.operators import (
    KeyedTable,
    dedup_subset,
    enrich,
    explode_lines,
    keep_latest,
    keep_top,
    money_totals,
    only_known,
    split_null_keys,
)
from ledgerlake.operators.dedup import total_order
from ledgerlake.session import scratch
from ledgerlake.specs import CLOSE_TASKS, COLLECTIONS, JOURNAL_ENTRIES, MONEY, CollectionSpec

ACCOUNT_ATTRIBUTES = {"name": "account_name", "type": "account_type"}
LINE_FIELDS = ["account_id", "debit", "credit"]
DOCUMENT_KEYS = ["entry_id", "_id"]


SOURCE_TEXT, _UNREADABLE = "_source", "_unreadable"


def conform_documents(docs: DataFrame, doc_col: str, spec: CollectionSpec) -> DataFrame:
    """Extended-JSON documents in the schema of a collection, with their problems and their text."""
    texts = docs.select(F.col(doc_col).alias(SOURCE_TEXT), F.col(doc_col).alias("_doc_text"))
    read = normalize_extended_json(texts, "_doc_text", spec.schema, leaf_mode="string", unreadable=_UNREADABLE)
    return conform(read, spec.schema, carry=(SOURCE_TEXT,), unreadable=_UNREADABLE)


def ingest_documents(docs: DataFrame, doc_col: str, spec: CollectionSpec, ts=None) -> tuple[DataFrame, DataFrame]:
    """Extended-JSON documents to ``(raw rows, rejects)`` of a collection, with their load time.

    Rejects keep the text of the document (``_source``) and name what is wrong (``_problems``).
    """
    good, rejects = split_conformed(conform_documents(docs, doc_col, spec))
    return with_ingest_ts(good.drop(SOURCE_TEXT), ts), rejects


LOAD = "load_id"


def append_raw(spark: SparkSession, df: DataFrame, name: str, spec: CollectionSpec, reload: bool = False, load: str | None = None) -> None:
    """Land rows append-only by load day; ``reload`` starts the collection afresh, once for the whole load.

    The rows of a load are partitions of their own, so a load that was broken off and is repeated under the same id comes once.
    """
    table = KeyedTable(spark, name, list(spec.keys), ["ingest_date", LOAD])
    days = "ingest_ts" in spec.schema.names  # else the load is of one day, so of one partition
    dated = df.withColumns({"ingest_date": F.to_date("ingest_ts"), LOAD: F.lit(load or uuid.uuid4().hex)})
    if reload:
        table.reload(dated, balanced=days)
    else:
        table.replace_partitions(dated, balanced=days)


@dataclass(frozen=True)
class LoadCount:
    """What a load has written of a collection."""

    collection: str
    load_id: str
    documents: int
    rows: int
    rejects: int


def ingest_collections(
    spark: SparkSession,
    database: str,
    documents: Mapping[str, DataFrame],
    doc_col: str = "doc",
    ts=None,
    reload: bool = False,
    load: str | None = None,
    specs: Mapping[str, CollectionSpec] = COLLECTIONS,
) -> list[LoadCount]:
    """Land every collection's documents in ``raw_<name>`` and the ones that do not fit in ``rejects_<name>``.

    Documents are read and parsed once: they are landed with whether they fit, and both halves come from there. What is
    written is counted by that same write. ``load`` names the load: repeating it, wherever it was broken off, leaves its rows and
    rejects there once, and its line in the table ``loads``, which comes last, says that it is complete.
    """
    load, counts = load or uuid.uuid4().hex, []
    for name, docs in documents.items():
        spec = specs[name]
        path = scratch(spark, f"ingest-{name}")
        fits = F.col("_fits")
        # only rejects keep their text; no partitions, for which every row would be sorted
        conformed = conform_documents(docs, doc_col, spec).withColumn("_fits", F.size(PROBLEMS) == 0)
        conformed = conformed.withColumn(SOURCE_TEXT, F.when(~fits, F.col(SOURCE_TEXT)))
        written = Observation(f"load-{name}")
        numbers = [F.count(F.lit(1)).alias("documents"), F.count_if(fits).alias("rows"), F.count_if(~fits).alias("rejects")]
        conformed.observe(written, *numbers).write.parquet(path)
        landed = spark.read.schema(conformed.schema).parquet(path)
        rejects = with_ingest_ts(landed.where(~fits).drop("_fits"), ts).withColumn(LOAD, F.lit(load))
        KeyedTable(spark, f"{database}.rejects_{name}", list(spec.keys), LOAD).replace_partitions(nested_to_json(rejects))
        rows = landed.where("_fits").drop("_fits", PROBLEMS, SOURCE_TEXT)
        append_raw(spark, with_ingest_ts(rows, ts), f"{database}.raw_{name}", spec, reload, load)
        counts.append(LoadCount(name, load, **written.get))
    lines = spark.createDataFrame([astuple(c) for c in counts], "collection string, load_id string, documents bigint, rows bigint, rejects bigint")
    KeyedTable(spark, f"{database}.loads", ["collection"], LOAD).replace_partitions(lines)
    return counts


def raw_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.raw_{name}").drop(LOAD)


def close_tasks_silver(raw: DataFrame, run_ts=None) -> DataFrame:
    """Typed close tasks, the latest load per task; tasks without an id are left out."""
    keyed, _ = split_null_keys(raw, ["task_id"])
    typed = backfill_ingest_ts(keyed.withColumn("due_date", iso_date("due_date")), run_ts)
    return keep_latest(typed, ["task_id"], ["ingest_ts"])


def _entries(raw: DataFrame) -> DataFrame:
    return raw.select("_id", "entry_id", iso_date("date").alias("entry_date"), "description", "lines", "ingest_ts")


def journal_lines(
    raw: DataFrame, keep_empty: bool = False, line_no: str | None = None, together: list[str] | None = None
) -> DataFrame:
    """One row per journal line, with its entry's fields.

    ``together`` names fields of the documents: documents are shuffled by them while they are whole, which moves an entry's
    fields once and not with each line, and lines grouped by these and other columns are not shuffled again.
    """
    entries = _entries(raw)
    if together:
        entries = entries.repartition(*together)
    return explode_lines(entries, "lines", LINE_FIELDS, keep_empty, line_no)


def line_keys(by_line: bool = False) -> list[str]:
    return ["entry_id", "account_id", *(["_id", "line_no"] if by_line else [])]


_PART, SPLIT = "_part", "_split"
HOT_DOCUMENTS, HOT_GROUPS = 50_000, 1 << 16


def lines_by_entry(raw: DataFrame, hot: int = HOT_DOCUMENTS, groups: int = HOT_GROUPS) -> DataFrame:
    """The lines of :func:`journal_lines`, documents shuffled whole by their entry, which moves an entry's fields once a document.

    An entry of more than ``hot`` documents would be one task, so its lines are shuffled one by one, by entry and account. Such
    entries are found by counting documents by a hash of their entry in ``groups`` groups: all entries of a group with more
    are taken for hot. ``_split`` tells where a line went: lines grouped by entry, account and it are not shuffled again.
    Entries without an id are left out.
    """
    entries = _entries(raw).where("entry_id IS NOT NULL").withColumn("_group", F.pmod(F.xxhash64("entry_id"), F.lit(groups)))
    counted = entries.where(F.size("lines") > 0).groupBy(F.col("_group").alias("_hot")).count()
    hot_groups = F.broadcast(counted.where(F.col("count") > hot).select("_hot"))
    placed = entries.where(F.size("lines") > 0).join(hot_groups, F.col("_group") == F.col("_hot"), "left")
    one_by_one = F.transform("lines", lambda x: F.struct(F.xxhash64(x.account_id).alias(SPLIT), F.array(x).alias("lines")))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias(SPLIT), F.col("lines")))
    fields = ["_id", "entry_id", "entry_date", "description", "ingest_ts"]
    parts = placed.select(*fields, F.explode(F.when(F.col("_hot").isNull(), whole).otherwise(one_by_one)).alias(_PART))
    shuffled = parts.select(*fields, f"{_PART}.{SPLIT}", f"{_PART}.lines").repartition("entry_id", SPLIT)
    return explode_lines(shuffled, "lines", LINE_FIELDS)


SPREAD = "_spread"
HOT_LINES, HOT_PARTS = 1_000_000, 1 << 8


def latest_lines_by_account(raw: DataFrame, hot: int = HOT_LINES, groups: int = HOT_GROUPS, parts: int = HOT_PARTS) -> DataFrame:
    """:func:`latest_lines`, shuffled once: by account, so that what is known of an account meets its lines where they are.

    An account of more than ``hot`` lines would be one task, so its lines are spread over ``parts`` by a hash of their entry, told
    by the column ``SPREAD``. Such accounts are found by counting lines by a hash of their account in ``groups`` groups: all of a
    group with more are spread. Lines grouped by account, ``SPREAD`` and other columns are not shuffled again.
    """
    keyed, _ = split_null_keys(journal_lines(raw), line_keys())
    group = F.pmod(F.xxhash64("account_id"), F.lit(groups))
    # the digest keeps every column of the counted lines, so that they come of the same shuffles as the lines themselves
    counted = keyed.groupBy(group.alias("_hot")).agg(F.count(F.lit(1)).alias("count"), F.max(F.xxhash64(*keyed.columns)).alias("_all"))
    hot_groups = F.broadcast(counted.where((F.col("count") > hot) & F.col("_all").isNotNull()).select("_hot"))
    placed = keyed.withColumn("_group", group).join(hot_groups, F.col("_group") == F.col("_hot"), "left")
    part = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("entry_id"), F.lit(parts))).otherwise(0)
    shuffled = placed.select(*keyed.columns, part.cast("int").alias(SPREAD)).repartition("account_id", SPREAD)
    order = total_order(keyed, line_keys(), ["ingest_ts"], None)
    return keep_top(shuffled, ["account_id", SPREAD, "entry_id"], order, 1)


def latest_documents(raw: DataFrame) -> DataFrame:
    """The latest load of each document, so that lines which a revision has dropped are not found. Documents without an id stay."""
    keyed, others = split_null_keys(raw, ["_id"])
    return keep_latest(keyed, ["_id"], ["ingest_ts"]).unionByName(others)


def latest_of_entries(lines: DataFrame) -> DataFrame:
    """The latest load of each of the lines that :func:`lines_by_entry` has placed, by entry and account, where they are."""
    keyed, _ = split_null_keys(lines, line_keys())
    order = total_order(keyed.drop(SPLIT), line_keys(), ["ingest_ts"], None)
    return keep_top(keyed, [*line_keys(), SPLIT], order, 1)


def _lines_by_document(raw: DataFrame, together: list[str] | None) -> DataFrame:
    """The latest load of each line, known by its document and position; ``together`` as in :func:`journal_lines`."""
    keyed, _ = split_null_keys(journal_lines(raw, line_no="line_no", together=together), line_keys())
    return keep_latest(keyed, line_keys(True), ["ingest_ts"])


def latest_lines(raw: DataFrame, by_line: bool = False, revised: bool = False, whole: bool = False) -> DataFrame:
    """The latest load of each line.

    A line is known by entry and account, which merges two lines of one entry on one account;
    ``by_line`` keeps them apart by document and position. ``revised`` takes lines from the latest load of their document
    only: a revision replaces the whole document, lines that it no longer has included.

    Lines known by their document meet where their documents do. Otherwise a line is shuffled by entry and account, so that
    an entry with a third of all lines is many tasks, and a later join by both needs no shuffle. ``whole`` shuffles fewer bytes where
    none follows: documents by their entry, and only the lines of hot entries one by one, for which documents are counted first.
    """
    if revised and by_line:
        # apart, as a union would lose where the latest loads are: by their ids, so their lines are together already
        keyed, others = split_null_keys(raw, ["_id"])
        latest = keep_latest(keyed, ["_id"], ["ingest_ts"])
        return _lines_by_document(latest, None).unionByName(_lines_by_document(others, DOCUMENT_KEYS))
    raw = latest_documents(raw) if revised else raw
    if whole and not by_line:
        return latest_of_entries(lines_by_entry(raw)).drop(SPLIT)
    if by_line:
        return _lines_by_document(raw, DOCUMENT_KEYS)
    keyed, _ = split_null_keys(journal_lines(raw), line_keys())
    return keep_latest(keyed, line_keys(), ["ingest_ts"])


def journal_silver(raw: DataFrame, accounts: DataFrame, by_line: bool = False, revised: bool = False) -> DataFrame:
    """Deduplicated lines with account name and type.

    Deduplicating first is what keeps a hot account harmless: the join is then the last shuffle,
    so AQE is free to split it.
    """
    return enrich(latest_lines(raw, by_line, revised, whole=True), accounts, "account_id", ACCOUNT_ATTRIBUTES, ["ingest_ts"])


def journal_gold(lines: DataFrame) -> DataFrame:
    """Credit and debit totals per entry and day. Needs no account, so unenriched lines do as well."""
    return money_totals(lines, ["entry_id", "entry_date"], ["credit", "debit"])


def journal_entry_detail(raw: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every loaded line whose account is known, with the account's attributes."""
    return enrich(
        journal_lines(raw), accounts, "account_id", ACCOUNT_ATTRIBUTES, ["ingest_ts"], how="inner"
    ).drop("ingest_ts")


def entry_account_totals(raw: DataFrame, accounts: DataFrame) -> DataFrame:
    """Totals per entry and known account, a document's account counted once.

    The accounts only filter here, so they meet the totals, not the lines.
    """
    lines = journal_lines(raw, together=DOCUMENT_KEYS).drop("ingest_ts")
    once = dedup_subset(lines, [*DOCUMENT_KEYS, "account_id"])
    totals = money_totals(once, ["entry_id", "account_id"], ["debit", "credit"])
    return only_known(totals, accounts, "account_id")


def dim_account(accounts: DataFrame) -> DataFrame:
    latest = keep_latest(accounts, ["account_id"], ["ingest_ts"])
    return latest.select(F.md5("account_id").alias("account_key"), "account_id", "name", "type")


def fact_journal_line(lines: DataFrame) -> DataFrame:
    """Facts keyed by digests of their natural keys, so that no lookup is needed to load them."""
    return lines.select(
        F.md5(F.concat_ws("|", "entry_id", "account_id")).alias("line_key"),
        F.md5("account_id").alias("account_key"),
        "entry_id",
        "entry_date",
        "debit",
        "credit",
    )


GOLD_KEYS = ["entry_id", "entry_date"]


def journal_gold_counted(lines: DataFrame) -> DataFrame:
    """Gold with the number of lines of each total, by which a total without lines is known to be gone."""
    return gold_after(None, signed_changes(None, lines))


def signed_changes(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """What turns the totals of the lines ``before`` into those of the lines ``after``: old ones negative, and new ones.

    Null amounts count as zero.
    """
    parts = []
    for lines, sign in ((before, -1), (after, 1)):
        if lines is not None:
            amounts = [(F.coalesce(F.col(c), F.lit(0)) * sign).cast(MONEY).alias(f"total_{c}") for c in ("credit", "debit")]
            parts.append(lines.select(*GOLD_KEYS, *amounts, F.lit(sign).cast("long").alias("line_count")))
    return reduce(DataFrame.unionByName, parts)


def gold_after(stored: DataFrame | None, changes: DataFrame, only_touched: bool = False) -> DataFrame:
    """The ``stored`` totals (with ``line_count``) after signed ``changes``, which are summed onto them; silver is not read.

    ``only_touched`` returns the groups of the changes alone. Groups without lines go, so a touched group may not be there.
    """
    sums = [F.sum(c).cast(MONEY).alias(c) for c in ("total_credit", "total_debit")]
    deltas = changes.groupBy(*GOLD_KEYS).agg(*sums, F.sum("line_count").alias("line_count"))
    if stored is None:
        return deltas.where("line_count > 0")
    kept = stored.select(*deltas.columns)
    if only_touched:
        touched = deltas.select(*[F.col(k).alias(f"_{k}") for k in GOLD_KEYS])
        kept = kept.join(touched, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in GOLD_KEYS]), "left_semi")
    return kept.unionByName(deltas).groupBy(*GOLD_KEYS).agg(*sums, F.sum("line_count").alias("line_count")).where("line_count > 0")


def curate(
    spark: SparkSession,
    database: str,
    tasks: DataFrame,
    journal: DataFrame,
    accounts: DataFrame,
    run_ts=None,
    by_line: bool = False,
    revised: bool = False,
) -> None:
    """Merge newly loaded raw rows into the silver tables and bring the gold totals up to date.

    Safe to repeat with the same rows. Only the entries that changed are totalled again. ``by_line`` keeps several
    lines of one entry on one account apart; a table is made with or without it and stays so. ``revised`` takes a load of a
    document for a revision of it: the lines of its earlier loads go, which needs every line's document, so ``by_line`` too.
    """
    if revised and not by_line:
        raise ValueError("revised needs by_line: without it a line does not tell its document")
    month = CLOSE_TASKS.partition_by
    silver_tasks = KeyedTable(spark, f"{database}.close_tasks_silver", ["task_id"], month)
    typed = close_tasks_silver(tasks, run_ts).withColumn(month, F.trunc("due_date", "month"))
    silver_tasks.merge(typed)

    month = JOURNAL_ENTRIES.partition_by
    silver = KeyedTable(spark, f"{database}.journal_entries_silver", line_keys(by_line), month)
    lines = journal_silver(journal, accounts, by_line, revised).withColumn(month, F.trunc("entry_date", "month"))
    if revised:
        silver.replace_groups(lines, journal.where("_id IS NOT NULL").select("_id").distinct(), ["_id"])
    else:
        silver.merge(lines)

    gold = KeyedTable(spark, f"{database}.journal_entries_gold", ["entry_id", "entry_date"], "entry_year")
    changed = journal.select("entry_id").distinct()
    affected = only_known(silver.read(), changed, "entry_id")
    gold.replace_groups(journal_gold(affected).withColumn("entry_year", F.year("entry_date")), changed, ["entry_id"])
