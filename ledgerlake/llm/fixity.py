"""Fixity audit of web archives: Merkle trees over ordered offset ranges of two replicas, compared from the roots down.

Every record has a digest. A leaf of a file's tree covers a range of offsets and hashes the digests of the records that
begin there, in order; an inner node hashes its children, in order; a file has one root. Only children of nodes that
differ are compared on the next level, and only records of leaf ranges that differ are compared one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import land, table
from ledgerlake.llm.sharding import running_total

LEAF_BYTES, FANOUT = 1 << 14, 8


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """A WARC response record as text; null parts are empty."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def archive(records: DataFrame, order: list[str], file_bytes: int) -> DataFrame:
    """Adds ``file`` and ``offset`` to records with a ``length``: in order, a file being full when ``file_bytes`` are written."""
    placed = running_total(records, order, F.col("length"), "_at")
    return placed.withColumn("file", F.expr(f"_at div {file_bytes}")).withColumn("offset", F.pmod("_at", F.lit(file_bytes))).drop("_at")


def _levels(both: DataFrame) -> list[DataFrame]:
    """The trees of both replicas, leaves first; one table of (replica, file, node, hash) per level."""
    last = both.agg(F.max("offset")).first()[0] or 0
    leaf = F.expr(f"offset div {LEAF_BYTES}")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "digest")))
    line = F.transform(ordered, lambda r: F.concat_ws(" ", r["offset"], r["length"], r["digest"]))
    levels = [land(both.groupBy("replica", "file", leaf.alias("node")).agg(F.sha2(F.concat_ws("\n", line), 256).alias("hash")), "leaves")]
    for _ in range(math.ceil(math.log(last // LEAF_BYTES + 1, FANOUT) - 1e-9)):
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        line = F.transform(children, lambda r: F.concat_ws(" ", r["node"], r["hash"]))
        up = levels[-1].groupBy("replica", "file", F.expr(f"node div {FANOUT}").alias("parent")).agg(F.sha2(F.concat_ws("\n", line), 256).alias("hash"))
        levels.append(land(up.withColumnRenamed("parent", "node"), "nodes"))
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """The records at which two manifests (record_id, file, offset, length, digest) differ.

    Returns file, offset, range_start (of the leaf), record_id, length, digest of the first, found_length and
    found_digest of the second, and status: ``damaged``, ``missing`` (only in the first) or ``extra`` (only in the
    second). Rows without file or offset are no records; repeated rows count once; other columns are ignored; equal or
    empty manifests give no rows. A null digest or length differs from any other.
    """
    names = ["record_id", "file", "offset", "length", "digest"]
    sides = [m.select(*names).where("file IS NOT NULL AND offset IS NOT NULL").distinct().withColumn("replica", F.lit(i)) for i, m in enumerate((first, second))]
    both = land(sides[0].union(sides[1]), "manifests")

    def differing(level: DataFrame) -> DataFrame:
        hashes = [F.max(F.when(F.col("replica") == i, F.col("hash"))).alias(f"h{i}") for i in (0, 1)]
        return level.groupBy("file", "node").agg(*hashes).where(~F.col("h0").eqNullSafe(F.col("h1"))).select("file", "node")

    levels = _levels(both)
    suspects = differing(levels[-1])
    for level in levels[-2::-1]:
        above = land(suspects.withColumnRenamed("node", "parent"), "suspects")
        suspects = differing(level.withColumn("parent", F.expr(f"node div {FANOUT}")).join(above, ["file", "parent"], "left_semi"))
    records = both.withColumn("node", F.expr(f"offset div {LEAF_BYTES}")).join(land(suspects, "suspects"), ["file", "node"], "left_semi")
    side = lambda i, c: F.max(F.when(F.col("replica") == i, F.col(c)))
    compared = records.groupBy("file", "offset", "node").agg(
        F.coalesce(side(0, "record_id"), side(1, "record_id")).alias("record_id"),
        side(0, "length").alias("length"),
        side(0, "digest").alias("digest"),
        side(1, "length").alias("found_length"),
        side(1, "digest").alias("found_digest"),
        F.max(F.col("replica") == 0).alias("_in_first"),
        F.max(F.col("replica") == 1).alias("_in_second"),
    )
    status = F.when(~F.col("_in_second"), "missing").when(~F.col("_in_first"), "extra").otherwise("damaged")
    same = F.col("length").eqNullSafe(F.col("found_length")) & F.col("digest").eqNullSafe(F.col("found_digest"))
    found = compared.withColumn("status", status).where((F.col("status") != "damaged") | ~same)
    return found.select("file", "offset", (F.col("node") * LEAF_BYTES).alias("range_start"), "record_id", "length", "digest", "found_length", "found_digest", "status")


#: The second replica of the query: a byte changed in some records, and the ends of some files lost.
FILE_BYTES, CHANGED, CUT_FILE, CUT_AT = 1 << 20, (97, 13), (40, 7), (1 << 20) * 9 // 10


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    hurt = F.concat(F.expr("left(_record, char_length(_record) - 1)"), F.lit("#"))
    rows = pages.select("page_id", "url", record.alias("_record")).select(
        F.col("page_id").alias("record_id"),
        "url",
        F.octet_length("_record").cast("long").alias("length"),
        F.sha2("_record", 256).alias("digest"),
        F.when(F.pmod("page_id", F.lit(CHANGED[0])) == CHANGED[1], F.sha2(hurt, 256)).alias("hurt"),
    )
    stored = land(archive(rows, ["record_id", "url", "digest"], FILE_BYTES), "archive")
    lost = (F.pmod("file", F.lit(CUT_FILE[0])) == CUT_FILE[1]) & (F.col("offset") >= CUT_AT)
    second = stored.where(~lost).withColumn("digest", F.coalesce("hurt", "digest"))
    return audit(stored, second)


OP3_SQL = f"""WITH r AS (SELECT page_id, url, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || page_id || '>' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS t FROM pages),
l AS (SELECT page_id AS record_id, url, strlen(t) AS length, sha256(t) AS digest, CASE WHEN page_id % {CHANGED[0]} = {CHANGED[1]} THEN sha256(t[:-2] || '#') END AS hurt FROM r),
a AS (SELECT *, coalesce(sum(length) OVER (ORDER BY record_id, url, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM l),
f AS (SELECT *, pos // {FILE_BYTES} AS file, pos % {FILE_BYTES} AS "offset" FROM a),
g AS (SELECT *, file % {CUT_FILE[0]} = {CUT_FILE[1]} AND "offset" >= {CUT_AT} AS lost FROM f)
SELECT file, "offset", "offset" // {LEAF_BYTES} * {LEAF_BYTES} AS range_start, record_id, length, digest,
  CASE WHEN NOT lost THEN length END AS found_length, CASE WHEN NOT lost THEN coalesce(hurt, digest) END AS found_digest,
  CASE WHEN lost THEN 'missing' ELSE 'damaged' END AS status
FROM g WHERE lost OR hurt IS NOT NULL"""
