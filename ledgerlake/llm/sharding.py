"""Shards along a Hilbert curve through several metadata dimensions, so that files have narrow ranges in each of them.

Each dimension is quantised into buckets of equal depth (the rows below a value, as a share of all rows), so no
dimension needs a known range. The rows are sorted by curve index and cut into runs. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import land, table


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """The Hilbert curve as a state machine, one step per bit plane: digit and next state by (state, label).

    A state is the entry corner and the direction of a sub-cube; a label has one bit of each coordinate.
    """
    size, mask = 1 << dims, (1 << dims) - 1
    left = lambda x, k: ((x << (k % dims)) | (x >> (dims - k % dims))) & mask
    gray = lambda i: i ^ (i >> 1)
    rank = {gray(i): i for i in range(size)}
    entry = lambda i: 0 if i == 0 else gray(2 * ((i - 1) // 2))
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  trailing one bits
    turn = lambda i: 0 if i == 0 else ones(i - 1 if i % 2 == 0 else i) % dims
    digits, following = [], []
    for state in range(size * dims):
        e, d = divmod(state, dims)
        for label in range(size):
            i = rank[left(label ^ e, dims - (d + 1) % dims)]
            digits.append(i)
            following.append((e ^ left(entry(i), d + 1)) * dims + (d + turn(i) + 1) % dims)
    return digits, following


def hilbert_index(coords: Sequence[str], bits: int) -> Column:
    """The place on the curve of integer coordinates (column names) of ``bits`` bits each."""
    dims = len(coords)
    if dims * bits > 62:
        raise ValueError("an index has 62 bits at most")
    digits, following = (f"array({','.join(map(str, x))})" for x in curve_tables(dims))
    label = " | ".join(f"shiftleft(shiftright(cast(`{c}` as int), _bit) & 1, {i})" for i, c in enumerate(coords))
    at = f"(_at.s * {1 << dims} + ({label}) + 1)"
    step = f"named_struct('h', _at.h * {1 << dims} + element_at({digits}, {at}), 's', element_at({following}, {at}))"
    return F.expr(f"aggregate(sequence({bits - 1}, 0, -1), named_struct('h', 0L, 's', 0), (_at, _bit) -> {step}, _at -> _at.h)")


def running_total(df: DataFrame, order: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over all rows before a row in ``order``, without gathering rows in one task.

    Rows are range-partitioned and landed, which fixes the ranges; the totals of the ranges, one row each, are summed
    and sent back to them. Rows with equal ``order`` come in any order.
    """
    ranged = land(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # a row per range: at most as many as there are shuffle partitions
    placed = ranged.join(F.broadcast(starts), "_range")
    total = F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return placed.withColumn(name, total.cast("long")).drop("_range", "_start")


def equal_depth(df: DataFrame, dims: Sequence[str], bits: int, total: int) -> DataFrame:
    """Adds ``_q0``, ``_q1``, ...: each dimension as ``2**bits * (rows below the value) // rows``; nulls are lowest.

    Numbers are compared as numbers, anything else as text. Works on the distinct values with their counts, so a value
    that a third of the rows share is one row here.
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    one = [
        F.struct(
            F.lit(i).alias("dim"),
            (F.col(c).cast("double") if numeric[c] else F.lit(None).cast("double")).alias("num"),
            (F.lit(None).cast("string") if numeric[c] else F.col(c).cast("string")).alias("str"),
        )
        for i, c in enumerate(dims)
    ]
    values = df.select(F.inline(F.array(*one))).groupBy("dim", "num", "str").agg(F.count("*").alias("rows"))
    below = running_total(values, ["dim", "num", "str"], F.col("rows"), "below")
    codes = land(below.withColumn("code", F.floor((F.col("below") - F.col("dim") * total) * (1 << bits) / F.lit(total)).cast("int")), "codes")
    for i, c in enumerate(dims):
        kind = "num" if numeric[c] else "str"
        code = codes.where(F.col("dim") == i).select(F.col(kind).alias("_v"), F.col("code").alias(f"_q{i}"))
        df = df.join(code, df[c].cast("double" if numeric[c] else "string").eqNullSafe(code["_v"]), "left").drop("_v")
    return df


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int, tie_break: Sequence[str] = (), bits: int = 8) -> DataFrame:
    """All rows with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0): runs of the Hilbert order.

    Row counts of shards differ by one at most. Null dimensions are lowest, rows equal in index and ``tie_break`` are
    in any order, repeated rows are rows, an empty table gives an empty one. Columns ``shard`` and ``slot`` of the
    input are replaced; names that begin with an underscore are reserved.
    """
    df = land(df.drop("shard", "slot"), "shard-input")
    total = df.count()
    placed = equal_depth(df, dims, bits, max(total, 1))
    coords = [f"_q{i}" for i in range(len(dims))]
    curve = placed.withColumn("_h", hilbert_index(coords, bits)).drop(*coords)
    ranked = running_total(curve, ["_h", *tie_break], F.lit(1), "_rank")
    shard = F.floor(F.col("_rank") * shards / F.lit(max(total, 1))).cast("int")
    if total * shards >= 1 << 53:  # beyond exact doubles
        shard = F.expr(f"cast(cast(_rank as decimal(20,0)) * {shards} div {max(total, 1)} as int)")
    first = F.ceil(F.col("shard").cast("decimal(20,0)") * total / F.lit(shards)).cast("long")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - first).drop("_h", "_rank")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes a folder per shard with files in slot order; a large shard is split over tasks by slot ranges."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


SHARDS = 40


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = hilbert_shards(rows, ["lang", "source", "size"], SHARDS, ["text_crc32", "doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
