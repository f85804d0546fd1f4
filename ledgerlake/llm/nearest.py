"""Approximate nearest neighbours by adaptive dimension scan (ADSampling) within the probed lists of an inverted index.

Vectors are rotated by a random orthogonal matrix, after which any few dimensions are a fair sample of a distance. Each
list is cut into blocks of bounded size; a block is scanned for a query in blocks of columns, and a candidate is
abandoned as soon as a hypothesis test on its partial distance says that it is beyond the k-th best so far. Distances
of those that remain are computed on the original vectors in double precision.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import land, table

SAMPLE = 20_000  # vectors that the lists' centres are fitted on
MOST_LISTS = 1024
PROBE_SHARE = 0.7  # of all lists, for a query; see the README for the recall measured
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
COLUMNS, EPSILON = 8, 2.1


def centres(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spread rows; empty lists keep their centre."""
    c = x[np.linspace(0, len(x) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        near = closest(x, c)
        order = np.argsort(near, kind="stable")
        ids, first = np.unique(near[order], return_index=True)
        c[ids] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.r_[first, len(x)])[:, None]
    return c


def closest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(1) - 2 * x @ c.T).argmin(1)


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scan(q: np.ndarray, q_turned: np.ndarray, x: np.ndarray, x_turned: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of the block's rows, as (distance, row), nearest first, ties by id; the row of id ``own`` is left out.

    A candidate is dropped when its squared distance over the first d of D rotated columns exceeds the k-th best so far
    times ``d / D * (1 + EPSILON / sqrt(d)) ** 2``.
    """
    dims, rows = x.shape[1], np.flatnonzero(ids != own)
    best = np.empty(0, np.int64)
    dist = np.empty(0)
    for part in np.split(rows, [4 * k, 32 * k]):  # a first few give the bound, more of them tighten it
        bound = dist[k - 1] ** 2 if len(dist) >= k else np.inf
        partial, d = np.zeros(len(part)), 0
        while d < dims and len(part) and np.isfinite(bound):
            e = min(dims, d + COLUMNS)
            partial = partial + ((x_turned[part, d:e] - q_turned[d:e]) ** 2).sum(1)
            stay = partial <= bound * (e / dims) * (1 + EPSILON / math.sqrt(e)) ** 2 + 1e-9
            part, partial, d = part[stay], partial[stay], e
        if len(part):
            best = np.r_[best, part]
            dist = np.r_[dist, np.sqrt(((x[part] - q) ** 2).sum(1))]
            order = np.lexsort((ids[best], dist))[:k]
            best, dist = best[order], dist[order]
    return dist, best


def _assign(frames: Iterator[pd.DataFrame], c: np.ndarray) -> Iterator[pd.DataFrame]:
    for df in frames:
        if len(df):
            df["list"] = closest(np.stack(df["vector"].to_list()).astype(float), c).astype(np.int32)
            yield df


def _probes(frames: Iterator[pd.DataFrame], c: np.ndarray, sizes: np.ndarray, probes: int, k: int) -> Iterator[pd.DataFrame]:
    """For each query its nearest lists, more where they hold too few vectors."""
    for df in frames:
        if not len(df):
            continue
        x = np.stack(df["vector"].to_list()).astype(float)
        order = np.argsort((c**2).sum(1) - 2 * x @ c.T, axis=1, kind="stable")
        enough = (np.cumsum(sizes[order], axis=1) < k + 1).sum(1) + 1
        df["lists"] = [o[: max(probes, n)].astype(np.int32) for o, n in zip(order, enough, strict=True)]
        yield df


def _scan_block(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame, turn: np.ndarray, k: int) -> pd.DataFrame:
    out: list[tuple] = []
    if len(rows) and len(queries):
        x, q = (np.stack(df["vector"].to_list()).astype(float) for df in (rows, queries))
        ids, x_turned, q_turned = rows["vec_id"].to_numpy(), x @ turn, q @ turn
        for i, own in enumerate(queries["query_id"].to_numpy()):
            dist, best = scan(q[i], q_turned[i], x, x_turned, ids, own, k)
            out += zip([own] * len(best), ids[best], dist, strict=True)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, probe_share: float = PROBE_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``vectors`` but that of its own id.

    Both have ``vec_id`` and ``embedding``. Rows with a null id, with a vector that is null, zero, or has null or
    non-finite components, and those with another number of components than most vectors have, take no part. Ties go
    to smaller ids; a repeated row is found as often as it is there; other columns are ignored.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("embedding").cast("array<double>")
        fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)

    everything = usable(vectors)
    widths = everything.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], schema)
    dims = widths[0]["n"]
    everything = everything.where(F.size("vector") == dims)
    total = everything.count()
    lists = min(MOST_LISTS, max(1, round(math.sqrt(total) / 2)))
    picked = everything.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    c = centres(np.stack(picked["vector"].to_list()).astype(float), min(lists, len(picked)))
    placed = land(everything.mapInPandas(functools.partial(_assign, c=c), "vec_id long, vector array<double>, list int"), "lists")
    sizes = np.zeros(len(c), np.int64)
    for r in placed.groupBy("list").count().collect():  # as many rows as lists
        sizes[r["list"]] = r["count"]
    blocks = F.array(*[F.lit(int(max(1, -(-n // BLOCK_ROWS)))) for n in sizes])
    asked = usable(queries).where(F.size("vector") == dims).withColumnRenamed("vec_id", "query_id")
    turns = max(1, -(-asked.count() // BLOCK_QUERIES))
    probes = max(1, math.ceil(probe_share * len(c)))
    probed = asked.mapInPandas(functools.partial(_probes, c=c, sizes=sizes, probes=probes, k=k), "query_id long, vector array<double>, lists array<int>")
    each = probed.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int")).withColumn("list", F.explode("lists")).drop("lists")
    each = each.withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("list")) - 1)))
    rows = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.get(blocks, F.col("list"))).cast("int"))
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    key = ["list", "block", "turn"]
    scanner = functools.partial(_scan_block, turn=rotation(dims), k=k)
    found = rows.groupBy(*key).cogroup(each.groupBy(*key)).applyInPandas(lambda key, a, b: scanner(key, a, b), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
