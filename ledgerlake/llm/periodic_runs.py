"""Periodic runs of words: maximal stretches in which every word equals the one a period later, at least twice around.

Periods below ``SHORT`` are found by comparing the words with themselves at each such lag. Longer ones go by scale: at
scale ``s`` periods from ``s`` to ``2 s - 1`` are sought with grams of ``s / 2`` words. The least gram hash of each window of
``s`` words is a minimizer; a run repeats its first windows one period on, so an equal pair of minimizers lies that far
apart in every run. Such pairs are seeds, which are extended both ways as far as words agree. Grams that are themselves
periodic (twice around or more) are left out: the runs they lie in are known from earlier scales, no window of a longer
run consists of them alone, and without them equal grams are more than a quarter of a scale apart, so a minimizer
has at most seven partners and the work per scale is linear in the words.

Words, grams and extensions are compared by hashes (of 64, 64 and 62 bits). Texts are worked on in chunks of about a
megabyte; a longer one is a chunk of its own and takes memory in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import BLANKS, CRC_TABLE, crc_of_id, crc_sql, in_batches, materialised, mix, table, text_chunks, word_hashes

LEAST = 12  # words in a run
SHORT = 32  # periods below it are scanned directly
PARTNERS = 7
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515247, 1540483477)
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class _Sequence:
    """The words of several texts in one array, each text followed by a value that occurs nowhere else.

    An agreement at lag p that crosses such a value is shorter than p and so never long enough for a run.
    """

    def __init__(self, words: np.ndarray, at: np.ndarray) -> None:
        sizes = np.diff(at)
        self.begin = at[:-1] + np.arange(len(sizes))
        self.end = self.begin + sizes
        self.x = np.empty(len(words) + len(sizes), np.uint64)
        is_word = np.ones(len(self.x), bool)
        is_word[self.end] = False
        self.x[is_word] = words
        self.x[self.end] = mix(np.arange(1, len(sizes) + 1, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, "right") - 1


def _lag_scan(x: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches that have period ``p`` and are long enough."""
    n = len(x) - p
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    differ = np.flatnonzero(x[p:] != x[:-p])
    before = np.r_[-1, differ]
    length = np.r_[differ, n] - before - 1
    enough = length >= max(p, LEAST - p)
    start = before[enough] + 1
    return start, start + length[enough] + p


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step % prime
        done, step = done + more, step * step % prime
    return out


class _Extension:
    """How far two places of a sequence agree, by prefix sums of polynomial hashes over two primes and bisection."""

    def __init__(self, x: np.ndarray) -> None:
        self.n, self.tables = len(x), []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            power = _powers(len(x) + 1, base, prime)
            sums = np.zeros(len(x) + 1, np.int64)
            np.cumsum((x % np.uint64(prime)).astype(np.int64) * power[:-1] % prime, out=sums[1:])
            self.tables.append((prime, power, sums % prime))

    def _equal(self, a: np.ndarray, lag: np.ndarray, length: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        for prime, power, sums in self.tables:
            here = (sums[a + length] - sums[a]) % prime
            there = (sums[a + lag + length] - sums[a + lag]) % prime
            same &= here * power[lag] % prime == there
        return same

    def agree(self, a: np.ndarray, lag: np.ndarray, forward: bool) -> np.ndarray:
        """The largest length over which the places ``a`` and ``a + lag`` agree, from there on or up to there."""
        low, high = np.zeros(len(a), np.int64), (self.n - a - lag if forward else a).astype(np.int64)
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self._equal(a if forward else a - half, lag, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def _minimizers(gram: np.ndarray, windows: int) -> np.ndarray:
    """The places that are least in some window of ``windows`` grams (a power of two and one more)."""
    least, step = gram.copy(), 1
    while step < windows - 1:
        least[:-step] = np.minimum(least[:-step], least[step:])
        step *= 2
    least[:-1] = np.minimum(least[:-1], least[1:])
    most, step = least, 1
    while step < windows - 1:
        most[step:] = np.maximum(most[step:], most[:-step])
        step *= 2
    most[1:] = np.maximum(most[1:], most[:-1])
    return np.flatnonzero((most == gram) & (gram != _NONE))


def _once(text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """(text, start, end, period) with the smallest period of each stretch: larger ones found for it are its multiples."""
    rows = np.stack([text, start, end, period], 1)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[first]


def chunk_runs(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs of texts given as hashes of their words: rows (text, start, end, period), ordered."""
    sizes = np.diff(at)
    seq = _Sequence(words, at)
    found = []
    for p in range(1, min(SHORT, int(sizes.max(initial=0)) // 2 + 1)):
        start, end = _lag_scan(seq.x, p)
        if len(start):
            text = seq.text_of(start)
            found.append(np.stack([text, start - seq.begin[text], end - seq.begin[text], np.full(len(start), p)], 1))
    kept, scale = np.arange(len(sizes)), SHORT
    while len(kept := kept[sizes[kept] >= 2 * scale]):
        is_kept = np.zeros(len(sizes), bool)
        is_kept[kept] = True
        lengths = sizes[kept]
        part = _Sequence(words[np.repeat(is_kept, sizes)], np.r_[0, np.cumsum(lengths)])
        width = scale // 2
        gram, done = part.x, 1
        while done < width:
            longer = np.full(len(gram), _NONE)
            longer[:-done] = mix(gram[:-done] * np.uint64(0x9E3779B97F4A7C15) + mix(gram[done:]))
            gram, done = longer, 2 * done
        gram = np.where(gram == _NONE, np.uint64(0), gram)
        # left out: grams over the end of a text, and those inside runs of at most half their width
        out = np.zeros(len(gram) + 1, np.int64)
        np.add.at(out, np.maximum(part.begin, part.end - width + 1), 1)
        np.add.at(out, part.end + 1, -1)
        if found:
            known = np.concatenate(found)
            known = known[is_kept[known[:, 0]] & (2 * known[:, 3] <= width) & (known[:, 2] - known[:, 1] >= width)]
            begin = part.begin[np.searchsorted(kept, known[:, 0])]
            np.add.at(out, begin + known[:, 1], 1)
            np.add.at(out, begin + known[:, 2] - width + 1, -1)
        gram = np.where(np.cumsum(out[:-1]) > 0, _NONE, gram)
        place = _minimizers(gram, width + 1)
        value = gram[place]
        order = np.argsort(value, kind="stable")
        place, value = place[order], value[order]
        seeds, lags = [], []
        for k in range(1, PARTNERS + 1):
            lag = place[k:] - place[:-k]
            seed = (value[k:] == value[:-k]) & (lag >= scale) & (lag < 2 * scale)
            seeds.append(place[:-k][seed])
            lags.append(lag[seed])
        seed, lag = np.concatenate(seeds), np.concatenate(lags)
        text = part.text_of(seed)
        one_text = seed + lag < part.end[text]
        seed, lag, text = seed[one_text], lag[one_text], text[one_text]
        if len(seed):
            extension = _Extension(part.x)
            start = seed - extension.agree(seed, lag, False)
            end = seed + lag + extension.agree(seed, lag, True)
            run = end - start >= 2 * lag
            text, start, end, lag = text[run], start[run], end[run], lag[run]
            found.append(_once(kept[text], start - part.begin[text], end - part.begin[text], lag))
        scale *= 2
    if not found:
        return np.empty((0, 4), np.int64)
    return _once(*np.concatenate(found).T)


def _collapsed(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The texts without the words that a run repeats, joined by one blank."""
    repeated = np.zeros(len(first) + 1, np.int64)
    np.add.at(repeated, at[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(repeated, at[runs[:, 0]] + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(repeated[:-1]) == 0)
    follows = np.ones(len(kept), bool)  # by another kept word of its text, so that one blank after it stays
    text = np.searchsorted(at, kept, "right") - 1
    follows[:-1] = text[1:] == text[:-1]
    follows[-1:] = False
    stays = np.zeros(len(data) + 2, np.int8)
    np.add.at(stays, first[kept], 1)
    np.add.at(stays, last[kept] + follows, -1)
    mask = np.cumsum(stays, dtype=np.int8)[: len(data)] > 0
    bytes_ = data.copy()
    bytes_[last[kept][follows]] = 32
    places = np.zeros(len(data) + 1, np.int32)
    np.cumsum(mask, out=places[1:])
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(places[bounds].tobytes()), pa.py_buffer(bytes_[mask].tobytes()))


def _with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for i, j, data, bounds in text_chunks(texts):
            words, first, last, at = word_hashes(data, bounds, fold=False)
            runs = chunk_runs(words, at)
            offsets = np.searchsorted(runs[:, 0], np.arange(j - i + 1)).astype(np.int32)
            fields = [pa.array(c.copy()) for c in (runs[:, 1], runs[:, 2] - runs[:, 1], runs[:, 3])]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            made = [pa.array(np.diff(at).astype(np.int64)), lists, _collapsed(data, bounds, first, last, at, runs)]
            kept = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], *made], names=[*kept.schema.names[:-1], "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed`` for each text.

    A run is a stretch of words with smallest period q and at least ``max(12, 2 q)`` words that no neighbouring word
    extends. ``collapsed`` has the words that no run contains after its first q ones, joined by one blank. Words are what
    blanks separate, in their own case. A null or blank text has no words, no runs and is "" collapsed. Every row gives one
    row, repeated ids too; other columns stay, but those called like the results are replaced.
    """
    rest = docs.drop("n_words", "runs", "collapsed")
    types = T.StructType([*rest.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return in_batches(rest.withColumn("_runs_of", F.coalesce(F.col(text).cast("string"), F.lit("")))).mapInArrow(_with_runs, types)


def repeated_tails(docs: DataFrame) -> Column:
    """The text of ``docs`` with a period in every tenth one, by the hash of the id: what ``op13`` asks to look for runs in."""
    h = crc_of_id(F.col("doc_id"))
    g, n = F.floor(h / 10), F.size("_words")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    moved = F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(F.get("_words", (a + F.pmod(i - a, p)).cast("int"))))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.array_join(moved, " "))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tenth = F.pmod(crc_of_id(F.col("doc_id")), F.lit(10)) == 0
    words = F.when(tenth, F.filter(F.split("text", BLANKS), lambda w: w != ""))
    split = docs.select("doc_id", "text", materialised(words, "_words"))
    placed = split.select("doc_id", F.coalesce(repeated_tails(split), "text").alias("text"))
    found = periodic_runs(placed).select("doc_id", "runs", "collapsed")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return digests.select(
        "doc_id", "n_runs", F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.floor(F.lit(1000) * -F.col("b.l") / F.col("b.p")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


#: DuckDB: runs as the stretches of equal words at each lag, by comparing all equal words of a text.
OP13_SQL = f"""WITH {CRC_TABLE},
d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS o,
  {crc_sql("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} AS h FROM documents, crc),
e AS (SELECT doc_id, o, len(o) AS n, h, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM e),
l AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN o ELSE list_concat(o[1:a], list_transform(range(a, n), lambda i: o[1 + a + (i - a) % p])) END AS w FROM f),
w AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM l),
q AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM q),
c AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM g GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(12, 2 * q)),
r AS (SELECT doc_id, s, l, min(q) AS q FROM c GROUP BY doc_id, s, l),
z AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM r),
k AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN z ON w.doc_id = z.doc_id AND w.i = z.i GROUP BY w.doc_id),
b AS (SELECT doc_id, count(*) AS n, min(struct_pack(l := -l, s := s, q := q)) AS b, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n, 0) AS n_runs, b.b.s AS "start", -b.b.l AS "length", b.b.q AS period, 1000 * -b.b.l // b.b.q AS exponent_milli,
  sha256(coalesce(b.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""
