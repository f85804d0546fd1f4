"""Helpers shared by the operators: landing intermediate tables, words, and vectorised hashing of words and shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import scratch

#: Of a batch handed to Python. Texts have no bound, so rows alone say nothing of its size; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: the blank and the control characters from tab to carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, fixes row placement."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def in_batches(df: DataFrame) -> DataFrame:
    """``df`` for ``mapInArrow``, in batches bounded by bytes: in this session from now on, unless it has a bound of its own."""
    if not df.sparkSession.conf.get(_BATCH_SETTING, None):
        df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BLANKS), lambda w: w != "")


def materialised(value: Column, name: str) -> Column:
    """A one-row generator around an expression, which keeps the optimizer from copying it into lambdas above it."""
    return F.explode(F.array(value)).alias(name)


def crc_of_id(doc_id: Column) -> Column:
    """The CRC-32 of an id written as text; of a null id, that of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def commonest(counted: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the largest counts, at most ``most`` of them: all above a limit, which a histogram of 16 steps to the double gives."""
    step = F.floor(F.log2(n) * 16).cast("int")
    steps = sorted(((r["step"], r["count"]) for r in counted.groupBy(step.alias("step")).count().collect()), reverse=True)
    total, limit = 0, steps[0][0] + 1 if steps else 0
    for at, rows in steps:
        total += rows
        if total > most:
            break
        limit = at
    return counted.where(step >= limit)


BITMAP_BITS = 1 << 25


def id_bitmap(ids: DataFrame, col: str, most: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of the hashed ids, of at most ``most`` bits (4 MB), whatever their number: what is not in it is not an id.

    Built by an aggregate over its 64-bit words; only the words reach the driver. Beyond some millions of ids it fills
    up and excludes little, which costs time and no result.
    """
    n = ids.count()
    bits = 1 << min(max(10, (16 * n).bit_length()), most.bit_length() - 1)
    place = F.xxhash64(col).bitwiseAND(F.lit(bits - 1))
    places = ids.select(F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    filled = places.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[filled.column("word").to_numpy()] = filled.column("set").to_numpy()
    return bitmap.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    place = hashed.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


#: DuckDB: the CRC-32 of a list of bytes, with the table ``crc`` (made by rule) at hand.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t)"


def crc_sql(bytes_: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)"


# ---- hashing in numpy

_POWER = np.uint64(0x9E3779B97F4A7C15 | 1)
_LANES = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_VALUE = np.zeros(256, np.uint64)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE[:] = mix(np.arange(1, 257, dtype=np.uint64))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse, grown to the longest chunk seen."""

    def __init__(self) -> None:
        self.n, self.up, self.down = 0, np.empty(0, np.uint64), np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", int(_POWER)), ("down", _inverse(int(_POWER)))):
                a = np.full(self.n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with up to ``limit`` bytes (a longer text alone): first row, end, bytes, bounds of the texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pa.concat_arrays([texts]) if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
    pa.default_memory_pool().release_unused()  # workers live on, and another operator's may be next


def word_hashes(data: np.ndarray, bounds: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of concatenated UTF-8 texts: a 64-bit hash, first byte and end of each, and each text's bounds in them.

    With ``fold`` A-Z count as a-z. The hash of a word is a polynomial in its bytes, taken from prefix sums, and mixed.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    blank = _BLANK[data]
    cut = np.zeros(n + 1, bool)  # a text begins or all end here
    cut[bounds] = True
    begins = ~blank
    ends = begins.copy()
    begins[1:] &= blank[:-1] | cut[1:n]
    ends[:-1] &= blank[1:] | cut[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers.get(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[_LOW[data] if fold else data] * up[:n], out=sums[1:])
    h = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)
    return mix(h), first, last, np.searchsorted(first, bounds)


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of ``width``-word shingles; a shorter text has its whole sequence as one, an empty none."""
    if not len(h):
        return h
    k = min(width, len(h))
    s = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        s = mix(s + h[j : len(h) - k + 1 + j] * _LANES[j % len(_LANES)])
    return np.unique(s)
