"""Similarity join of word-shingle sets by parity sketches, and the groups that its links form.

A set's sketch XORs the hash of each shingle into one of ``k`` cells, chosen by the hash. Two sets with symmetric
difference ``d`` differ in ``d`` cells at most, so the cells that differ, like the differing bits of a parity bitmap,
bound the symmetric difference from below. Sizes are cut into bands; a band's ``k`` exceeds the largest difference that
similar sets of the band can have, so similar sets agree in a cell (pigeonhole) and an equi-join on
(band, cell, value) misses none. A set that differs in ``d`` cells at most from any similar one presents ``d + 1`` of its
cells, the first in an order of all cell values (prefix filter); those of many shingles come first, as sets that have
little in common seldom agree in them. A cell without shingles says nothing: only sets with fewer than ``d + 1`` others,
which could agree in empty cells alone, present these.

Sets that are equal are one class. Of the classes that share a cell, each is first compared with one of them, in a few
turns with another one each; pairs that are then still in different groups are compared one by one, so groups are
whole, yet a group of copies is never expanded into all its pairs. Comparisons that parity bitmaps (of 512 bits, for
large sets also of about as many bits as members) cannot exclude are made on the whole sets.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import id_bitmap, in_batches, in_bitmap, land, mix, shingle_hashes, table, text_chunks, word_hashes

GROWTH = 1.5  # of sizes, from band to band
RESERVE = 0.06  # share of cells
BITMAP = [f"b{i}" for i in range(8)]
WIDE_FROM = 256  # sets of more members have a second bitmap
MAX_SIZE = 1 << 40
MOST_TURNS = 4
CELL_PART = 2_000  # members of a cell compared with each other in one task


def bands(percent: int) -> tuple[tuple[int, int, int, int], ...]:
    """(smallest, largest size, cells, reserve) of each band.

    Sets of sizes a <= b that are ``percent`` similar differ in ``(a + b) * (100 - percent) / (100 + percent)`` at most.
    """
    out, low = [], 1
    while low < MAX_SIZE:
        high = max(low, math.floor(low * GROWTH))
        most = 2 * high * (100 - percent) // (100 + percent)
        spare = math.ceil(RESERVE * (most + 1)) if most else 0
        out.append((low, high, most + 1 + spare, spare))
        low = high + 1
    return tuple(out)


def cells(u: np.ndarray, percent: int, all_bands: tuple[tuple[int, int, int, int], ...]) -> np.ndarray:
    """The cell values that a sorted set of hashes presents, in its own band and in larger ones where a similar set may be.

    Of ``k`` cells, ``e`` of them empty, a similar set agrees in ``k - d - e`` that are not empty at least, if ``d`` is the
    largest difference; so all but that many and one more, ``d + 1``, of the ``k - e`` will do, where there are as many.
    """
    n, out = len(u), []
    high32 = u >> np.uint64(32)
    first = next(i for i, b in enumerate(all_bands) if n <= b[1])
    for i in range(first, len(all_bands)):
        low, high, k, _ = all_bands[i]
        if i > first and low * percent > 100 * n:
            break
        most = (n + min(high, 100 * n // percent)) * (100 - percent) // (100 + percent)
        cell = ((high32 * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        names = np.uint64(i << 44) + cell[starts].astype(np.uint64)
        values = mix(np.bitwise_xor.reduceat(u, starts) + mix(names))
        if len(starts) > most + 1:
            out.append(values[np.lexsort((values, -np.diff(starts, append=n)))[: most + 1]])
        else:
            out.append(values)
        if len(starts) <= most:
            empty = np.setdiff1d(np.arange(k), cell[starts]).astype(np.uint64)
            out.append(mix(mix(np.uint64(i << 44) + empty) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.concatenate(out)


def parity(u: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap in which each member has toggled a bit. Its upper half XORed to the lower one is that of half the bits."""
    odd = np.bincount((u & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for i, j, data, bounds in text_chunks(batch.column("text")):
        h, _, _, at = word_hashes(data, bounds)
        yield batch.slice(i, j - i), [shingle_hashes(h[a:b], width) for a, b in zip(at[:-1], at[1:], strict=True)]


DIGEST = "doc_id bigint, textual bigint, n bigint, d1 bigint, d2 bigint"


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Two numbers by which a set is known, with its size; zeros for an empty one."""
    d = np.zeros((2, len(sets)), np.uint64)
    for i, u in enumerate(sets):
        if len(u):
            d[:, i] = u.sum(), np.bitwise_xor.reduce(mix(u))
    return pa.array(d[0].view(np.int64).copy()), pa.array(d[1].view(np.int64).copy())


FEATURES = DIGEST + ", " + ", ".join(f"{b} bigint" for b in BITMAP) + ", wide array<bigint>"


def _features(batches: Iterator[pa.RecordBatch], width: int, percent: int | None) -> Iterator[pa.RecordBatch]:
    """Size and digests of each text's set, and its bitmaps or, where ``percent`` is given, its cells."""
    empty, all_bands = np.empty(0, np.uint64), bands(percent) if percent else ()
    for batch in batches:
        for part, sets in _sets(batch, width):
            maps = np.zeros((len(sets), 8), np.int64)
            values, wide = [], []
            for i, u in enumerate(sets):
                if len(u) and not percent:
                    maps[i] = parity(u, 512).view(np.int64)
                if percent:
                    values.append(cells(u, percent, all_bands) if len(u) else empty)
                    continue
                wide.append(parity(u, max(1024, 1 << (len(u) - 1).bit_length())) if len(u) > WIDE_FROM else empty)
            columns = [part.column("doc_id"), part.column("textual"), pa.array(np.array([len(u) for u in sets], np.int64)), *_digests(sets)]
            names = ["doc_id", "textual", "n", "d1", "d2", *(["cells"] if percent else [*BITMAP, "wide"])]
            columns += [_lists(values)] if percent else [*[pa.array(maps[:, i].copy()) for i in range(8)], _lists(wide)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _whole_sets(batches: Iterator[pa.RecordBatch], width: int, bitmap: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = batch.filter(pa.array(in_bitmap(bitmap.value, batch.column("hashed").to_numpy())))
        for part, sets in _sets(wanted, width):
            yield pa.RecordBatch.from_arrays([part.column("id"), *_digests(sets), _lists(sets)], names=["id", "d1", "d2", "hashes"])


def components(edges: DataFrame) -> DataFrame:
    """(v, c): the smallest vertex that links lead to from each vertex of ``edges`` (a, b).

    Labels spread along links and then jump to their label's label, so long chains take few rounds; each round is landed.
    """
    both = land(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = land(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        spread = labels.join(near, "v").select("v", F.col("c").alias("was"), F.least("c", "m").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("cc"))
        after = land(spread.join(jump, "c", "left").select("v", "was", F.least("c", F.coalesce("cc", "c")).alias("c")), "labels")
        labels = after.select("v", "c")
        if not after.where("c < was").limit(1).count():
            return labels


def _textual() -> Column:
    """What a row's text is known by besides its id, which may be repeated."""
    return F.xxhash64(F.col("text").cast("string"))


def similar_groups(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: links join documents with ``100 * common >= percent * union``.

    ``component_id`` is the smallest doc_id that links lead to. Texts without words, or null, have no shingles and link
    with nothing: their component is their own id. A text with fewer words than ``width`` has its whole sequence as one
    shingle. Rows that share an id are vertices of their own; a null id takes part but is never the smallest, and
    stays null where no other document is linked. Other columns are ignored.
    """
    return _grouped(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, textual, n, component, component_id) per row; ``component`` tells groups apart, also those of one smallest id."""
    texts = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _textual().alias("textual"), F.col("text").cast("string").alias("text")))
    features = land(texts.mapInArrow(functools.partial(_features, width=width, percent=None), FEATURES), "features")
    key = ["n", "d1", "d2"]
    # equal sets are one class, and one vertex; numbers given on landing are unique and stay
    classes = land(features.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep")).withColumn("v", F.monotonically_increasing_id()), "classes")
    same = F.col("f.doc_id").eqNullSafe(F.col("c.rep")) & (F.col("f.n") == F.col("c.n")) & (F.col("f.d1") == F.col("c.d1")) & (F.col("f.d2") == F.col("c.d2"))
    # the cells are larger than all else together: made anew of the texts, they are shuffled without being landed first;
    # a class whose smallest id is on several rows comes several times, which links nothing new
    celled = texts.mapInArrow(functools.partial(_features, width=width, percent=percent), DIGEST + ", cells array<bigint>")
    cell = celled.alias("f").join(classes.alias("c"), same).select("c.v", F.explode("cells").alias("cell"))
    shared = cell.groupBy("cell").agg(F.min("v").alias("w"), F.max("v").alias("x")).where("w < x").select("cell")
    members = land(cell.join(shared, "cell"), "members")
    one = features.alias("f").join(classes.alias("c"), same).select("c.v", "c.n", "c.d1", "c.d2", "c.rep", *[F.col(f"f.{c}").alias(c) for c in (*BITMAP, "wide")])
    facts = land(one.join(members.select("v").distinct(), "v", "left_semi").dropDuplicates(["v"]), "class-facts")
    text = in_batches(docs).select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("doc_id").cast("long")).alias("hashed"), F.col("text").cast("string").alias("text"))

    def side(name: str, *more: str) -> DataFrame:
        return facts.select(*[F.col(c).alias(f"{name}_{c}") for c in ("v", "n", *BITMAP, *more)])

    differ = sum((F.bit_count(F.col(f"a_{b}").bitwiseXOR(F.col(f"b_{b}"))) for b in BITMAP), F.lit(0))
    near = (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent) & (differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent))

    # bitmaps of one size, or the larger one folded; where neither fits, nothing is excluded
    folded = lambda x, y: f"if(size({x}) = 2 * size({y}), zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p ^ q), {x})"
    apart = f"aggregate(zip_with({folded('a_wide', 'b_wide')}, {folded('b_wide', 'a_wide')}, (p, q) -> bit_count(p ^ q)), 0, (t, x) -> t + coalesce(x, 0))"
    fit = "size(a_wide) > 0 AND size(b_wide) > 0 AND (size(a_wide) = size(b_wide) OR size(a_wide) = 2 * size(b_wide) OR size(b_wide) = 2 * size(a_wide))"
    wide_near = F.expr(f"CASE WHEN {fit} THEN {apart} * {100 + percent} <= (a_n + b_n) * {100 - percent} ELSE true END")

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and bitmaps do not exclude."""
        both = pairs.join(side("a", "wide"), F.col("a") == F.col("a_v")).join(side("b", "wide"), (F.col("b") == F.col("b_v")) & near)
        return both.where(wide_near).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar, on whole sets made anew of the texts concerned."""
        wanted = land(facts.join(pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct(), "v", "left_semi").select("v", "rep", "n", F.col("d1").alias("w1"), F.col("d2").alias("w2")), "wanted")
        bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(wanted, "rep"))
        found = text.mapInArrow(functools.partial(_whole_sets, width=width, bitmap=bitmap), "id bigint, d1 bigint, d2 bigint, hashes array<bigint>")
        # a repeated id may bring the set of another class
        mine = F.col("id").eqNullSafe(F.col("rep")) & (F.size("hashes") == F.col("n")) & (F.col("d1") == F.col("w1")) & (F.col("d2") == F.col("w2"))
        sets = land(found.join(wanted, mine).select("v", "hashes").dropDuplicates(["v"]), "sets")
        a, b = (sets.select(F.col("v").alias(side), F.col("hashes").alias(f"set_{side}")) for side in "ab")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        return land(pairs.join(a, "a").join(b, "b").where(common * 100 >= union * percent).select("a", "b"), "verified")

    links, grouped = None, members.withColumn("c", F.col("v"))
    for turn in range(MOST_TURNS):
        # the cells' members against one of them, another one each turn
        hub = F.min(F.struct(F.xxhash64("v", F.lit(turn)).alias("order"), "v", "c")).alias("hub")
        hubs = grouped.groupBy("cell").agg(hub).select("cell", F.col("hub.v").alias("hub"), F.col("hub.c").alias("hub_c"))
        star = grouped.join(hubs, "cell").where("c <> hub_c").select(F.least("hub", "v").alias("a"), F.greatest("hub", "v").alias("b")).distinct()
        more = verified(land(possible(star), "star"))
        new = more.limit(1).count()
        if new or links is None:
            links = more if links is None else land(links.union(more), "all-links")
            groups = components(links)
            named = members.join(groups, "v", "left").select("cell", "v", F.coalesce("c", "v").alias("c"))
            mixed = named.groupBy("cell").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("cell")
            grouped = land(named.join(mixed, "cell", "left_semi"), "mixed")
        if not new:
            break
    # what is still in different groups, pair by pair. A cell of many members is dealt out in parts, each pair of which is
    # compared in a task of its own; only pairs that sizes and bitmaps do not exclude leave the comparison
    in_parts = grouped.join(grouped.groupBy("cell").agg(F.ceil(F.count("*") / CELL_PART).cast("int").alias("parts")), "cell")
    part = F.pmod(F.xxhash64("v"), "parts").cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    meets = {
        "a": F.transform(every, lambda i: F.struct(part.alias("left"), i.alias("right"))),
        "b": F.transform(every, lambda i: F.struct(i.alias("left"), part.alias("right"))),
    }
    a, b = (
        in_parts.select("cell", F.col("v").alias(f"{x}_v"), F.col("c").alias(f"{x}_c"), F.inline(meets[x])).join(side(x, "wide"), f"{x}_v") for x in "ab"
    )
    here = (a["cell"] == b["cell"]) & (a["left"] == b["left"]) & (a["right"] == b["right"])
    rest = a.join(b, here & (F.col("a_v") < F.col("b_v")) & (F.col("a_c") != F.col("b_c")) & near & wide_near)
    more = verified(land(rest.select(F.col("a_v").alias("a"), F.col("b_v").alias("b")).distinct(), "rest"))
    if more.limit(1).count():
        groups = components(links.union(more))
    smallest = classes.join(groups, "v", "left").withColumn("c", F.coalesce("c", "v"))
    ids = smallest.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = smallest.join(ids, "c").select(*key, F.col("c").alias("component"), "component_id")
    columns = ["doc_id", "textual", "n", "component", "component_id"]
    rows = features.select("doc_id", "textual", *key).where("n > 0").join(named, key)
    alone = features.where("n = 0").withColumn("component", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return rows.select(columns).union(alone.select(columns))


def keep_one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """All columns of the documents that remain when of each group only the document of the smallest id stays.

    Documents without words all stay. Of rows of a group that share its smallest id one stays (of different texts that of
    the smallest hash); groups of unrelated texts keep one each, also where these share an id. A null id is larger than others.
    """
    groups = _grouped(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "textual")).alias("first")
    kept = groups.where("n > 0").groupBy("component").agg(first).select(F.col("first.doc_id").alias("_kept"), F.col("first.textual").alias("_text"), F.lit(False).alias("_all"))
    empty = groups.where("n = 0").select(F.col("doc_id").alias("_kept"), F.col("textual").alias("_text"), F.lit(True).alias("_all"))
    stays = kept.union(empty).distinct()
    held = docs.withColumn("_textual", _textual())
    rows = held.join(stays, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")) & (F.col("_textual") == F.col("_text")))
    one = rows.where(~F.col("_all")).dropDuplicates(["doc_id", "_textual"])
    return one.select(*docs.columns).union(rows.where("_all").select(*docs.columns))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), 4, 85)


def groups_sql(width: int, percent: int, documents: str = "documents") -> str:
    """DuckDB: (doc_id, n_shingles, component_id) by comparing all documents that share a shingle."""
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {documents}),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * m >= {percent} * (a.n + b.n - m)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce((SELECT min(y) FROM r WHERE r.x = w.doc_id), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)"""


OP6_SQL = groups_sql(4, 85)
