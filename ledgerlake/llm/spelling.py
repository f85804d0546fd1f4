"""Spelling variants: words one edit apart, found by a trie over letter-group counts.

A word's vector holds its length and how often each group of letters occurs in it. One inserted code point raises one
count by one (a surplus), a deleted one lowers one (a deficit), a replaced one does both or, within a group, neither.
Words are arranged in a trie by successive counts; a search goes down depth first and may spend one surplus and one
deficit on its way. To find each pair from one side only, words are searched for partners of their own length, whose
surplus comes before the deficit, and for partners one code point longer. The words of the leaves reached are verified:
the half of the word that the edit is not in must be equal, then all code points are compared.

The trie is spread over the cluster: its top levels are columns, and what is below one node of them is searched in one
task, which gets the node's words and, from an equi-join, the searches that arrive there with what they have spent. The
number of top levels follows the sizes of the nodes, and nodes that remain large are dealt out in pieces, so a task has a
bounded number of words, whatever the number of words in all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import CRC_TABLE, LOWER, UPPER, crc_sql, land, mix, table

#: Letter groups, the most telling first; letters in none of them count in the last, which has no level.
GROUPS = ("e", "n", "t", "i", "a", "r", "s", "o", "h", "d", "u", "lj", "cx", "gk", "mqé", "bwö", "fzàü", "pvyóñ")
TOP_LEVELS = 6  # at most, after the length
NODE_WORDS = 20_000
LEAF_WORDS = 6  # a node of so few words is not divided further
CLIP = 14  # larger counts are taken for this one, which can only lead to more leaves
STATES, PAIRS = 1 << 18, 1 << 20  # handled at a time
LEAST_LENGTH, LEAST_COUNT, STEP, DOMINANCE = 6, 5, 199, 5


def words_with_slips(docs: DataFrame, text: str = "text", step: int = STEP) -> DataFrame:
    """(word, n): the letter runs of whole texts, A-Z in lower case, and how often each occurs.

    From every run whose hash with the id of its document ``step`` divides, one code point is deleted. Runs of under six code
    points are passed over, as no word comes of them. Null texts have no runs; a null id counts as an empty one.
    """
    low = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(low, F.lit("[a-z\\u00C0-\\u00FF]{%d,}" % LEAST_LENGTH), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    slip = F.concat(F.expr("substr(run, 1, at)"), F.expr("substr(run, at + 2)"))
    word = F.when(F.pmod(h, F.lit(step)) == 0, slip).otherwise(F.col("run"))
    return runs.withColumn("at", at).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


# ---- the trie of one node's words


def _letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


_GROUP = np.full(256, len(GROUPS), np.uint8)
for _i, _letters_of in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters_of]] = _i


def _counts(letters: np.ndarray, levels: range) -> np.ndarray:
    grouped = _GROUP[letters]
    return np.stack([np.minimum((grouped == k).sum(1), CLIP) for k in levels], 1) if len(levels) else np.empty((len(letters), 0), np.int64)


def _half_hashes(letters: np.ndarray, head: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``head`` code points and of those from ``tail`` on."""
    out = []
    for part in (letters[:, :head], letters[:, tail:]):
        h = np.zeros(len(letters), np.uint64)
        for c in part.T:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1))
        out.append(h)
    return out[0], out[1]


class Trie:
    """Words by successive counts. Per level, a table gives each node's children by their count, -1 where there is none."""

    def __init__(self, counts: np.ndarray) -> None:
        self.order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(counts))
        ordered = counts[self.order]
        node = np.zeros(len(ordered), np.int64)
        self.levels = []  # (children, first word, end) by node
        bounds = (np.zeros(1, np.int64), np.full(1, len(ordered)))
        for k in range(counts.shape[1]):
            begins = np.ones(len(ordered), bool)
            begins[1:] = (node[1:] != node[:-1]) | (ordered[1:, k] != ordered[:-1, k])
            first = np.flatnonzero(begins)
            children = np.full((node[-1] + 1, CLIP + 1), -1, np.int32)
            children[node[first], ordered[first, k]] = np.arange(len(first))
            self.levels.append((children, *bounds))
            node = np.cumsum(begins) - 1
            bounds = (first, np.r_[first[1:], len(ordered)])
        self.levels.append((None, *bounds))

    def search(self, counts: np.ndarray, spent: np.ndarray, deficit: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(search, word, spent) for all words of the leaves reached; ``spent`` is 0, 1 (surplus) or 2 (deficit too)."""
        stack = [(0, q, np.zeros(len(q), np.int64), spent[q]) for q in np.array_split(np.arange(len(counts)), max(1, math.ceil(len(counts) / STATES)))]
        while stack:
            level, q, node, used = stack.pop()
            children, first, end = self.levels[level]
            size = end[node] - first[node]
            leaf = size <= LEAF_WORDS if children is not None else np.ones(len(q), bool)
            if leaf.any():
                yield from self._members(q[leaf], first[node[leaf]], size[leaf], used[leaf])
            if leaf.all():
                continue
            q, node, used = q[~leaf], node[~leaf], used[~leaf]
            mine = counts[q, level]
            steps = [(children[node, mine], q, used)]
            up = np.flatnonzero((used == 0) & (mine < CLIP))
            steps.append((children[node[up], mine[up] + 1], q[up], np.ones(len(up), used.dtype)))
            if deficit:
                down = np.flatnonzero((used == 1) & (mine > 0))
                steps.append((children[node[down], mine[down] - 1], q[down], np.full(len(down), 2, used.dtype)))
            child, q, used = (np.concatenate(x) for x in zip(*steps, strict=True))
            there = np.flatnonzero(child >= 0)
            for part in np.array_split(there, max(1, math.ceil(len(there) / STATES))):
                if len(part):
                    stack.append((level + 1, q[part], child[part].astype(np.int64), used[part]))

    def _members(self, q: np.ndarray, first: np.ndarray, size: np.ndarray, used: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        ends = np.cumsum(size)
        for low in range(0, int(ends[-1]), PAIRS):  # of all (search, word), a block at a time
            which = np.arange(low, min(low + PAIRS, int(ends[-1])))
            at = np.searchsorted(ends, which, "right")
            yield q[at], self.order[first[at] + which - (ends[at] - size[at])], used[at]


def near_pairs(mine: list[str], theirs: list[str], spent: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (index of a search, index of a word) one edit apart, each once. All searches are of one length, all words of one.

    Words are as long as the searches or longer by one. ``top`` counts were compared before; ``spent`` says with what result.
    """
    length, longer = len(mine[0]), len(theirs[0]) - len(mine[0])
    a, b = _letters(mine, length), _letters(theirs, length + longer)
    levels = range(top, len(GROUPS))
    trie = Trie(_counts(b, levels))
    half = length // 2
    a_head, a_tail = _half_hashes(a, half, half)
    b_head, b_tail = _half_hashes(b, half, half + longer)
    rows = max(1, PAIRS * 8 // (length + 1))
    for q, w, used in trie.search(_counts(a, levels), spent, longer == 0):
        likely = np.flatnonzero((a_head[q] == b_head[w]) | (a_tail[q] == b_tail[w]))
        for low in range(0, len(likely), rows):
            block = likely[low : low + rows]
            i, j = q[block], w[block]
            x, y = a[i], b[j]
            if longer:
                head = np.logical_and.accumulate(x == y[:, :length], 1).sum(1)
                tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], 1).sum(1)
                near = head + tail >= length
            else:
                differ = x != y
                near = differ.sum(1) == 1
                # unspent pairs are met from both sides
                at = differ.argmax(1)
                rows_ = np.arange(len(block))
                near &= (used[block] > 0) | (x[rows_, at] < y[rows_, at])
            yield i[near], j[near]


NEAR = "word string, n_near bigint, near string, near_n bigint"


def _search_node(key: tuple, own: pa.Table, searches: pa.Table) -> pa.Table:
    """For the words of one piece of a node and the searches that come there: each word's near words, counted, and the largest."""
    top = key[0].as_py()
    words, n = own.column("word").to_pylist(), own.column("n").to_numpy()
    found = []
    for longer in (0, 1):
        part = searches.filter(pa.compute.equal(searches.column("longer"), longer))
        if not part.num_rows or not len(words):
            continue
        asked, asked_n, spent = part.column("asked").to_pylist(), part.column("asked_n").to_numpy(), part.column("spent").to_numpy().astype(np.int8)
        for i, j in near_pairs(asked, words, spent, top):
            here = pd.DataFrame({"word": [*map(asked.__getitem__, i), *map(words.__getitem__, j)], "near": [*map(words.__getitem__, j), *map(asked.__getitem__, i)], "near_n": np.r_[n[j], asked_n[i]]})
            found.append(_largest(here.assign(n_near=1)))
    out = _largest(pd.concat(found)) if found else pd.DataFrame({"word": [], "n_near": [], "near": [], "near_n": []})
    return pa.Table.from_pydict(
        {"word": pa.array(out["word"], pa.string()), "n_near": pa.array(out["n_near"].astype("int64")), "near": pa.array(out["near"], pa.string()), "near_n": pa.array(out["near_n"].astype("int64"))}
    )


def _largest(pairs: pd.DataFrame) -> pd.DataFrame:
    """One row per word: of its near words the number, and the one with the largest n (the first in code-point order)."""
    ordered = pairs.assign(less=-pairs["near_n"]).sort_values(["word", "less", "near"])
    counts = ordered.groupby("word", sort=False)["n_near"].sum()
    return ordered.drop_duplicates("word").drop(columns=["n_near", "less"]).assign(n_near=counts.to_numpy())


# ---- on Spark


def _top_count(level: int) -> Column:
    group = GROUPS[level]
    return F.least(F.char_length("word") - F.char_length(F.translate("word", group, "")), F.lit(CLIP)).cast("int")


def _searches(top: int) -> Column:
    """What a word searches: the counts at the top levels, as an array, with what was spent on the way there."""
    steps = [(0, 0, {})]
    steps += [(0, 1, {k: 1}) for k in range(top)]
    steps += [(0, 2, {k: 1, m: -1}) for k, m in combinations(range(top), 2)]
    steps += [(1, 0, {}), *[(1, 1, {k: 1}) for k in range(top)]]

    def counts(change: dict[int, int]) -> Column:
        return F.array(*[F.col(f"c{k}") + F.lit(change.get(k, 0)) for k in range(top)]).cast("array<int>")

    return F.array(*[F.struct(F.lit(longer).alias("longer"), F.lit(spent).alias("spent"), counts(change).alias("counts")) for longer, spent, change in steps])


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, n_near, near, near_n) for the ``words`` (word, n) that have near ones: their number and the largest of them.

    Of those with equal n the first in code-point order is the largest. Words are distinct, not null, and of code points up to
    U+00FF; n is not null. Without words there are no rows.
    """
    vectors = words.select("word", "n", F.char_length("word").alias("len"), *[_top_count(k).alias(f"c{k}") for k in range(TOP_LEVELS)])
    sizes = land(vectors.groupBy("len", *[f"c{k}" for k in range(TOP_LEVELS)]).count(), "trie-nodes")
    for top in range(2, TOP_LEVELS + 1):
        nodes = sizes.groupBy("len", F.array(*[f"c{k}" for k in range(top)]).alias("counts")).agg(F.sum("count").alias("size"))
        if (nodes.agg(F.max("size")).first()[0] or 0) <= node_words:
            break
    nodes = nodes.select(F.col("len").alias("node_len"), "counts", F.ceil(F.col("size") / node_words).cast("int").alias("pieces"))
    own = vectors.select("word", "n", "len", F.array(*[f"c{k}" for k in range(top)]).alias("counts"))
    same = (F.col("len") == F.col("node_len")) & (own["counts"] == nodes["counts"])
    placed = own.join(nodes, same).select(F.lit(top).alias("top"), "node_len", nodes["counts"].alias("node"), F.pmod(F.xxhash64("word"), "pieces").cast("int").alias("piece"), "word", "n")
    asked = vectors.select(F.col("word").alias("asked"), F.col("n").alias("asked_n"), "len", F.inline(_searches(top)))
    nodes = nodes.toDF("at_len", "at_node", "pieces")
    there = (F.col("len") + F.col("longer") == F.col("at_len")) & (F.col("counts") == F.col("at_node"))
    pieces = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("at_piece")
    arrived = asked.join(nodes, there).select(F.lit(top).alias("at_top"), "at_len", "at_node", pieces, "asked", "asked_n", "longer", "spent")
    words_of, searches_at = placed.groupBy("top", "node_len", "node", "piece"), arrived.groupBy("at_top", "at_len", "at_node", "at_piece")
    found = words_of.cogroup(searches_at).applyInArrow(_search_node, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    counted = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return counted.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for ``links`` (word, form) without cycles: the form that following them ends at.

    Each turn follows twice as many links as the one before, so the turns grow with the logarithm of the longest chain.
    """
    reached = land(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.select("word", "root").join(onward, "root", "left")
        reached = land(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if not reached.where("moved").limit(1).count():
            return reached.select("word", "root")


def spelling_forms(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for all ``words`` (word, n), as :func:`near_words` takes them.

    The form is the largest near word if it occurs ``dominance`` times as often at least; the root is where forms lead to, the
    word itself if it has none. As counts grow along forms, they lead in no circle.
    """
    near = near_words(words)
    has_form = F.col("near_n") >= F.lit(dominance) * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("near")).alias("form"), F.when(has_form, F.col("near_n")).alias("form_n")
    )
    formed = land(formed, "near-words")
    led = roots(formed.where("form IS NOT NULL"))
    return formed.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = words_with_slips(table(spark, sf_dir, "documents"))
    words = land(counted.where((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT)), "words")
    return spelling_forms(words)


_UTF8 = "flatten(list_transform(string_split(x, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"
#: DuckDB: words that share what is left when one code point is deleted, or of which one is that of the other.
OP11_SQL = f"""WITH RECURSIVE {CRC_TABLE},
u AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]{{6,}}')) AS run FROM documents),
g AS (SELECT doc_id, run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS x, count(*) AS n FROM u GROUP BY ALL),
h AS (SELECT run, n, {crc_sql(_UTF8)} AS h FROM g, crc),
d AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
v AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near FROM v a JOIN v b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON v.d = w.word UNION SELECT w.word, v.word FROM v JOIN w ON v.d = w.word),
k AS (SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS k FROM p JOIN w ON w.word = p.near),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM w LEFT JOIN k ON k.word = w.word AND k.k = 1),
r AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM f LEFT JOIN (SELECT r.word, r.root FROM r JOIN f ON f.word = r.root WHERE f.form IS NULL) e ON e.word = f.word"""
