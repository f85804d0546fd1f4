"""Quality by a sparse ensemble of rules over statistics of the whole text.

Statistics are rates of kinds of characters, of words and of repetition. Small boosted trees are grown on a bounded
sample of labelled texts, each on a part of rows and statistics; every path from a root to a node below it is a rule,
a conjunction of bounds on statistics. A logistic regression with an absolute-value penalty (lasso) keeps few of the rules
and weighs them; the penalty is the largest that does not tell on rows set apart. The kept rules are compiled into one
Spark column expression over the columns of statistics, so scoring is a projection of each row where it is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import crc_of_id, in_batches, land, mix, table, text_chunks, word_hashes


def _bytes(chars: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: Kinds of bytes whose share of the text is a statistic.
KINDS = {
    "upper": _bytes(range(65, 91)),
    "lower": _bytes(range(97, 123)),
    "digit": _bytes(range(48, 58)),
    "blank": _bytes(b" \t\n\v\f\r"),
    "line_end": _bytes(b"\n"),
    "stop": _bytes(b"."),
    "comma": _bytes(b",;:"),
    "shout": _bytes(b"!?"),
    "quote": _bytes(b"\"'()-"),
    "pipe": _bytes(b"|"),
    "symbol": _bytes(b"#$%&*@^~+=_\\/<>[]{}`"),
    "wide": _bytes(range(128, 256)),
}
STATISTICS = [
    *[f"{k}_rate" for k in KINDS], "log_words", "mean_word", "long_word_rate", "short_word_rate", "bare_word_rate", "symbol_word_rate",
    "same_word_rate", "same_word_run", "distinct_rate", "top_word_rate", "distinct_pair_rate", "top_pair_rate", "mean_line", "distinct_line_rate",
]
_STRANGE = KINDS["symbol"] | KINDS["pipe"] | KINDS["shout"]


def _shares(keys: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the keys of each text, the share of distinct ones and that of the commonest; 0 for a text without keys."""
    distinct, most = np.zeros(n_texts), np.zeros(n_texts)
    if len(keys):
        order = np.lexsort((keys, text))
        k, t = keys[order], text[order]
        first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])])
        size = np.diff(np.r_[first, len(k)])
        distinct += np.bincount(t[first], minlength=n_texts)
        np.maximum.at(most, t[first], size)
    all_ = np.maximum(1, np.bincount(text, minlength=n_texts))
    return distinct / all_, most / all_


def chunk_statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The statistics of texts given as bytes: a row for each. Those of a text without words are 0 but for its bytes' kinds."""
    n = len(bounds) - 1
    size = np.maximum(1, np.diff(bounds))

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums

    out = [np.diff(per_text(kind[data])[bounds]) / size for kind in KINDS.values()]
    h, first, last, at = word_hashes(data, bounds)
    words = np.diff(at)
    some = np.maximum(1, words)
    text = np.repeat(np.arange(n), words)
    length = last - first
    strange = per_text(_STRANGE[data])
    odd = strange[last] - strange[first]

    def rate(mask: np.ndarray) -> np.ndarray:
        return np.bincount(text, mask, n) / some

    follows = np.zeros(len(h), bool)
    follows[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    # the longest row of one word: words since the last one that does not repeat its predecessor
    new = np.maximum.accumulate(np.where(follows, 0, np.arange(len(h)))) if len(h) else np.empty(0, np.int64)
    run = np.zeros(n)
    np.maximum.at(run, text, np.arange(len(h)) - new)
    pair = np.flatnonzero(text[1:] == text[:-1])
    pairs = mix(h[pair] + mix(h[pair + 1])) if len(pair) else np.empty(0, np.uint64)
    line_ends = np.flatnonzero(data == 10)
    starts = np.unique(np.r_[bounds[:-1], line_ends + 1])
    starts = starts[starts < bounds[-1]]
    # a line is known by the sum of its mixed words
    line = np.searchsorted(starts, first, "right") - 1
    lines, line_of = np.unique(line, return_inverse=True)
    sums = np.zeros(len(lines), np.uint64)
    np.add.at(sums, line_of, mix(h ^ np.uint64(0xA0761D6478BD642F)))
    line_text = np.searchsorted(bounds, starts[lines], "right") - 1 if len(lines) else np.empty(0, np.int64)
    n_lines = np.maximum(1, np.bincount(line_text, minlength=n))
    distinct, top = _shares(h, text, n)
    distinct_pairs, top_pair = _shares(pairs, text[pair] if len(pair) else np.empty(0, np.int64), n)
    out += [
        np.log1p(words), np.bincount(text, length, n) / some, rate(length > 12), rate(length <= 2), rate(odd == length), rate((odd > 0) & (odd < length)),
        rate(follows), np.log1p(run), distinct, top, distinct_pairs, top_pair, words / n_lines, _shares(sums, line_text, n)[0],
    ]
    return np.stack(out, 1)


# ---- trees, rules and their weights


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics, all of which must hold: (statistic, low, high) for low < value <= high."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(x[:, STATISTICS.index(s)] > low) & (x[:, STATISTICS.index(s)] <= high) for s, low, high in self.bounds])

    def column(self) -> Column:
        sides = [(F.col(s) > F.lit(low) if math.isfinite(low) else None, F.col(s) <= F.lit(high) if math.isfinite(high) else None) for s, low, high in self.bounds]
        return reduce(and_, [c for pair in sides for c in pair if c is not None])

    def __str__(self) -> str:
        return " and ".join((f"{low:.4g} < " if math.isfinite(low) else "") + s + (f" <= {high:.4g}" if math.isfinite(high) else "") for s, low, high in self.bounds)


@dataclass
class RuleEnsemble:
    """A start value and weighted rules; the score is the logistic function of their sum."""

    base: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-sum([w * r.holds(x) for r, w in self.rules], np.full(len(x), self.base))))

    def column(self) -> Column:
        """The score as an expression over the columns of statistics."""
        total = reduce(lambda a, b: a + b, [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.base))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  {r}" for r, w in sorted(self.rules, key=lambda rw: -abs(rw[1]))]


def _paths(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, allowed: np.ndarray, depth: int) -> list[tuple[tuple, np.ndarray, float]]:
    """A tree on some rows and statistics: (path, all rows it leads to, its step) of every node but the root.

    A path is a tuple of (statistic, bin, above): the best split of each node by the gain of the logistic loss, to ``depth``.
    """
    found, open_ = [], [((), np.ones(len(g), bool))]
    in_sample = np.zeros(len(g), bool)
    in_sample[rows] = True
    for _ in range(depth):
        following = []
        for path, inside in open_:
            idx = np.flatnonzero(inside & in_sample)
            gs, hs = g[idx].sum(), h[idx].sum()
            best, split = 1e-4, None
            for f in allowed:
                if not len(edges[f]):
                    continue
                b = binned[idx, f]
                gl = np.cumsum(np.bincount(b, g[idx], len(edges[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[idx], len(edges[f]) + 1))[:-1]
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(hl < 1) | (hs - hl < 1)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, split = gain[k], (int(f), k)
            if split is None:
                continue
            f, k = split
            for above in (False, True):
                part = inside & ((binned[:, f] > k) == above)
                own = part & in_sample
                longer = (*path, (f, k, above))
                following.append((longer, part))
                found.append((longer, part, float(-g[own].sum() / (h[own].sum() + 1))))
        open_ = following
    return found


def _rule(path: tuple[tuple[int, int, bool], ...], edges: list[np.ndarray]) -> Rule:
    bounds: dict[int, list[float]] = {}
    for f, k, above in path:
        b = bounds.setdefault(f, [-math.inf, math.inf])
        if above:
            b[0] = max(b[0], float(edges[f][k]))
        else:
            b[1] = min(b[1], float(edges[f][k]))
    return Rule(tuple((STATISTICS[f], *b) for f, b in sorted(bounds.items())))


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.15, bins: int = 48, seed: int = 7) -> list[Rule]:
    """The paths of boosted trees as rules, one for each distinct set of rows."""
    random = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    # a rare statistic is zero nearly everywhere: split at zero and within what is above
    edges = [np.unique(np.r_[e, 0.0, np.quantile(c[c > 0], [0.1, 0.25, 0.5, 0.75, 0.9], method="lower")]) if (c > 0).any() else e for e, c in zip(edges, x.T, strict=True)]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T, strict=True)]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    prior = y.mean()
    margin = np.full(len(y), math.log(prior / (1 - prior)))
    rules: dict[bytes, Rule] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(random.random(len(y)) < 0.6)
        allowed = np.flatnonzero(random.random(x.shape[1]) < 0.5)
        paths = _paths(binned, edges, p - y, p * (1 - p), rows, allowed, depth)
        for path, inside, step in paths:
            rules.setdefault(np.packbits(inside).tobytes(), _rule(path, edges))
            if not any(len(q) > len(path) and q[: len(path)] == path for q, _, _ in paths):
                margin += np.where(inside, rate * step, 0.0)
    return list(rules.values())


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, start: tuple[float, np.ndarray] | None = None, turns: int = 200) -> tuple[float, np.ndarray]:
    """Intercept and weights of least logistic loss plus ``penalty`` times the absolute weights, by accelerated proximal gradient."""
    n, y = len(y), y.astype(z.dtype)
    base, w = start if start is not None else (math.log(y.mean() / (1 - y.mean())), np.zeros(z.shape[1], z.dtype))
    step = 4.0 / (1.0 + float(np.linalg.norm(z.T @ z / n, 2)))
    b0, w0, b1, w1, t = base, w, base, w, 1.0
    for _ in range(turns):
        error = 1 / (1 + np.exp(-(z @ w1 + b1))) - y
        b2 = b1 - step * float(error.mean())
        w2 = w1 - step * (z.T @ error) / n
        w2 = (np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)).astype(z.dtype)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        b1, w1 = b2 + (t - 1) / t2 * (b2 - b0), w2 + (t - 1) / t2 * (w2 - w0)
        if max(abs(b2 - b0), np.abs(w2 - w0).max(initial=0)) < 1e-5:
            break
        b0, w0, t = b2, w2, t2
    return b2, w2


PENALTIES = tuple(0.02 * 0.6**k for k in range(10))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> RuleEnsemble:
    """Rules from the rows that ``apart`` leaves; the penalty is chosen on those it marks, the weights are fitted on all.

    Without rows every score is 0.5; with one class only it is that class (0 or 1, nearly).
    """
    if not len(y):
        return RuleEnsemble(0.0)
    if y.min() == y.max():
        return RuleEnsemble(20.0 if y[0] else -20.0)
    if not apart.any() or y[~apart].min(initial=2) == y[~apart].max(initial=-1):
        apart = np.zeros(len(y), bool)
    rules = grow_rules(x[~apart], y[~apart])
    z = np.stack([r.holds(x) for r in rules], 1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    checked, fitted = (z[apart], y[apart]) if apart.any() else (z, y), None
    losses = []
    for penalty in PENALTIES:
        fitted = lasso_logistic(z[~apart], y[~apart], penalty, fitted)
        margin = checked[0] @ fitted[1] + fitted[0]
        each = np.logaddexp(0, np.where(checked[1] == 1, -margin, margin))
        losses.append((float(each.mean()), float(each.std() / math.sqrt(len(each)))))
        if len(losses) > 1 and losses[-1][0] > losses[-2][0] - 1e-4:
            break
    low, spread = min(losses)
    penalty = next(p for p, (loss, _) in zip(PENALTIES, losses, strict=False) if loss <= low + spread)
    base, weights = lasso_logistic(z, y, penalty, fitted, 400)
    return RuleEnsemble(base, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-4])


# ---- on Spark


def _with_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, bounds in text_chunks(batch.column(batch.num_columns - 1)):
            kept, x = batch.slice(i, j - i), chunk_statistics(data, bounds)
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], *[pa.array(c) for c in np.ascontiguousarray(x.T)]], names=[*kept.schema.names[:-1], *STATISTICS])


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column for each of ``STATISTICS`` of the whole text; columns already called so are replaced.

    A null text is as an empty one, all of whose statistics are 0.
    """
    rest = docs.drop(*STATISTICS)
    types = T.StructType([*rest.schema.fields, *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])
    return in_batches(rest.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))).mapInArrow(_with_statistics, types)


MAX_ROWS = 30_000  # labelled rows that the rules are fitted on


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleEnsemble:
    """Rules from the labelled documents, those with the smallest hashes where there are more than ``max_rows``.

    Null labels and ids are ignored. Of a document's labels, and of those of equal texts, which count once, the smallest counts.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(F.col("quality").cast("int")).alias("_label"))
    sample = known.withColumn("_order", F.xxhash64("_id", F.lit("quality"))).orderBy("_order", "_id").limit(max_rows)
    # at most max_rows rows of a few bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    stats = with_statistics(rows.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), "_label", "text")).drop("text")
    once = land(stats.groupBy("_hash").agg(F.min("_label").alias("_label"), *[F.first(s).alias(s) for s in STATISTICS]), "labelled")
    got = once.toPandas().sort_values("_hash").reset_index(drop=True)
    part = (got["_hash"].to_numpy(np.int64) >> 9) % 4 == 0
    return fit(got[STATISTICS].to_numpy(np.float64), got["_label"].to_numpy(np.int64), part)


def score_documents(docs: DataFrame, model: RuleEnsemble, score: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is of quality, a null one as an empty one; a column called like the score is replaced.

    Every row of the input has one row, repeated ones too.
    """
    rest = docs.drop(score)
    own = [c for c in rest.columns if c not in STATISTICS]
    clash = [c for c in rest.columns if c in STATISTICS]
    held = rest.select(*own, *[F.col(c).alias(f"_own_{c}") for c in clash])
    scored = with_statistics(held).select("*", model.column().alias(score))
    return scored.select(*[F.col(f"_own_{c}").alias(c) if c in clash else F.col(c) for c in rest.columns], score)


THRESHOLD = 0.5


def held_out() -> Column:
    return F.pmod(crc_of_id(F.col("doc_id")), F.lit(3)) == 1


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out()))
    scored = score_documents(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
