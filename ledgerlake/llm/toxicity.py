"""Toxicity by gradient-boosted trees over dense features of the whole text, with isotonic calibration.

Features: densities of several lexicons, plain and after undoing common obfuscation; how close insults stand to
second-person words; rates of capitals, shouting, punctuation, digits and obfuscated words. Besides lexicons of common
insults there is one learned from the labels: words and word stems that toxic texts have too often for chance. Its
features are cross-fitted: a row's come from the lexicon of the other half. The model is fitted on a bounded sample of
labelled rows; every document is scored where it is read, so nothing but the sample moves.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import crc_of_id, in_batches, land, table, text_chunks

#: Common insults and hostile words by kind, in English, German, French and Spanish.
LEXICONS = {
    "insult": """idiot idiots moron morons stupid dumb loser losers clown clowns fool fools imbecile jerk pathetic worthless
        trash garbage scum filth vermin disgusting retard retarded coward cretin dimwit halfwit lowlife nobody pig pigs
        idiota estúpido imbécil basura asqueroso inútil payaso tonto cerdo escoria cobarde
        idiotin trottel dumm dummkopf blöd abschaum müll widerlich versager schwachkopf depp arschloch
        idiote imbécile stupide débile crétin ordure déchet minable dégoûtant salaud connard abruti""",
    "profanity": """fuck fucking fucker shit shitty bullshit bitch bastard asshole damn crap dick cunt whore slut piss
        mierda puta puto cabrón joder coño scheiße scheisse fick hure wichser merde putain bordel enculé salope""",
    "threat": """kill die dead hate hurt destroy murder shoot hang burn beat punch rape suffer
        matar muere odio töten stirb hasse tuer crève déteste""",
}
SECOND_PERSON = frozenset("you your yours yourself u ur ya du dich dir dein deine ihr euch tu toi ton ta tes vous votre vos tú te ti usted ustedes vosotros".split())
LEET = str.maketrans("0134578@$!|€+", "oieastbasiiet")
WORD = re.compile(r"[^\W\d_]+")
#: From the start of a run only and without going back, so that long runs take linear time.
ODD = re.compile(r"(?<![^\W_])[@$]?\d*+[^\W\d_]++(?:[\d@$!|*._+€-]++[^\W\d_]++)++")
SHOUT = re.compile(r"[A-ZÀ-ÖØ-Þ]{3,}")
NAMES = [
    *[f"{k}_density" for k in LEXICONS], *[f"{k}_count" for k in LEXICONS], "insult_kinds", "hidden_density", "second_person_density",
    "proximity", "near_count", "capital_rate", "shout_rate", "exclamation_rate", "question_rate", "symbol_rate", "punctuation_rate",
    "digit_rate", "obfuscated_rate", "stretched_rate", "log_words", "mean_word",
    "learned_count", "learned_density", "learned_kinds", "learned_most", "learned_sum",
]
NEAR_WORDS = 6


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


STEMS = (4, 5, 6)  # letters


def terms(word: str) -> list[str]:
    """A word and its stems, which end in a star: inflected forms share them."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) > n]]


class Learned:
    """A learned lexicon: the weight of each word or stem, and what they begin with, to pass over other words fast."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.heads = {t[: STEMS[0]].rstrip("*") for t in weights}

    def hits(self, words: set[str]) -> dict[str, float]:
        near = [w for w in words if w[: STEMS[0]] in self.heads]
        found = {w: max([self.weights.get(t, 0.0) for t in terms(w)]) for w in near}
        return {w: x for w, x in found.items() if x > 0}


def text_features(text: str, data: np.ndarray, learned: Learned) -> list[float]:
    """The features of one text, given also as bytes; all zero for an empty one."""
    count = np.bincount(data, minlength=256)
    n = max(1, len(data))
    low = text.lower()
    words = WORD.findall(low)
    m = max(1, len(words))
    distinct = set(words)
    present = _LEXICON.keys() & distinct
    taught = learned.hits(distinct)
    taught_count = sum(w in taught for w in words) if taught else 0
    kinds = dict.fromkeys(LEXICONS, 0)
    you = []
    places: list[int] = []
    if present or not SECOND_PERSON.isdisjoint(words):
        for i, w in enumerate(words):
            if w in present:
                kinds[_LEXICON[w]] += 1
                places.append(i)
            elif w in SECOND_PERSON:
                you.append(i)
    hidden = odd = 0
    for w in ODD.findall(low):
        odd += 1
        plain = w.translate(LEET)
        hidden += any(x in _LEXICON for x in (re.sub(r"[^\w]|_", "", plain), re.sub(r"(.)\1+", r"\1", plain)))
    near, closeness = 0, 0.0
    if places and you:
        a = np.array(you)
        for p in places:
            i = int(np.searchsorted(a, p))
            gap = min([abs(p - int(a[j])) for j in (i - 1, i) if 0 <= j < len(a)])
            near += gap <= NEAR_WORDS
            closeness = max(closeness, 1 / gap)
    letters = count[65:91].sum() + count[97:123].sum()
    triple = int(((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]).sum()) if len(data) > 2 else 0
    return [
        *[kinds[k] / m for k in LEXICONS], *[math.log1p(kinds[k]) for k in LEXICONS], len(present), hidden / m, len(you) / m,
        closeness, math.log1p(near), count[65:91].sum() / max(1, letters), len(SHOUT.findall(text)) / m, count[33] / n, count[63] / n,
        count[_SYMBOL].sum() / n, count[_PUNCTUATION].sum() / n, count[48:58].sum() / n, odd / m, triple / n, math.log1p(len(words)), n / m,
        math.log1p(taught_count), taught_count / m, len(taught), max(taught.values(), default=0.0), sum(taught.values()),
    ]


_LEXICON = {w: k for k, ws in LEXICONS.items() for w in ws.split()}
_LETTER = _is("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SYMBOL = _is("#$%&*@^~|<>")
_PUNCTUATION = _is(".,;:!?\"'()-")


def batch_features(texts: pa.Array, learned: list[Learned], use: list[int]) -> np.ndarray:
    """The features of texts; ``use`` has the number of the learned lexicon for each."""
    rows = []
    for i, j, data, bounds in text_chunks(texts):
        for k in range(j - i):
            part = data[bounds[k] : bounds[k + 1]]
            rows.append(text_features(part.tobytes().decode("utf-8", "replace"), part, learned[use[i + k]]))
    return np.array(rows, np.float64).reshape(-1, len(NAMES))


# ---- boosted trees


@dataclass
class Model:
    """Trees as arrays (feature, threshold, left child, right child, value), a start value, and the calibration's steps."""

    base: float
    trees: list[tuple[np.ndarray, ...]]
    steps: tuple[np.ndarray, np.ndarray]
    learned: Learned

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = left[node] >= 0
                if not inner.any():
                    break
                go = x[np.arange(len(x)), feature[node]] <= threshold[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            out += value[node]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.margins(x), *self.steps), 0.0, 1.0) if len(x) else np.empty(0)


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float, least: float, l2: float) -> tuple[np.ndarray, ...]:
    feature, threshold, left, right, value = [0], [0.0], [-1], [-1], [0.0]
    rows = {0: np.arange(len(g))}
    bins = int(binned.max(initial=0)) + 1
    for _ in range(depth):
        following = {}
        for node, idx in rows.items():
            gs, hs = g[idx].sum(), h[idx].sum()
            best, at = 1e-6, None
            for f in range(binned.shape[1]):
                if len(edges[f]) == 0:
                    continue
                b = binned[idx, f]
                gl = np.cumsum(np.bincount(b, g[idx], bins))[:-1]
                hl = np.cumsum(np.bincount(b, h[idx], bins))[:-1]
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                gain[(hl < least) | (hs - hl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best and k < len(edges[f]):
                    best, at = gain[k], (f, k)
            if at is None:
                continue
            f, k = at
            feature[node], threshold[node], left[node], right[node] = f, float(edges[f][k]), len(feature), len(feature) + 1
            go = binned[idx, f] <= k
            for part in (idx[go], idx[~go]):
                following[len(feature)] = part
                feature.append(0)
                threshold.append(0.0)
                left.append(-1)
                right.append(-1)
                value.append(float(-rate * g[part].sum() / (h[part].sum() + l2)))
        rows = following
    return np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of least squares, by pooling adjacent violators; as points to interpolate."""
    order = np.argsort(x, kind="stable")
    xs, first, n = np.unique(x[order], return_index=True, return_counts=True)
    means = np.add.reduceat(y[order], first) / n
    pools: list[list[float]] = []
    for v, m, w in zip(xs, means, n, strict=True):
        pools.append([v, v, m, float(w)])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            _, high, m2, w2 = pools.pop()
            p = pools[-1]
            p[1], p[2], p[3] = high, (p[2] * p[3] + m2 * w2) / (p[3] + w2), p[3] + w2
    points = [(v, p[2]) for p in pools for v in dict.fromkeys((p[0], p[1]))]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


def fit(x: np.ndarray, y: np.ndarray, calibration: np.ndarray, learned: Learned, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Model:
    """Trees on the rows that ``calibration`` leaves, calibrated on those it marks (on all where a part has one class)."""
    if not len(y) or y.min() == y.max():
        p = float(y[0]) if len(y) else 0.0
        return Model(0.0, [], (np.zeros(1), np.array([p])), learned)
    train = ~calibration
    if y[train].min(initial=2) == y[train].max(initial=-1) or not calibration.any() or y[calibration].min() == y[calibration].max():
        train = calibration = np.ones(len(y), bool)
    xt, yt = x[train], y[train]
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in xt.T]
    # a rare feature is zero nearly everywhere: split at zero and within what is left
    edges = [np.unique(np.r_[e, 0.0, np.quantile(c[c > 0], [0.25, 0.5, 0.75], method="lower")]) if (c > 0).any() and c.min() >= 0 else e for e, c in zip(edges, xt.T, strict=True)]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, xt.T, strict=True)], 1)
    prior = yt.mean()
    model = Model(float(np.log(prior / (1 - prior))), [], (np.zeros(1), np.zeros(1)), learned)
    margin = np.full(len(yt), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(binned, edges, p - yt, p * (1 - p), depth, rate, 2.0, 1.0)
        model.trees.append(tree)
        margin += Model(0.0, [tree], model.steps, learned).margins(xt)
    model.steps = isotonic(model.margins(x[calibration]), y[calibration].astype(float))
    return model


# ---- on Spark


def _feature_rows(batches: Iterator[pa.RecordBatch], learned: list[Learned]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch_features(batch.column("text"), learned, batch.column("half").to_pylist())
        kept = ["hash", "label", "part"]
        columns = [*[batch.column(c) for c in kept], *[pa.array(c.copy()) for c in x.T.reshape(len(NAMES), -1)]]
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, *NAMES])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch, how many toxic and other texts of each half have a term."""
    for batch in batches:
        counts = [Counter() for _ in range(4)]
        for half, label, text in zip(*[batch.column(c).to_pylist() for c in ("half", "label", "text")], strict=True):
            counts[2 * half + (label > 0)].update({t for w in set(WORD.findall(text.lower())) for t in terms(w)})
        names = list(set().union(*counts))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[t] for t in names], pa.int64()) for c in counts]], names=["term", "c0", "t0", "c1", "t1"])


def _chance(k: int, n: int, p: float) -> float:
    """An upper bound (Chernoff's) of the probability of k or more of n at probability p, where k / n > p."""
    q = k / n
    tail = 0.0 if q >= 1 else (1 - q) * math.log((1 - q) / (1 - p))
    return math.exp(-n * (q * math.log(q / p) + tail))


def _lexicon(counts: list[tuple[str, int, int]], toxic: int, rows: int) -> Learned:
    """The terms that toxic texts have too often for chance; their weights are smoothed log odds."""
    if not 0 < toxic < rows:
        return Learned({})
    p, weights = toxic / rows, {}
    for term, c, t in counts:
        if t / (t + c) > p and _chance(t, t + c, p) < CHANCE:
            weights[term] = math.log((t + 0.5) / (c + 0.5)) - math.log(p / (1 - p))
    return Learned({t: w for t, w in weights.items() if w > LEAST_WEIGHT})


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.scores(batch_features(batch.column("text"), [model.learned], [0] * batch.num_rows))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "_score"])


MAX_ROWS = 30_000  # labelled rows that the model is fitted on
MAX_TERMS = 20_000  # candidates of the learned lexicon, those that stand out most
CHANCE, LEAST_WEIGHT = 1e-5, 2.0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from the labelled documents, those with the smallest hashes where there are more than ``max_rows``.

    A label repeated for a document counts as 1 if any is; null labels and ids are ignored. Equal texts count once, so
    copies do not weigh more; the largest label counts. A quarter of the sample calibrates. Without labels every score
    is 0, with one class only it is that class.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("label"))
    sample = known.withColumn("_order", F.xxhash64("_id", F.lit("toxicity"))).orderBy("_order", "_id").limit(max_rows)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most max_rows rows of a few bytes
    rows = text.join(F.broadcast(sample), text["doc_id"] == F.col("_id")).select(F.xxhash64("text").alias("hash"), "label", "text")
    once = rows.groupBy("hash").agg(F.max("label").alias("label"), F.first("text").alias("text"))
    bits = lambda shift, n: F.pmod(F.shiftright("hash", shift), F.lit(n)).cast("int")
    rows = land(once.select("hash", "label", bits(7, 2).alias("half"), bits(9, 4).alias("part"), "text").repartition(docs.sparkSession.sparkContext.defaultParallelism, "hash"), "labelled")
    sizes = rows.groupBy("half").agg(F.count("*").alias("n"), F.sum("label").alias("t")).collect()
    n, t = ([sum(r[k] for r in sizes if r["half"] == h) for h in (0, 1)] for k in ("n", "t"))
    counts = rows.mapInArrow(_term_counts, "term string, c0 bigint, t0 bigint, c1 bigint, t1 bigint").groupBy("term").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
    toxic, everyone, share = F.col("t0") + F.col("t1"), F.expr("c0 + t0 + c1 + t1"), max(sum(t), 1) / max(sum(n), 1)
    stands_out = (toxic - everyone * share) / F.sqrt(everyone)
    terms_ = [tuple(r) for r in counts.where(toxic >= 3).orderBy(F.desc(stands_out), "term").limit(MAX_TERMS).collect()]
    halves = [_lexicon([(x[0], x[1 + 2 * h], x[2 + 2 * h]) for x in terms_ if x[2 + 2 * h]], t[h], n[h]) for h in (0, 1)]
    whole = _lexicon([(x[0], x[1] + x[3], x[2] + x[4]) for x in terms_], sum(t), sum(n))
    got = rows.mapInArrow(functools.partial(_feature_rows, learned=halves[::-1]), "hash bigint, label int, part int, " + ", ".join(f"{x} double" for x in NAMES)).toPandas()
    got = got.sort_values("hash").reset_index(drop=True)
    return fit(got[NAMES].to_numpy(np.float64), got["label"].to_numpy(np.int64), got["part"].to_numpy() == 0, whole)


def score_documents(docs: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity of each text; a null text scores as an empty one.

    A column that is already called like the score is replaced. Every row of the input has one row, repeated ones too.
    """
    rest = in_batches(docs.drop(score).withColumn("text", F.col("text").cast("string")))
    types = T.StructType([*rest.schema.fields, T.StructField("_score", T.DoubleType())])
    return rest.mapInArrow(functools.partial(_scored, model=model), types).withColumnRenamed("_score", score)


THRESHOLD = 0.7


def held_out() -> Column:
    return F.pmod(crc_of_id(F.col("doc_id")), F.lit(3)) == 1


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out()))
    scored = score_documents(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
