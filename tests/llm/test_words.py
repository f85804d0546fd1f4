"""Spelling variants, rules of quality and periodic runs against brute force, and their defined results for odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import periodic_runs, quality, spelling
from ledgerlake.llm.common import mix

DOCS = "doc_id bigint, text string"
BLANKS = re.compile("[\x20\x09-\x0d]+")


def _words(text):
    return [w for w in BLANKS.split(text or "") if w]


# ---- periodic runs


def brute_runs(words):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def _sequence(r, n):
    kind = r.random()
    if kind < 0.3:
        return [r.randint(0, r.choice([1, 2, 50])) for _ in range(n)]
    if kind < 0.4:  # overlap-free
        out = [0]
        while len(out) < n:
            out += [1 - x for x in out]
        return out[:n]
    if kind < 0.5:  # as many runs as there can be, nearly
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    out = []
    while len(out) < n:
        inner = [r.randint(0, 9) for _ in range(r.randint(1, 9))] * r.randint(1, 9)
        block = inner + [r.randint(0, 99) for _ in range(r.randint(0, 90))]
        out += (block * r.randint(1, 5))[: r.randint(1, 400)]
    return out[:n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    texts = [_sequence(r, r.randint(0, 600)) for _ in range(7)]
    texts.append(texts[0])
    at = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    hashes = mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(3))
    got = [(int(t), int(s), int(e - s), int(q)) for t, s, e, q in periodic_runs.chunk_runs(hashes, at)]
    assert got == [(i, *run) for i, t in enumerate(texts) for run in brute_runs(t)]


def test_period_of_several_thousand_words():
    r = random.Random(1)
    block = [r.randint(0, 10**6) for _ in range(3001)]
    words = mix(np.array(([7, 8] + block) * 2 + block[:5], np.uint64))
    got = periodic_runs.chunk_runs(words, np.array([0, len(words)]))
    assert got.tolist() == [[0, 0, 2 * 3003, 3003]]
    assert not len(periodic_runs.chunk_runs(words[:-7], np.array([0, len(words) - 7])))


def test_run_columns_for_odd_texts(spark):
    run = "la " * 11 + "la"
    rows = [(1, run, 5), (1, run, 6), (2, None, 7), (None, "", 8), (3, f"x {run} y\t\n z", 9), (4, "a b " * 5 + "A b", 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = {tuple(r)[:1] + (r.collapsed, r.n_words, tuple(map(tuple, r.runs))) for r in periodic_runs.periodic_runs(docs).collect()}
    assert got == {
        (1, "la", 12, ((0, 12, 1),)),
        (2, "", 0, ()),
        (None, "", 0, ()),
        (3, "x la y z", 15, ((1, 12, 1),)),
        (4, " ".join(["a b"] * 5) + " A b", 12, ()),
    }
    assert periodic_runs.periodic_runs(docs).count() == 6
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op13_equals_brute_force(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["ab", "c", "Dé"]) if i % 3 else str(r.randint(0, 500)) for _ in range(r.randint(0, 300)))) for i in range(120)]
    spark.createDataFrame([*rows, (500, None), (501, " \n")], DOCS).write.parquet(f"{tmp_path}/documents.parquet")

    def expected(doc_id, text):
        words = _words(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)

    got = sorted(map(tuple, periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect()))
    assert got == [expected(*row) for row in [*rows, (500, None), (501, " \n")]]


# ---- spelling variants


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts):
    near = {w: [v for v in counts if v != w and _near(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near.items() if v}
    form = {w: b if counts[b] >= 5 * counts[w] else None for w, b in best.items()}

    def root(w):
        while form.get(w):
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if form.get(w) else None) for w, n in counts.items())


def _vocabulary(r, size):
    words = set()
    while len(words) < size:
        w = "".join(r.choice(["th", "on", "e", "ré", "ß", "aa", "zy"]) for _ in range(r.randint(3, 5)))
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("aez÷é") + w[i:], w[:i] + r.choice("aeté") + w[i + 1 :]])
        if len(w) >= 6:
            words.add(w)
    return sorted(words)


@pytest.mark.parametrize("node_words", [20_000, 7])
def test_forms_equal_brute_force_whatever_the_pieces(spark, node_words):
    r = random.Random(node_words)
    # long letters of one kind go beyond the counts that the trie tells apart
    words = [*_vocabulary(r, 400), "e" * 20, "e" * 21, "e" * 20 + "a", "e" * 19 + "aa", "abcdef", "abcdeg"]
    counts = {w: r.choice([5, 5, 6, 26, 30, 160, 900]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    near = {r.word: (r.n_near, r.near, r.near_n) for r in spelling.near_words(frame, node_words).collect()}
    want = brute_forms(counts)
    assert {w: x[0] for w, x in near.items()} == {w: k for w, _, _, _, k, _ in want if k}
    assert sorted(map(tuple, spelling.spelling_forms(frame).collect()), key=str) == sorted(want, key=str)


def test_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5")], "word string, form string")
    got = dict(map(tuple, spelling.roots(links).collect()))
    assert set(got.values()) == {"w13"} and len(got) == 14
    assert spelling.roots(links.limit(0)).count() == 0


def test_op11_equals_brute_force(spark, tmp_path):
    r = random.Random(11)
    words = _vocabulary(r, 60)
    rows = [(i, " ".join(r.choice(words).upper() if r.random() < 0.1 else r.choice(words) for _ in range(80)) + "×÷, 12ab") for i in range(60)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (99, None), (100, "")]
    spark.createDataFrame(rows, DOCS).withColumn("word", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(lower)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    want = brute_forms({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = spelling.op11_spelling_variants(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_op11_without_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.op11_spelling_variants(spark, str(tmp_path)).count() == 0


# ---- rules of quality


def _statistics(text):
    """The statistics of a text, one by one."""
    data = (text or "").encode()
    size = max(1, len(data))
    strange = set(b"#$%&*@^~+=_\\/<>[]{}`|!?")
    words = [w.encode() for w in _words(text)]
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    n = max(1, len(words))
    pairs = list(zip(low, low[1:]))
    lines = [tuple(w) for w in map(_words, (text or "").split("\n")) if w]
    run = longest = 0
    for a, b in pairs:
        run = run + 1 if a == b else 0
        longest = max(longest, run)
    odd = [sum(c in strange for c in w) for w in words]
    share = lambda xs: (len(set(xs)) / max(1, len(xs)), max(Counter(xs).values(), default=0) / max(1, len(xs)))
    return {
        **{f"{k}_rate": sum(bool(m[c]) for c in data) / size for k, m in quality.KINDS.items()},
        "log_words": np.log1p(len(words)), "mean_word": sum(map(len, words)) / n, "long_word_rate": sum(len(w) > 12 for w in words) / n,
        "short_word_rate": sum(len(w) <= 2 for w in words) / n, "bare_word_rate": sum(o == len(w) for o, w in zip(odd, words)) / n,
        "symbol_word_rate": sum(0 < o < len(w) for o, w in zip(odd, words)) / n, "same_word_rate": sum(a == b for a, b in pairs) / n,
        "same_word_run": np.log1p(longest), "distinct_rate": share(low)[0], "top_word_rate": share(low)[1], "distinct_pair_rate": share(pairs)[0],
        "top_pair_rate": share(pairs)[1], "mean_line": len(words) / max(1, len(lines)), "distinct_line_rate": share([tuple(x.lower() for x in l) for l in lines])[0],
    }


ODD_TEXTS = ["", None, " \n", "a", "a a a b\n\nA a a b\n", "THE !!! é| x|y\nthe !!!", "one\ntwo one two\n one", "x" * 2000]


def test_statistics_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], DOCS)
    for row in quality.with_statistics(docs).collect():
        want = _statistics(ODD_TEXTS[row.doc_id])
        assert {s: row[s] for s in quality.STATISTICS} == pytest.approx(want), ODD_TEXTS[row.doc_id]


def _clean(r):
    return " ".join(r.choice(["the", "house", "was", "green", "and", "tall", "near", "a", "river", "stone"]) for _ in range(r.randint(8, 60))) + "."


def _junk(r):
    return " ".join(r.choice(["buy", "now", "###", "$$$", "click"]) + r.choice(["!!!", "&&", "%"]) for _ in range(r.randint(8, 60)))


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    r, path = random.Random(2), str(tmp_path_factory.mktemp("quality"))
    rows = [(i, _clean(r) if i % 4 else _junk(r), "x", i) for i in range(600)] + [(900, None, "x", 1), (901, "", "x", 1), (None, _clean(r), "x", 1), (7, _clean(r), "x", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, log_words string, score int").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 > 0)) for i in range(600)] + [(900, 0), (None, 1), (5, None), (5, 1), (12345, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_op12_tells_held_out_texts_apart(spark, labelled):
    rows = quality.op12_quality_rules(spark, labelled).collect()
    assert len(rows) == 604
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert len(held) > 100 and sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_compiled_rules_score_as_the_ensemble_does(spark, labelled):
    docs, labels = (spark.read.parquet(f"{labelled}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert model.rules and len(model.describe()) == len(model.rules)
    rows = quality.with_statistics(docs).select(*quality.STATISTICS, model.column().alias("s")).collect()
    x = np.array([[r[c] for c in quality.STATISTICS] for r in rows])
    assert np.allclose(model.scores(x), [r.s for r in rows])
    kept = quality.score_documents(docs, model)
    assert kept.columns == ["doc_id", "text", "log_words", "score"]
    assert {r.log_words for r in kept.collect()} == {"x"}


def test_quality_without_labels_or_with_one_class(spark, labelled):
    docs, labels = (spark.read.parquet(f"{labelled}/{t}.parquet") for t in ("documents", "labels"))
    of = lambda l: {round(r.score, 3) for r in quality.score_documents(docs, quality.train(docs, l)).collect()}
    assert of(labels.limit(0)) == {0.5}
    assert of(labels.where("quality = 1")) == {1.0}
    assert of(labels.where("quality = 0")) == {0.0}
    assert quality.score_documents(docs.limit(0), quality.train(docs, labels.limit(0))).count() == 0


def test_lasso_keeps_few_weights():
    r = np.random.default_rng(0)
    z = (r.random((800, 30)) < 0.4).astype(np.float32)
    y = (r.random(800) < 1 / (1 + np.exp(2 - 4 * z[:, 3] + 3 * z[:, 7]))).astype(np.int64)
    base, w = quality.lasso_logistic(z, y, 0.02)
    assert set(np.flatnonzero(np.abs(w) > 1e-3)) == {3, 7} and w[3] > 0 > w[7]
    # at the least, no small step in any weight lowers the loss
    loss = lambda b, v: np.logaddexp(0, np.where(y == 1, -(z @ v + b), z @ v + b)).mean() + 0.02 * np.abs(v).sum()
    at = loss(base, w)
    assert all(loss(base, w + d * np.eye(30, dtype=np.float32)[k]) >= at - 1e-6 for k in range(30) for d in (0.01, -0.01))
