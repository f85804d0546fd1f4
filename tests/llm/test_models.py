"""Language model, pieces, pages, archives, licences, neighbours: small fixtures against brute force, and odd input."""

import math
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import fixity, language_model, licences, nearest, sentencepieces, wrapper

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(60)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_gradients_follow_differences():
    rng = np.random.default_rng(1)
    head = np.r_[np.uint64(language_model.END), rng.integers(1, 2**63, 50, dtype=np.uint64)]
    model = language_model.new_model(head, np.arange(51, 0, -1), np.full(language_model._SPELLINGS, 3.0))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    for k in ("wc", "ww"):
        model.weights[k] += rng.normal(size=model.weights[k].shape) * 0.1
    ids = rng.integers(0, 60, (5, 3))
    before, after = ids[:-1], ids[1:]
    h0 = rng.normal(size=(3, language_model.STATE))
    _, grads, _ = language_model.gradients(model, h0, before, after)
    for k, w in model.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape) if k != "x" else (int(before[1, 0]), int(rng.integers(0, w.shape[1])))
            if w[at] < -1e8:
                continue
            keep, sides = w[at], []
            for d in (1e-4, -1e-4):
                w[at] = keep + d
                sides.append(language_model.gradients(model, h0, before, after)[0] * after.size)
            w[at] = keep
            assert abs((sides[0] - sides[1]) / 2e-4 - grads[k][at]) < 2e-3 * max(1, abs(grads[k][at])), k


def test_windows_do_not_change_scores():
    rng = np.random.default_rng(2)
    head = np.r_[np.uint64(language_model.END), rng.integers(1, 2**63, 30, dtype=np.uint64)]
    model = language_model.new_model(head, np.ones(31, np.int64), np.ones(language_model._SPELLINGS))
    model.weights["wc"] += rng.normal(size=model.weights["wc"].shape).astype(np.float32)
    texts = [np.r_[rng.integers(0, 100, n), model.end] for n in (0, 3, 200, 40, 1)]
    together, narrow = language_model.score_texts(model, texts), language_model.score_texts(model, texts, most=7)
    alone = [language_model.score_texts(model, [t])[0] for t in texts]
    assert np.allclose(together, narrow, rtol=1e-4) and np.allclose(together, alone, rtol=1e-4)


def small_model(n=40):
    rng = np.random.default_rng(4)
    head = np.r_[np.uint64(language_model.END), rng.integers(1, 2**63, n, dtype=np.uint64)]
    return language_model.new_model(head, np.arange(n + 1, 0, -1), np.ones(language_model._SPELLINGS))


def test_learning_takes_in_every_token(monkeypatch):
    seen = []
    plain = language_model.gradients

    def spy(model, h0, before, after):
        seen.append(after.copy())
        return plain(model, h0, before, after)

    monkeypatch.setattr(language_model, "gradients", spy)
    model = small_model()
    for n in (0, 1, 31, 700, 5003):
        tokens = np.random.default_rng(n).integers(0, 60, n)
        seen.clear()
        language_model.Learner(model, 1e-3).learn(tokens)
        got = Counter(int(x) for part in seen for x in part.ravel())
        want = Counter(int(x) for x in tokens)
        assert got - want == {model.end: c for c in [sum(got.values()) - n] if c} and not want - got


def test_weights_are_the_mean_of_the_tasks_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(language_model, "ROUNDS", ((0, 16, 3e-3),))
    monkeypatch.setattr(language_model, "BUFFER", 300)
    rng = random.Random(9)
    rows = [(str(i), prose(rng.randint(0, 90), rng) if i % 7 else "") for i in range(60)]
    df = spark.createDataFrame(rows, "id string, text string").repartition(3, "id")
    parts = df.withColumn("p", F.spark_partition_id()).collect()
    begin = small_model()

    class Held:
        value = vars(begin)

    pa = pytest.importorskip("pyarrow")
    out = []
    for p in sorted({r["p"] for r in parts}):
        batch = pa.RecordBatch.from_pydict({"text": [r["text"] for r in parts if r["p"] == p]})
        out += [(b.column(0)[0].as_py(), np.array(b.column(1)[0].as_py())) for b in language_model._learn(iter([batch]), Held, 3e-3)]
    assert sum(n for n, _ in out) == sum(len(t.split()) + 1 for _, t in rows) and len(out) == 3
    mean = sum(n * w for n, w in out) / sum(n for n, _ in out)
    got = small_model()
    language_model.train(got, df)
    assert np.allclose(np.concatenate([got.weights[k].ravel() for k in sorted(got.weights)]), mean, rtol=1e-4, atol=1e-5)
    assert any(not np.allclose(got.weights[k], begin.weights[k]) for k in got.weights)
    kept = {k: v.copy() for k, v in got.weights.items()}
    language_model.train(got, df.limit(0))
    assert all((got.weights[k] == kept[k]).all() for k in kept)


def test_learning_from_order_beats_counts(spark):
    rng = random.Random(12)
    follow = {w: WORDS[(i * 7 + 3) % len(WORDS)] for i, w in enumerate(WORDS)}

    def chain(n):
        out = [rng.choice(WORDS)]
        while len(out) < n:
            out.append(follow[out[-1]] if rng.random() < 0.9 else rng.choice(WORDS))
        return " ".join(out)

    df = spark.createDataFrame([(i, chain(120), i % 5 != 1) for i in range(1500)], "doc_id long, text string, learn boolean").repartition(4)
    held = language_model.score_documents(df, F.col("learn")).where("not learn").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.8 * held[1]


def test_scores_of_documents(spark, monkeypatch):
    monkeypatch.setattr(language_model, "KNOWN", 20)  # most words are looked up by the join
    rng = random.Random(6)
    texts = [prose(rng.randint(1, 60), rng) for _ in range(150)] + [None, "", " \t", "unseen Éléphant", "long " * 3000]
    df = spark.createDataFrame([(i, t, i % 5 != 1) for i, t in enumerate(texts)] + [(None, "aa bb", False), (3, texts[3], True)], "doc_id long, text string, learn boolean").withColumn("score", F.lit("clash"))
    got = language_model.score_documents(df, F.col("learn")).collect()
    tokens = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]
    rows = [(r["doc_id"], r["text"], r["learn"]) for r in df.collect()]
    c = Counter(w for _, t, learn in rows if learn for w in tokens(t))
    n, z = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    want = sorted((repr(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 0.5) / z) for w in tokens(t)), 5)) for i, t, _ in rows)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert language_model.score_documents(df.limit(0), F.col("learn")).count() == 0


TEXTS = [None, "", " ", "  ", "a", "hello   world", " " * 15 + "y", " " * 17 + "def", " " * 33, "tab\there\nnew  line", "中文测试" * 30, "😀 👍🏽", "x" * 61, "x" * 62, "x" * 200, "<s> </s> <0x0A>", "trail ", "é é"]


@pytest.mark.parametrize("rare", ["task", "join"])
def test_pieces_equal_the_library(spark, sf, rare):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepieces.MODEL)
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + docs + docs[:2])], "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("word", F.lit(1))
    vocabulary = sentencepieces.load()
    out = sentencepieces.decode(sentencepieces.encode(df, vocabulary, known_words=500, rare=rare, round_trip="same"), vocabulary).collect()
    assert len(out) == len(TEXTS) + len(docs) + 2
    for r in out:
        assert list(r["ids"]) == library.encode(r["text"] or "") and r["decoded"] == (r["text"] or "") and r["same"]


@pytest.mark.parametrize("rare", ["task", "join"])
def test_pieces_of_long_repeated_words_equal_the_library(spark, rare):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepieces.MODEL)
    rng = random.Random(3)
    long = "\n".join("".join(rng.choice("theandtionerin中文测试") for _ in range(99)) for _ in range(3000))
    texts = [long, "one two", long, long[:62], long[:62], "a" * 5000, "a" * 5000, " " * 20_000 + "end", " " * 20_000 + "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sentencepieces.encode(df, sentencepieces.load(), rare=rare, round_trip="same").collect()
    assert len(long) == 299_999 and len(out) == len(texts)
    for r in out:
        assert list(r["ids"]) == library.encode(r["text"]) and r["same"]


def test_viterbi_finds_the_best_path(spark):
    pieces = {"a": -2.0, "b": -2.5, "c": -3.0, "ab": -3.5, "bc": -3.9, "abc": -7.0, sentencepieces.SPACE: -1.0, sentencepieces.SPACE + "a": -2.2, "ca": -4.4}
    vocabulary = sentencepieces.Vocabulary(tuple((p, s, i + 300) for i, (p, s) in enumerate(pieces.items())), tuple(range(256)), 0, False)
    words = [sentencepieces.SPACE + "".join(w) for n in (1, 2, 3, 4) for w in product("abc", repeat=n)] + [sentencepieces.SPACE + "azb"]
    rows = sentencepieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), vocabulary).collect()
    score = {i + 300: s for i, s in enumerate(pieces.values())}

    def best(w):
        if not w:
            return 0.0
        return max([pieces[w[:k]] + best(w[k:]) for k in range(1, len(w) + 1) if w[:k] in pieces] + ([-7.0 - 10 + best(w[1:])] if w[0] not in pieces else []))

    encoder = sentencepieces.WordEncoder(vocabulary)
    for r in rows:
        total = sum(score.get(i, -17.0) for i in r["ids"])
        assert abs(total - best(r["word"])) < 1e-9
        assert abs(sum(score.get(i, -17.0) for i in np.frombuffer(encoder(r["word"]), np.int32).tolist()) - total) < 1e-9


def page(body, n, extra=""):
    return f"""<!DOCTYPE html><html><head><title>T {n}</title><script>var a="</p><article>no";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=1>Home {n}</a><li><a href=2>News</a></ul></nav><!-- <article>hidden</article> --><div class="ad-box">Buy {n % 3}</div>{body}{extra}
<div id="comments"><p>Reader {n} says</p></div><form><p>Search</p></form><footer>&copy; 20 Site</footer></body></html>"""


def test_main_text(spark):
    rows, want = [], {}
    for i in range(30):
        rows.append((i, f"https://A.example/{i}", page(f"<article><h1>Head {i}</h1><p>One &amp; {i}\n two<p><b>bold</b>er <i>{prose(30)}</i><ul><li>x<li>y</ul></article>", i)))
        want[i] = None
        rows.append((100 + i, f"http://b.example:80/{i}?q", page(f"<div class='content x{i}'><h2>Title {i}</h2><p>{(t := prose(40))}</p><p>tail {i}</p></div>", i, "<div class=sidebar><p>Also</p></div>")))
        want[100 + i] = f"Title {i} {t} tail {i}"
    rows += [(200, None, None), (201, "nohost", ""), (202, "https://c.example/", "<p>only</p> text < 3"), (203, "https://c.example/", "<div>" * 3000 + "deep"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("tree", F.lit(1)).withColumn("code", F.lit("c"))
    got = wrapper.main_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["page_id"]
        if i < 100:
            assert r["text"].startswith(f"Head {i} One & {i} two bolder ") and r["text"].endswith(" x y") and "Reader" not in r["text"]
        elif i < 200:
            assert r["text"] == want[i]
        else:
            assert r["text"] == {200: "", 201: "", 202: "only text < 3", 203: "deep"}[i]
    assert wrapper.main_text(df.limit(0)).count() == 0


def test_constant_elements_of_marked_articles_go(spark):
    rows, want = [], {}
    for i in range(24):
        a, b = prose(25), prose(25)
        rows.append((i, f"https://a.example/{i}", page(f"<article><h1>Head {i}</h1><p>{a}</p><p>Sign up for our letter today</p><p>{b}</p><div>We use small files here</div><ul><li>x<li>y</ul></article>", i)))
        want[i] = f"Head {i} {a} {b} x y"
    got = wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


@pytest.mark.parametrize("name", ["page with-sidebar", "page", "post share", "content-header related"])
def test_a_name_on_the_article_does_not_hide_it(spark, name):
    rows, want = [], {}
    for i in range(24):
        body = prose(30)
        page_ = f"<div class='{name}'><h2>Title {i}</h2><p>{body}</p></div><div class=sidebar><p>Also {i}</p></div><div class='comments'><p>Nice {i}</p></div><div class=end><p>same text on all</p></div>"
        rows.append((i, f"https://a.example/{i}", f"<html><body><nav>Menu</nav>{page_}</body></html>"))
        want[i] = f"Title {i} {body}"
    got = wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><script src=/js/>var leak=1</script><p>one</p></article>", "one"),
        ("<article><script src='/js/' />var leak=1</script><p>two</p></article>", "var leak=1 two"),
        ("<article><p>one</p><!--><p>two</p></article>", "one two"),
        ("<article><p>one</p><!---><p>two</p></article>", "one two"),
        ("<article><p>one</p><!-- x --!><p>two</p></article>", "one two"),
        ("<article><p>one</p><!-- x -- > <p>two</p></article>", "one"),
        ("<article>" + "<section>" * 80 + "<nav><ul><li>Menu</ul></nav><b>a</b> text here</article>", "a text here"),
    ],
)
def test_odd_markup(spark, html, text):
    got = wrapper.main_text(spark.createDataFrame([(1, "https://a.example/1", html)], "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got] == [text]


@pytest.mark.parametrize("n_articles", [12, 19, 20])
def test_copies_do_not_make_articles_template(spark, n_articles):
    texts = [(f"Title {k}", prose(30)) for k in range(n_articles)]
    rows, want = [], {}
    for i in range(300):
        head, body = texts[i % n_articles]
        rows.append((i, f"https://a.example/{i}", f"<html><body><div><h2>{head}</h2><p>{body}</p><div>Day {i} of all</div></div><div><p>Always the same words here</p></div></body></html>"))
        want[i] = f"{head} {body} Day {i} of all"
    got = wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_tree_matching():
    a = ["r", [["x", []], ["y", [["z", []]]]]]
    b = ["r", [["y", [["z", []], ["w", []]]], ["x", []]]]
    assert wrapper.match(a, b, {}) == 3 and wrapper.match(a, ["q", []], {}) == 0
    m = wrapper.merged(a, b, {})
    assert m == ["r", [["x", []], ["y", [["z", []], ["w", []]]], ["x", []]]] and wrapper.placed(m, b) == [0, 2, 3, 4, 5]


def test_audit_finds_every_difference(spark):
    rng = random.Random(9)
    first = []
    for f in range(4):
        at = 0
        for r in range(400):
            first.append((f"{f}-{r}", f, at, n := rng.randint(1, 3000), f"d{rng.random()}"))
            at += n
    second = {(x[1], x[2]): list(x) for x in first}
    for x in rng.sample(first, 9):
        second[x[1], x[2]][4] = "other"
    for x in rng.sample([x for x in first if second[x[1], x[2]][4] != "other"], 5):
        del second[x[1], x[2]]
    second[2, 10**7] = ["new", 2, 10**7, 5, "e"]
    ddl = "record_id string, file int, offset long, length int, digest string"
    a, b = spark.createDataFrame(first + first[:3] + [(None, None, None, None, None)], ddl).withColumn("node", F.lit(1)).withColumn("hash", F.lit("x")), spark.createDataFrame([tuple(x) for x in second.values()], ddl)
    got = {(r["file"], r["offset"]): r["status"] for r in fixity.audit(a, b).collect()}
    want = {}
    for x in first:
        y = second.get((x[1], x[2]))
        if y is None or list(x) != y:
            want[x[1], x[2]] = "missing" if y is None else "damaged"
    assert got == {**want, (2, 10**7): "extra"}
    assert fixity.audit(a, a).count() == 0 and fixity.audit(a.limit(0), b.limit(0)).count() == 0


def test_licences(spark):
    rows = [
        (1, "a/LICENSE", "The MIT License (MIT)"), (2, "a/b/c.txt", prose(30)), (3, "a/b/d.txt", prose(30) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(9)),
        (4, "z/e.txt", prose(30)), (5, "top.txt", "licence to kill the version"), (6, None, "All rights reserved."), (7, "a/x.txt", None), (8, "a/b/LICENSE", "GNU General Public License, version 3 29 June 2007"),
        (9, "ab/c.txt", ""), (10, "a/long.txt", (prose(200) + " released under the mit license " + prose(100))), (2, "a/b/c.txt", prose(4)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("score", F.lit("clash")).withColumn("word", F.lit(0))
    got = {(r["doc_id"], r["licence"], r["origin"], r["licence_dir"]) for r in licences.scan_licences(df).collect()}
    assert got == {
        (1, "MIT", "header", None), (2, "GPL-3.0", "inherited", "a/b"), (3, "Apache-2.0", "header", None), (4, None, "none", None), (5, None, "none", None), (6, "Proprietary", "header", None),
        (7, "MIT", "inherited", "a"), (8, "GPL-3.0", "header", None), (9, None, "none", None), (10, "MIT", "header", None),
    }
    assert licences.scan_licences(df.limit(0)).count() == 0


def test_licences_inside_lines(spark):
    rows = [
        (1, "Copyright (c) 2019 Jane Doe. All rights reserved.", "Proprietary"), (2, prose(20) + " released under the MIT License " + prose(20), "MIT"), (3, "All rights reserved. Licensed under CC BY 4.0", "CC-BY-4.0"),
        (4, "the rights of all are reserved for the licence", None), (5, prose(30), None),
    ]
    df = spark.createDataFrame([(i, f"d{i}/a.txt", t) for i, t, _ in rows], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in licences.scan_licences(df).collect()}
    assert got == {i: (x, "header" if x else "none") for i, _, x in rows}


def test_licence_scores_equal_brute_force_in_lines_of_any_length(spark):
    rng = random.Random(5)
    pick = lambda n: " ".join(rng.choice("the of version license by for work soft data gnu rights public term".split()) for _ in range(n))
    headers = [t for ts in licences.TEMPLATES.values() for t in ts]
    texts = ["", pick(500), pick(79) + " MIT", *[pick(n) + " " + rng.choice(headers) + " " + pick(m) for n, m in ((0, 0), (3, 2), (40, 34), (70, 6), (75, 1), (81, 0), (300, 9), (9, 5000))]]
    texts += ["\n".join([pick(4), rng.choice(headers).replace("License", "Licence"), pick(90) + " " + rng.choice(headers)]) for _ in range(9)]
    lines = [ws for t in texts for ws in map(licences.tokens, t.split("\n")) if ws]
    total, seen = len(lines), Counter(w for ws in lines for w in set(ws))
    idf = lambda w: math.log((1 + total) / (1 + seen[w])) + 1

    def cosine(a, b):
        x, y = ({w: n * idf(w) for w, n in Counter(ws).items()} for ws in (a, b))
        return sum(x[w] * y.get(w, 0.0) for w in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    best = []
    for t in texts:
        scores = [0.0]
        for ws in map(licences.tokens, t.split("\n")):
            for header in map(licences.tokens, headers):
                k = len(header)
                scores += [cosine(run, header) for run in (ws, *(ws[i : i + k] for i in range(len(ws) - k + 1))) if run]
        best.append(max(scores) if max(scores) >= licences.THRESHOLD else 0.0)
    assert best[8] > 0.8 and best[10] > 0.8  # after 81 tokens, before 5,000
    df = spark.createDataFrame([(i, f"d{i}/a.txt", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["score"] for r in licences.scan_licences(df).collect() if r["origin"] == "header"}
    assert set(got) == {i for i, x in enumerate(best) if x} and all(abs(got[i] - best[i]) < 1e-9 for i in got)


def test_licence_weights_of_common_words(spark):
    texts = ["zzz the MIT License zzz", *["zzz " + prose(3)] * 400]
    df = spark.createDataFrame([(i, f"d{i}/a.txt", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    (row,) = [r for r in licences.scan_licences(df, {"MIT": ["qqq qqr the MIT License"], "Other": ["the MIT License now"]}).collect() if r["doc_id"] == 0]
    assert row["licence"] == "Other" and 0.8 < row["score"] < 0.9


def test_neighbours_recall_and_odd_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    odd = [(10**6, None), (10**6 + 100, [0.0] * 64), (10**6 + 200, [float("nan")] * 64), (10**6 + 300, [None] * 64), (None, [1.0] * 64), (10**6 + 400, [1.0, 2.0])]
    all_rows = df.select("vec_id", "embedding").union(spark.createDataFrame(odd, "vec_id long, embedding array<float>")).withColumn("list", F.lit(1)).withColumn("block", F.lit("c"))
    got = nearest.nearest(all_rows, all_rows.where("vec_id % 100 = 0")).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        order = np.lexsort((ids, d))[:10]
        mine = sorted([r for r in got if r["query_id"] == ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [*range(1, 11)] and [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(ids[order].tolist()))
        total += 10
    assert hits / total >= 0.9 and {r["query_id"] for r in got} == set(ids[ids % 100 == 0].tolist())
    few = all_rows.where("vec_id < 4 OR vec_id >= 1000000")
    assert nearest.nearest(few, few.where("vec_id % 100 = 0")).count() == 3
    assert nearest.nearest(all_rows.limit(0), all_rows.limit(0)).count() == 0
