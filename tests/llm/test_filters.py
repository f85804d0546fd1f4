"""Decontamination, similarity groups, sharding and toxicity: small fixtures against brute force, and odd input."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontamination, jaccard_join, sharding, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def changed(text, share, rng):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def shingles(text, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_groups(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(group) if group else None))
    return sorted(out, key=repr)


def near_copies(seed, n_groups=6, size=12):
    rng = random.Random(seed)
    texts = [None, "", "   ", "One", "one", "a b", "A  b", "x" * 5000]
    for _ in range(n_groups):
        base = prose(rng.choice([3, 8, 40, 150, 600]), rng)
        passage = prose(60, rng)
        texts += [base, base] + [changed(base, rng.choice([0.01, 0.03, 0.06]), rng) for _ in range(size)]
        texts += [passage + " " + prose(60, rng) for _ in range(4)]
    return texts


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (2, 50)])
def test_groups_equal_brute_force(spark, width, percent):
    texts = near_copies(width)
    ids = [*range(100, 100 + len(texts))]
    ids[-1] = None
    rows = [*zip(ids, texts, strict=True), (100 + len(texts), texts[-2]), (105, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("v", F.lit(1))
    got = sorted(map(tuple, jaccard_join.similar_groups(df, width, percent).collect()), key=repr)
    assert got == brute_groups(rows, width, percent)


def test_groups_of_nothing(spark):
    assert jaccard_join.similar_groups(frame(spark, []), 4, 85).count() == 0
    assert [tuple(r) for r in jaccard_join.similar_groups(frame(spark, [None]), 4, 85).collect()] == [(0, 0, 0)]


def test_one_of_each_group_stays(spark):
    base = prose(80)
    df = frame(spark, [base, base, base.replace(base.split()[0], "other", 1), prose(50), None, None, base], [5, 2, 9, 7, 11, 12, 2])
    kept = jaccard_join.keep_one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 11, 12]


def test_rows_of_one_id_and_size_lose_no_link_in_either_order(spark):
    rng = random.Random(21)
    first, second = prose(60, rng), prose(60, rng)
    near_first, near_second = (f"{t.rsplit(' ', 1)[0]} other" for t in (first, second))
    rows = [(5, second), (5, first), (3, near_first), (8, near_second)]
    assert len({len(shingles(t, 4)) for _, t in rows}) == 1
    for order in (rows, rows[::-1], [rows[1], rows[0], *rows[2:]]):
        df = frame(spark, [t for _, t in order], [i for i, _ in order]).coalesce(1)
        got = sorted(map(tuple, jaccard_join.similar_groups(df, 4, 85).collect()))
        assert [(i, c) for i, _, c in got] == [(3, 3), (5, 3), (5, 5), (8, 5)]


def test_unrelated_texts_of_one_id_both_stay(spark):
    rng = random.Random(22)
    a, b = prose(60, rng), prose(60, rng)
    near = f"{a} more"
    df = frame(spark, [near, a, b, a, None, a, near], [3, 5, 5, 9, None, None, 3])
    kept = jaccard_join.keep_one_of_each_group(df, 4, 85)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(3, near), (5, b), (None, None)], key=repr)
    alone = jaccard_join.keep_one_of_each_group(frame(spark, [a, a, b], [None, None, None]), 4, 85)
    assert sorted(r.text for r in alone.collect()) == sorted([a, b])


def test_many_texts_of_one_template_below_the_limit(spark, monkeypatch):
    """They share cells but are not similar: parts of a cell meet each other, and what is similar is still found."""
    monkeypatch.setattr(jaccard_join, "CELL_PART", 90)
    rng = random.Random(23)
    template = prose(40, rng).split()
    texts = [" ".join([*template, *(f"w{rng.randint(0, 10**9)}" for _ in range(14))]) for _ in range(900)]
    texts += [f"{t} z" for t in texts[:25]]
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(frame(spark, texts), 4, 85).collect()}
    assert got == {i: i if i < 900 else i - 900 for i in range(925)}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(0, 40), st.sampled_from([50, 80, 85, 95]), st.integers(0, 10**6))
def test_similar_sets_agree_in_a_cell(n, changes, percent, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    b = np.unique(np.r_[a[min(changes, len(a) - 1) :], rng.integers(0, 2**64, rng.integers(0, changes + 1), dtype=np.uint64)])
    common_ = len(np.intersect1d(a, b))
    bands = jaccard_join.bands(percent)
    if 100 * common_ >= percent * (len(a) + len(b) - common_):
        assert set(jaccard_join.cells(a, percent, bands).tolist()) & set(jaccard_join.cells(b, percent, bands).tolist())


@pytest.mark.parametrize("n", [300, 900, 2000])
def test_sets_present_no_more_cells_than_a_similar_one_can_change(n):
    rng = np.random.default_rng(n)
    bands = jaccard_join.bands(80)
    presented = [set(jaccard_join.cells(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)), 80, bands).tolist()) for _ in range(60)]
    # a similar set differs in a quarter of the members at most, and shows itself in two bands at most
    assert max(map(len, presented)) <= 2 * (n // 4 + 1)
    # no two of these have a member in common, so they share nothing but empty cells, which none presents
    assert len(set().union(*presented)) == sum(map(len, presented))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["v"]: r["c"] for r in jaccard_join.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["Ab  cd\tAB", "", None, "ab", "é É ab"]
    hashes = [h[a:b] for _, _, d, o in common.text_chunks(pa.array(texts)) for h, _, _, at in [common.word_hashes(d, o)] for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(h) for h in hashes] == [3, 0, 0, 1, 3]
    assert hashes[0][0] == hashes[0][2] == hashes[3][0] == hashes[4][2] and hashes[4][0] != hashes[4][1]


def brute_contained(docs, items):
    alnum = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    sets = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
    best = {}
    for d, t in docs:
        for i, u in items:
            k = min(5, len(alnum(u)))
            s, q = sets(alnum(t), k), sets(alnum(u), k)
            if q and len(s & q) >= 0.8 * len(q) - 1e-9:
                best[(d, i)] = max(best.get((d, i), (0, 0, 0)), (len(s & q) / len(q), len(q), len(s & q)))
    return sorted([(*k, v[1], v[2], v[0]) for k, v in best.items()], key=repr)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(n, rng)) for i, n in enumerate([30, 45, 9, 5, 4, 1, 200])] + [(7, None), (8, ""), (1, "again " + prose(12, rng)), (None, prose(20, rng))]
    docs = [(i, prose(400, rng)) for i in range(20)]
    for k, (_, text) in enumerate(items):
        if text:
            docs += [(100 + k, prose(300, rng) + ", " + text.upper() + "! " + prose(20, rng)), (200 + k, prose(50, rng) + " " + " ".join(text.split()[: int(len(text.split()) * 0.9)]))]
            docs += [(300 + k, prose(9, rng) + " " + changed(text, 0.02, rng) + " " + prose(4000, rng)), (400 + k, text)]
    docs += [(None, items[0][1]), (500, None), (501, ""), (100, prose(3, rng))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(-1)).withColumn("hashes", F.lit("clash"))
    got = decontamination.contaminated(df, spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_contained(docs, items)
    kept = {r["doc_id"] for r in decontamination.decontaminate(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {r[0] for r in brute_contained(docs, items)}


def test_items_of_few_words_are_found_inside(spark):
    items = [(1, "c d e f"), (2, "J"), (3, "b, c"), (4, "e f g h i"), (5, "d c"), (6, "z")]
    docs = [(1, "a b c d e f g h i j"), (2, "c d e f"), (3, "j"), (4, "c d e"), (5, ""), (6, None), (7, "j j " * 3000), (8, "b c " * 5)]
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_contained(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (3, 2), (7, 2), (8, 3)}


def test_contamination_sql_equals_brute_force(tmp_path):
    duckdb = pytest.importorskip("duckdb")
    items = [(1, "c d e f"), (2, "J"), (3, "b, c"), (4, "e f g h i"), (7, "a b c d e f g"), (8, None), (9, "")]
    docs = [(1, "a b c d e f g h i j"), (2, "c d e f"), (3, "j"), (4, None), (5, ""), (6, "a b c d e f")]
    db = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        db.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert sorted(db.execute(decontamination.OP1_SQL).fetchall()) == brute_contained(docs, items)


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(frame(spark, ["a b c d e f"]), none).count() == 0
    assert decontamination.contaminated(frame(spark, []), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 1)])
def test_curve_visits_every_cell_once_by_single_steps(spark, dims, bits):
    cells = np.indices([1 << bits] * dims).reshape(dims, -1).T
    df = spark.createDataFrame([tuple(map(int, c)) for c in cells], ", ".join(f"x{i} int" for i in range(dims)))
    rows = df.select("*", sharding.hilbert_index([f"x{i}" for i in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(len(cells)))
    points = np.array([r[:dims] for r in rows])
    assert (np.abs(np.diff(points, axis=0)).sum(1) == 1).all()


def test_shards_are_even_and_ordered(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([1.5, 7.0, None, float(i)]), "x") for i in range(333)] + [(1, "a", 7.0, "x")] * 2 + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, size double, shard string")
    out = sharding.hilbert_shards(df, ["lang", "size"], 7, ["doc_id"])
    got = out.collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(7)]
    assert len(got) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s])) for s in range(7))
    # brute force: equal-depth codes, then the curve's order
    codes = []
    for k in (1, 2):
        values = sorted([r[k] for r in rows], key=lambda v: (v is not None, v))
        codes.append([values.index(r[k]) * 256 // len(rows) for r in rows])
    index = spark.createDataFrame(list(zip(*codes, [r[0] for r in rows], strict=True)), "a int, b int, doc_id long").select("doc_id", sharding.hilbert_index(["a", "b"], 8).alias("h")).collect()
    want = [r["doc_id"] for r in sorted(index, key=lambda r: (r["h"], r["doc_id"] is not None, r["doc_id"] or 0))]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] == want
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    assert sharding.hilbert_shards(df.limit(0), ["lang"], 7).count() == 0


def test_sharding_query(spark, sf):
    got = sharding.op5_hilbert_sharding(spark, sf).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in common.table(spark, sf, "documents").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in docs.items()}
    counts = [sum(r["shard"] == s for r in got) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_isotonic_is_monotone_and_pools():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(y) >= 0).all() and np.interp([1, 2.5, 4], x, y).tolist() == [0.0, 0.5, 1.0]


def toxic_corpus(seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(700):
        bad = rng.random() < 0.25
        extra = [rng.choice(["you idiot", "zorgel", "zorgelen", "you are s.t.u.p.i.d", "!!! MORON !!!"]) for _ in range(4)] if bad else []
        words_ = prose(60, rng).split() + extra
        rng.shuffle(words_)
        docs.append((i, " ".join(words_)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    df = spark.createDataFrame([*docs, (None, None), (-1, ""), (-2, "x" * 200_000), (1, docs[1][1])], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("label", F.lit(3))
    out = toxicity.score_documents(df, toxicity.train(df, known)).collect()
    assert len(out) == len(docs) + 4 and all(0 <= r["score"] <= 1 for r in out)
    truth = dict(labels)
    held = [(r["score"] >= toxicity.THRESHOLD, truth[r["doc_id"]]) for r in out if r["doc_id"] is not None and r["doc_id"] >= 0 and r["doc_id"] % 3 == 0]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    assert all(r["score"] < toxicity.THRESHOLD for r in out if r["doc_id"] in (-1, None))


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score_documents(frame(spark, ["a"]), toxicity.train(frame(spark, ["a"]), none)).collect()] == [0.0]
    assert toxicity.score_documents(frame(spark, []), toxicity.train(frame(spark, ["a"]), spark.createDataFrame([(0, 1)], "doc_id long, toxic int"))).count() == 0
