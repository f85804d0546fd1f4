"""All stages of the pipeline together, on small tables, against a plain version of each stage in turn."""

import random

import corpus_pipeline
import sentencepiece
from test_filters import brute_contained, brute_groups

from ledgerlake.llm import sentencepieces

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
COLUMNS = ["doc_id", "lang", "source", "n_chars", "ids", "n_pieces"]
R = random.Random(31)
VOCABULARY = ["".join(R.choice("abcdeghilmnorstuv") for _ in range(R.randint(2, 7))) for _ in range(600)]
INSULTS = ["idiot", "scum", "worthless", "moron", "pathetic"]


def prose(n):
    return " ".join(R.choice(VOCABULARY) for _ in range(n))


def toxic(n):
    words = prose(n).split()
    for i in range(0, n, 4):
        words[i] = R.choice(INSULTS)
    return "you " + " ".join(words)


def tables():
    """Documents (with ids of what is toxic), labels and benchmark items, with all that may be odd in them."""
    items = [(i, prose(n)) for i, n in enumerate([20, 35, 60])] + [(9, None), (10, "")]
    rows = [(i, prose(R.randint(30, 90))) for i in range(120)]
    bad = [(200 + i, toxic(R.randint(20, 60))) for i in range(60)]
    rows += bad
    rows += [(300 + i, rows[i][1]) for i in range(10)] + [(320 + i, f"{rows[i][1]} more") for i in range(5, 15)]  # copies, near copies
    rows += [(400 + i, f"{prose(40)} {items[i][1]} {prose(40)}") for i in range(3)] + [(410, items[2][1])]  # passages
    rows += [(3, rows[3][1]), (4, prose(50)), (None, prose(40)), (None, rows[20][1]), (500, None), (501, ""), (502, " \n"), (503, "ß 漢字 word\t" * 9)]
    labels = [(i, 1, int(i >= 200)) for i in [*range(120), *range(200, 260)]] + [(None, 1, 1), (7, None, None), (99999, 0, 1)]
    return rows, {i for i, _ in bad}, labels, items


def write(spark, path, rows, labels, items):
    full = [(i, t, R.choice(["en", "de"]), "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")


def plain(rows, bad, items):
    """(doc_id, text) that stay. Of a group the smallest id stays; a null id is larger than others."""
    rows = [r for r in rows if r[0] not in bad]
    numbered = [(k, t) for k, (_, t) in enumerate(rows)]
    groups = {}
    for k, n, group in brute_groups(numbered, 5, 80):
        groups.setdefault(group if n else ("alone", k), []).append(k)
    kept = [rows[min(ks, key=lambda k: (rows[k][0] is None, rows[k][0] or 0))] for ks in groups.values()]
    found = {k for k, *_ in brute_contained([(k, t) for k, (_, t) in enumerate(kept)], items)}
    with_id = {kept[k][0] for k in found}
    return [r for r in kept if r[0] not in with_id]


def test_stages_together_equal_the_plain_version(spark, tmp_path):
    rows, bad, labels, items = tables()
    write(spark, tmp_path, rows, labels, items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == COLUMNS
    encode = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL).encode
    want = sorted(((i, encode(t or "")) for i, t in plain(rows, bad, items)), key=repr)
    got = out.collect()
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=repr) == want
    assert all(r.n_pieces == len(r.ids) for r in got)
    assert {3, 4, 500, 501, 502, 503} <= {r.doc_id for r in got} and not {400, 401, 402, 410} & {r.doc_id for r in got}


def test_no_documents_and_no_labels(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == COLUMNS and out.count() == 0
