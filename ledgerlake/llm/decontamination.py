"""Benchmark decontamination: which documents contain which test items, by containment of word shingles.

An item is contained in a document when the document has a given share of the item's distinct shingles. Items are
partitioned by size; each size class has a MinHash sketch length, the number of smallest shingle hashes of an item that
is kept. With ``floor((1 - share) * size) + 1`` hashes for the largest size of a class, a document that contains the
item has one of them for certain, however long it is, so the search by equi-join on sketch hashes loses nothing.
Candidates are verified by exact containment. An item with fewer words than a shingle is one run of its own length, and
documents are searched for their runs of each such length that occurs among the items. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import land, materialised, table

WIDTH, SHARE = 5, 0.8


def alnum_words(text: Column) -> Column:
    """Runs of letters and digits in lower case, so that punctuation around a passage does not hide it."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _runs(width: int) -> Column:
    """Hashes of the runs of ``width`` words of ``_w``, which has that many; words beyond its end are left out of a hash."""
    last = F.greatest(F.size("_w") - width, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(width)]))


def shingled(df: DataFrame, text: str, keep: list[Column], width: int, short: tuple[int, ...] = ()) -> DataFrame:
    """``keep`` and ``hashes``: of each run of ``width`` words; of all words where there are fewer; none without words.

    The distinct runs of each of the ``short`` lengths follow.
    """
    none = F.array().cast("array<bigint>")
    hashes = F.when(F.size("_w") > 0, _runs(width)).otherwise(none)
    for n in short:
        hashes = F.concat(hashes, F.when(F.size("_w") >= n, F.array_distinct(_runs(n))).otherwise(none))
    return df.select(*keep, materialised(alnum_words(F.col(text)), "_w")).select(*[c for c in df.select(*keep).columns], hashes.alias("hashes"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_found, containment) with ``containment >= share``.

    Texts that are null or have no words match nothing. An item of fewer than ``width`` words has its whole sequence as
    one shingle, which any run of as many words in a document matches. Rows that share an id are looked at one by one and the best containment counts; a null id is an id.
    Other columns are ignored. Empty tables give no pairs.
    """
    per_mille = round(share * 1000)
    n_words = F.size(alnum_words(F.col("text")))
    # at most width - 1 numbers
    short = tuple(sorted(r["n"] for r in items.select(n_words.alias("n")).where(F.col("n").between(1, width - 1)).distinct().collect()))
    sized = shingled(items, "text", [F.col("item_id")], width).select("item_id", materialised(F.array_sort(F.array_distinct("hashes")), "set"))
    q = F.size("set")
    # the largest size of the item's size class, a power of two less one
    top = F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), F.floor(F.log2(q)) + 1) - 1
    length = F.floor(top * (1000 - per_mille) / 1000).cast("int") + 1
    items_set = land(
        sized.where(q > 0).select(
            "item_id",
            "set",
            q.cast("long").alias("n_shingles"),
            F.ceil(q * F.lit(per_mille) / 1000).cast("long").alias("_need"),
            F.slice("set", F.lit(1), F.least(length, q)).alias("_sketch"),
        ),
        "items",
    )
    sketch = items_set.select(F.col("item_id").alias("_item"), F.col("_need").alias("_least"), F.explode("_sketch").alias("_hash"))
    probes = shingled(docs, "text", [F.col("doc_id")], width, short).select("doc_id", F.size("hashes").alias("_n"), F.explode("hashes").alias("_hash"))
    # a document with fewer shingles than needed cannot contain the item
    hits = probes.join(sketch, (probes["_hash"] == sketch["_hash"]) & (F.col("_n") >= F.col("_least")))
    pairs = land(hits.select("doc_id", "_item").distinct(), "candidates")

    wanted = pairs.select(F.col("doc_id").alias("_doc")).distinct()
    found = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    sets = shingled(found, "text", [F.col("doc_id").alias("_doc")], width, short)
    named = items_set.select(F.col("item_id").alias("_id"), "set", "n_shingles", "_need").dropDuplicates(["_id", "set"])
    both = pairs.join(named, pairs["_item"].eqNullSafe(named["_id"])).join(sets, pairs["doc_id"].eqNullSafe(sets["_doc"]))
    n = both.select("doc_id", F.col("_id").alias("item_id"), "n_shingles", "_need", F.size(F.array_intersect("set", "hashes")).cast("long").alias("n_found"))
    best = n.where(F.col("n_found") >= F.col("_need")).groupBy("doc_id", "item_id")
    row = F.max(F.struct((F.col("n_found") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_found"))
    return best.agg(row.alias("_r")).select("doc_id", "item_id", "_r.n_shingles", "_r.n_found", "_r.containment")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item. Rows that share an id with one that does go with it."""
    bad = contaminated(docs, items, width, share).select(F.col("doc_id").alias("_doc")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def containment_sql(documents: str = "documents") -> str:
    """DuckDB: pairs by exact containment, as op1 returns them, over the given table or query of documents."""
    return f"""WITH words AS (SELECT 'd' AS side, doc_id AS id, text FROM {documents} UNION ALL SELECT 'b', item_id, text FROM benchmark),
split AS (SELECT side, id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM words),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM split WHERE side = 'b' AND len(w) > 0),
runs AS (SELECT DISTINCT side, id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM split JOIN lengths ON len(w) >= k WHERE side = 'd' OR k = least(len(w), 5)),
n AS (SELECT id AS item_id, count(*) AS n_shingles FROM runs WHERE side = 'b' GROUP BY ALL),
f AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found FROM runs d JOIN runs b USING (k, s) WHERE d.side = 'd' AND b.side = 'b' GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment FROM f JOIN n USING (item_id)
WHERE 1000 * n_found >= 800 * n_shingles"""


OP1_SQL = containment_sql()
