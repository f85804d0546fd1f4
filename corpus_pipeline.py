"""From raw documents to token ids: each stage works on all that the one before it kept, which is landed in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontamination, jaccard_join, sentencepieces, toxicity
from ledgerlake.llm.common import land, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels that op7 learns from."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels), "_toxic")
    return scored.where(scored["_toxic"] < toxicity.THRESHOLD).drop("_toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 on five-word shingles, that of the smallest id stays."""
    return jaccard_join.keep_one_of_each_group(docs, 5, 80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, without the text."""
    coded = sentencepieces.encode(docs, sentencepieces.load())
    return coded.selectExpr("doc_id", "lang", "source", "n_chars", "ids", "cast(size(ids) as bigint) as n_pieces")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]
#: SQL can express neither the classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
