"""File scans: JSON documents, nested envelopes, delimited text, storage listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.specs import INVOICE_ROWS


def read_json_docs(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    json_array: bool = False,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Scan JSON documents against a declared schema.

    JSON lines split across tasks. ``json_array`` reads files that hold one top-level array; such a
    file is one task whatever its size; :func:`ledgerlake.sources.read_json_array` reads large ones in parallel. ``corrupt_col`` keeps the
    text of documents that are not JSON at all.
    """
    reader = spark.read.option("multiLine", str(json_array).lower())
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).json(path)


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 0.1, json_array: bool = False) -> DataFrame:
    """Scan JSON with an inferred schema. Only the inference samples; every document is read."""
    return (
        spark.read.option("multiLine", str(json_array).lower())
        .option("samplingRatio", sampling_ratio)
        .json(path)
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Scan headed delimited text. Quotes are escaped by doubling, as spreadsheets write them."""
    return spark.read.option("header", "true").option("sep", sep).option("escape", '"').schema(schema).csv(path)


def flatten_envelope(envelopes: DataFrame, array: str, names: dict[str, str]) -> DataFrame:
    """One row per element of the array of structs at the path ``array``; ``names`` declares the fields wanted and what to call them."""
    return envelopes.select(F.inline(array)).select(*[F.col(field).alias(name) for field, name in names.items()])


def flatten_invoices(envelopes: DataFrame) -> DataFrame:
    return flatten_envelope(envelopes, *INVOICE_ROWS)


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files below ``path`` with size and change time; their content is pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))
    )
