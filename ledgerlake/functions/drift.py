"""Documents of open shape: the schema that they have, by Spark's variant type, against the declared one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MIXED, _EMPTY = "mixed", "empty"
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def observed_schemas(docs: DataFrame, doc_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group: ``documents``, how many are ``unreadable`` as JSON, and the ``schema`` that all others fit, as text.

    The schemas are merged as they are met, before anything is shuffled, so a group's rows reach its task as one schema each.
    """
    variants = docs.select(*by, F.try_parse_json(doc_col).alias("_doc"))
    return variants.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("_doc").isNull()).alias("unreadable"),
        F.schema_of_variant_agg("_doc").alias("schema"),
    )


def schema_paths(dtype: T.DataType, prefix: str = "") -> dict[str, T.DataType]:
    """Every field by its path, ``[]`` for the elements of an array; structs and arrays have a path of their own too."""
    out: dict[str, T.DataType] = {prefix: dtype} if prefix else {}
    if isinstance(dtype, T.ArrayType):
        out |= schema_paths(dtype.elementType, f"{prefix}[]")
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            out |= schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    return out


def _name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.VariantType):
        return _MIXED
    if isinstance(dtype, T.NullType):
        return _EMPTY
    return {T.StructType: "object", T.ArrayType: "array"}.get(type(dtype)) or dtype.simpleString()


def _fits(observed: T.DataType, declared: T.DataType) -> bool:
    """Whether JSON values of one type can be read as the other without loss; dates and times come as text."""
    if isinstance(declared, (T.StructType, T.ArrayType)):
        return type(observed) is type(declared)
    if isinstance(declared, _NUMBERS):
        return isinstance(observed, _NUMBERS) or (isinstance(observed, T.DecimalType) and observed.scale == 0)
    if isinstance(declared, (T.DecimalType, T.DoubleType, T.FloatType)):
        return isinstance(observed, T.NumericType)
    if isinstance(declared, T.BooleanType):
        return isinstance(observed, T.BooleanType)
    return isinstance(observed, T.StringType)


def drift(observed: T.DataType, declared: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(path, declared, observed, kind) of each path that is ``new``, ``missing``, ``retyped`` or ``empty`` (null everywhere).

    What lies below a path that is new, missing, empty or of another kind is not listed by itself.
    """
    have, want = schema_paths(observed), schema_paths(declared)
    out: list[tuple[str, str | None, str | None, str]] = []
    for path in sorted({*have, *want}):
        if any(path.startswith((f"{p}.", f"{p}[]")) for p, *_ in out):
            continue
        if path not in want:
            out.append((path, None, _name(have[path]), "new"))
        elif path not in have:
            out.append((path, _name(want[path]), None, "missing"))
        elif isinstance(have[path], T.NullType):
            out.append((path, _name(want[path]), _EMPTY, "empty"))
        elif not _fits(have[path], want[path]):
            out.append((path, _name(want[path]), _name(have[path]), "retyped"))
    return out


def schema_drift(docs: DataFrame, doc_col: str, declared: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    """The :func:`drift` of each group of documents, with the group's ``by`` columns: which paths the loads of a day have changed, say.

    The schemas of the groups, one text each, are compared on the driver; groups are loads or days, not keys. Types that a path
    has side by side are ``mixed``. A group without a readable document has no drift.
    """
    spark = docs.sparkSession
    found = observed_schemas(docs, doc_col, by)
    fields = [*[found.schema[c] for c in by], *[T.StructField(c, T.StringType()) for c in ("path", "declared", "observed", "drift")]]
    rows = []
    for group in found.where("unreadable < documents").select(*by, "schema").collect():
        schema = T.DataType.fromDDL(group["schema"].replace("OBJECT<", "STRUCT<"))
        whole = schema if isinstance(schema, T.StructType) else T.StructType()
        rows += [(*[group[c] for c in by], *line) for line in drift(whole, declared)]
    return spark.createDataFrame(rows, T.StructType(fields))
