"""Document normalisation: typed-JSON unwrapping, schema enforcement, load times, quality splits."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type wrappers of extended JSON, {"$name": "text"} or {"$date": {"$numberLong": "millis"}}.
STRING_WRAPPERS = ("oid", "date", "numberDecimal", "numberLong", "numberInt", "numberDouble")
NUMBER_WRAPPERS = ("numberDecimal", "numberLong", "numberInt", "numberDouble")
DATE_WRAPPERS = ("date",)
MILLIS = r'^\{\s*"\$date"\s*:\s*\{\s*"\$numberLong"\s*:\s*"(-?\d+)"\s*\}\s*\}$'


def _wire_type(dtype: T.DataType) -> T.DataType:
    """The same nesting with every leaf a string, so that a wrapped leaf arrives as its JSON text."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_wire_type(dtype.elementType))
    return T.StringType()


def _member(c: Column, names: tuple[str, ...]) -> Column:
    """Text inside one of these wrappers; anything else as it is. Plain text costs one character test.

    The wrapped values are ids, dates and numbers, which never hold an escaped quote, so a pattern
    finds them without parsing the leaf again.
    """
    wrapper = rf'^\{{\s*"\$(?:{"|".join(names)})"\s*:\s*"([^"]*)"\s*\}}$'
    return F.when(c.startswith("{"), F.regexp_replace(c, wrapper, "$1")).otherwise(c)


def _moment(c: Column) -> Column:
    """Timestamp from ISO text or from milliseconds, wrapped or plain, in the session's time zone (UTC)."""
    millis = F.regexp_extract(c, MILLIS, 1).try_cast("bigint")
    iso = _member(c, DATE_WRAPPERS).try_cast("timestamp")
    return F.when(c.startswith("{"), F.coalesce(iso, F.timestamp_millis(millis))).otherwise(iso)


def _unwrap(c: Column, dtype: T.DataType, as_text: bool) -> Column:
    if isinstance(dtype, T.StructType):
        fields = [_unwrap(c.getField(f.name), f.dataType, as_text).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _unwrap(x, dtype.elementType, as_text))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        moment = _moment(c)
        if not as_text:
            return moment.cast(dtype)
        # the cast writes a fraction only where there is one; text that is no date stays, for the schema to reject
        return F.coalesce(F.translate(moment.cast("string"), " ", "T"), _member(c, DATE_WRAPPERS))
    if isinstance(dtype, T.NumericType):
        number = _member(c, NUMBER_WRAPPERS)
        return number if as_text else number.try_cast(dtype)
    if isinstance(dtype, T.StringType):
        return _member(c, STRING_WRAPPERS)
    return c if as_text else c.try_cast(dtype)


def _computed_once(df: DataFrame, kept: list[Column], columns: list[Column]) -> DataFrame:
    """``select(kept, columns)``, the latter as a one-row generator.

    The optimizer copies the expressions of a plain projection into every filter and projection
    above it; parsing a document again for each would cost more than reading it. What is only
    passed through stays outside, where it is pruned and filtered in the scan.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


_BROKEN = "_broken"


def normalize_extended_json(
    df: DataFrame, doc_col: str, schema: T.StructType, leaf_mode: str = "typed", unreadable: str | None = None
) -> DataFrame:
    """JSON documents with typed wrappers (ids, dates, exact numbers) to plain typed columns.

    Wrapped, plain and mixed documents are accepted. ``leaf_mode="string"`` keeps every leaf as
    text: dates in ISO form with their fraction of a second, numbers with all their digits, and
    what is no date as it is. Other columns of ``df`` are kept. ``unreadable`` names a boolean
    column that is true where a document is null, empty, not JSON, or has an object or array where
    the schema has none, or the other way round; what could be read of it is there all the same.
    """
    if leaf_mode not in ("typed", "string"):
        raise ValueError(f"leaf_mode must be 'typed' or 'string', not {leaf_mode!r}")
    as_text = leaf_mode == "string"
    wire = _wire_type(schema)
    if unreadable:
        wire = T.StructType([*wire.fields, T.StructField(_BROKEN, T.StringType())])
    doc = F.from_json(F.col(doc_col), wire, {"columnNameOfCorruptRecord": _BROKEN} if unreadable else None)
    kept = [F.col(c) for c in df.columns if c != doc_col]
    parsed = _computed_once(df, kept, [doc.alias("_doc")])
    fields = [_unwrap(F.col("_doc").getField(f.name), f.dataType, as_text).alias(f.name) for f in schema.fields]
    if unreadable:
        broken = F.col("_doc").isNull() | F.col("_doc").getField(_BROKEN).isNotNull()
        fields.append(broken.alias(unreadable))
    return parsed.select(*kept, *fields)


def _same_kind(source: T.DataType, target: T.DataType) -> bool:
    return any(isinstance(source, k) and isinstance(target, k) for k in (T.StructType, T.ArrayType))


def _shape(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """``c`` in the target type; leaves that do not fit become null, fields it lacks too."""
    if not _same_kind(source, target):
        return c if source == target else c.try_cast(target)
    if isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: _shape(x, source.elementType, target.elementType))
    have = {f.name: f.dataType for f in source.fields}
    fields = [
        (_shape(c.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in target.fields
    ]
    return F.when(c.isNotNull(), F.struct(*fields))


def _lossy(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """True where some leaf of ``c`` is set but does not fit the target type."""
    if not _same_kind(source, target):
        return F.lit(False) if source == target else c.isNotNull() & c.try_cast(target).isNull()
    if isinstance(target, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: _lossy(x, source.elementType, target.elementType)), F.lit(False))
    have = {f.name: f.dataType for f in source.fields}
    parts = [_lossy(c.getField(f.name), have[f.name], f.dataType) for f in target.fields if f.name in have]
    return c.isNotNull() & reduce(or_, parts, F.lit(False))


PROBLEMS, DOCUMENT = "_problems", "_document"


def conform(
    df: DataFrame, schema: T.StructType, carry: tuple[str, ...] = (), unreadable: str | None = None
) -> DataFrame:
    """Enforce a declared schema: extra columns go, missing ones are null, leaves are cast.

    ``_problems`` names the columns holding a value that did not fit. One pass: write the result
    partitioned by whether it is empty, or take both halves with :func:`split_conformed`.
    ``carry`` keeps source columns (the original text, say) for the quarantine. Where the boolean
    column ``unreadable`` is true, the problem is ``_document``.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = F.array_compact(
        F.array(
            *([F.when(F.col(unreadable), F.lit(DOCUMENT))] if unreadable else []),
            *[
                F.when(_lossy(F.col(f.name), have[f.name], f.dataType), F.lit(f.name))
                for f in schema.fields
                if f.name in have
            ]
        )
    )
    columns = [
        (_shape(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ]
    return _computed_once(df, [F.col(c) for c in carry], [*columns, problems.alias(PROBLEMS)])


def split_conformed(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; together they are the input."""
    clean = F.size(PROBLEMS) == 0
    return conformed.where(clean).drop(PROBLEMS), conformed.where(~clean)


def quality_split(df: DataFrame, *rules: Column) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` by row rules; a rule that is null is not met."""
    good = F.coalesce(reduce(and_, rules), F.lit(False))
    return df.where(good), df.where(~good)


def nested_to_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Struct, array and map columns as JSON text; the others stay as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    names = columns if columns is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, nested)]
    return df.withColumns({c: F.to_json(c) for c in names}) if names else df


def _moment_or_now(ts) -> Column:
    if ts is None:
        return F.current_timestamp()
    return ts if isinstance(ts, Column) else F.lit(ts)


def with_ingest_ts(df: DataFrame, ts=None, col: str = "ingest_ts", overwrite: bool = False) -> DataFrame:
    """Attach the load time unless the documents bring one. Pass ``ts`` to make a run repeatable."""
    if col in df.columns and not overwrite:
        return df
    return df.withColumn(col, _moment_or_now(ts))


def backfill_ingest_ts(df: DataFrame, ts=None, col: str = "ingest_ts") -> DataFrame:
    """Fill missing load times with the time of this run."""
    return df.withColumn(col, F.coalesce(F.col(col), _moment_or_now(ts).cast(df.schema[col].dataType)))
