from datetime import datetime
from decimal import Decimal

from support import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import functions as fn
from ledgerlake.specs import MONEY, strings

SCHEMA = strings(
    "_id",
    at=T.TimestampNTZType(),
    total=MONEY,
    lines=T.ArrayType(strings("sku", qty=T.IntegerType())),
)


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def test_wrapped_plain_and_mixed_documents_agree(spark):
    rows = fn.normalize_extended_json(
        docs(
            spark,
            '{"_id":{"$oid":"a1"},"at":{"$date":"2024-01-02T03:04:05Z"},"total":{"$numberDecimal":"1.25"},'
            '"lines":[{"sku":{"$oid":"s"},"qty":{"$numberInt":"2"}},{"sku":"t","qty":3}]}',
            '{"_id":"a1","at":"2024-01-02T03:04:05","total":"1.25","lines":[{"sku":"s","qty":"2"},{"sku":"t","qty":3}]}',
            '{"_id":"a1","at":{"$date":{"$numberLong":"1704164645000"}},"total":1.25,'
            '"lines":[{"sku":"s","qty":2},{"sku":{ "$oid" : "t"},"qty":{"$numberLong":"3"}}]}',
        ),
        "doc",
        SCHEMA,
    ).collect()
    assert len({repr(r) for r in rows}) == 1
    assert rows[0].at == datetime(2024, 1, 2, 3, 4, 5)
    assert rows[0].total == Decimal("1.25")
    assert [(x.sku, x.qty) for x in rows[0].lines] == [("s", 2), ("t", 3)]


def test_nulls_gaps_and_text_that_only_looks_wrapped(spark):
    rows = fn.normalize_extended_json(
        docs(spark, '{"_id":null,"lines":null}', "not json", '{"_id":"{curly","total":"x","lines":[]}'), "doc", SCHEMA
    ).collect()
    assert [r._id for r in rows] == [None, None, "{curly"]
    assert [r.total for r in rows] == [None, None, None]
    assert [r.lines for r in rows] == [None, None, []]


def test_string_mode_keeps_all_digits(spark):
    row = fn.normalize_extended_json(
        docs(spark, '{"_id":{"$oid":"a"},"at":{"$date":"2024-01-02T03:04:05Z"},"total":{"$numberDecimal":"1.234567"}}'),
        "doc",
        SCHEMA,
        leaf_mode="string",
    ).first()
    assert (row.at, row.total) == ("2024-01-02T03:04:05", "1.234567")


def test_string_mode_keeps_fractions_and_what_is_no_date(spark):
    times = {
        '"2024-01-02T03:04:05.678Z"': "2024-01-02T03:04:05.678",
        '{"$date":"2024-01-02T03:04:10.500Z"}': "2024-01-02T03:04:10.5",
        '{"$date":{"$numberLong":"1704164645001"}}': "2024-01-02T03:04:05.001",
        '"2024-01-02"': "2024-01-02T00:00:00",
        '"soon"': "soon",
        '{"$date":"soon"}': "soon",
        "null": None,
    }
    rows = docs(spark, *[f'{{"_id":"{i}","at":{t}}}' for i, t in enumerate(times)])
    got = fn.normalize_extended_json(rows, "doc", SCHEMA, leaf_mode="string").orderBy("_id").collect()
    assert [r.at for r in got] == list(times.values())


def test_unreadable_documents_are_marked(spark):
    texts = ["not json", "", "5", '{"_id":"a","lines":"oops"}', '{"_id":"b","lines":[]}', "{}"]
    rows = fn.normalize_extended_json(docs(spark, *texts).withColumn("t", F.col("doc")), "doc", SCHEMA, unreadable="bad")
    assert {r.t: (r._id, r.bad) for r in rows.collect()} == {
        "not json": (None, True), "": (None, True), "5": (None, True), texts[3]: ("a", True), texts[4]: ("b", False), "{}": (None, False),
    }


def test_conform_splits_without_loss(spark):
    rows = spark.createDataFrame(
        [("1", "2024-01-01", [("5",)], "x"), ("2", "soon", [("5",)], "x"), ("3", None, [("5",), ("?",)], "x"), ("4", None, None, "x")],
        "id string, day string, lines array<struct<q: string>>, extra string",
    )
    target = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("day", T.DateType()),
            T.StructField("lines", T.ArrayType(T.StructType([T.StructField("q", T.IntegerType())]))),
            T.StructField("note", T.StringType()),
        ]
    )
    good, rejects = fn.split_conformed(fn.conform(rows, target))
    assert good.columns == ["id", "day", "lines", "note"]
    assert [r.id for r in good.orderBy("id").collect()] == [1, 4]
    assert {r.id: r._problems for r in rejects.collect()} == {2: ["day"], 3: ["lines"]}


def test_quality_split_treats_null_as_reject(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (1, None), (1, -1.0)], "q int, p double")
    good, rejects = fn.quality_split(df, F.col("q") > 0, F.col("p") > 0)
    assert (good.count(), rejects.count()) == (1, 3)


def test_nested_to_json_and_ingest_time(spark):
    df = spark.createDataFrame([(("a", 1), ["x"], "s")], "o struct<k: string, n: int>, l array<string>, p string")
    assert tuple(fn.nested_to_json(df).first()) == ('{"k":"a","n":1}', '["x"]', "s")
    stamped = fn.with_ingest_ts(df, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert stamped.first().ingest_ts == datetime(2024, 1, 1)
    assert fn.with_ingest_ts(stamped, F.lit(None)).first().ingest_ts == datetime(2024, 1, 1)
    gaps = spark.createDataFrame([(None,), (datetime(2020, 1, 1),)], "ingest_ts timestamp_ntz")
    filled = fn.backfill_ingest_ts(gaps, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert values(filled) == [(datetime(2020, 1, 1),), (datetime(2024, 1, 1),)]


def test_dirty_text_never_raises(spark):
    df = spark.createDataFrame([("29.01.22", "12.5", '"[{""a"":1}]"', "A,B , C"), ("x", "y", "", None)], "d string, m string, q string, l string")
    rows = df.select(
        fn.iso_date("d", "dd.MM.yy").alias("d"),
        fn.to_money("m").alias("m"),
        fn.blank_to(fn.repair_quotes("q"), "Unknown").alias("q"),
        fn.item(fn.split_names("l"), 2).alias("third"),
    ).collect()
    assert (str(rows[0].d), rows[0].m, rows[0].q, rows[0].third) == ("2022-01-29", Decimal("12.50"), '[{"a":1}]', "C")
    assert tuple(rows[1]) == (None, None, "Unknown", None)
