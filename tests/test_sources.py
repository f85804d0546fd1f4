import json
from datetime import datetime

import pytest
from support import plan, values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import sources as src
from ledgerlake.session import scratch
from ledgerlake.plans import staging
from ledgerlake.plans.queries import QUERIES
from ledgerlake.sources import read_json_array, read_json_docs
from ledgerlake.sources.json_arrays import array_documents
from ledgerlake.specs import ACCOUNTS, CRATE_ORDERS


def test_json_lines_array_and_inference(spark, tmp_path):
    one, two = '{"account_id":"1","name":"Cash","x":1}', '{"account_id":"2","name":"AP"}'
    (tmp_path / "lines.json").write_text(f"{one}\n{two}\nnot json\n")
    (tmp_path / "array.json").write_text(f"[{one},{two}]")
    lines = src.read_json_docs(spark, str(tmp_path / "lines.json"), ACCOUNTS.schema, corrupt_col="_bad").cache()
    assert [r._bad for r in lines.where("_bad is not null").collect()] == ["not json"]
    array = src.read_json_docs(spark, str(tmp_path / "array.json"), ACCOUNTS.schema, json_array=True)
    assert values(array.select("account_id", "name")) == [("1", "Cash"), ("2", "AP")]
    inferred = src.read_json_inferred(spark, str(tmp_path / "array.json"), 1.0, json_array=True)
    assert inferred.count() == 2 and "x" in inferred.columns


def test_delimited_text_with_quoted_json(spark, tmp_path):
    header = ";".join(CRATE_ORDERS.schema.names)
    (tmp_path / "o.csv").write_text(f'{header}\no1;29.01.22;k;n;Plastic;"[{{""contact_name"":""A;B""}}]";"X, Y"\n')
    row = src.read_delimited(spark, str(tmp_path / "o.csv"), CRATE_ORDERS.schema).first()
    assert (row.contact_data, row.salesowners) == ('[{"contact_name":"A;B"}]', "X, Y")


def test_lookup_and_increment_reach_the_scan(spark):
    path = scratch(spark, "ids")
    spark.range(10).write.parquet(path)
    docs = src.read_collection(spark, "parquet", {"path": path})
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,3)]" in plan(src.point_lookup(docs, "id", 3))
    assert "GreaterThan(id,6)" in plan(src.since_mark(docs, "id", F.lit(6)))
    assert src.since_mark(docs, "id", F.lit(6), inclusive=True).count() == 4
    assert src.since_mark(docs, "id", None).count() == 10


def test_marks_survive_runs(spark):
    store = src.MarkStore(spark, scratch(spark, "marks"))
    assert store.get("a") is None
    store.put("a", datetime(2024, 1, 1))
    store.put("b", 7)
    store.put("a", datetime(2024, 1, 2))
    row = spark.range(1).select(store.get("a", "timestamp_ntz").alias("a"), store.get("b", "bigint").alias("b")).first()
    assert tuple(row) == (datetime(2024, 1, 2), 7)


def test_file_listing_reads_no_content(spark):
    path = scratch(spark, "listing")
    spark.range(10).repartition(2).write.parquet(path)
    listed = src.list_files(spark, path)
    assert listed.count() == 2
    assert "content" not in plan(listed)


ODD_DOCS = [
    {"id": "a", "note": 'braces } { ] [ and "quotes" \\', "lines": [{"n": 1, "t": "}"}, {"n": 2, "t": '\\"}{"'}]},
    {"id": "b", "note": "", "lines": []},
    {"id": "ü€😀", "note": "\\\\", "lines": [{"n": 3, "t": ",[{"}]},
    {"id": "d", "note": None, "lines": None},
    {},
    *[{"id": f"long {i}", "note": "x}" * i, "lines": [{"n": k, "t": "\\" * k} for k in range(i % 7)]} for i in range(60)],
]
ODD_SCHEMA = "id string, note string, lines array<struct<n: int, t: string>>"


@pytest.mark.parametrize("indent, split", [(None, "90"), (3, "250"), (None, "7"), (None, "1000000")])
def test_an_array_is_read_in_splits(spark, tmp_path, indent, split):
    (tmp_path / "one.json").write_text(json.dumps(ODD_DOCS, indent=indent), encoding="utf-8")
    (tmp_path / "two.json").write_text(" [ " + json.dumps(ODD_DOCS[0], ensure_ascii=False) + " \n]\n", encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    schema = T.StructType.fromDDL(ODD_SCHEMA)
    want = values(read_json_docs(spark, str(tmp_path), schema, json_array=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        scan = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert (scan.select(F.spark_partition_id()).distinct().count() > 10) == (int(split) < 1000)
        assert values(read_json_array(spark, str(tmp_path), schema)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(want) == len(ODD_DOCS) + 1


def test_an_array_that_breaks_off_loses_its_last_document(spark, tmp_path):
    text = json.dumps(ODD_DOCS)
    (tmp_path / "cut.json").write_text(text[:-30])
    got = read_json_array(spark, str(tmp_path), T.StructType.fromDDL("id string"), "wrong").collect()
    assert [r.wrong for r in got] == [None] * len(got)
    assert sorted(r.id or "" for r in got) == sorted(d.get("id", "") for d in ODD_DOCS[:-1])
    (tmp_path / "odd.json").write_text('[{"id": "a"}, {"id": 1 2}]')
    got = read_json_array(spark, str(tmp_path / "odd.json"), T.StructType.fromDDL("id string"), "wrong").collect()
    assert sorted(((r.id, r.wrong) for r in got), key=repr) == sorted([("a", None), (None, '{"id": 1 2}')], key=repr)


def _dump(path, keys, key="_id", wrap=lambda k: k):
    path.write_text("".join(json.dumps({key: wrap(k), "note": f"é {k} " + "x" * (hash(str(k)) % 90)}) + "\n" for k in keys), encoding="utf-8")


def test_a_dump_is_read_by_key_ranges(spark, tmp_path):
    _dump(tmp_path / "a.json", [f"{i:05}" for i in range(0, 3000, 2)])
    _dump(tmp_path / "b.json", [f"{i:05}" for i in [1, 3, 3, 3, 700, 5000]], wrap=lambda k: {"$oid": k})
    (tmp_path / "empty.json").write_text("")
    dump = src.read_dump(spark, str(tmp_path), range_bytes=2000)
    assert dump.rdd.getNumPartitions() > 30
    want = sorted([f"{i:05}" for i in range(0, 3000, 2)] + [f"{i:05}" for i in [1, 3, 3, 3, 700, 5000]])
    rows = dump.collect()
    assert sorted(r._id for r in rows) == want
    assert all(json.loads(r.doc)["note"].startswith(f"é {r._id}") for r in rows)


@pytest.mark.parametrize(
    "asked, keep, most",
    [
        ("_id = '00700'", lambda k: k == "00700", 2),
        ("_id = '00003'", lambda k: k == "00003", 1),
        ("_id = '9'", lambda k: False, 0),
        ("_id >= '02990'", lambda k: k >= "02990", 2),
        ("_id > '00010' AND _id <= '00020'", lambda k: "00010" < k <= "00020", 2),
        ("_id IN ('00002', '00008')", lambda k: k in ("00002", "00008"), 2),
        ("_id < '00000'", lambda k: False, 0),
        ("_id >= '00100' AND doc LIKE '%zzz%'", lambda k: False, 999),
    ],
)
def test_filters_on_the_key_prune_ranges(spark, tmp_path, asked, keep, most):
    keys = {"a.json": [f"{i:05}" for i in range(0, 3000, 2)], "b.json": [f"{i:05}" for i in [1, 3, 3, 3, 700, 5000]]}
    for name, values_ in keys.items():
        _dump(tmp_path / name, values_)
    found = src.read_dump(spark, str(tmp_path), range_bytes=2000).where(asked)
    assert sorted(r._id for r in found.collect()) == sorted(k for ks in keys.values() for k in ks if keep(k))
    assert found.rdd.getNumPartitions() <= max(1, most)


def test_a_dump_out_of_order_is_an_error(spark, tmp_path):
    _dump(tmp_path / "a.json", [5, 7, 6])
    with pytest.raises(Exception, match="not in the order"):
        src.read_dump(spark, str(tmp_path), key_type="long").collect()


def test_arrays_are_written_and_read_without_moving_the_text(spark, tmp_path):
    docs = spark.range(0, 500, 1, 5).selectExpr("cast(id as string) as id", "repeat('}\"', 20) as note").where("id < 100 or id >= 200")
    path = str(tmp_path / "arrays")
    staging.write_array_files(docs, path)
    texts = [f.read_text() for f in (tmp_path / "arrays").glob("part-*") if f.stat().st_size]
    assert len(texts) == 4 and sorted(len(json.loads(t)) for t in texts) == [100] * 4
    found = array_documents(spark, path)
    assert "piece" not in " ".join(line for line in plan(found).splitlines() if "Exchange" in line or "Sort" in line)
    assert "Scan parquet" not in plan(found) and found.count() == 400


def test_staged_json_documents_are_compressed(spark):
    docs = QUERIES["scan_json_docs"](spark, "/root/testdata/sf0.001")
    assert all(f.endswith(".json.gz") for f in docs.inputFiles()) and docs.inputFiles()
