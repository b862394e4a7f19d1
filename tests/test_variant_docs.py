"""Documents without a declared schema, and their drift from the declared one."""

import json

from pyspark.sql import types as T

from casemill.operators.profile import EXTRACTED_COLUMNS, extract_profile
from casemill.operators.variant_docs import declared_paths, drift_report, parse_variant_docs
from casemill.plans import derived as D
from helpers import SF_SMALL

DOCS = "phone string, part long, doc string"


def rows(df):
    return sorted(tuple(r) for r in df.select(*EXTRACTED_COLUMNS).collect())


def one(spark, doc, **settings):
    df = spark.createDataFrame([("p", 0, doc if doc is None or isinstance(doc, str) else json.dumps(doc))], DOCS)
    got = extract_profile(df, parse=lambda d, key: parse_variant_docs(d, key, **settings)).first()
    return got.call_record_top_ten, got.address_detail, got.shared_address, got.profile_status


def test_declared_documents_read_the_same(spark):
    for docs in (D.profiles(spark, SF_SMALL), D.odd_profiles(spark, SF_SMALL)):
        assert rows(extract_profile(docs, parse=parse_variant_docs)) == rows(extract_profile(docs))


def test_shapes(spark):
    none = ("未知",) * 3
    addr = lambda v: {"key": "address", "value": v}
    lists = {"call_contact_detail": [{"peer_num": 22, "call_cnt_6m": 3}, {"peer_num": "33", "call_cnt_6m": "7"}, 5, None],
             "cell_phone": ["x", addr("a")], "user_basic": addr("s")}
    assert one(spark, {"mxReport": lists}) == ("33,22", "a", "s", "ok")
    single = {"call_contact_detail": {"peer_num": "44"}, "cell_phone": {"key": "other", "value": "a"}, "user_basic": 7}
    assert one(spark, {"mxReport": single}) == ("44", "未知", "未知", "ok")
    assert one(spark, {"mxReport": {"call_contact_detail": {"1": 2, "2": "9"}}}) == ("2,1", "未知", "未知", "ok")
    for bad in (None, "", "{", "[]", "5", "null", "{}", '{"mxReport": null}', '{"mxReport": [1]}'):
        assert one(spark, bad) == (*none, "no_report"), bad
    assert one(spark, {"mxReport": {}}) == (*none, "ok")
    moved = {"data": {"report": {"cell_phone": [addr("a")]}}, "mxReport": 3}
    assert one(spark, moved, report_paths=("$.mxReport", "$.data.report")) == ("未知", "a", "未知", "ok")
    long = {"mxReport": {"cell_phone": [addr("x" * 2_000_000)], "call_contact_detail": {str(i): i for i in range(5000)}}}
    got = one(spark, long)
    assert got[0].split(",") == [str(i) for i in range(4999, 4989, -1)] and len(got[1]) == 2_000_000


def test_drift_report(spark):
    docs = ['{"a": 1, "b": [{"c": "x"}, {"c": null, "d.e": 2.5}], "f": []}', '{"a": "s", "b": {"c": [[true]]}}', "{", None, "null", '{"f": {}}']
    schema = T.StructType.fromDDL("a string, b array<struct<c: string>>, z struct<y: date>")
    assert declared_paths(schema) == {"$.a": "STRING", "$.b[].c": "STRING", "$.z.y": "DATE"}
    df = spark.createDataFrame([(d,) for d in docs * 3], "doc string")
    got = {(r.path, r.type): (r.n_values, r.status) for r in drift_report(df, schema).collect()}
    assert got == {
        ("$.a", "BIGINT"): (3, "other_type"), ("$.a", "STRING"): (3, "declared"),
        ("$.b[].c", "STRING"): (3, "declared"), ("$.b[].c", "VOID"): (3, "declared"), ("$.b[].`d.e`", "DECIMAL"): (3, "unknown"),
        ("$.b.c[][]", "BOOLEAN"): (3, "unknown"), ("$.f", "ARRAY"): (3, "unknown"), ("$.f", "OBJECT"): (3, "unknown"),
        ("$", "INVALID"): (6, "invalid"), ("$", "VOID"): (3, "unknown"), ("$.z.y", "DATE"): (0, "missing")}
    empty = drift_report(df.where("false"), schema).collect()
    assert {(r.path, r.status) for r in empty} == {("$.a", "missing"), ("$.b[].c", "missing"), ("$.z.y", "missing")}
    deep = spark.createDataFrame([("[" * 12 + "1" + "]" * 12,)], "doc string")
    assert [r.path for r in drift_report(deep, T.StructType([])).collect()] == ["$" + "[]" * 12]
