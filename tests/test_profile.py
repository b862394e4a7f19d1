import json

from casemill.operators.profile import enrich_cases, extract_profile
from casemill.schemas import UNKNOWN
from helpers import by_key


def doc(contacts=None, cell=None, basic=None, report=True):
    if not report:
        return json.dumps({"baseInfo": {"mobile": "x"}})
    r = {}
    if contacts is not None:
        r["call_contact_detail"] = [{"peer_num": p, "call_cnt_6m": c} for p, c in contacts]
    if cell is not None:
        r["cell_phone"] = [{"key": k, "value": v} for k, v in cell]
    if basic is not None:
        r["user_basic"] = [{"key": k, "value": v} for k, v in basic]
    return json.dumps({"mxReport": r})


def extract(spark, rows, **kw):
    df = spark.createDataFrame(rows, "phone string, part long, doc string")
    return by_key(extract_profile(df, **kw), "phone")


def test_top_ten_order_ties_and_bad_counts(spark):
    contacts = [(f"p{i:02d}", str(i)) for i in range(12)] + [("zz", "abc"), ("aa", None), ("p05b", "5")]
    got = extract(spark, [("1", 0, doc(contacts=contacts))])["1"]
    # 11..2 by count, tie at 5 broken by peer number; bad counts sort last
    assert got["call_record_top_ten"] == "p11,p10,p09,p08,p07,p06,p05,p05b,p04,p03"
    few = extract(spark, [("2", 0, doc(contacts=[("b", "1"), ("a", "1"), ("c", None)]))])["2"]
    assert few["call_record_top_ten"] == "a,b,c"


def test_addresses_and_defaults(spark):
    rows = [
        ("1", 0, doc(cell=[("city", "x"), ("address", "A-1"), ("address", "A-2")], basic=[("address", "B")])),
        ("2", 0, None),
        ("3", 0, ""),
        ("4", 0, "{}"),
        ("5", 0, '{"mxReport": null}'),
        ("6", 0, "{bad json"),
        ("7", 0, doc(contacts=[], cell=[], basic=[])),
    ]
    got = extract(spark, rows)
    assert got["1"]["address_detail"] == "A-1" and got["1"]["shared_address"] == "B"
    assert got["1"]["call_record_top_ten"] == UNKNOWN and got["1"]["profile_status"] == "ok"
    for k in "23456":
        assert got[k]["address_detail"] == UNKNOWN and got[k]["call_record_top_ten"] == UNKNOWN
        assert got[k]["profile_status"] == "no_report"
    assert got["7"]["profile_status"] == "ok" and got["7"]["shared_address"] == UNKNOWN


def test_documents_of_one_phone_are_read_in_order(spark):
    rows = [
        ("1", 2, doc(contacts=[("late", "50")], cell=[("address", "later")])),
        ("1", 1, doc(contacts=[("x", "3"), ("y", "2")], cell=[("address", "first")])),
        ("1", 3, "{bad"),
    ]
    got = extract(spark, rows)["1"]
    assert got["address_detail"] == "first"
    assert got["call_record_top_ten"] == "late,x,y"
    assert got["profile_status"] == "ok"


def test_peers_of_several_documents_are_added_up(spark):
    rows = [("1", i, doc(contacts=[("a", "3"), ("b", str(10 - i)), ("c", "x"), ("b", "1")])) for i in range(4)]
    rows += [("2", 0, ""), ("2", 1, doc(contacts=[("z", "x")]))]
    got = extract(spark, rows)
    assert got["1"]["call_record_top_ten"] == "b,a,c" and got["2"]["call_record_top_ten"] == "z"
    # without a `part` column too, and whatever the blocks of documents are
    bare = spark.createDataFrame([(p, d) for p, _, d in rows], "phone string, doc string")
    assert by_key(extract_profile(bare), "phone")["1"]["call_record_top_ten"] == "b,a,c"


def test_columns_decide_the_work(spark):
    df = spark.createDataFrame([("1", 0, doc(cell=[("address", "A")]))], "phone string, part long, doc string")
    only = extract_profile(df, columns=["address_detail"])
    assert [tuple(r) for r in only.collect()] == [("1", "A")]
    plan = only._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    full = extract_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in full


def test_hot_phone_many_documents(spark):
    # one phone with 400 documents: the merge never needs them in one group
    rows = [("hot", i, doc(contacts=[(f"q{i:03d}", str(i % 37))], cell=[("address", f"a{i}")]))
            for i in range(400)]
    got = extract(spark, rows)["hot"]
    expected = sorted(((i % 37, f"q{i:03d}") for i in range(400)), key=lambda t: (-t[0], t[1]))[:10]
    assert got["call_record_top_ten"] == ",".join(p for _, p in expected)
    assert got["address_detail"] == "a0"


def test_enrich_variants(spark):
    cases = spark.createDataFrame([("1", "p1", "ca"), ("2", "p2", "cb")],
                                  "overdueId string, mobile string, companyAddress string")
    cases = cases.selectExpr("*", "CAST(NULL AS STRING) AS address", "CAST(NULL AS STRING) AS callRecordTopTen",
                             "CAST(NULL AS STRING) AS permanentAddress", "CAST(NULL AS STRING) AS createdDate",
                             "CAST(NULL AS STRING) AS updatedDate")
    prof = spark.createDataFrame([("p1", 0, doc(contacts=[("n", "1")], cell=[("address", "A")], basic=[("address", "S")]))],
                                 "phone string, part long, doc string")
    ex = extract_profile(prof)
    full = by_key(enrich_cases(cases, ex, "2024-06-30"), "overdueId")
    assert full["1"]["address"] == "A" and full["1"]["companyAddress"] == "S" and full["1"]["permanentAddress"] == "S"
    assert full["1"]["createdDate"] == "2024-06-30" and full["1"]["callRecordTopTen"] == "n"
    assert full["2"]["address"] == UNKNOWN and full["2"]["profile_status"] == "missing"
    basic = by_key(enrich_cases(cases, ex, "2024-06-30", profile_addresses=False), "overdueId")
    assert basic["1"]["companyAddress"] == "ca" and basic["1"]["permanentAddress"] is None


def test_documents_matched_by_their_own_mobile(spark):
    docs = [json.dumps({"baseInfo": {"mobile": "m1"}, "mxReport": {"cell_phone": [{"key": "address", "value": "A"}],
                                                                  "call_contact_detail": [{"peer_num": "x", "call_cnt_6m": "2"}]}}),
            json.dumps({"mxReport": {"cell_phone": [{"key": "address", "value": "orphan"}]}}),
            "not json"]
    bare = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = by_key(extract_profile(bare), "phone")
    assert set(got) == {"m1"}  # documents without a mobile match no phone
    assert got["m1"]["address_detail"] == "A" and got["m1"]["call_record_top_ten"] == "x"


def test_bare_documents_are_read_for_their_phone_first(spark, capsys):
    """Documents of other phones are left out before the parse."""
    from casemill.operators.backfill import profiles_of
    good = '{"baseInfo": {"mobile": "%s"}, "mxReport": {"cell_phone": [{"key": "address", "value": "%s"}]}}'
    docs = [(0, good % ("1", "a")), (1, good % ("2", "b")), (2, good % ("1", "late")), (3, None), (4, ""), (5, "{"), (6, '{"baseInfo": {}}'),
            (7, '{"baseInfo": {"mobile": 3}, "mxReport": {}}'), (8, good % ("4", "d") + "tail")]
    bare = spark.createDataFrame(docs, "part long, doc string")
    phones = spark.createDataFrame([("1",), ("3",), ("4",), ("9",)], "phone string")
    got = profiles_of(phones, bare)
    whole = extract_profile(bare).join(phones, "phone", "left_semi")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and got.count() >= 2
    got.explain()
    plan = capsys.readouterr().out
    # the plan is printed from the result down to the scans
    assert plan.index("from_json") < plan.rindex("LeftSemi") < plan.rindex("get_json_object")
