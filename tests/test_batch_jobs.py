import os
import tempfile

from casemill.operators.backfill import extract_cases, missing_ids, normalize_ids, write_extract, backfill
from casemill.operators.offsets import advance_ledger, resolve_start_offsets, starting_offsets_json
from casemill.sources.idlist import read_id_list
from casemill.sources.jdbc import read_jdbc_table, write_jdbc_table
from helpers import kafka_rows


def test_id_list_source_and_missing(spark, tmp_path):
    p = tmp_path / "ids.txt"
    p.write_text("1\n 2 \n\n   \n2\n99\n")
    ids = read_id_list(spark, str(p))
    assert sorted(r[0] for r in ids.collect()) == ["1", "2", "99"]
    cases = spark.createDataFrame([("1", "p"), ("2", "q")], "overdue_id string, phone string")
    assert [r[0] for r in missing_ids(ids, cases).collect()] == ["99"]


def test_backfill_reports_missing_and_defaults(spark):
    ids = normalize_ids(spark.createDataFrame([("1",), ("3",)], "value string"))
    cases = spark.createDataFrame([("1", "p1"), ("2", "p2")], "overdue_id string, phone string")
    prof = spark.createDataFrame([("p2", 0, '{"mxReport": {"cell_phone": [{"key": "address", "value": "A"}]}}')],
                                 "phone string, part long, doc string")
    changes, missing = backfill(ids, cases, prof, ["address_detail"])
    got = {r["overdue_id"]: r["address_detail"] for r in changes.collect()}
    assert got == {"1": "未知"}
    assert [r[0] for r in missing.collect()] == ["3"]


def test_extract_all_matches_and_csv_append(spark, tmp_path):
    ids = normalize_ids(spark.createDataFrame([("1",), ("01",)], "value string"))
    inc = spark.createDataFrame([("1", "a", "t"), ("1", "b", "u"), ("2", "c", "v")],
                                "overdueId string, address string, callRecordTopTen string")
    out = extract_cases(ids, inc)
    assert sorted(r["address"] for r in out.collect()) == ["a", "b"]  # string equality: '01' matches nothing
    path = str(tmp_path / "extract")
    write_extract(out, path, single_file=True)
    write_extract(out, path, single_file=True)
    back = spark.read.option("sep", "\t").csv(path)
    assert back.count() == 4


def test_ledger_advance_and_resolve(spark):
    ledger = spark.createDataFrame([("g", "t", 0, 5), ("g", "t", 1, 7), ("h", "t", 0, 1), ("g", "u", 2, 4)],
                                   "groupid string, topic string, kafka_partition int, kafka_offset long")
    batch = kafka_rows(spark, ["a", "b"], topic="t", partition=0, start=10).unionByName(
        kafka_rows(spark, ["c"], topic="t", partition=2, start=3))
    new = {(r[0], r[1], r[2]): r[3] for r in advance_ledger(ledger, batch, "g").collect()}
    assert new == {("g", "t", 0): 12, ("g", "t", 1): 7, ("g", "t", 2): 4, ("h", "t", 0): 1, ("g", "u", 2): 4}
    earliest = spark.createDataFrame([("t", 0, 3), ("t", 1, 9), ("t", 2, 0)],
                                     "topic string, partition int, earliest_offset long")
    res = resolve_start_offsets(ledger, earliest, "g", "t").collect()
    got = {r["partition"]: (r["start_offset"], r["lost"]) for r in res}
    assert got == {0: (5, 0), 1: (9, 2), 2: (0, 0)}  # keep, clamp, new partition
    assert starting_offsets_json(res) == '{"t": {"0": 5, "1": 9, "2": 0}}'


def test_jdbc_round_trip_embedded_derby(spark):
    url = "jdbc:derby:memory:casemill;create=true"
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "overdue_id int, phone string")
    write_jdbc_table(df, url, "CASES", mode="overwrite", column_types="phone VARCHAR(20)",
                     properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = read_jdbc_table(spark, url, "CASES", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
                           partition_column="OVERDUE_ID", lower_bound=0, upper_bound=20, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    one = back.where("OVERDUE_ID = 7").select("PHONE")
    assert [r[0] for r in one.collect()] == ["v7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "equalto(overdue_id,7)" in plan.lower()


def test_recommended_conf_scales_with_input():
    from casemill.session import recommended_conf
    assert recommended_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"
    assert recommended_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    assert recommended_conf(1 << 20)["spark.sql.shuffle.partitions"] == "8"
    assert recommended_conf(1)["spark.sql.adaptive.enabled"] == "true"
