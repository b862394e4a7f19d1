"""A third of all rows on one key (and one phone): results stay whole and exact."""

import json

from pyspark.sql import functions as F

from casemill.operators.merge import case_changes, fold_changes
from casemill.operators.parse import parse_cases
from casemill.operators.profile import enrich_cases, extract_profile
from casemill.schemas import KAFKA_SCHEMA
from casemill.sources.kafka import kafka_options, rate_cap

N = 3000


def messages(spark):
    rows = []
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{i}"
        phone = "p-hot" if i % 3 != 2 else f"p{i % 50}"
        rows.append((None, json.dumps({"overdueId": key, "mobile": phone, "name": f"n{i}"}),
                     "t", i % 4, i, None))
    return spark.createDataFrame(rows, KAFKA_SCHEMA).repartition(8)


def profiles(spark):
    docs = [("p-hot", part, json.dumps({"mxReport": {
        "call_contact_detail": [{"peer_num": f"c{part}", "call_cnt_6m": str(part % 11)}],
        "cell_phone": [{"key": "address", "value": f"a{part}"}]}})) for part in range(300)]
    docs += [(f"p{i}", 0, json.dumps({"mxReport": {"cell_phone": [{"key": "address", "value": f"x{i}"}]}}))
             for i in range(50)]
    return spark.createDataFrame(docs, "phone string, part long, doc string")


def test_hot_key_and_hot_phone(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        valid, _ = parse_cases(messages(spark))
        ex = extract_profile(profiles(spark))
        enriched = enrich_cases(valid, ex, "2024-06-30")
        assert enriched.count() == N  # no case dropped or multiplied
        hot = enriched.where(F.col("mobile") == "p-hot").select("address", "callRecordTopTen").distinct().collect()
        tops = sorted(((p % 11, f"c{p}") for p in range(300)), key=lambda t: (-t[0], t[1]))[:10]
        expected_top = ",".join(peer for _, peer in tops)
        assert [(r[0], r[1]) for r in hot] == [("a0", expected_top)]
        table = fold_changes(case_changes(enriched), None)
        got = {r["overdue_id"]: r["name"] for r in table.collect()}
        assert len(got) == 1 + (N - N // 3)
        assert got["hot"] == f"n{max(i for i in range(N) if i % 3 == 0)}"  # last message of the hot key
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_kafka_options_and_rate_cap():
    opts = kafka_options("b1:9092", ["case_increment"], max_offsets_per_trigger=rate_cap(10, 6, 2),
                         min_partitions=64)
    assert opts["minPartitions"] == "64"
    assert opts["subscribe"] == "case_increment" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "120" and opts["failOnDataLoss"] == "false"
