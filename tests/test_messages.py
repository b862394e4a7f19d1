"""Messages made of table rows: their text, and the tasks that make and read them."""

import re

import pytest
from pyspark.sql import functions as F

from casemill.operators.parse import parse_cases
from casemill.plans import derived as D
from casemill.plans.jobs import intake_batch
from casemill.schemas import CASE_FIELDS
from casemill.session import scratch_path


@pytest.fixture(scope="module")
def tables(spark):
    """Orders, customers and events of one file each, with nulls and text that JSON escapes."""
    folder = scratch_path(spark, "test-messages")
    names = F.when(F.col("id") == 0, F.lit('a"b\\c\n\tü')).when(F.col("id") > 1, F.concat(F.lit("c"), "id"))
    spark.range(8).select(F.col("id").alias("c_custkey"), names.alias("c_name"), F.lit("M").alias("c_mktsegment")).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    key = F.when(F.col("id") != 7, F.col("id") - 20)
    spark.range(400).select(
        key.alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.when(F.col("id") % 5 > 0, F.lit("O")).alias("o_orderstatus"),
        F.when(F.col("id") % 6 > 0, F.lit("1-URGENT")).alias("o_orderpriority"),
        F.when(F.col("id") % 8 > 0, F.lit("2024-01-02").cast("timestamp")).alias("o_orderdate")).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(400).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit("2024-01-02").cast("timestamp").alias("ts"), F.lit('{"k": "1"}').alias("props")).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def test_message_text_is_the_record_in_json(spark, tables):
    rows = spark.read.parquet(f"{tables}/orders.parquet").join(spark.read.parquet(f"{tables}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    mobile = F.when(k % 37 != 0, (F.col("o_custkey") % 200).cast("string"))
    given = {"overdueId": D.case_id(F.col("o_custkey")), "mobile": mobile, "name": F.col("c_name"), "productName": F.col("o_orderpriority"),
             "status": F.col("o_orderstatus"), "address2": F.col("c_mktsegment"), "loanDate": F.date_format("o_orderdate", "yyyy-MM-dd"),
             "seqNo": k.cast("string"), "loanAmt": F.when((k % 4 == 3) & mobile.isNotNull(), "@").otherwise(F.concat(F.lit("loanAmt-"), (k % 10).cast("string")))}
    record = F.to_json(F.struct(*[given.get(f, F.concat(F.lit(f"{f}-"), (k % (len(f) + 3)).cast("string"))).alias(f) for f in CASE_FIELDS]))
    text = F.replace(record, F.lit('"loanAmt":"@"'), F.concat(F.lit('"loanAmt": '), k.cast("string"), F.lit(".50")))
    value = F.when(k % 50 == 0, "not json").when(k % 50 == 1, "").otherwise(text)
    want = [(r[0], r[1]) for r in rows.select(k, value).collect()]
    got = [(r[0], r[1]) for r in D.case_messages(spark, tables).select("offset", "value").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_messages_of_one_file_are_made_by_many_tasks(spark, tables):
    tasks = spark.sparkContext.defaultParallelism
    for messages in (D.case_messages(spark, tables), D.update_messages(spark, tables)):
        assert messages.rdd.getNumPartitions() >= tasks


def test_digits_are_kept_beside_text_that_begins_like_a_number(spark):
    value = '{"overdueId": "1", "mobile": "2", "loanAmt": 7.50, "balance": "7.50x", "realAmt": " 8", "repayAmt": -1.10, "overdueAmt": "Infinity"}'
    row = parse_cases(spark.createDataFrame([(value,)], "value string"))[0].first()
    assert (row.loanAmt, row.balance, row.realAmt, row.repayAmt, row.overdueAmt) == ("7.50", "7.50x", " 8", "-1.10", "Infinity")


def test_bare_documents_do_not_parse_the_messages_again(spark, tables):
    bare = spark.createDataFrame([(0, '{"baseInfo": {"mobile": "2"}}')], "part bigint, doc string")
    plan = intake_batch(D.case_messages(spark, tables), bare).changes._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation .*o_orderkey", plan)) == 1
