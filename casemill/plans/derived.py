"""Inputs derived from the driver tables (messages, profiles, cases, ids).

Each builder reads the given parquet tables and derives the pipeline's input
shapes with plain DataFrame operations over every row, so their size grows
with the tables.  Ids of the other branch (cases that only messages know, or
only the table knows) carry a letter in front; no row is left out.  A phone's
profile spans documents of at most `PROFILE_BLOCK` event ids; what is
extracted does not depend on that block, because counts are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators.merge import CASE_HISTORY, CASE_REPORT
from casemill.schemas import CASE_FIELDS, UPDATE_FIELDS
from casemill.sources.files import hadoop
from casemill.sources.tables import read_table

INTAKE_TOPIC = "case_increment"
UPDATE_TOPIC = "case_update"
INTAKE_GROUP = "case_increment"
UPDATE_GROUP = "case_update"
PROFILE_BLOCK = 500
DEALT_BYTES = 1 << 20  # of a table's file per task that makes messages of its rows
AS_OF = "2024-06-30"


def _s(c) -> F.Column:
    return c.cast("string")


def case_id(custkey: F.Column) -> F.Column:
    """Case id of a customer's messages; a fifth of the customers have cases
    that the case table does not know yet."""
    return F.when(custkey % 5 == 0, F.concat(F.lit("N"), _s(custkey))).otherwise(_s(custkey))


def _filler(fields: list[str], given: dict[str, F.Column], key: F.Column) -> F.Column:
    """A record of all `fields`: the given ones, and in the others their name
    with the key's remainder by the length of the name plus three."""
    rest = lambda f: F.concat(F.lit(f"{f}-"), _s(key % (len(f) + 3)))
    return F.struct(*[given.get(f, rest(f)).alias(f) for f in fields])


def _dealt(rows: DataFrame, table: str, key: str) -> DataFrame:
    """Narrow `rows` of a table dealt over tasks by `key`, a task for every
    `DEALT_BYTES` of its file: a message is much larger than the row it is made
    of, and takes long to write and to read, while one task may scan a whole
    file of them."""
    spark = rows.sparkSession
    fs, at = hadoop(spark, table)
    n = max(spark.sparkContext.defaultParallelism, -(-fs.getContentSummary(at).getLength() // DEALT_BYTES))
    return rows.repartition(n, key)


def _case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "c_name", "c_mktsegment")
    rows = _dealt(rows, f"{sf_dir}/orders.parquet", "o_orderkey")
    # columns of their own: with all remainders inside, the expression of a
    # message's text is compiled into a method too large for the JIT
    rests = sorted({len(f) + 3 for f in CASE_FIELDS})
    return rows.select("*", *[_s(F.col("o_orderkey") % n).alias(f"rest_{n}") for n in rests])


def _json_text(field: str, value: F.Column, plain: bool = False) -> F.Column:
    """`,"field":"value"`, empty for a null as `to_json` leaves it out; a
    `plain` value holds nothing that JSON escapes."""
    if plain:
        return F.coalesce(F.concat(F.lit(f',"{field}":"'), value, F.lit('"')), F.lit(""))
    text = F.to_json(F.struct(value.alias(field)))
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(","), text.substr(F.lit(2), F.length(text) - 2)))


def _case_text(mobile: F.Column) -> F.Column:
    """The JSON of a case message; a quarter of them send an amount as a JSON
    number, as 7.50.  It is what `to_json` writes for a record of all fields in
    which the given ones have their values and the others their name with the
    key's remainder by the length of the name plus three: put together as text,
    as a record that wide is slow to write."""
    key = F.col("o_orderkey")
    as_number = (key % 4 == 3) & mobile.isNotNull()
    given = {
        "overdueId": _json_text("overdueId", case_id(F.col("o_custkey")), plain=True),
        "mobile": _json_text("mobile", mobile, plain=True),
        "name": _json_text("name", F.col("c_name")),
        "productName": _json_text("productName", F.col("o_orderpriority")),
        "status": _json_text("status", F.col("o_orderstatus")),
        "address2": _json_text("address2", F.col("c_mktsegment")),
        "loanDate": _json_text("loanDate", F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"), plain=True),
        "seqNo": _json_text("seqNo", _s(key), plain=True),
        "loanAmt": F.when(as_number, F.concat(F.lit(',"loanAmt": '), _s(key), F.lit(".50"))).otherwise(
            F.concat(F.lit(',"loanAmt":"loanAmt-'), _s(key % 10), F.lit('"'))),
    }
    pieces, text = [], "{"  # `text`: the constant part that comes next
    for f in CASE_FIELDS:
        if f in given:
            pieces += [F.lit(text), given[f]]
            text = ""
        else:
            pieces += [F.lit(text + ("" if f == CASE_FIELDS[0] else ",") + f'"{f}":"{f}-'), F.col(f"rest_{len(f) + 3}")]
            text = '"'
    return F.concat(*pieces, F.lit(text + "}"))


def case_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1: Kafka-shaped case messages from orders x customer."""
    d = _case_rows(spark, sf_dir)
    mobile = F.when(F.col("o_orderkey") % 37 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("o_custkey") % 200))
    value = (F.when(F.col("o_orderkey") % 50 == 0, F.lit("not json"))
             .when(F.col("o_orderkey") % 50 == 1, F.lit(""))
             .otherwise(_case_text(mobile)))
    return d.select(
        case_id(F.col("o_custkey")).alias("key"),
        value.alias("value"),
        F.lit(INTAKE_TOPIC).alias("topic"),
        (F.col("o_custkey") % 4).cast("int").alias("partition"),
        F.col("o_orderkey").cast("bigint").alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def case_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected values of D1's messages that are not JSON or lack a phone, at
    the positions these have."""
    k = F.col("o_orderkey")
    bad = _case_rows(spark, sf_dir).where((k % 50 == 0) | ((k % 37 == 0) & (k % 50 != 1)))
    return bad.select(F.lit(INTAKE_TOPIC).alias("topic"), (F.col("o_custkey") % 4).cast("int").alias("partition"),
                      k.cast("bigint").alias("offset"), _case_text(_s(F.col("o_custkey") % 200)).alias("value"))


def update_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2: Kafka-shaped update messages from events."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    e = _dealt(e, f"{sf_dir}/events.parquet", "event_id")
    mobile = F.when(F.col("event_id") % 41 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("user_id")))
    status = (F.when(F.col("event_type") == "purchase", F.lit("CLOSE"))
              .when(F.col("event_type") == "error", F.lit(None).cast("string"))
              .otherwise(F.col("event_type")))
    rec = _filler(UPDATE_FIELDS, {
        "mobile": mobile,
        "overdueDays": _s(F.col("event_id") % 90),
        "overdueId": _s(F.col("user_id")),
        "seqNo": _s(F.col("event_id")),
        "status": status,
    }, F.col("event_id"))
    return e.select(
        _s(F.col("user_id")).alias("key"),
        F.to_json(rec).alias("value"),
        F.lit(UPDATE_TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def profiles(spark: SparkSession, sf_dir: str, block: int = PROFILE_BLOCK) -> DataFrame:
    """D3: profile documents `(phone, part, doc)` from events.

    One document per (user, block of event ids): contact counts per `props.k`
    within the block, and one cell_phone / user_basic entry per event in
    event order (`signup` / `view` events carry the `address` key).
    """
    e = read_table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type",
        F.get_json_object("props", "$.k").alias("k"),
        F.floor(F.col("event_id") / block).cast("bigint").alias("part"),
    )
    # one shuffle: each document's events (at most `block` of them) gathered
    # in event order; the per-peer counts are taken inside that bounded array
    docs = e.groupBy("user_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "event_type", "k"))).alias("ev"))
    peers = F.array_sort(F.array_distinct(F.transform("ev", lambda x: x["k"])))
    contacts = F.transform(peers, lambda p: F.struct(
        p.alias("peer_num"),
        _s(F.size(F.filter("ev", lambda x: x["k"].eqNullSafe(p)))).alias("call_cnt_6m")))
    value = lambda x: F.concat(F.lit("addr-"), _s(x["event_id"]))
    cell = F.transform("ev", lambda x: F.struct(
        F.when(x["event_type"] == "signup", F.lit("address")).otherwise(x["event_type"]).alias("key"),
        value(x).alias("value")))
    basic = F.transform("ev", lambda x: F.struct(
        F.when(x["event_type"] == "view", F.lit("address")).otherwise(x["event_type"]).alias("key"),
        value(x).alias("value")))
    doc = F.to_json(F.struct(
        F.struct(_s(F.col("user_id")).alias("mobile")).alias("baseInfo"),
        F.struct(contacts.alias("call_contact_detail"), cell.alias("cell_phone"), basic.alias("user_basic")).alias("mxReport"),
    ))
    return docs.select(_s(F.col("user_id")).alias("phone"), "part", doc.alias("doc"))


def undeclared_profiles(spark: SparkSession, sf_dir: str, block: int = PROFILE_BLOCK) -> DataFrame:
    """Documents with what `profiles` says, every second user's in another
    shape: contacts as an object of counts, one entry instead of a list of
    them, the phone as a number, and a field that nobody declared."""
    e = read_table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"),
        F.floor(F.col("event_id") / block).cast("bigint").alias("part"))
    peers = e.groupBy("user_id", "part", "k").agg(F.count(F.lit(1)).alias("n"), *[
        F.min(F.when(F.col("event_type") == kind, F.col("event_id"))).alias(kind) for kind in ("signup", "view")])
    docs = peers.groupBy("user_id", "part").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "n"))))).alias("counts"),
        F.min("signup").alias("signup"), F.min("view").alias("view"))
    entry = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        F.lit("address").alias("key"), F.concat(F.lit("addr-"), _s(F.col(c))).alias("value")))
    other = F.to_json(F.struct(
        F.struct(F.col("user_id").alias("mobile"), F.lit("2").alias("version")).alias("baseInfo"),
        F.struct(F.col("counts").alias("call_contact_detail"), entry("signup").alias("cell_phone"), entry("view").alias("user_basic")).alias("mxReport")))
    mine = docs.where(F.col("user_id") % 2 == 1).select(_s(F.col("user_id")).alias("phone"), "part", other.alias("doc"))
    return profiles(spark, sf_dir, block).where(F.col("phone").cast("bigint") % 2 == 0).unionByName(mine)


def consumed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of messages as consumers saw them: a hot partition with two
    thirds of all events, blocks of offsets; errors were never seen, purchases
    and every event of some blocks twice."""
    e = read_table(spark, sf_dir, "events").where("event_type <> 'error'")
    block = F.floor(F.col("event_id") / 500)
    twice = (F.col("event_type") == "purchase") | (block % 7 == 0)
    return e.select(
        F.lit(UPDATE_TOPIC).alias("topic"),
        F.when(block % 3 < 2, F.lit(0)).otherwise(F.lit(1)).alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def odd_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile documents of every customer, four of five unusable: not JSON,
    empty, without a report, with a null report."""
    c = read_table(spark, sf_dir, "customer")
    good = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.lit("address").alias("key"), F.col("c_mktsegment").alias("value"))).alias("cell_phone")).alias("mxReport")))
    kind = F.col("c_custkey") % 5
    doc = (F.when(kind == 0, good).when(kind == 1, F.lit('{"mxReport": {')).when(kind == 2, F.lit(""))
           .when(kind == 3, F.lit("{}")).otherwise(F.lit('{"mxReport": null}')))
    return c.select(_s(F.col("c_custkey")).alias("phone"), doc.alias("doc"))


def existing_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4: case_report snapshot from customer; a third of the customers are
    known by ids that no message and no id list carries."""
    c = read_table(spark, sf_dir, "customer")
    given = {
        "overdue_id": "CASE WHEN c_custkey % 3 = 0 THEN concat('X', c_custkey) ELSE CAST(c_custkey AS STRING) END",
        "phone": "CAST(c_custkey % 200 AS STRING)",
        "remark": "c_mktsegment",
        "balance": "'9'",
        "loan_type": "'old'",
    }
    return c.selectExpr(*[f"{given.get(col, 'CAST(NULL AS STRING)')} AS `{col}`" for col in CASE_REPORT.columns])


def existing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_history snapshot from customer; a third of the customers are known
    by ids that no message carries."""
    c = read_table(spark, sf_dir, "customer")
    given = {
        "overdueId": "CASE WHEN c_custkey % 3 = 0 THEN concat('H', c_custkey) ELSE CAST(c_custkey AS STRING) END",
        "name": "c_name",
        "address": "'held'",
        "status": "c_mktsegment",
    }
    return c.selectExpr(*[f"{given.get(col, 'CAST(NULL AS STRING)')} AS `{col}`" for col in CASE_HISTORY.columns])


def uneven_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a number and a string whose values crowd at the low end, both
    null in every eleventh row."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", F.when(k % 11 != 0, F.col("o_custkey") * F.col("o_custkey") * F.col("o_custkey")).alias("steep"),
                    F.when(k % 11 != 0, F.concat(F.lit("case-"), _s(F.col("o_custkey")))).alias("label"))


def id_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5: id-list lines (`value`): ids, padded repeats, blanks, unknown ids."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    base = c.where(k % 7 == 0).select(_s(k).alias("value"))
    repeats = c.where(k % 14 == 0).select(F.concat(F.lit(" "), _s(k), F.lit(" ")).alias("value"))
    blanks = c.where(k % 49 == 0).select(F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("   ")).alias("value"))
    unknown = c.where(k % 70 == 0).select(F.concat(F.lit("900000000000"), _s(k)).alias("value"))
    return base.unionByName(repeats).unionByName(blanks).unionByName(unknown)


def increment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_increment rows (several per case) from orders."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        _s(F.col("o_custkey")).alias("overdueId"),
        F.col("o_orderpriority").alias("address"),
        _s(F.col("o_orderkey")).alias("callRecordTopTen"),
    )


def _partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First offset and next offset per D2 partition, from the position
    columns alone (same definitions as `update_messages`)."""
    e = read_table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 3).cast("int").alias("partition")).agg(
        F.min("event_id").alias("first"), (F.max("event_id") + 1).alias("end"),
    ).withColumn("topic", F.lit(UPDATE_TOPIC))


def _ledger_rows(b: DataFrame, specs) -> DataFrame:
    """Ledger rows from the bounds in one pass: `specs` are
    (group, topic column, offset column, keep condition)."""
    rows = F.inline(F.array(*[
        F.struct(F.lit(g).alias("groupid"), t.alias("topic"), F.col("partition").cast("int").alias("kafka_partition"),
                 F.col(off).cast("bigint").alias("kafka_offset"), keep.alias("keep"))
        for g, t, off, keep in specs
    ]))
    return b.select(rows).where("keep").drop("keep")


def stale_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger before an advance: stale positions (first offsets) of partitions
    0 and 1 for the update group, and the intake group's position."""
    p = F.col("partition")
    return _ledger_rows(_partition_bounds(spark, sf_dir), [
        (UPDATE_GROUP, F.col("topic"), "first", p < 2),
        (INTAKE_GROUP, F.lit(INTAKE_TOPIC), "first", p == 0),
    ])


def resume_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 ledger: end positions of partitions 0 and 1 for the update group,
    plus rows of another topic and another group that must be ignored."""
    p = F.col("partition")
    return _ledger_rows(_partition_bounds(spark, sf_dir), [
        (UPDATE_GROUP, F.col("topic"), "end", p < 2),
        (UPDATE_GROUP, F.lit(INTAKE_TOPIC), "end", p == 2),
        (INTAKE_GROUP, F.col("topic"), "end", p == 2),
    ])


def earliest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 earliest offsets: partition 1 was trimmed to one past its stored
    position; the others still start at their first offset."""
    b = _partition_bounds(spark, sf_dir)
    return b.select("topic", "partition",
                    F.when(F.col("partition") == 1, F.col("end") + 1).otherwise(F.col("first")).alias("earliest_offset"))
