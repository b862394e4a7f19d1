import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casemill.operators.merge import (
    CASE_REPORT,
    case_changes,
    column_changes,
    fold_changes,
    history_merge,
    make_ord,
    replace_merge,
    update_changes,
    update_merge,
)
from casemill.schemas import CASE_FIELDS, CASE_REPORT_COLUMNS, CASE_REPORT_SCHEMA, UPDATE_FIELDS
from helpers import by_key

AS_OF = "2024-06-30"


def cases(spark, rows, start=0):
    """Case records (dicts of fields) with offsets in list order."""
    data = [tuple(r.get(f) for f in CASE_FIELDS) + (start + i, 0) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"`{f}` string" for f in CASE_FIELDS) + ", offset long, partition int")


def updates(spark, rows, start=0):
    data = [tuple(r.get(f) for f in UPDATE_FIELDS) + (start + i, 0) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"`{f}` string" for f in UPDATE_FIELDS) + ", offset long, partition int")


def snapshot(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in CASE_REPORT_COLUMNS) for r in rows], CASE_REPORT_SCHEMA)


def test_close_then_normal_keeps_close_only_columns(spark):
    snap = snapshot(spark, [{"overdue_id": "1", "phone": "p", "balance": "100", "repay_num": "3"}])
    u = updates(spark, [
        {"overdueId": "1", "mobile": "p", "status": "CLOSE", "overdueAmt": "5"},
        {"overdueId": "1", "mobile": "p", "status": "OPEN", "overdueAmt": "7"},
    ])
    out = by_key(fold_changes(update_changes(u, AS_OF), snap), "overdue_id")["1"]
    assert out["remark"] == "OPEN" and out["overdue_amt"] == "7"
    # written by CLOSE only, so the later normal update leaves them
    assert out["balance"] == "0" and out["repay_num"] == "1"
    assert out["collection_type"] == "回收" and out["entrust_end_date"] == AS_OF
    assert out["loan_type"] == "信贷" and out["updated_date"] == AS_OF


def test_normal_then_close(spark):
    snap = snapshot(spark, [{"overdue_id": "1", "balance": "100"}])
    u = updates(spark, [
        {"overdueId": "1", "mobile": "p", "status": "OPEN", "overdueAmt": "7"},
        {"overdueId": "1", "mobile": "p", "status": "CLOSE", "overdueAmt": "9"},
    ])
    out = by_key(fold_changes(update_changes(u, AS_OF), snap), "overdue_id")["1"]
    assert (out["remark"], out["overdue_amt"], out["balance"]) == ("CLOSE", "0", "0")


def test_null_overwrites_and_null_status_is_normal(spark):
    snap = snapshot(spark, [{"overdue_id": "1", "overdue_amt": "old", "remark": "x"}])
    u = updates(spark, [
        {"overdueId": "1", "mobile": "p", "status": "A", "overdueAmt": "3"},
        {"overdueId": "1", "mobile": "p", "status": None, "overdueAmt": None},
    ])
    out = by_key(fold_changes(update_changes(u, AS_OF), snap), "overdue_id")["1"]
    assert out["overdue_amt"] is None and out["remark"] is None
    assert out["balance"] is None  # normal branch never writes balance


def test_update_never_inserts_and_replace_does(spark):
    snap = snapshot(spark, [{"overdue_id": "1"}])
    u = update_changes(updates(spark, [{"overdueId": "2", "mobile": "p", "status": "A"}]), AS_OF)
    assert fold_changes(u, snap).count() == 1
    r = case_changes(cases(spark, [{"overdueId": "3", "mobile": "p", "name": "N"}]))
    out = by_key(fold_changes(r.unionByName(u), snap), "overdue_id")
    assert set(out) == {"1", "3"}


def test_update_before_first_replace_is_lost(spark):
    # batch 0: update for a key nobody has; batch 1: the replace creating it
    u = update_changes(updates(spark, [{"overdueId": "5", "mobile": "p", "status": "A", "overdueDays": "9"}]),
                       AS_OF, batch_id=0)
    r = case_changes(cases(spark, [{"overdueId": "5", "mobile": "p", "overdueDays": "1"}]), batch_id=1)
    out = by_key(fold_changes(u.unionByName(r), None), "overdue_id")["5"]
    assert out["overdue_days"] == "1" and out["loan_type"] is None


def test_replace_after_close_wipes_update_only_columns(spark):
    snap = snapshot(spark, [{"overdue_id": "1", "loan_type": "old", "collection_type": "x", "name": "keep?"}])
    c = update_changes(updates(spark, [{"overdueId": "1", "mobile": "p", "status": "CLOSE"}]), AS_OF, batch_id=0)
    r = case_changes(cases(spark, [{"overdueId": "1", "mobile": "p", "name": "new"}]), batch_id=1)
    out = by_key(fold_changes(c.unionByName(r), snap), "overdue_id")["1"]
    assert out["name"] == "new" and out["loan_type"] is None and out["collection_type"] is None
    assert out["balance"] is None  # the replace carries no balance


def test_replace_keeps_last_message_per_key(spark):
    r = case_changes(cases(spark, [
        {"overdueId": "1", "mobile": "p", "name": "first"},
        {"overdueId": "1", "mobile": "p", "name": "second"},
    ]))
    out = by_key(fold_changes(r, None), "overdue_id")["1"]
    assert out["name"] == "second"


def test_column_changes_and_shape_check(spark):
    snap = snapshot(spark, [{"overdue_id": "1", "address_detail": "a", "call_record_top_ten": "t"}])
    rows = spark.createDataFrame([("1", "new")], "overdue_id string, address_detail string")
    out = by_key(fold_changes(column_changes(rows, ["address_detail"]), snap), "overdue_id")["1"]
    assert out["address_detail"] == "new" and out["call_record_top_ten"] == "t"
    rows2 = spark.createDataFrame([("1", "x")], "overdue_id string, phone string")
    try:
        column_changes(rows2, ["phone"])
    except ValueError:
        pass
    else:
        raise AssertionError("a write splitting a column group must be rejected")
    # generic update_merge declares its own shape
    out = by_key(update_merge(snap, rows2, ["phone"]), "overdue_id")["1"]
    assert out["phone"] == "x" and out["address_detail"] == "a"


def test_replace_merge_and_history(spark):
    target = snapshot(spark, [{"overdue_id": "1", "name": "old", "loan_type": "L"}])
    rows = spark.createDataFrame([("1", "new", 0)], "overdue_id string, name string, offset long")
    out = by_key(replace_merge(target, rows), "overdue_id")["1"]
    assert out["name"] == "new" and out["loan_type"] is None
    h = by_key(history_merge(None, cases(spark, [{"overdueId": "1", "mobile": "p", "address": "addr"}])), "overdueId")
    assert h["1"]["address"] == "" and h["1"]["mobile"] == "p"


# ---------------------------------------------------------------------------
# property: the fold equals applying the changes one by one
# ---------------------------------------------------------------------------

COLS = ["phone", "remark", "balance", "address_detail", "loan_type"]
SHAPES = {
    "R": COLS,
    "U": ["phone", "remark", "loan_type"],
    "C": ["phone", "remark", "balance", "loan_type"],
    "E": ["address_detail"],
}


def apply_one_by_one(snap, changes):
    table = {k: dict(v) for k, v in snap.items()}
    for op, key, _, values in sorted(changes, key=lambda c: c[2]):
        if op == "R":
            table[key] = {c: values.get(c) for c in COLS}
        elif key in table:
            for c in SHAPES[op]:
                table[key][c] = values.get(c)
    return table


change_st = st.tuples(
    st.sampled_from(["R", "U", "C", "E"]),
    st.sampled_from(["k1", "k2", "k3", "k4"]),
    st.dictionaries(st.sampled_from(COLS), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(change_st, max_size=25), st.sets(st.sampled_from(["k1", "k2", "k3"])), st.randoms())
def test_fold_matches_sequential_application(spark, changes, snap_keys, rnd):
    snap = {k: {c: f"s-{k}-{c}" for c in COLS} for k in snap_keys}
    # unique, shuffled order positions spread over batches, topics and partitions
    positions = list(range(len(changes)))
    rnd.shuffle(positions)
    seq = [(op, key, (p // 7, (p // 3) % 2, p, p % 3), vals) for (op, key, vals), p in zip(changes, positions)]
    expected = apply_one_by_one(snap, seq)

    rows = []
    for op, key, ordt, vals in seq:
        written = SHAPES[op]
        rows.append((op, key, ordt[0], ordt[1], ordt[2], ordt[3], CASE_REPORT.mask_of(
            CASE_REPORT_COLUMNS if op == "R" else written),
            *[vals.get(c) if c in written else None for c in COLS]))
    schema = "op string, overdue_id string, b long, t int, o long, p int, mask long, " + ", ".join(f"{c} string" for c in COLS)
    df = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
    df = df.select("op", "overdue_id", make_ord(F.col("b"), 0, F.col("o"), F.col("p")).alias("ord0"),
                   "t", "mask", *COLS)
    df = df.select("op", "overdue_id",
                   F.struct(F.col("ord0.batch_id"), F.col("t").alias("topic_rank"), F.col("ord0.offset"),
                            F.col("ord0.partition")).alias("ord"),
                   "mask", *[F.col(c) for c in COLS],
                   *[F.lit(None).cast("string").alias(c) for c in CASE_REPORT_COLUMNS if c not in COLS + ["overdue_id"]])
    snap_df = snapshot(spark, [dict(v, overdue_id=k) for k, v in snap.items()])
    got = {r["overdue_id"]: {c: r[c] for c in COLS} for r in fold_changes(df, snap_df).collect()}
    assert got == expected


def test_fold_random_large(spark):
    """4,000 random changes over 300 keys, checked against plain Python."""
    rnd = random.Random(7)
    keys = [f"k{i}" for i in range(300)]
    snap = {k: {c: f"s{c}" for c in COLS} for k in keys[:200]}
    seq = []
    for i in range(4000):
        op = rnd.choice("RUCE")
        vals = {c: rnd.choice([None, "x", "y", str(i)]) for c in COLS}
        seq.append((op, rnd.choice(keys), (rnd.randrange(5), rnd.randrange(2), i, 0), vals))
    expected = apply_one_by_one(snap, seq)
    rows = [(op, k, o[0], o[1], o[2], o[3],
             CASE_REPORT.mask_of(CASE_REPORT_COLUMNS if op == "R" else SHAPES[op]),
             *[v.get(c) if c in SHAPES[op] else None for c in COLS]) for op, k, o, v in seq]
    df = spark.createDataFrame(rows, "op string, overdue_id string, b long, t int, o long, p int, mask long, "
                               + ", ".join(f"{c} string" for c in COLS))
    df = df.select("op", "overdue_id",
                   F.struct(F.col("b").alias("batch_id"), F.col("t").alias("topic_rank"),
                            F.col("o").alias("offset"), F.col("p").alias("partition")).alias("ord"),
                   "mask", *COLS,
                   *[F.lit(None).cast("string").alias(c) for c in CASE_REPORT_COLUMNS if c not in COLS + ["overdue_id"]])
    snap_df = snapshot(spark, [dict(v, overdue_id=k) for k, v in snap.items()])
    got = {r["overdue_id"]: {c: r[c] for c in COLS} for r in fold_changes(df, snap_df).collect()}
    assert got == expected


def test_run_date_defaults_to_today(spark):
    import datetime

    snap = snapshot(spark, [{"overdue_id": "1"}])
    u = updates(spark, [{"overdueId": "1", "mobile": "p", "status": "CLOSE"}])
    out = by_key(fold_changes(update_changes(u, None), snap), "overdue_id")["1"]
    today = spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").first()[0]
    assert out["updated_date"] == today and out["entrust_end_date"] == today
    datetime.date.fromisoformat(today)
