"""Stream = batch, and replay after a lost commit gives the same table."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from casemill.operators.merge import fold_changes
from casemill.plans import derived as D
from casemill.plans.jobs import intake_batch, update_batch
from casemill.schemas import KAFKA_SCHEMA
from casemill.session import scratch_path
from casemill.operators.merge import history_merge
from casemill.operators.parse import parse_cases, split
from casemill.operators.profile import enrich_cases, extract_profile
from casemill.streaming.drivers import (
    StreamPaths,
    compact,
    compact_history,
    current_history,
    current_ledger,
    current_table,
    last_complete_batch,
    prune_log,
    start_intake_stream,
    start_update_stream,
)
from casemill.streaming import drivers
from casemill.plans.replay import Replay, stage_source
from casemill.streaming.drivers import log_backfill, order_of
from casemill.streaming.order import LogMark, Order
from helpers import SF_SMALL

AS_OF = "2024-06-30"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def run(spark, kind, src, paths, profiles=None):
    source = spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    if kind == "intake":
        q = start_intake_stream(source, profiles, paths, "g", AS_OF, trigger={"availableNow": True},
                                write_history=True)
    else:
        q = start_update_stream(source, paths, "g", AS_OF, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_intake_stream_equals_batch_and_replays(spark):
    msgs = D.case_messages(spark, SF_SMALL)
    profiles = D.profiles(spark, SF_SMALL)
    snap = D.existing_cases(spark, SF_SMALL)
    batch = fold_changes(intake_batch(msgs, profiles, AS_OF).changes, snap)

    paths = StreamPaths(scratch_path(spark, "test-intake"))
    src = paths.root + "/source"
    stage_source(spark, msgs, src, files=4)
    run(spark, "intake", src, paths, profiles)
    assert len(glob.glob(paths.changes + "/batch_id=*")) >= 2  # several micro-batches
    expected = rows(batch)
    assert rows(current_table(spark, paths, snap)) == expected
    hist = current_history(spark, paths, None)
    assert rows(hist) == rows(history_merge(None, enrich_cases(parse_cases(msgs)[0], extract_profile(profiles), AS_OF)))

    # compaction: the folded table becomes a snapshot in the shared folder
    compacted, mark = compact(spark, paths, snap, paths.root + "/snapshot")
    assert rows(compacted) == expected
    assert mark == LogMark(len(glob.glob(paths.changes + "/batch_id=*")), ((paths.root, -1),))  # every batch completed
    # after compaction only newer batches are read; there are none, so the snapshot is the table
    assert current_table(spark, paths, compacted, mark) is compacted
    # folding the whole log again over the compacted snapshot changes nothing (idempotent)
    assert rows(current_table(spark, paths, compacted)) == expected

    # lose the last commit marker: the batch runs again and overwrites its own output
    commits = sorted(glob.glob(paths.checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), "." + os.path.basename(commits[-1]) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    run(spark, "intake", src, paths, profiles)
    assert rows(current_table(spark, paths, snap)) == expected

    # ledger: one position per touched partition, next offset to read
    ledger = current_ledger(spark, paths)
    ends = {r["kafka_partition"]: r["kafka_offset"] for r in ledger.collect()}
    want = {r["partition"]: r["m"] + 1 for r in msgs.groupBy("partition").agg({"offset": "max"})
            .withColumnRenamed("max(offset)", "m").collect()}
    assert ends == want


def test_update_stream_equals_batch(spark):
    msgs = D.update_messages(spark, SF_SMALL)
    snap = D.existing_cases(spark, SF_SMALL)
    batch = fold_changes(update_batch(msgs, AS_OF).changes, snap)
    paths = StreamPaths(scratch_path(spark, "test-update"))
    src = paths.root + "/source"
    stage_source(spark, msgs, src, files=3)
    run(spark, "update", src, paths)
    assert rows(current_table(spark, paths, snap)) == rows(batch)
    from casemill.streaming.drivers import read_quarantine
    q = read_quarantine(spark, paths)
    assert {r["reason"] for r in q.collect()} == {"no_phone"}


def test_combined_stream_then_logged_backfill(spark):
    from casemill.operators.backfill import apply_backfill, normalize_ids
    from casemill.operators.merge import case_changes, update_changes
    from casemill.operators.parse import parse_updates
    from casemill.streaming.drivers import start_case_stream

    intake, updates = D.case_messages(spark, SF_SMALL), D.update_messages(spark, SF_SMALL)
    profiles, snap = D.profiles(spark, SF_SMALL), D.existing_cases(spark, SF_SMALL)
    enriched = enrich_cases(parse_cases(intake)[0], extract_profile(profiles), AS_OF)
    batch = fold_changes(case_changes(enriched).unionByName(update_changes(parse_updates(updates)[0], AS_OF)), snap)

    paths = StreamPaths(scratch_path(spark, "test-case-stream"))
    src = paths.root + "/source"
    stage_source(spark, intake.unionByName(updates), src, files=1)
    source = spark.readStream.schema(KAFKA_SCHEMA).parquet(src)
    q = start_case_stream(source, profiles, paths, "g", D.INTAKE_TOPIC, D.UPDATE_TOPIC, AS_OF,
                          trigger={"availableNow": True}, write_history=True)
    q.awaitTermination()
    assert q.exception() is None
    assert rows(current_table(spark, paths, snap)) == rows(batch)
    assert rows(current_history(spark, paths, None)) == rows(history_merge(None, enriched))

    # replay the (only) batch after losing its commit marker: same table, same report
    commits = sorted(glob.glob(paths.checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), "." + os.path.basename(commits[-1]) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    q = start_case_stream(spark.readStream.schema(KAFKA_SCHEMA).parquet(src), profiles, paths, "g",
                          D.INTAKE_TOPIC, D.UPDATE_TOPIC, AS_OF, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    assert rows(current_table(spark, paths, snap)) == rows(batch)

    ids = normalize_ids(D.id_lines(spark, SF_SMALL))
    missing = log_backfill(spark, paths, ids, snap, profiles, ["address_detail", "call_record_top_ten"])
    assert missing.count() > 0
    expected = apply_backfill(ids, batch, profiles, ["address_detail", "call_record_top_ten"])
    assert rows(current_table(spark, paths, snap)) == rows(expected)
    assert [(b.log, b.id, b.place) for b in order_of(spark, paths).complete()] == [("stream", 0, 1), ("backfill", 0, 1)]


def test_intake_stream_from_precomputed_profile_summary(spark):
    msgs, profiles = D.case_messages(spark, SF_SMALL), D.profiles(spark, SF_SMALL)
    snap = D.existing_cases(spark, SF_SMALL)
    paths = StreamPaths(scratch_path(spark, "test-summary"))
    summary_path = paths.root + "/profile_summary"
    extract_profile(profiles).write.parquet(summary_path)  # batch job over the whole profile table
    src = paths.root + "/source"
    stage_source(spark, msgs, src, files=2)
    source = spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_intake_stream(source, None, paths, "g", AS_OF, trigger={"availableNow": True},
                            extracted=spark.read.parquet(summary_path))
    q.awaitTermination()
    assert q.exception() is None
    batch = fold_changes(intake_batch(msgs, profiles, AS_OF).changes, snap)
    assert rows(current_table(spark, paths, snap)) == rows(batch)


# -- the log: nothing is lost and the order needs no clock -------------------

COLS = ["overdue_id", "name", "address_detail"]


def message(k, name, offset, phone="p1"):
    return (None, f'{{"overdueId": "{k}", "mobile": "{phone}", "name": "{name}"}}', "t", 0, offset, None)


def feed(spark, replay, *msgs):
    replay.feed(spark.createDataFrame(list(msgs), KAFKA_SCHEMA))


def make(spark, name):
    paths = StreamPaths(scratch_path(spark, name))
    prof = paths.root + "/profiles"
    write_profile(spark, prof, "p1", "old")
    return paths, prof, Replay(spark, "intake", paths, AS_OF, extracted=lambda s: extract_profile(s.read.parquet(prof)))


def write_profile(spark, folder, phone, address):
    doc = f'{{"mxReport": {{"cell_phone": [{{"key": "address", "value": "{address}"}}]}}}}'
    spark.createDataFrame([(phone, 0, doc)], "phone string, part long, doc string").write.mode("append").parquet(folder)


def table(spark, paths, snap=None, mark=None):
    return {r[0]: (r[1], r[2]) for r in current_table(spark, paths, snap, mark).select(*COLS).collect()}


def fill(spark, paths, address, snap=None, mark=None):
    doc = f'{{"mxReport": {{"cell_phone": [{{"key": "address", "value": "{address}"}}]}}}}'
    prof = spark.createDataFrame([("p1", 0, doc)], "phone string, part long, doc string")
    ids = spark.createDataFrame([("k1",), ("nobody",)], "overdue_id string")
    return [r[0] for r in log_backfill(spark, paths, ids, snap, prof, ["address_detail"], mark).collect()]


def test_batches_after_a_backfill_and_a_compaction_are_kept(spark):
    paths, prof, replay = make(spark, "test-log")
    feed(spark, replay, message("k1", "first", 0))
    assert fill(spark, paths, "filled") == ["nobody"]
    assert table(spark, paths) == {"k1": ("first", "filled")}
    snap, mark = compact(spark, paths, None, paths.root + "/s1", buckets=2, table_name="t_log")
    write_profile(spark, prof, "p2", "new")  # read by the running stream
    feed(spark, replay, message("k1", "second", 1), message("k2", "x", 2, "p2"))
    assert table(spark, paths, snap, mark) == {"k1": ("second", "old"), "k2": ("x", "new")}
    assert fill(spark, paths, "again", snap, mark) == ["nobody"]
    # a second bucketed compaction over the first, and a read of it
    snap, mark = compact(spark, paths, snap, paths.root + "/s2", buckets=2, table_name="t_log", mark=mark)
    assert table(spark, paths, snap, mark) == {"k1": ("second", "again"), "k2": ("x", "new")}
    feed(spark, replay, message("k1", "third", 3))
    assert table(spark, paths, snap, mark)["k1"] == ("third", "old")


def begun(spark, paths, batch):
    order_of(spark, paths).begin(paths.root, batch)


def test_crashed_backfill_and_unfinished_batch(spark, monkeypatch):
    paths, _, replay = make(spark, "test-crash")
    feed(spark, replay, message("k1", "first", 0))

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(Order, "finish_backfill", crash)
        fill(spark, paths, "lost")
    assert table(spark, paths) == {"k1": ("first", "old")}  # it does not exist
    fill(spark, paths, "filled")  # an id of its own
    assert table(spark, paths) == {"k1": ("first", "filled")}
    snap, mark = compact(spark, paths, None, paths.root + "/s1")
    assert mark == LogMark(1, ((paths.root, 1),))
    with pytest.raises(RuntimeError, match="overtaken"):  # the crashed one cannot come to life before the snapshot
        order_of(spark, paths).finish_backfill(paths.root, 0)
    feed(spark, replay, message("k1", "second", 1))
    assert table(spark, paths, snap, mark) == {"k1": ("second", "old")}
    begun(spark, paths, 1)  # a replay of batch 1 has begun
    assert table(spark, paths, snap, mark) == {"k1": ("first", "filled")}
    _, again = compact(spark, paths, snap, paths.root + "/s2", mark=mark)
    assert again.place == 1  # the unfinished batch is not held


def two_roots(spark, name):
    a, b = scratch_path(spark, name + "-a"), scratch_path(spark, name + "-b")
    one, two = StreamPaths(a, beside=(b,)), StreamPaths(b, beside=(a,))
    none = lambda s: extract_profile(s.createDataFrame([], "phone string, part long, doc string"))
    return one, two, Replay(spark, "intake", one, AS_OF, extracted=none), Replay(spark, "intake", two, AS_OF, extracted=none)


def names(spark, paths, snap=None, mark=None):
    return {k: v[0] for k, v in table(spark, paths, snap, mark).items()}


def test_several_roots_fold_in_one_order_and_compact_together(spark):
    """Compacting one of two roots used to bring old values back."""
    a, b, one, two = two_roots(spark, "test-roots")
    feed(spark, two, message("k1", "b-old", 0), message("k2", "b0", 1))
    feed(spark, one, message("k1", "a-new", 100))
    assert names(spark, [a, b]) == names(spark, a) == {"k1": "a-new", "k2": "b0"}
    snap, mark = compact(spark, a, None, a.root + "/s1")  # the roots beside are part of the table
    assert mark.roots == {a.root, b.root} and names(spark, [a, b], snap, mark) == {"k1": "a-new", "k2": "b0"}
    feed(spark, two, message("k1", "b-newer", 2))
    assert names(spark, [a, b], snap, mark) == {"k1": "b-newer", "k2": "b0"}
    feed(spark, one, message("k1", "a-newest", 101))
    assert names(spark, [b, a], snap, mark)["k1"] == "a-newest"
    alone = StreamPaths(a.root)
    with pytest.raises(ValueError, match="does not go with"):
        current_table(spark, alone, snap, mark)
    again, both = compact(spark, [a, b], snap, a.root + "/s2", mark=mark)
    assert names(spark, [a, b], again, both) == {"k1": "a-newest", "k2": "b0"}


def test_order_does_not_follow_the_clock(spark, monkeypatch):
    paths, _, replay = make(spark, "test-clock")
    feed(spark, replay, message("k1", "first", 0))
    import time
    now = time.time_ns
    monkeypatch.setattr(time, "time_ns", lambda: now() - 10_000_000_000)
    monkeypatch.setattr(time, "time", lambda: now() / 1e9 - 10)
    feed(spark, replay, message("k1", "second", 1))
    assert names(spark, paths) == {"k1": "second"}


def test_a_replay_does_not_undo_a_backfill(spark):
    paths, _, replay = make(spark, "test-replay")
    first = spark.createDataFrame([message("k1", "first", 0)], KAFKA_SCHEMA)
    replay.feed(first)
    fill(spark, paths, "filled")
    replay.again(first)
    assert table(spark, paths) == {"k1": ("first", "filled")}
    replay.again(first)  # and once more
    assert table(spark, paths) == {"k1": ("first", "filled")}
    feed(spark, replay, message("k1", "second", 1))
    assert table(spark, paths) == {"k1": ("second", "old")}


def test_concurrent_batches_backfills_and_compactions(spark):
    """The files of the order alone: what one side does between two steps of
    another."""
    a, b = scratch_path(spark, "test-order-a"), scratch_path(spark, "test-order-b")
    order = Order(spark, [a, b])
    keys = lambda mark=None: [(x.root == b, x.log, x.id) for x in order.complete(mark)]
    assert order.begin(a, 0) == 1 and order.begin(b, 0) == 2
    order.finish(b, 0)
    assert keys() == [(True, "stream", 0)]
    # a's batch is unfinished: a backfill reads and stands before it
    assert order.begin_backfill(b) == (0, 0) and order.as_of(0) == []
    order.finish_backfill(b, 0)
    order.finish(a, 0)
    assert keys() == [(True, "backfill", 0), (False, "stream", 0), (True, "stream", 0)]
    # a batch chose its place before it saw a fence there
    seen, late = order._states, Order(spark, [a, b])
    first = iter([seen()])
    mark = order.hold()
    assert mark.place == 2
    late._states = lambda: next(first, None) or seen()
    assert late.begin(a, 1) == 3  # one above all it saw, and above the fence
    late.finish(a, 1)
    stale = seen()
    order.begin(b, 1)
    order.finish(b, 1)  # place 4
    assert order.begin_backfill(a) == (0, 4)
    first = iter([stale])
    assert late.begin(a, 2) == 5  # 4 was free when it looked, but a backfill stands there now
    assert [f for f in (order._state(a).streams, order._state(b).streams)] == [{0: 1, 1: 3, 2: 5}, {0: 2, 1: 4}]
    # a compaction does not hold what is behind an unfinished batch
    order.begin(b, 2)
    order.finish(b, 2)
    mark = order.hold()
    assert mark.place == 4 and keys(mark) == [(True, "stream", 2)]
    with pytest.raises(RuntimeError, match="overtaken"):
        order.finish_backfill(a, 0)


def test_pruned_log(spark):
    paths, prof, replay = make(spark, "test-prune")
    source = paths.root + "/source"
    for k in range(4):
        feed(spark, replay, message(f"k{k}", f"n{k}", 10 * k), message("k0", f"n0-{k}", 10 * k + 1))
    fill(spark, paths, "filled")
    before, ledger = table(spark, paths), rows(current_ledger(spark, paths))
    snap, mark = compact(spark, paths, None, paths.root + "/s1")
    removed = prune_log(spark, paths, mark)
    assert {os.path.relpath(r, paths.root) for r in removed} == {
        "changes/batch_id=0", "changes/batch_id=1", "ledger/batch_id=0", "ledger/batch_id=1", "backfills/batch_id=0"}
    assert table(spark, paths, snap, mark) == before and rows(current_ledger(spark, paths)) == ledger
    replay.again(spark.createDataFrame([message("k3", "n3", 30), message("k0", "n0-3", 31)], KAFKA_SCHEMA))
    assert table(spark, paths, snap, mark) == before and rows(current_ledger(spark, paths)) == ledger
    feed(spark, replay, message("k1", "late", 50))
    assert table(spark, paths, snap, mark) == before | {"k1": ("late", "old")}
    assert fill(spark, paths, "more", snap, mark) == ["nobody"] and os.path.isdir(source)
    assert table(spark, paths, snap, mark)["k1"] == ("late", "more")


def test_history_and_changes_by_one_mark(spark):
    paths = StreamPaths(scratch_path(spark, "test-history"))
    none = spark.createDataFrame([], "phone string, part long, doc string")
    handle = drivers.handler("intake", paths, "g", AS_OF, none, write_history=True)
    give = lambda b, *m: handle(spark.createDataFrame(list(m), KAFKA_SCHEMA), b)
    old = spark.createDataFrame([("k0", "kept"), ("k1", "gone")], "overdueId string, name string")
    from casemill.operators.merge import CASE_HISTORY
    old = old.select(*[F.col(c) if c in old.columns else F.lit(None).cast("string").alias(c) for c in CASE_HISTORY.columns])
    give(0, message("k1", "first", 0))
    give(1, message("k2", "second", 1))
    names_of = lambda df: {r.overdueId: r.name for r in df.select("overdueId", "name").collect()}
    snap, mark = compact(spark, paths, None, paths.root + "/s1")
    hist = compact_history(spark, paths, old, paths.root + "/h1", mark)
    assert names_of(hist) == {"k0": "kept", "k1": "first", "k2": "second"}
    give(2, message("k2", "third", 2))
    prune_log(spark, paths, mark)
    assert names_of(current_history(spark, paths, hist, mark)) == {"k0": "kept", "k1": "first", "k2": "third"}
    assert names(spark, paths, snap, mark) == {"k1": "first", "k2": "third"}


def test_empty_log_and_unknown_topics(spark):
    paths = StreamPaths(scratch_path(spark, "test-empty"))
    assert current_table(spark, paths, None).count() == 0
    snap, mark = compact(spark, paths, None, paths.root + "/s")
    assert snap.count() == 0 and mark == LogMark(0, ((paths.root, -1),))
    replay = Replay(spark, "cases", paths, AS_OF, extracted=lambda s: extract_profile(
        s.createDataFrame([], "phone string, part long, doc string")), intake_topic="t", update_topic="u")
    odd = (None, "{}", "else", 0, 7, None)
    feed(spark, replay, message("k1", "n", 0), odd, (None, "x", None, 0, 8, None))
    q = drivers.read_quarantine(spark, paths).collect()
    assert sorted((r.reason, r.offset) for r in q) == [("unknown_topic", 7), ("unknown_topic", 8)]
    # an empty batch writes nothing
    handle = drivers._handler("intake", paths, "g", AS_OF, None, True)
    handle(spark.createDataFrame([], KAFKA_SCHEMA), 99)
    assert last_complete_batch(spark, paths) == 0


def mixed_messages(spark):
    """Both topics in one batch: amounts as JSON numbers and strings, bad text, no phone, no key, an unknown topic."""
    case = ['{"overdueId": "1", "mobile": "p", "name": "n", "loanAmt": 7.50, "overdueAmt": "7"}', "not json", "", "null",
            '{"overdueId": "2", "name": "n"}', '{"mobile": "p"}', '{"overdueId": "3", "mobile": "p", "overdueAmt": 1.10, "interestRate": 0.10}']
    update = ['{"overdueId": "1", "mobile": "p", "overdueAmt": 2.50, "status": "CLOSE"}', "{", '{"overdueId": "1"}',
              '{"overdueId": "3", "mobile": "p", "overdueAmt": "2", "loanAmt": 3.50, "name": "no field of updates"}']
    rows = [(None, v, t, 0, i, None) for t, values in (("i", case), ("u", update), ("x", ["other"]), (None, ["none"])) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_a_kept_batch_holds_the_text_of_quarantined_messages_alone(spark, monkeypatch):
    """Parsed rows are kept for the sinks, the text of usable messages is not."""
    held = []

    def watched(classified):
        held.append(classified.where("reason IS NULL AND value IS NOT NULL").count())
        return split(classified)

    monkeypatch.setattr(drivers, "split", watched)
    for kind in ("intake", "update", "cases"):
        paths = StreamPaths(scratch_path(spark, f"test-kept-{kind}"))
        none = lambda s: extract_profile(s.createDataFrame([], "phone string, part bigint, doc string"))
        drivers.handler(kind, paths, "g", AS_OF, extracted=none, topics=("i", "u"))(mixed_messages(spark), 0)
        bad = drivers.read_quarantine(spark, paths).where("reason = 'corrupt'").select("value").distinct()
        assert {"not json", "{"} <= {r[0] for r in bad.collect()}
    assert held == [0, 0, 0]


def test_both_topics_in_one_batch_equal_two_streams(spark):
    """Each message is parsed once by the fields of both kinds, with the same
    changes and quarantine as by those of its own kind."""
    none = lambda s: extract_profile(s.createDataFrame([], "phone string, part bigint, doc string"))
    messages, roots = mixed_messages(spark), {}
    for kind, topic in (("cases", None), ("intake", "i"), ("update", "u")):
        roots[kind] = StreamPaths(scratch_path(spark, f"test-both-{kind}"))
        batch = messages if topic is None else messages.where(F.col("topic") == topic)
        drivers.handler(kind, roots[kind], "g", AS_OF, extracted=none, topics=("i", "u"))(batch, 0)
    read = lambda kind, folder: [tuple(r) for r in spark.read.parquet(f"{roots[kind].root}/{folder}/batch_id=0").collect()]
    assert sorted(read("cases", "changes"), key=str) == sorted(read("intake", "changes") + read("update", "changes"), key=str)
    others = [("unknown_topic", "other", "x", 0, 0), ("unknown_topic", "none", None, 0, 0)]
    assert sorted(read("cases", "report"), key=str) == sorted(read("intake", "report") + read("update", "report") + others, key=str)
    assert {r.topic: r.kafka_offset for r in current_ledger(spark, roots["cases"]).collect()} == {"i": 7, "u": 4, "x": 1, None: 1}
