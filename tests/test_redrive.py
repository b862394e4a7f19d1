"""Corrected messages at the places of the quarantined ones."""

import os

import pytest

from casemill.schemas import KAFKA_SCHEMA
from casemill.session import scratch_path
from casemill.streaming import drivers
from casemill.streaming.drivers import StreamPaths, compact, compact_parts, current_history, current_table, order_of, parted_snapshot, prune_log, snapshot_mark
from casemill.streaming.order import Order
from casemill.streaming.redrive import one_each, open_quarantine, redrive

AS_OF = "2024-06-30"
CORRECTION = "topic string, partition int, offset long, value string, version int"


def case(k, name):
    return f'{{"overdueId": "{k}", "mobile": "p1", "name": "{name}"}}'


def update(k, days):
    return f'{{"overdueId": "{k}", "mobile": "p1", "overdueDays": "{days}"}}'


def make(spark, name):
    """A stream of both topics: `give(batch, (topic, offset, value)...)`."""
    paths = StreamPaths(scratch_path(spark, name))
    none = spark.createDataFrame([], "phone string, part long, doc string")
    handle = drivers.handler("cases", paths, "g", AS_OF, none, write_history=True, topics=("in", "up"))

    def give(batch, *messages):
        handle(spark.createDataFrame([(None, v, t, 0, o, None) for t, o, v in messages], KAFKA_SCHEMA), batch)

    def mend(*rows):
        sent = spark.createDataFrame([(t, 0, o, v, n) for t, o, v, n in [(*r, 0)[:4] for r in rows]], CORRECTION)
        out = redrive(spark, paths, sent, "in", "up", AS_OF, none, write_history=True)
        return {(r.topic, r.offset): r.reason for r in out.collect()}

    return paths, give, mend


def table(spark, paths, snap=None, mark=None):
    return {r[0]: (r[1], r[2]) for r in current_table(spark, paths, snap, mark).select("overdue_id", "name", "overdue_days").collect()}


def test_corrected_messages_stand_where_the_bad_ones_stood(spark):
    paths, give, mend = make(spark, "test-redrive")
    give(0, ("in", 0, "{bad"), ("in", 1, "{bad"), ("up", 0, "{bad"), ("up", 1, update("k3", 7)), ("in", 2, "{bad"))
    give(1, ("in", 5, case("k1", "later")), ("in", 6, case("k2", "later")), ("in", 7, ""), ("other", 3, "x"))
    assert table(spark, paths) == {"k1": ("later", None), "k2": ("later", None)}
    before = open_quarantine(spark, paths).count()
    assert mend(("in", 0, case("k1", "early")),  # loses to the later replace
                ("in", 1, case("k3", "inserted")),  # now the update of its batch applies to it
                ("up", 0, update("k2", 9)),  # wiped by the later replace
                ("in", 2, '{"overdueId": "k4"}'),  # still bad
                ("in", 6, case("k2", "never")), ("in", 99, "{}"),  # were not quarantined
                ("other", 3, "y"), (None, 0, "y")) == {
        ("in", 2): "no_phone", ("in", 6): "not_quarantined", ("in", 99): "not_quarantined",
        ("other", 3): "unknown_topic", (None, 0): "not_quarantined"}
    now = {"k1": ("later", None), "k2": ("later", None), "k3": ("inserted", "7")}
    assert table(spark, paths) == now and before - open_quarantine(spark, paths).count() == 3
    names = {r.overdueId: r.name for r in current_history(spark, paths, None).collect()}
    assert names == {k: v[0] for k, v in now.items()}
    # once each; one that was still bad may come again, one behind a message of its own batch stays behind it
    assert mend(("in", 0, case("k1", "twice")), ("in", 2, case("k3", "last"), 1), ("in", 2, case("k3", "old"), 0),
                ("in", 7, case("k5", "new"))) == {("in", 0): "redriven"}
    assert table(spark, paths) == now | {"k3": ("last", "7"), "k5": ("new", None)}
    give(0, ("in", 0, "{bad"), ("in", 1, "{bad"), ("up", 0, "{bad"), ("up", 1, update("k3", 7)), ("in", 2, "{bad"))  # a replay
    assert table(spark, paths) == now | {"k3": ("last", "7"), "k5": ("new", None)}


def test_crashed_and_overtaken_redrives_and_compaction(spark, monkeypatch):
    paths, give, mend = make(spark, "test-redrive-crash")
    give(0, ("in", 0, "{bad"), ("in", 1, "{bad"), ("in", 2, "{bad"))

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(Order, "finish_redrive", crash)
        mend(("in", 0, case("k0", "lost")))
    assert table(spark, paths) == {}
    assert mend(("in", 0, case("k0", "kept"))) == {}
    with pytest.raises(RuntimeError, match="overtaken"):  # by the second one
        order_of(spark, paths).finish_redrive(paths.root, 0)
    number, _, done = order_of(spark, paths).begin_redrive(paths.root)
    assert (number, done) == (2, {1})
    snap, mark = compact(spark, paths, None, paths.root + "/s1")
    with pytest.raises(RuntimeError, match="overtaken"):  # by the compaction
        order_of(spark, paths).finish_redrive(paths.root, number)
    assert table(spark, paths, snap, mark) == {"k0": ("kept", None)}
    give(1, ("in", 10, "{bad"))
    assert mend(("in", 1, case("k1", "late")), ("in", 10, case("k10", "new"))) == {("in", 1): "closed"}
    assert table(spark, paths, snap, mark) == {"k0": ("kept", None), "k10": ("new", None)}
    give(2, ("in", 20, case("k20", "x")))
    give(3, ("in", 30, case("k30", "x")))
    snap, mark = compact(spark, paths, snap, paths.root + "/s2", mark=mark)
    prune_log(spark, paths, mark)
    left = [d for r in os.listdir(paths.redriven) for d in os.listdir(f"{paths.redriven}/{r}") if d.startswith("batch_id")]
    assert left == [] and set(table(spark, paths, snap, mark)) == {"k0", "k10", "k20", "k30"}


def test_redriven_messages_reach_the_parts_they_touch(spark):
    paths, give, mend = make(spark, "test-redrive-parts")
    snapshot = parted_snapshot(spark, paths.root + "/snapshot", parts=4)
    give(0, ("in", 0, "{bad"), ("in", 1, case("k1", "x")))
    assert mend(("in", 0, case("k0", "added"))) == {}
    compact_parts(spark, paths, snapshot)
    assert table(spark, paths, snapshot.read(), snapshot_mark(snapshot)) == {"k0": ("added", None), "k1": ("x", None)}


def test_one_value_per_position_and_nothing_to_do(spark):
    rows = [("t", 0, 1, "b", 1), ("t", 0, 1, "a", 1), ("t", 0, 1, "z", 0), ("t", 0, 2, None, None), ("t", 0, 2, "x", None)] * 2
    one = one_each(spark.createDataFrame(rows, CORRECTION))
    assert sorted(tuple(r) for r in one.collect()) == [("t", 0, 1, "b"), ("t", 0, 2, "x")]
    paths = StreamPaths(scratch_path(spark, "test-redrive-none"))
    assert open_quarantine(spark, paths) is None
    none = spark.createDataFrame([], CORRECTION)
    assert redrive(spark, paths, none, update_topic="up").collect() == []
    with pytest.raises(ValueError):
        redrive(spark, paths, none)
