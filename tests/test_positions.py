"""Position audit and the rate cap of a running stream."""

import random
import time

import pytest
from casemill.operators.positions import audit_positions
from casemill.schemas import KAFKA_SCHEMA
from casemill.session import scratch_path
from casemill.sources.kafka import file_source

SCHEMA = "topic string, partition int, offset long"


def spans(rows):
    """Lost and repeated runs by a walk over sorted offsets."""
    out, places = [], {}
    for t, p, o in rows:
        if None not in (t, p, o):
            places.setdefault((t, p), {}).setdefault(o, 0)
            places[t, p][o] += 1
    for (t, p), seen in places.items():
        last, run = None, None
        for o in sorted(seen):
            if last is not None and o - last > 1:
                out.append((t, p, "lost", last + 1, o - 1, 0))
            last = o
            if seen[o] > 1 and run and run[1] == o - 1:
                run = (run[0], o, run[2] + seen[o])
                continue
            out += [(t, p, "repeated", *run)] if run and (seen[o] > 1) else []
            run = (o, o, seen[o]) if seen[o] > 1 else run
        out += [(t, p, "repeated", *run)] if run else []
    return sorted(out)


@pytest.mark.parametrize("span", [1, 2, 7, 50, 10_000])
def test_spans_do_not_depend_on_the_ranges(spark, span):
    r = random.Random(span)
    rows = [("t", 0, o) for o in range(400) if r.random() < 0.9 for _ in range(r.choice([1, 1, 2, 3]))]  # hot
    rows += [("t", 1, o) for o in range(-20, 60) for _ in range(2)] + [("u", 1, 5), ("u", 1, 900), ("u", 2, 1 << 40)]
    rows += [("t", 0, None), (None, 0, 3), ("t", None, 3)]
    got = sorted(tuple(x) for x in audit_positions(spark.createDataFrame(rows, SCHEMA), span).collect())
    assert got == spans(rows) and ("u", 1, "lost", 6, 899, 0) in got and ("t", 1, "repeated", -20, 59, 160) in got
    assert audit_positions(spark.createDataFrame([], SCHEMA), span).collect() == []


def test_running_stream_keeps_its_rate_cap(spark):
    """A real trigger interval: no batch takes more files than the cap, all
    rows arrive, and batches are an interval apart."""
    folder = scratch_path(spark, "test-cap")
    rows = [(None, f"m{i}", "t", 0, i, None) for i in range(60)]
    for k in range(6):
        spark.createDataFrame(rows[10 * k : 10 * k + 10], KAFKA_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    got = []
    query = (file_source(spark, folder, max_files_per_trigger=2).writeStream.foreachBatch(lambda df, i: got.append((time.time(), df.count())))
             .option("checkpointLocation", scratch_path(spark, "test-cap-checkpoint")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while sum(n for _, n in got) < 60 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [n for _, n in got] == [20, 20, 20]
    assert all(b - a > 0.5 for (a, _), (b, _) in zip(got, got[1:]))
