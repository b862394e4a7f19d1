"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is first run once on the smallest scale to warm the JVM and the
code-generation cache, then timed at the target scale; every result is fully
materialized (noop sink: all rows and columns computed, nothing collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casemill.plans.catalog import QUERIES  # noqa: E402
from casemill.session import local_session  # noqa: E402

HEADLINE = [
    "case_intake",
    "case_parse",
    "profile_top_ten",
    "enrich_case_full",
    "case_replace",
    "update_fold",
    "change_log_fold",
    "backfill_address_top_ten",
    "missing_ids",
    "extract_cases",
    "ledger_advance",
    "ledger_resolve",
    "stream_update",
]

WARM_DIR = "/root/testdata/sf0.001"


def run(spark, name: str, sf_dir: str) -> float:
    t = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="casemill-bench")
    names = sys.argv[1:] or HEADLINE
    if os.path.isdir(WARM_DIR):
        for n in names:
            run(spark, n, WARM_DIR)
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
