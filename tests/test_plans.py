"""Plan-shape checks: pushdown, pruning, shuffles that should not be there."""

import re

from casemill.operators.merge import case_changes, fold_changes
from casemill.operators.parse import parse_cases
from casemill.plans import derived as D
from casemill.plans.catalog import QUERIES
from casemill.session import scratch_path
from helpers import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fold_against_bucketed_snapshot_shuffles_only_the_changes(spark):
    path = scratch_path(spark, "bucketed-snapshot")
    (D.existing_cases(spark, SF_SMALL).write.format("parquet").option("path", path)
     .bucketBy(8, "overdue_id").sortBy("overdue_id").saveAsTable("snap_bucketed_test"))
    snap = spark.table("snap_bucketed_test")
    ch = case_changes(parse_cases(D.case_messages(spark, SF_SMALL))[0])
    p = plan(fold_changes(ch, snap))
    assert len(re.findall(r"Exchange hashpartitioning\(overdue_id", p)) == 1


def test_partial_aggregation_before_fold_shuffle(spark):
    p = plan(QUERIES["update_fold"](spark, SF_SMALL))
    # the fold aggregate runs once before and once after the key exchange
    agg = [m.start() for m in re.finditer(r"SortAggregate|HashAggregate", p)]
    ex = re.search(r"Exchange hashpartitioning\(overdue_id", p[agg[0]:]).start() + agg[0]
    assert len(agg) >= 2 and agg[0] < ex < agg[-1]


def test_scans_are_pruned(spark):
    p = plan(QUERIES["update_fold"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<event_id:bigint,user_id:bigint,event_type:string>" in schemas
    assert all("c_name" not in s and "c_acctbal" not in s for s in schemas)
