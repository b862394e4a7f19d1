"""Audit of consumed positions: which offsets of a partition are missing, and
which came more than once.

Offsets of a partition are looked at in ranges of `span`; no window goes over a
whole partition.  A gap lies inside a range, or between the last offset of a
range and the first of the next one that has any: for those, one row per range
is ordered.  A run of repeated offsets that touches the border of its range is
joined with the run that goes on behind it: at most two runs a range do, and only
these are ordered over the ranges.  So a hot partition is dealt out like any
other, and what is ordered in one task grows with the offsets over `span`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE = ["topic", "partition"]


def audit_positions(messages: DataFrame, span: int = 1_000_000) -> DataFrame:
    """`topic, partition, kind, first, last, messages` of every maximal run of
    offsets that is `lost` (between the first and the last one seen; no
    messages) or `repeated` (`messages`: how many there are of the run's
    offsets, two or more each).  Rows without a position are ignored."""
    seen = messages.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL").groupBy(*PLACE, "offset").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.withColumn("range", F.floor(F.col("offset") / span).cast("bigint"))
    in_range = Window.partitionBy(*PLACE, "range").orderBy("offset")
    over_ranges = Window.partitionBy(*PLACE).orderBy("range")
    lost = lambda rows, before, at: rows.where(F.col(at) - F.col(before) > 1).select(
        *PLACE, F.lit("lost").alias("kind"), (F.col(before) + 1).alias("first"), (F.col(at) - 1).alias("last"), F.lit(0).cast("bigint").alias("messages"))
    inside = lost(seen.withColumn("before", F.lag("offset").over(in_range)), "before", "offset")
    edges = seen.groupBy(*PLACE, "range").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    between = lost(edges.withColumn("before", F.lag("high").over(over_ranges)), "before", "low")

    again = seen.where("n > 1").withColumn("run", F.col("offset") - F.row_number().over(in_range))
    runs = again.groupBy(*PLACE, "range", "run").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n").alias("messages"))
    at_border = (F.col("first") == F.col("range") * span) | (F.col("last") == (F.col("range") + 1) * span - 1)
    order = Window.partitionBy(*PLACE).orderBy("first")
    border = runs.where(at_border).withColumn("new", F.coalesce(F.col("first") - F.lag("last").over(order) > 1, F.lit(True)).cast("int"))
    border = border.withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = border.groupBy(*PLACE, "chain").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("messages").alias("messages"))
    columns = [*PLACE, F.lit("repeated").alias("kind"), "first", "last", "messages"]
    repeated = runs.where(~at_border).select(*columns).unionByName(joined.select(*columns))
    return inside.unionByName(between).unionByName(repeated)
