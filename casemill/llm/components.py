"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import cut, scalar


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """`node, root` for every node of `links` (`a`, `b`): the smallest node of
    its component.  Nodes may be of any type that sorts; null ends and loops
    are ignored.

    Large-star and small-star steps in turn: each node's larger neighbours are
    tied to the smallest node near it, then its smaller neighbours and itself.
    A step takes the minimum per node (reduced before the shuffle) and joins
    it back, so a node with very many links is never gathered in one group;
    the join may split it.  Every round is written to the shared folder.
    """
    e = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, f"{name}-0")
    step = 0
    state = _state(e)
    while True:
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e1 = large.where("u <> v").distinct()
        # small star: every u now has only smaller neighbours v
        low = e1.groupBy("u").agg(F.min("v").alias("m"))
        small = e1.join(low, "u")
        tied = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(tied.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    """Number and order-free fingerprint of the links."""
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)
