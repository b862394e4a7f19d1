"""Groups of similar nodes from buckets, without all pairs of a bucket.

First every member of a bucket is compared with the one that shares most
entries with others, and links make components.  Pairs inside one component need no comparison.  Buckets that
still hold several components are compared again across components: buckets up
to a bound member by member, larger ones against a growing number of drawn
members, until each bucket has one component or all its cross pairs were
compared.  So no link that a bucket offers is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import cut, scalar
from casemill.llm.components import connected


def shared_keys(rows: DataFrame) -> DataFrame:
    """The rows whose `key` two rows or more have.  Keys are counted with a
    map-side combine, so a frequent one is not gathered."""
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return rows.join(shared, "key", "left_semi")


def ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with `a` < `b`."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_buckets(table: DataFrame, confirm: Callable[[DataFrame, str], DataFrame], bound: int, name: str,
                 links: DataFrame | None = None, close: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """`node, root` of every node linked with another.  `table` holds the
    buckets as (`key`, `node`); `confirm(pairs, name)` returns those of the
    distinct pairs (`a` < `b`) that are links; `links` are known before.  With
    `close`, the table has a `size` of each node, and pairs whose sizes are not
    close, which are no links, are left out before they are shuffled."""
    more = [] if close is None else ["size"]
    may_link = F.lit(True) if close is None else close(F.col("size"), F.col("a_size"))
    of_a = [F.col(f"c.{k}").alias(f"a_{k}") for k in more]
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weights = table.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    centre = table.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node", *more)).alias("c")).select("key", F.col("c.node").alias("a"), *of_a)
    pairs = ordered(table.join(centre, "key").where("node <> a").where(may_link).select("a", F.col("node").alias("b")))
    tested = cut(pairs, f"{name}-pairs-0")
    found = confirm(tested, f"{name}-0")
    links = found if links is None else links.unionByName(found)
    roots, done, limit, step = connected(links), 0, bound, 0
    while True:
        step += 1
        placed = table.join(roots.withColumnRenamed("root", "known"), "node", "left").select(
            "key", "node", F.coalesce("known", "node").alias("root"), *more)
        placed = cut(placed, f"{name}-placed-{step}")
        open_keys = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        open_keys = cut(open_keys.where((F.col("lo") != F.col("hi")) & (F.col("n") > done)).select("key", "n"), f"{name}-open-{step}")
        most = scalar(open_keys.agg(F.max("n")))
        if most is None:
            return roots
        members = placed.join(open_keys, "key")
        draw = F.when(F.col("n") <= limit, F.col("node")).otherwise(F.pmod(F.xxhash64("node", F.lit(step)), F.lit(limit)))
        drawn = members.withColumn("draw", draw).groupBy("key", "draw").agg(F.min(F.struct("node", "root", *more)).alias("c"))
        drawn = drawn.select("key", F.col("c.node").alias("a"), F.col("c.root").alias("a_root"), *of_a)
        pairs = members.join(drawn, "key").where("root <> a_root").where(may_link).select("a", F.col("node").alias("b"))
        fresh = cut(ordered(pairs).join(tested, ["a", "b"], "left_anti"), f"{name}-pairs-{step}")
        tested = tested.unionByName(fresh)
        links = links.unionByName(confirm(fresh, f"{name}-{step}"))
        roots = connected(links)
        if most <= limit:  # every cross pair of every open bucket was compared
            return roots
        done, limit = limit, limit * 8
