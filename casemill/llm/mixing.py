"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words; its rate is target / size.  Every
document of the source is taken floor(rate) times, and once more with
probability frac(rate).  Which documents get the extra copy is decided by the
cube method: the vector of inclusion probabilities moves through the null
space of the balancing constraints (number of documents and number of words of
the source), until each coordinate but a few has reached 0 or 1.

The flight runs in blocks of at most about `block` units per task.  A block's
flight leaves at most two fractional units and keeps its sums of probabilities
and of expected words exactly; the left-overs of all blocks of a source form
new blocks, level by level, until one block per source remains.  There the
landing gives up the document count, keeps the words as long as two units are
left, and rounds the last one by its probability.  So a source's taken words
differ from its target by less than one document.

Sizes are word counts (0 for a null or empty text, which is taken 0 words).
Rows with the same (doc_id, source, size) are one unit that is taken as a
whole, each copy equally often.  Null ids and a null source are values like
others.  Draws depend on the unit's own values and the seed alone.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casemill.llm.common import arrow_batch, count_words, cut, fresh, scalar

KEYS = ["doc_id", "source", "size"]
COPIES = 1024  # equal rows that one task makes out of one row
EPS = 1e-9


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """`source, source_size, target` per source of `sized` (`source`, `size`).

    Sources in code-point order, null last, weigh `weights`, repeating, and
    share `share` of all sizes; a target stops at `cap` times its source's
    size and the excess is reshared by weight.  Resharing until none is above
    ends at the level L with sum(min(cap, L * weight)) = total: sources whose
    cap / weight is below L are full.  Sorting by cap / weight gives L by
    running sums.  Only one row per source goes through these windows.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(cap))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(every) * F.lit(share) - before) / rest)
    # the first source in this order that its level does not fill; filling it
    # all the same would only lower the level, so that is the largest level
    found = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(every)
    # no level fits only if the share is beyond every cap: then all are full
    target = F.least("cap", F.coalesce(found * F.col("w"), F.col("cap")))
    return per.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, level: int, key: tuple) -> float:
    raw = hashlib.blake2b(repr((seed, level, key)).encode(), digest_size=8).digest()
    return int.from_bytes(raw, "big") / 2.0**64


def _step(p: list[float], u: list[float], draw: float) -> list[float]:
    """Move p along u or against it, as far as the cube allows, so that the
    expectation stays p."""
    up = min((1 - a) / b if b > 0 else a / -b for a, b in zip(p, u, strict=True) if b)
    down = min(a / b if b > 0 else (1 - a) / -b for a, b in zip(p, u, strict=True) if b)
    by = up if draw * (up + down) < down else -down
    moved = [a + by * b for a, b in zip(p, u, strict=True)]
    return [0.0 if a < EPS else 1.0 if a > 1 - EPS else a for a in moved]


def _direction(a: list[tuple[float, float]]) -> list[float]:
    """A vector u with sum(u * a) = 0 for both balancing variables."""
    (c1, t1), (c2, t2), (c3, t3) = a
    u = [c2 * t3 - c3 * t2, c3 * t1 - c1 * t3, c1 * t2 - c2 * t1]
    if any(u):
        return u
    return [t2, -t1, 0.0]  # proportional constraints: two units suffice


def flight(keys: list[tuple], p: list[float], a: list[tuple[float, float]], seed: int, level: int) -> list[float]:
    """Cube flight over units with balancing variables `a` (documents, words);
    at most two of the returned probabilities are not 0 or 1."""
    out, held = list(p), []
    for i in range(len(p)):
        if EPS < out[i] < 1 - EPS:
            held.append(i)
        if len(held) == 3:
            u = _direction([a[j] for j in held])
            for j, q in zip(held, _step([out[j] for j in held], u, _uniform(seed, level, keys[i])), strict=True):
                out[j] = q
            held = [j for j in held if 0 < out[j] < 1]
    return out


def landing(keys: list[tuple], p: list[float], a: list[tuple[float, float]], seed: int) -> list[float]:
    """Round what a flight left: keep the words while two units are left, then
    round the last by its probability."""
    out = list(p)
    held = [i for i in range(len(p)) if 0 < out[i] < 1]
    while len(held) >= 2:
        i, j = held[:2]
        out[i], out[j] = _step([out[i], out[j]], [a[j][1], -a[i][1]], _uniform(seed, -1, keys[i]))
        held = [k for k in held if 0 < out[k] < 1]
    for i in held:
        out[i] = 1.0 if _uniform(seed, -2, keys[i]) < out[i] else 0.0
    return out


MOVED = [*KEYS, "copies", "p", "n_blocks"]
MOVED_DDL = "doc_id long, source string, size long, copies long, p double, n_blocks long"
MOVED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("copies", pa.int64()),
                          ("p", pa.float64()), ("n_blocks", pa.int64())])


def _hash(seed: int, *more) -> Column:
    return F.xxhash64(*[F.col(k) for k in KEYS], F.lit(seed), *[F.lit(m) for m in more])


def balanced_sample(units: DataFrame, seed: int = 7, block: int = 4096) -> DataFrame:
    """`units` (doc_id, source, size > 0, copies, p) with `take` 0 or 1.

    Each level moves only (key, size, p) rows; a source's blocks are drawn by
    the hash of the unit, so a source that holds most rows is spread over many
    tasks.
    """
    def run(level: int, last: bool):
        def fly(block_rows: pa.Table) -> pa.Table:
            rows = sorted(zip(*(block_rows[c].to_pylist() for c in ("order", *MOVED)), strict=True), key=lambda r: (r[0], repr(r[1:4])))
            keys = [r[1:4] for r in rows]
            a = [(float(copies), float(copies * size)) for _, _, _, size, copies, _, _ in rows]
            p = flight(keys, [r[5] for r in rows], a, seed, level)
            if last:
                p = landing(keys, p, a, seed)
            made = [(*r[1:5], q, r[6]) for r, q in zip(rows, p, strict=True)]
            return pa.Table.from_batches([arrow_batch(made, MOVED_SCHEMA)])

        return fly

    counts = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("n_blocks"))
    counts = cut(counts, "flight-blocks").withColumnRenamed("source", "of")
    left = units.join(counts, F.col("source").eqNullSafe(F.col("of"))).select(*MOVED)
    most = scalar(counts.agg(F.max("n_blocks"))) or 0
    done, level = [], 0
    while most:
        last = most == 1
        blocks = left.withColumn("block", F.pmod(_hash(seed, level), F.col("n_blocks"))).withColumn("order", _hash(seed, level, 1))
        moved = cut(blocks.groupBy("source", "block").applyInArrow(run(level, last), MOVED_DDL), f"flight-{level}")
        fixed = (F.col("p") == 0) | (F.col("p") == 1)
        done.append(moved.where(fixed))
        if last:
            break
        # about two units a block are left; their blocks are sized for three
        shrunk = F.ceil(F.col("n_blocks") * 3 / block).cast("long")
        left = moved.where(~fixed).withColumn("n_blocks", shrunk)
        most, level = math.ceil(most * 3 / block), level + 1
    if not done:
        return units.withColumn("take", F.lit(0).cast("long"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "source", "size", "copies", F.col("p").cast("long").alias("take"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7,
             block: int = 4096) -> DataFrame:
    """`doc_id, source, size, copies, source_size, target, times` per unit of
    `docs` (`doc_id`, `source`, `text`): how often the mix takes each copy."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), count_words(F.col("text")).alias("size"))
    units = cut(sized.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies")), "mix-units")
    targets = source_targets(units.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, share, cap)
    targets = cut(targets, "mix-targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = units.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("rate", rate)
    whole = F.floor(F.col("rate") + EPS).cast("long")
    part = F.col("rate") - whole
    rated = rated.withColumn("whole", whole).withColumn("p", F.when((F.col("size") > 0) & (part > EPS), part).otherwise(F.lit(0.0)))
    drawn = balanced_sample(rated.where("p > 0").select(*KEYS, "copies", "p"), seed, block)
    drawn = drawn.select(*[F.col(k).alias(f"drawn_{k}") for k in KEYS], "take")
    same = [F.col(k).eqNullSafe(F.col(f"drawn_{k}")) for k in KEYS]
    joined = rated.where("p > 0").join(drawn, same).select(*KEYS, "copies", "source_size", "target", (F.col("whole") + F.col("take")).alias("times"))
    rest = rated.where("p = 0").select(*KEYS, "copies", "source_size", "target", F.col("whole").alias("times"))
    return joined.unionByName(rest)


def per_document(plan: DataFrame) -> DataFrame:
    """`doc_id, size, source_size, target, taken`, one row per document."""
    out = ["doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")]
    one = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy")
    few = plan.where(F.col("copies") <= COPIES).select(*out, one(F.col("copies")))
    # a unit of very many equal rows is dealt out in parts before it becomes rows
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    parts = plan.where(F.col("copies") > COPIES).withColumn("begin", begin).repartition("doc_id", "source", "size", "begin")
    many = parts.select(*out, one(F.least(F.col("copies") - F.col("begin"), F.lit(COPIES).cast("long"))))
    return few.unionByName(many).drop("copy")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, all columns kept."""
    plan = plan_mix(docs, **settings).where("times > 0").select(*[F.col(k).alias(f"mix_{k}") for k in KEYS], F.col("times").alias("mix_times"))
    cols = [docs[c] for c in docs.columns]
    size = count_words(docs["text"])
    same = (docs["doc_id"].cast("long").eqNullSafe(plan["mix_doc_id"]) & docs["source"].eqNullSafe(plan["mix_source"])
            & (size == plan["mix_size"]))
    (copy,) = fresh(docs.columns, "mix_copy")
    taken = docs.join(plan, same).select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), plan["mix_times"])).alias(copy))
    return taken.drop(copy)
