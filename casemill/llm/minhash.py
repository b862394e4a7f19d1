"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct runs of five words.  Instead of computing
the minhashes of every table apart, two small collections of bands are
computed, and table (i, j) is keyed by band i of the first with band j of the
second: `2 g` bands of two minhashes make `g * g` tables.  Two documents meet
in some table if they share a band of either collection; `g` is chosen so that
a pair at the threshold misses with a probability of at most `max_miss`.

Only bands that two or more sets share are paired (others cannot meet), exact
copies are one node from the start, and candidates are confirmed on full sets.

Within a bucket not all pairs are made, yet none that could be a link is lost.
Each bucket gets a centre c: every node names the most central node among those
it meets in any bucket, and the name that most members give is the bucket's
centre (in a group of near copies the original, whether or
not it is in this bucket).  Every member is compared with c, and links make
components.  What is left are
pairs (x, y) of different components, so at least one, say x, is not linked
with c.  If x and y share nothing outside c and |c| <= |y|, then
J(x, c) >= J(x, y), because |x & c| >= |x & y|: such a pair is no link.  So a
link that is left either

- shares a shingle outside c: members are put into finer buckets by the
  shingles that they have and c lacks, and these are treated alike; or
- has |y| < |c|: y and x then lack a common shingle of c, more than
  (100 |c - y| + t |y - c|) / (100 + t) of them at threshold t %, and are
  paired by these.

Both use the prefix of shingles (in hash order) that a large enough overlap
must meet.  In a group of near copies the shingles outside the centre are each
copy's own, so nearly nothing is left after the first comparison, however
large the group is.  Finer buckets of at most `bound` members are compared
member by member across components, larger ones are refined again.  What is
still open after `levels` refinements is closed by `grouping.link_buckets`.

Words are runs of other characters than the six ASCII spaces, A-Z lower-cased.
A text of fewer than five words has its whole sequence as its one shingle; a
null text or one without words has none, and is linked with nothing.  Sets are
compared by 64-bit hashes of their shingles, and equal sets are found by a
64-bit hash.  Rows are judged one by one: repeated rows get the same answer.
Null ids are never the smallest id while another exists.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import arrow_map, cut, fresh, join_small, raw_text
from casemill.llm.components import connected
from casemill.llm.grouping import link_buckets, ordered, shared_keys

SHINGLE = 5
MIX = np.uint64(0x9E3779B97F4A7C15)
BAND = 2  # minhashes per band


class WordHashes(dict):
    """64-bit hashes of words, bounded like a cache."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= 150_000:
                self.clear()
            self[word] = h
        return h


_powers = np.array([pow(int(MIX), k, 1 << 64) for k in range(1, SHINGLE + 1)], np.uint64)


def shingles(raw: bytes | None, known: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    known = WordHashes() if known is None else known
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(x) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            h += x[k : k + n] * _powers[k]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def bands_for(percent: int, max_miss: float) -> int:
    """Bands per collection so that a pair at the threshold is missed with a
    probability of at most `max_miss`: each collection misses with
    (1 - t ** BAND) ** g, and either miss loses the pair."""
    t = percent / 100
    if t >= 1:
        return 1
    return max(1, math.ceil(math.log(max_miss / 2) / math.log(1 - t**BAND)))


def least_agreement(n: int, percent: int, max_miss: float) -> int:
    """The smallest number of equal minhashes of `n` that a pair at the
    threshold falls below with a probability of at most `max_miss`."""
    t, below = percent / 100, 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * t**k * (1 - t) ** (n - k)
        if below > max_miss:
            return k
    return n


def minhashes(h: np.ndarray, n: int) -> bytes:
    """`n` 32-bit minhashes of a set of well-mixed 64-bit hashes."""
    rng = np.random.Generator(np.random.PCG64(77))
    mult = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(n, 0xFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 4096):
            out = np.minimum(out, ((h[at : at + 4096, None] * mult) >> np.uint64(32)).min(axis=0))
    return out.astype("<u4").tobytes()


SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary())])
SETS = pa.schema([("node", pa.int64()), ("hashes", pa.binary())])


def node_of(h: np.ndarray) -> int | None:
    """Signed 64-bit name of a set; null for the empty set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64)) if len(h) else None


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """`doc_id, text_hash, n_shingles, node, sketch` per row of `docs`."""

    known = WordHashes()  # each task has its own, gone with the task

    def run(rows):
        out = []
        for i, text_hash, raw in rows:
            h = shingles(raw, known)
            out.append((i, text_hash, len(h), node_of(h), minhashes(h, n) if len(h) else None))
        return out

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), raw_text("text"))
    return cols.mapInArrow(arrow_map(run, SKETCH), "doc_id long, text_hash long, n_shingles long, node long, sketch binary")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`node, hashes`: full sets of the nodes in `wanted` (`doc_id`,
    `text_hash` of one row each)."""

    known = WordHashes()

    def run(rows):
        out = []
        for (raw,) in rows:
            h = shingles(raw, known)
            out.append((node_of(h), h.tobytes()))
        return out

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = join_small(cols, wanted, ["doc_id", "text_hash"], "left_semi").select(raw_text("text"))
    return rows.mapInArrow(arrow_map(run, SETS, 64), "node long, hashes binary").dropDuplicates(["node"])


def buckets(nodes: DataFrame, g: int) -> DataFrame:
    """`key, node, weight` of every table entry that two or more nodes share;
    a node's weight is the number of band entries that it shares."""
    width = 4 * BAND
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width)) for i in range(2 * g)])
    rows = nodes.select("node", F.posexplode(bands).alias("band", "key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    mine = rows.join(shared, "key").groupBy("node").agg(
        F.collect_list(F.when(F.col("band") < g, F.col("key"))).alias("first"),
        F.collect_list(F.when(F.col("band") >= g, F.col("key"))).alias("second"),  # at most 2 g entries a node
        F.sum("n").alias("weight"))
    pairs = F.flatten(F.transform("first", lambda a: F.transform("second", lambda b: F.xxhash64(a, b))))
    table = cut(mine.select("node", "weight", F.explode(pairs).alias("key")), "minhash-tables")
    return cut(shared_keys(table), "minhash-buckets")


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
TOKENS = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("side", pa.int8()), ("parent", pa.int64()),
                    ("less", pa.int64()), ("more", pa.int64()), ("base", pa.int64())])
SPREAD = pa.schema([("node", pa.int64()), ("h", pa.int64())])
OUTSIDE, FAR, SMALL = 0, 1, 2


class Nodes:
    """What is known of the nodes that meet in some bucket: sizes, sketches
    and full sets."""

    def __init__(self, nodes: DataFrame, table: DataFrame, docs: DataFrame, percent: int, least: int, n: int):
        self.percent, self.least, self.n = percent, least, n
        met = nodes.join(table.select("node").distinct(), "node", "left_semi")
        self.meta = cut(met.select("node", "n_shingles", "sketch", "doc_id", "text_hash"), "minhash-met")
        self.sets = cut(full_sets(docs, self.meta.select("doc_id", "text_hash")), "minhash-sets")

    def centrality(self, table: DataFrame) -> DataFrame:
        """`node, score` of the nodes that share most bands in some bucket.

        With df the number of nodes that have a shingle, and m its median over
        a node's shingles, the score is the sum of 2 df - m: largest for the
        node whose set differs least from those of its group.  The df are
        counted on a quarter of the nodes; scores only choose centres, what is
        compared does not depend on them being exact.
        """
        most = table.groupBy("key").agg(F.max("weight").alias("weight"))
        some = table.join(most, ["key", "weight"], "left_semi").select("node").distinct()

        def spread(rows):
            return [(i, h) for i, raw in rows for h in np.frombuffer(raw, np.int64).tolist()]

        tokens = lambda sets: sets.mapInArrow(arrow_map(spread, SPREAD, 64), "node long, h long")
        df = tokens(self.sets.where(F.pmod(F.xxhash64("node", F.lit("df")), F.lit(4)) == 0)).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
        rows = tokens(self.sets.join(some, "node", "left_semi")).join(df, "h", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        score = 2 * F.sum("df") - F.count(F.lit(1)) * F.percentile_approx("df", 0.5)
        return cut(rows.groupBy("node").agg(score.alias("score")), "minhash-scores")

    def with_sets(self, pairs: DataFrame) -> DataFrame:
        """`a, b` with their full sets `x`, `y`."""
        a = self.sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
        b = self.sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")

    def confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (`a`, `b`) whose full sets reach the threshold.  Sizes and
        sketches rule out what cannot reach it before full sets are fetched."""
        percent = self.percent
        left = self.meta.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
        right = self.meta.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
        part = lambda s, k: F.col(s).substr(k * 4 + 1, F.lit(4))
        agree = F.aggregate(F.sequence(F.lit(0), F.lit(self.n - 1)), F.lit(0),
                            lambda acc, k: acc + F.when(part("s_a", k) == part("s_b", k), 1).otherwise(0))
        sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        likely = cut(pairs.join(left, "a").join(right, "b").where(sized & (agree >= self.least)).select("a", "b"), f"{name}-likely")

        def run(rows):
            out = []
            for a, b, x, y in rows:
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a, b))
            return out

        return cut(self.with_sets(likely).mapInArrow(arrow_map(run, PAIRS, 64), "a long, b long"), f"{name}-links")

    def differences(self, spokes: DataFrame, name: str) -> DataFrame:
        """Finer buckets `key, node, side, parent` of the pairs of a centre (`a`) and a
        member (`b`) of its open buckets, as the module's text says."""
        t = self.percent

        def run(rows):
            out = []
            for c, b, x, y in rows:
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                outside, lacking = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                both, more, less = len(y) - len(outside), len(outside), len(lacking)
                far = 100 * both < t * (len(x) + more)
                need = max(1, -(-t * len(y) // 100) - both)
                size = (less, more, len(x))
                out += [(named(c, h, 0), b, OUTSIDE, c, *size) for h in outside[: max(0, more - need + 1)].tolist()]
                if far:
                    need = max(1, -(-(100 * less + t * more - (100 - t) * len(x)) // t))
                    out += [(named(c, h, 1), b, FAR, c, *size) for h in lacking[: max(0, less - need + 1)].tolist()]
                if len(y) < len(x):
                    need = (100 * less + t * more) // (100 + t) + 1
                    out += [(named(c, h, 1), b, SMALL, c, *size) for h in lacking[: max(0, less - need + 1)].tolist()]
            return out

        rows = self.with_sets(spokes).mapInArrow(arrow_map(run, TOKENS, 64), "key long, node long, side byte, parent long, less long, more long, base long")
        return cut(rows, f"{name}-finer")


def named(centre: int, h: int, kind: int) -> int:
    """Signed 64-bit key of a shingle beside a centre."""
    return int.from_bytes(xxhash.xxh3_64_digest(b"%d %d %d" % (centre, h, kind)), "big", signed=True)


def link_nodes(nodes: DataFrame, docs: DataFrame, percent: int, max_miss: float, bound: int, levels: int) -> DataFrame:
    """`node, root` of every node that is linked with another."""
    g = bands_for(percent, max_miss)
    n = 2 * g * BAND
    table = buckets(nodes, g)
    known = Nodes(nodes, table, docs, percent, least_agreement(n, percent, max_miss), n)
    named = cut(names(table, known.centrality(table)), "minhash-names")
    table = table.select("key", "node", F.lit(None).cast("long").alias("parent"))
    links = tested = roots = None

    def test(pairs: DataFrame, name: str) -> None:
        nonlocal links, tested
        fresh = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), f"{name}-pairs")
        found = known.confirm(fresh, name)
        tested = fresh if tested is None else tested.unionByName(fresh)
        links = found if links is None else links.unionByName(found)

    for level in range(levels):
        name = f"minhash-level-{level}"
        if level:
            sized = table.join(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")
            few = sized.where(F.col("n") <= bound).join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
            other = few.select("key", F.col("node").alias("a"), F.col("root").alias("a_root"))
            test(ordered(few.join(other, "key").where("a < node AND a_root <> root").select("a", F.col("node").alias("b"))), f"{name}-few")
            table = cut(sized.where(F.col("n") > bound).drop("n"), f"{name}-many")
            if table.isEmpty():
                return connected(links, f"{name}-last")
        spokes = table.join(centres(table, named), "key").select("key", F.col("centre").alias("a"), F.col("node").alias("b"))
        spokes = cut(spokes, f"{name}-spokes")
        test(ordered(spokes.where("a <> b")), name)
        if not level:  # later levels add few links; taking them as not yet joined only compares more
            roots = connected(links, name)
        opened = open_spokes(spokes, roots, name)
        if opened.isEmpty():
            return roots if not level else connected(links, f"{name}-last")
        finer = known.differences(opened, name)
        side = lambda s, k: finer.where(F.col("side") == s).select(
            "key", F.col("node").alias(k), F.col("less").alias(f"less_{k}"), F.col("more").alias(f"more_{k}"), "base")
        far, small = side(FAR, "a"), side(SMALL, "b").drop("base")
        # a link without a common shingle outside the centre needs this many
        # common lacking ones, and cannot have more than either lacks
        shared = F.lit(100) * (F.col("less_a") + F.col("less_b")) + percent * (F.col("more_a") + F.col("more_b")) - (100 - percent) * F.col("base")
        can = (F.col("a") != F.col("b")) & (shared <= (100 + percent) * F.least("less_a", "less_b"))
        test(ordered(far.join(small, (far["key"] == small["key"]) & can)), f"{name}-small")
        inner = finer.where(F.col("side") == OUTSIDE).select("key", "node", "parent").distinct()
        table = cut(shared_keys(inner), f"{name}-table")
    return link_buckets(table.select("key", "node"), known.confirm, bound, "minhash-rest", links)


def names(table: DataFrame, scores: DataFrame) -> DataFrame:
    """`node, c` of every node: the most central node (`c.node`) among those
    it meets in some bucket."""
    first = table.join(scores, "node").groupBy("key").agg(F.max(F.struct("score", "node")).alias("c"))
    return table.join(first, "key").groupBy("node").agg(F.max("c").alias("c"))


def centres(table: DataFrame, named: DataFrame) -> DataFrame:
    """`key, centre` of every bucket of `table` (`key`, `node`, `parent`): the
    node that most members name, other than the centre that the bucket was
    refined from; else a member.  All steps are aggregates that combine before
    they are shuffled."""
    votes = table.join(named, "node").where("parent IS NULL OR c.node <> parent").groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    most = votes.groupBy("key").agg(F.max(F.struct("n", "c")).alias("m")).select("key", F.col("m.c.node").alias("vote"))
    member = table.groupBy("key").agg(F.min("node").alias("member"))
    return member.join(most, "key", "left").select("key", F.coalesce("vote", "member").alias("centre"))


def open_spokes(spokes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """The distinct (centre, member) pairs of buckets with two components or
    more."""
    placed = spokes.join(roots.withColumnRenamed("node", "b"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return cut(spokes.join(open_keys, "key", "left_semi").where("a <> b").select("a", "b").distinct(), f"{name}-open")


def near_duplicates(docs: DataFrame, percent: int = 80, max_miss: float = 1e-5, bound: int = 256, levels: int = 4) -> DataFrame:
    """`doc_id, text_hash, n_shingles, component_id, kept, stays` per row of
    `docs` (`doc_id`, `text`): documents with 100 * intersection >= `percent` *
    union of their shingle sets are linked.  `kept` tells that the row has its
    group's smallest id; `stays`, that it has the one id and text of its group
    that `keep_one_of_each` keeps."""
    g = bands_for(percent, max_miss)
    rows = cut(sketches(docs, 2 * g * BAND), "minhash-sketches")
    named = rows.where("node IS NOT NULL")
    # the row that stands for a node, and then for a group, is the one with the smallest id
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = named.groupBy("node").agg(F.min(place).alias("r"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    nodes = cut(classes.select("node", "n_shingles", "sketch", F.col("r.doc_id").alias("doc_id"), F.col("r.text_hash").alias("text_hash")), "minhash-nodes")
    roots = link_nodes(nodes, docs, percent, max_miss, bound, levels)
    rooted = nodes.select("node", place.alias("r")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("r").alias("first"))
    of_node = rooted.select("node", "root").join(smallest, "root").select("node", "first")
    out = rows.join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      (F.col("node").isNull() | place.eqNullSafe(F.col("first"))).alias("stays"))


def keep_one_of_each(docs: DataFrame, percent: int = 80, **settings) -> DataFrame:
    """The rows of `docs` with one document of each near-duplicate group, all
    columns kept: the one with the smallest id, and the smallest text hash
    among texts under that id.  Groups are told apart by their links, so rows
    that only share an id, or have none, are different documents.  Of repeated
    rows with the same id and text one stays; documents without words all
    stay."""
    judged = cut(near_duplicates(docs, percent, **settings), "minhash-judged")
    bad = cut(judged.where("NOT stays").select("doc_id", "text_hash").distinct(), "minhash-dropped")
    key = fresh(docs.columns, "near_id", "near_text")
    keyed = docs.withColumns({key[0]: F.col("doc_id").cast("long"), key[1]: F.xxhash64("text")})
    bad = bad.select(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1]))
    out = join_small(keyed, bad, key, "left_anti")
    twice = judged.where("stays AND n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if twice.isEmpty():
        return out.drop(*key)
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    once = out.where(worded).dropDuplicates(key).unionByName(out.where(~F.coalesce(worded, F.lit(False))))
    return once.drop(*key)
