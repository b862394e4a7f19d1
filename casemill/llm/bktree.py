"""Near-duplicate documents by SimHash fingerprints in BK-trees.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42)
of a text's runs of four words.  Fingerprints link at `radius` differing bits or
fewer.  Exact copies are one fingerprint from the start.

A BK-tree holds fingerprints; a child hangs at its Hamming distance from its
parent.  By the triangle inequality a search with radius r that is d away from a
node follows the edges d - r to d + r alone.  In 64 dimensions this skips little
of a tree over everything, so each tree is that of a shard: the 64 bits are cut
into `b` blocks, two fingerprints with r differing bits or fewer agree in
at least b - r of them, and every choice of b - r blocks has a shard for each of
its values (`shard_masks`).  All links lie inside shards; `b` follows the number of
fingerprints, so a shard holds a few.

A shard of more than `bound` fingerprints is split into several trees by a hash.
Links inside the trees make components; most large shards (groups of near
copies) are one component then, and done.  In the others only pairs across
components can be missing, and one end of each is outside the shard's largest
component.  So these members alone are searched for, in all trees of the
shard: the trees are broadcast if they are counted to be small enough, and joined
by shard otherwise.  A shard of over `bound * most` members is first cut into finer
shards by the bits it does not yet agree in (at most r of them differ, so one of r + 1
blocks agrees), and these are treated alike.  Nothing is dropped: every
pair within the radius is met in a tree or joined by other links.

Trees yield only links that join two of their components, never all pairs of a
group.

A-Z are lower-cased; words are runs of other characters than the six ASCII
spaces.  A text of fewer than four words is hashed as a whole; without words or
text the fingerprint is zero, linked like any other.  Repeated rows get the same
answer.  Null ids are never the smallest id while another exists.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.common import arrow_batch, arrow_map, cut, raw_text
from casemill.llm.components import connected
from casemill.llm.grouping import shared_keys

BITS = 64
SHINGLE = 4
SEED = 42
ALL = (1 << BITS) - 1
TREES = 65_536  # trees that are broadcast, of at most `bound` fingerprints


def fingerprint(raw: bytes | None) -> int:
    """Signed 64-bit SimHash of a text."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= SHINGLE:
        return int(np.uint64(xxhash.xxh64_intdigest(text, SEED)).astype(np.int64))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[: 1 - SHINGLE] + 1).tolist()]
    whole, h = memoryview(text), xxhash.xxh64_intdigest
    hashes = np.fromiter((h(whole[i:j], SEED) for i, j in zip(begins, ends[SHINGLE - 1 :].tolist(), strict=False)), "<u8", len(words) - SHINGLE + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, print` per row of `docs`."""
    run = lambda rows: [(i, fingerprint(raw)) for i, raw in rows]
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text("text"))
    return cols.mapInArrow(arrow_map(run, PRINTS), "doc_id long, print long")


class BKTree:
    """Integers by Hamming distance; `edges[k]` maps a distance from the k-th
    value to the child that hangs there."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        at, new = 0, len(self.values)
        while new:
            d = (self.values[at] ^ value).bit_count()
            if d not in self.edges[at]:
                self.edges[at][d] = new
                break
            at = self.edges[at][d]
        self.values.append(value)
        self.edges.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at most `radius` bits away."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            open_nodes += [child for edge, child in self.edges[at].items() if d - radius <= edge <= d + radius]
        return found


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the components of `values`, from one BK-tree: each value
    is searched for and then inserted."""
    tree, root, out = BKTree(), list(range(len(values))), []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, value in enumerate(values):
        for near in tree.within(value, radius):
            a, b = find(near), find(k)
            if a != b:
                root[b] = a
                out.append((value, values[near]))
        tree.insert(value)
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def blocks_of(mask: int, n: int) -> list[int]:
    """The bits of `mask` in `n` runs of even size, as masks."""
    bits = [k for k in range(BITS) if mask >> k & 1]
    return [sum(1 << k for k in bits[len(bits) * i // n : len(bits) * (i + 1) // n]) for i in range(n)]


def shard_masks(n: int, radius: int) -> list[int]:
    """Masks whose values name the shards of `n` fingerprints: all choices of
    b - radius of b blocks, with the smallest b that makes shards of about four."""
    b = radius + 1
    while BITS * (b - radius) / b < min(log2(max(n, 1)) - 2, BITS / 2):
        b += 1
    blocks = blocks_of(ALL, b)
    return [sum(chosen) for chosen in combinations(blocks, b - radius)]


def shards(prints: DataFrame, masks: list[int]) -> DataFrame:
    """`key, print, mask` of the shards that two fingerprints or more share."""
    entries = [F.struct(F.lit(_signed(m)).alias("mask"), F.xxhash64(F.lit(_signed(m)), F.col("print").bitwiseAND(F.lit(_signed(m)))).alias("key")) for m in masks]
    return shared_keys(prints.select("print", F.inline(F.array(*entries))))


FINER = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("mask", pa.int64())])


def finer(table: DataFrame, radius: int) -> DataFrame:
    """The shards of `table` cut by the bits outside their masks: pairs of a
    shard agree in one of radius + 1 blocks of them."""
    masks: dict[int, list[int]] = {}

    def run(rows):
        out = []
        for key, value, mask in rows:
            if mask not in masks:
                masks[mask] = blocks_of(~mask & ALL, radius + 1)
            out += [(xxhash.xxh3_64_intdigest(b"%d %d %d" % (key, m, value & m)) - (1 << 63), value, _signed((mask | m) & ALL)) for m in masks[mask]]
        return out

    return shared_keys(table.select("key", "print", "mask").mapInArrow(arrow_map(run, FINER), "key long, print long, mask long"))


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [(_signed(a), _signed(b)) for a, b in links]


def tree_links(trees: DataFrame, radius: int) -> DataFrame:
    """`a, b`: links inside each tree (`key`, `tree`, `print`).  Rows come
    sorted by tree; a task holds one tree at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, values, found = None, [], []
        for batch in batches:
            keys, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            prints = batch.column(2).to_numpy().view(np.uint64).tolist()
            for here, value in zip(zip(keys, numbers, strict=True), prints, strict=True):
                if here != name:
                    found += spanning_links(values, radius)
                    name, values = here, []
                values.append(value)
            yield arrow_batch(_pairs(found), LINKS)
            found = []
        yield arrow_batch(_pairs(found + spanning_links(values, radius)), LINKS)

    dealt = trees.select("key", "tree", "print").repartition("key", "tree").sortWithinPartitions("key", "tree")
    return dealt.mapInArrow(run, "a long, b long")


def across_trees(members: DataFrame, roots: DataFrame, bound: int, radius: int) -> DataFrame:
    """`a, b`: links between a shard's members outside its largest component
    and all its trees.  `members`: `key, tree, print` of open shards."""
    placed = members.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    placed = cut(placed, "simhash-placed")
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("m")).select("key", F.col("m.root").alias("main"))
    outside = placed.join(largest, "key").where("root <> main")
    size = outside.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("print", F.lit("search")), F.ceil(F.col("n") / bound))
    asked = outside.join(size, "key").withColumn("part", part).groupBy("key", "part").agg(F.collect_list("print").alias("asked"))  # about `bound`
    trees = cut(placed.groupBy("key", "tree").agg(F.collect_list("print").alias("values")), "simhash-trees")  # about `bound` each
    if trees.count() <= TREES:
        trees = F.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree, out = BKTree(), []
                for v in values:
                    tree.insert(v & ALL)
                for w in wanted:
                    out += [(w & ALL, tree.values[k]) for k in tree.within(w & ALL, radius)]
                yield arrow_batch(_pairs(_forest(out)), LINKS)

    return asked.join(trees, "key").select("values", "asked").mapInArrow(run, "a long, b long")


def _forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that join two components of the links before."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def link_prints(prints: DataFrame, radius: int = 4, bound: int = 512, most: int = 64) -> DataFrame:
    """`node, root` of every fingerprint (`print`, distinct) that is linked
    with another."""
    table = cut(shards(prints, shard_masks(prints.count(), radius)), "simhash-shards")
    links, step = None, 0
    while True:
        sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        tree = F.pmod(F.xxhash64("print", "key"), F.ceil(F.col("n") / bound)).cast("int")
        table = cut(table.join(sizes, "key").withColumn("tree", tree), f"simhash-members-{step}")
        found = cut(tree_links(table, radius), f"simhash-links-{step}")
        links = found if links is None else links.unionByName(found)
        roots = connected(links, f"simhash-components-{step}")
        many = table.where(F.col("n") > bound)
        of = many.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
        open_keys = of.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        opened = cut(many.join(open_keys, "key", "left_semi"), f"simhash-open-{step}")
        if opened.isEmpty():
            return roots
        few = opened.where(F.col("n") <= bound * most).select("key", "tree", "print")
        links = links.unionByName(cut(across_trees(few, roots, bound, radius), f"simhash-across-{step}"))
        table = cut(finer(opened.where(F.col("n") > bound * most), radius), f"simhash-finer-{step}")
        if table.isEmpty():
            return connected(links, f"simhash-last-{step}")
        step += 1


def near_duplicates(docs: DataFrame, radius: int = 4, bound: int = 512, most: int = 64) -> DataFrame:
    """`doc_id, print, fingerprint, component_id` per row of `docs`."""
    rows = cut(fingerprints(docs), "simhash-prints")
    prints = cut(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = link_prints(prints.select("print"), radius, bound, most)
    rooted = prints.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.select("print", "root").join(smallest, "root").select("print", "component_id")
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(of_print, "print").select("doc_id", "print", hexed, "component_id")
