"""Source divergence audit: which sources of a language use words unlike the
others, and by which words.

Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z
lower-cased.  A language keeps the terms that at least `min_docs` of its
documents hold.  Every group (language, source) and every language gives each
kept term the smoothed share p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two
shares differ by f(p, q) = floor((p - q)^2 / (p + q)).

The value of two sources A and B is the sum of f over all V kept terms.  Most
counts are zero, and p depends on the count alone, so with 0 for a zero count

    value = V f(0, 0) + sum over A's terms of  f(a, 0) - f(0, 0)
                      + sum over B's terms of  f(0, b) - f(0, 0)
                      + sum over common terms of  f(a, b) - f(a, 0) - f(0, b) + f(0, 0).

The first three parts need only how many terms have which count in a source.
The last comes from a frequent-pattern tree: a kept term is a row of its
nonzero (source, count) items in the order of the sources, inserted with the
number of terms that have the same row.  A node then knows how many terms share
its path, and its correction with each of its ancestors is computed once for
all of them.  Rows are dealt out by range and inserted in order, so a task holds
the rightmost branch of its part of the tree alone: a node is complete when a
row leaves it.  A node cut by a range border is counted in both parts with its
share of the terms.

All arithmetic is exact (decimals and 64-bit integers).  Null text, language
and source are the empty string.  Repeated rows are documents of their own.
A group without terms has its shares too; where a language keeps no term, every
pair has the value 0.  Ties are ranked by the item's UTF-8 bytes.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import cut, join_small, raw_text

SCALE = 1_000_000_000
ENTRIES, TEXT_BYTES = 500_000, 64 << 20  # a task passes its counts on when it holds so many, or has read so much
OUT_ROWS = 16_384
CELLS = 4 << 20  # pair sums that a task holds
BLOCK = 1 << 16  # pairs of nodes that are computed at a time

# letters lower-cased, bytes of longer characters as they are, all else a blank
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

TERMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def _named(docs: DataFrame, *more: Column | str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), *more)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    read = entries = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for at in range(0, len(terms), OUT_ROWS):
                some = terms[at : at + OUT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary()),
                     pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())], schema=TERMS)
        held.clear()

    for batch in batches:
        for lang, source, raw in zip(*batch.columns, strict=True):
            raw = raw.as_py()
            if not raw:
                continue
            words = raw.translate(TERM_BYTES).split()
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before = len(n)
            n.update(words)
            docs.update(set(words))
            read, entries = read + len(raw), entries + len(n) - before
            if read >= TEXT_BYTES or entries >= ENTRIES:
                yield from flush()
                read = entries = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """`lang, source, term, n, docs`: occurrences and documents per term.
    Tasks count their documents before anything is shuffled."""
    parts = _named(docs, raw_text("text")).mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    summed = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.withColumn("term", F.col("term").cast("string"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)); null where no term is kept."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(SCALE)
    return F.call_function("div", wide, F.nullif((total + 2 * kept).cast("decimal(21,0)"), F.lit(0))) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class Branch:
    """The rightmost branch of a frequent-pattern tree and the pair sums of
    the nodes left so far."""

    def __init__(self) -> None:
        self.lang, self.cells = None, 0
        self.sums: dict[tuple[str, int], np.ndarray] = {}
        # of the nodes on the branch: item (source, count, p, p at zero) and number of terms
        self.items: list[tuple[int, int, int, int]] = []
        self.terms: list[int] = []

    def insert(self, lang: str, path: list[int], terms: int) -> None:
        items = list(zip(*[iter(path)] * 4, strict=True))
        shared = 0
        if lang == self.lang:
            while shared < min(len(items), len(self.items)) and items[shared] == self.items[shared]:
                shared += 1
        self.leave(shared)
        self.lang = lang
        self.items += items[shared:]
        self.terms += [0] * (len(items) - shared)
        for k in range(len(items)):
            self.terms[k] += terms

    def leave(self, depth: int) -> None:
        """Close the nodes below `depth`: each is paired with its ancestors."""
        if depth >= len(self.items):
            return
        source, _, p, zero = np.array(self.items, np.int64).T
        terms, n = np.array(self.terms, np.int64), len(p)
        for low in range(max(depth, 1), n, max(1, BLOCK // n)):  # nodes [low, high) against all above them
            high = min(n, low + max(1, BLOCK // n))
            a, a0, b, b0 = p[: high - 1], zero[: high - 1], p[low:high, None], zero[low:high, None]
            both = terms[low:high, None] * (_apart(a, b) - _apart(a, b0) - _apart(a0, b) + _apart(a0, b0))
            for k in range(low, high):
                key = (self.lang, int(source[k]))
                if key not in self.sums:
                    self.sums[key] = np.zeros(key[1], np.int64)  # ancestors come before in the order of sources
                    self.cells += key[1]
                self.sums[key][source[:k]] += both[k - low, :k]
        del self.items[depth:], self.terms[depth:]

    def take(self) -> Iterator[pa.RecordBatch]:
        for (lang, b), values in self.sums.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array([b] * len(at), pa.int32()), pa.array(values[at])],
                schema=PAIRS)
        self.sums, self.cells = {}, 0


def _apart(p, q):
    return (p - q) ** 2 // (p + q)


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    branch = Branch()
    for batch in batches:
        for lang, path, terms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            branch.insert(lang, path, terms)
            if branch.cells > CELLS:
                yield from branch.take()
    branch.leave(0)
    yield from branch.take()


def tree_corrections(items: DataFrame) -> DataFrame:
    """`lang, a, b, value` (ranks of sources, a < b): the corrections of terms
    that both sources hold.  `items`: `lang, term, rank, n, p, p0`."""
    flat = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("rank", "n", "p", "p0"))),
                                 lambda x: F.array(x["rank"].cast("long"), x["n"], x["p"], x["p0"])))
    rows = items.groupBy("lang", "term").agg(flat.alias("path"))
    rows = cut(rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms")), "divergence-rows")
    dealt = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(_tree, "lang string, a int, b int, value long")


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """`lang, source, part, item, value, rank`.  Part `pair`: the other sources
    of the language by their distance; part `term`: the `top` kept terms that
    the source uses more than its language, by their share of the distance to
    it."""
    counted = term_counts(docs).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    kept = cut(counted.where(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")
    long = kept.select("lang", "term", "total", F.inline("counts"))

    # one row per group from here on, and one per language
    groups = _named(docs).distinct()
    sums = long.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    stats = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["group_n", "v", "lang_n"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    stats = stats.withColumns({"rank": rank, "p0": share(F.lit(0), F.col("group_n"), F.col("v"))})
    stats = cut(stats, "divergence-groups")

    items = join_small(long, stats, ["lang", "source"], "inner")
    items = items.withColumn("p", share(F.col("n"), F.col("group_n"), F.col("v")))

    # pairs: all terms absent, terms of one source, terms of both
    a, b = (stats.select("lang", F.col("rank").alias(k), F.col("p0").alias(f"{k}0"), *(["v"] if k == "a" else [])) for k in "ab")
    absent = a.join(b, "lang").where("a < b").select("lang", "a", "b", F.coalesce(F.col("v") * apart(F.col("a0"), F.col("b0")), F.lit(0)).alias("value"))
    alike = items.groupBy("lang", "rank", "n", "p", "p0").agg(F.count(F.lit(1)).alias("terms"))
    other = stats.select("lang", F.col("rank").alias("other"), F.col("p0").alias("q0"))
    lone = alike.join(other, "lang").where("rank <> other").select(
        "lang", F.least("rank", "other").alias("a"), F.greatest("rank", "other").alias("b"),
        (F.col("terms") * (apart(F.col("p"), F.col("q0")) - apart(F.col("p0"), F.col("q0")))).alias("value"))
    pairs = absent.unionByName(lone).unionByName(tree_corrections(items)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = stats.select("lang", "rank", "source")
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"), "value")
    pair = both.select("lang", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "value").join(
        names.select("lang", F.col("rank").alias("x"), "source"), ["lang", "x"]).join(
        names.select("lang", F.col("rank").alias("y"), F.col("source").alias("item")), ["lang", "y"])

    q = share(F.col("total"), F.col("lang_n"), F.col("v"))
    term = items.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    parts = [pair.withColumns({"part": F.lit("pair"), "rank": place}),
             term.withColumns({"part": F.lit("term"), "rank": place}).where(F.col("rank") <= top)]
    return parts[0].select("lang", "source", "part", "item", "value", "rank").unionByName(
        parts[1].select("lang", "source", "part", "item", "value", "rank"))
