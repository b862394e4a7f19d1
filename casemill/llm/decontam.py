"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (a run of `min_match`
words) are tiled: the longest matching runs of unmarked words are found with
running Karp-Rabin hashes, marked in both, and the search repeats with the
next longest, until no run of `min_match` words is left.  The share of the
item's words that tiles cover is its coverage; the order of the tiles does not
matter, so passages whose parts were reordered are caught.

Words are runs of letters, digits and underscores, lower-cased, so a passage
that was re-punctuated or re-cased still matches.  Items with fewer words than
`min_match` match only as a whole run of their words.  Null and empty texts
match nothing; items without words are never found.  Equal items are reported
each; repeated documents are reported row by row.

The items go through all documents in blocks of at most `block_bytes` of text
each; a block's index travels with the tasks, so that bound is its size.  Any
number of items gives the same result, in more passes.  Of several blocks each
one's findings are written before the next but one is read, so that the driver
holds a few blocks at a time and a plan one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import arrow_map, as_text, cut, fresh, join_small, raw_text, slices
from casemill.session import scratch_path

WORDS = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(raw: bytes | None) -> list[str]:
    return WORDS.findall(as_text(raw).lower())


class Items:
    """Index of one block of items: their words as numbers, and the hash of
    every run of `min_match` words -> (item, position)."""

    def __init__(self, items: list[tuple[int | None, bytes]], min_match: int):
        self.vocabulary: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.words: list[np.ndarray] = []
        self.min_match = min_match
        for i, raw in items:
            words = words_of(raw)
            if words:
                self.ids.append(i)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64))
        # seeds of short items are as long as the item
        self.sizes = sorted({min(min_match, len(w)) for w in self.words})
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            found = [(int(h), k) for k, w in enumerate(self.words) if min(min_match, len(w)) == size
                     for h in np.unique(rolling(w, size))]
            hashes = np.array([h for h, _ in found], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.seeds[size] = hashes[order], np.array([k for _, k in found])[order]

    def numbers(self, words: list[str]) -> np.ndarray:
        """Words as the items' numbers, 0 for words that no item has."""
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    def candidates(self, doc: np.ndarray) -> set[int]:
        """Items that share a seed with the document."""
        out: set[int] = set()
        zero = np.concatenate([[0], np.cumsum(doc == 0)])
        for size in self.sizes:
            if len(doc) < size:
                continue
            known = np.flatnonzero(zero[size:] == zero[:-size])  # runs of words that items have
            if not len(known):
                continue
            run = rolling(doc, size)[known]
            hashes, owners = self.seeds[size]
            low, high = np.searchsorted(hashes, run, "left"), np.searchsorted(hashes, run, "right")
            for a, b in {(int(a), int(b)) for a, b in zip(low, high, strict=True) if b > a}:
                out.update(owners[a:b].tolist())
        return out


def rolling(x: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of `size` numbers."""
    if len(x) < size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(x) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * BASE + x[k : k + len(out)] + np.uint64(1)
    return out


def matches(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Positions (document, item) of equal unmarked runs of `size` words,
    found by hash and compared word by word: by position in the item, then in
    the document.  What the caller marks meanwhile is left out, and a document
    position that was marked is not looked at again, so a word repeated in
    both does not lead to all pairs of its places."""
    open_runs = lambda free: np.flatnonzero(np.convolve(free, np.ones(size, int), "valid") == size)
    di, ii = open_runs(free_doc), open_runs(free_item)
    if not len(di) or not len(ii):
        return
    dh, ih = rolling(doc, size)[di], rolling(item, size)[ii]
    keep = np.isin(dh, ih)
    table: dict[int, list[int]] = {}
    for h, a in zip(dh[keep].tolist(), di[keep].tolist(), strict=True):
        table.setdefault(h, []).append(a)
    first = dict.fromkeys(table, 0)
    for h, b in zip(ih.tolist(), ii.tolist(), strict=True):
        if h not in table or not free_item[b : b + size].all():
            continue
        places, k = table[h], first[h]
        while k < len(places) and not free_doc[places[k] : places[k] + size].all():
            k += 1
        first[h] = k
        for a in map(places.__getitem__, range(k, len(places))):
            if free_doc[a : a + size].all() and np.array_equal(doc[a : a + size], item[b : b + size]):
                yield a, b
                if not free_item[b : b + size].all():
                    break


def tile(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: `(document position, item position, length)` of
    non-overlapping tiles, longest first; of equal lengths the earliest in the
    item, then in the document."""
    free_doc, free_item = np.ones(len(doc), int), np.ones(len(item), int)
    tiles: list[tuple[int, int, int]] = []
    size = len(item)
    while size >= min_match:
        # the longest run that still matches, at most as long as the last
        low, high = min_match, size
        if next(matches(doc, item, free_doc, free_item, min_match), None) is None:
            break
        while low < high:
            mid = (low + high + 1) // 2
            if next(matches(doc, item, free_doc, free_item, mid), None) is None:
                high = mid - 1
            else:
                low = mid
        size = low
        for a, b in matches(doc, item, free_doc, free_item, size):
            free_doc[a : a + size] = free_item[b : b + size] = 0
            tiles.append((a, b, size))
        size = size if size > min_match else size - 1
    return tiles


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered_words", pa.int64()),
                   ("n_tiles", pa.int64()), ("tiles", pa.list_(pa.list_(pa.int64())))])
FOUND_DDL = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long, tiles array<array<long>>"


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items (`item_id`, `text`) in blocks of at most `block_bytes` of
    text (a longer item alone in its block), streamed through the driver one
    partition at a time."""
    held, size = [], 0
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), raw_text("text"))
    for i, raw in rows.toLocalIterator():
        if held and size + len(raw) > block_bytes:
            yield held
            held, size = [], 0
        held.append((i, bytes(raw)))
        size += len(raw)
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, min_coverage: float = 0.5,
                 block_bytes: int = 4 << 20) -> DataFrame:
    """A row per (document, item) whose tiles cover `min_coverage` of the
    item's words or more: `doc_id`, `item_id`, word counts and the tiles as
    `[document word, item word, length]`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text("text"))
    found = lambda items: rows.mapInArrow(arrow_map(searcher(items, min_match, min_coverage), FOUND), FOUND_DDL)
    out = in_turn(item_blocks(benchmark, block_bytes), found, "tiles-found")
    return docs.sparkSession.createDataFrame([], FOUND_DDL) if out is None else out


def in_turn(blocks: Iterator[list], found: Callable[[list], DataFrame], name: str) -> DataFrame | None:
    """All that is found for the blocks.  A single block's findings are left as
    a plan; of several, each block's are appended to one table at once, before
    the next block is taken."""
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return None if first is None else found(first)
    part = found(first)
    spark, schema, path = part.sparkSession, part.schema, scratch_path(part.sparkSession, name)
    part.write.parquet(path)
    part = first = None
    while second is not None:
        found(second).write.mode("append").parquet(path)
        second = next(blocks, None)
    return spark.read.schema(schema).parquet(path)


def finder(items: list[tuple[int | None, bytes]], min_match: int, min_coverage: float):
    """What a text holds of one block of items, indexed once per task:
    `(item, words of it, covered words, tiles)` per item found."""
    held: list[Items] = []

    def find(raw: bytes | None):
        if not held:
            held.append(Items(items, min_match))
        index = held[0]
        doc = index.numbers(words_of(raw))
        for k in sorted(index.candidates(doc)):
            item = index.words[k]
            tiles = tile(doc, item, min(min_match, len(item)))
            covered = sum(t[2] for t in tiles)
            if covered >= min_coverage * len(item):
                yield index.ids[k], len(item), covered, tiles

    return find


def searcher(items, min_match: int, min_coverage: float):
    find = finder(items, min_match, min_coverage)

    def search(rows):
        return [(doc_id, item, n, covered, len(tiles), [list(t) for t in tiles])
                for doc_id, raw in rows for item, n, covered, tiles in find(raw)]

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, min_coverage: float = 0.5,
                  block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of `docs` that hold no item of `benchmark`, all columns kept.
    With one block of items, rows are judged where they are: nothing is joined
    or shuffled.  With more, each block's contaminated texts are written as
    (length, two hashes), and rows with such a text go by one join."""
    blocks = item_blocks(benchmark, block_bytes)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is None:
        at = docs.columns.index("text")
        return docs.mapInArrow(_keeper(finder(first, min_match, min_coverage), at), docs.schema)
    named = docs.select(raw_text("text"), *[F.expr(c).alias(n) for n, c in TEXT_KEY.items()])
    found = lambda items: named.mapInArrow(
        arrow_map(_holders(items, min_match, min_coverage), TEXT_NAMES), "n_bytes long, hash_a long, hash_b long").distinct()
    bad = cut(in_turn(chain([first, second], blocks), found, "tiles-texts").distinct(), "tiles-bad")
    key = fresh(docs.columns, *TEXT_KEY)
    keyed = docs.withColumns(dict(zip(key, map(F.expr, TEXT_KEY.values()), strict=True)))
    return join_small(keyed, bad.toDF(*key), key, "left_anti").drop(*key)


# what a text is told by where the text itself is not carried
TEXT_KEY = {"n_bytes": "CAST(octet_length(text) AS BIGINT)", "hash_a": "xxhash64(text)", "hash_b": "xxhash64('b', text)"}
TEXT_NAMES = pa.schema([(n, pa.int64()) for n in TEXT_KEY])


def _holders(items, min_match: int, min_coverage: float):
    find = finder(items, min_match, min_coverage)
    return lambda rows: [tuple(name) for raw, *name in rows if next(iter(find(raw)), None) is not None]


def _keeper(find, at: int):
    def keep(batches):
        for batch in batches:
            for part in slices(batch, column=at):
                clean = [next(iter(find(None if t is None else t.encode("utf-8", "replace"))), None) is None
                         for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))
        pa.default_memory_pool().release_unused()

    return keep
