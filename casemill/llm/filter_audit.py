"""Filter interaction audit: what each filter of a chain removes in every
order of the chain, and what it would have removed elsewhere.

A text is read once by a finite-state transducer over its UTF-8 bytes.  Its two
states are GAP and WORD; a byte's class chooses the next state and the events
that the step emits: a word begins, a word ends, a capital, a code point, a
symbol.  Any step into a state depends on the last byte's class alone, so a
block's states are its classes moved by one place and its events one table
lookup per byte.  The spans of words go into a hash table with open addressing;
a span that meets its own hash is compared with the slot's word byte by byte,
and goes to the next slot if they differ (`first_spans`), so the number of
distinct words is exact.

A document's failures are one bit per filter.  All orders and steps follow from
the number of documents per part, set of failures and label, which Spark counts.
The duplicate filter needs the smallest id of each text: rows are counted per
(text, part, label) first, so a text that a third of all documents share is one
row before its smallest id is taken.  Texts are told apart by a 128-bit digest.

A null text is empty, a null source the part ''.  A word is a run of other bytes
than the six ASCII spaces; `[A-Z]` and the symbols are ASCII, a code point is a
byte that continues none.  Rows with the same id and text are no copies of each
other; a null id is not compared, so such a row never fails the duplicate filter
and carries no label.  Of several labels of an id any that is 1 counts.  No
documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import arrow_batch, raw_text

PIECE = 1 << 20  # bytes of text that are read at a time

BLANK, CAPITAL, SYMBOL, PLAIN, FOLLOW = range(5)
GAP, WORD = range(2)
BEGIN, END, IS_CAPITAL, IS_POINT, IS_SYMBOL = (1 << k for k in range(5))


def _class_of(c: int) -> int:
    if c == 32 or 9 <= c <= 13:
        return BLANK
    if 65 <= c <= 90:
        return CAPITAL
    if chr(c) in "#$%&*|":
        return SYMBOL
    return FOLLOW if 0x80 <= c <= 0xBF else PLAIN


CLASS = np.array([_class_of(c) for c in range(256)], np.uint8)
NEXT = np.array([GAP, WORD, WORD, WORD, WORD], np.uint8)  # by class


def _events(state: int, kind: int) -> int:
    out = 0 if kind == FOLLOW else IS_POINT
    if NEXT[kind] != state:
        out |= BEGIN if state == GAP else END
    return out | {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0)


EVENTS = np.array([_events(s, c) for s in (GAP, WORD) for c in range(len(NEXT))], np.uint8)

# Powers of an odd number and of its inverse modulo 2^64, for span hashes.
BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


POWERS, INVERSE = _powers(BASE, PIECE + 1), _powers(pow(BASE, -1, 1 << 64), PIECE + 1)


def span_hashes(block: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: sums of byte times power, from one running
    sum over the block."""
    size = len(block) + 1
    up, down = (POWERS, INVERSE) if size <= len(POWERS) else (_powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size))
    with np.errstate(over="ignore"):
        total = np.zeros(size, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=total[1:])
        h = (total[end] - total[begin]) * down[begin]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def equal_spans(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of `size` bytes at `a` and at `b` hold the same bytes.
    The buffer has eight bytes more than its spans."""
    same = np.ones(len(a), bool)
    eight = np.ndarray(len(buffer) - 7, "<u8", buffer.data, 0, (1,))
    short = np.minimum(size, 64)
    for at in range(0, int(short.max(initial=0)), 8):
        k = np.flatnonzero(same & (size <= 64) & (size > at))
        rest = np.minimum(size[k] - at, 8).astype(np.uint64)
        differ = (eight[a[k] + at] ^ eight[b[k] + at]) << (np.uint64(64) - np.uint64(8) * rest)
        same[k] = differ == 0
    for k in np.flatnonzero(size > 64).tolist():
        same[k] = buffer[a[k] : a[k] + size[k]].tobytes() == buffer[b[k] : b[k] + size[k]].tobytes()
    return same


def first_spans(buffer: np.ndarray, doc: np.ndarray, begin: np.ndarray, size: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which spans are the first with their bytes in their document.

    All spans are put into one table at the same time.  In each round a span
    looks at one slot: an empty one is taken by the first span that looks at
    it; in a slot of the same document, hash and bytes the span is a repeat;
    else it goes on to the next slot.  Equal spans look at the same slots in
    the same rounds, so they end in the same slot.
    """
    n = len(begin)
    first = np.zeros(n, bool)
    bits = max(4, int(2 * n).bit_length())
    with np.errstate(over="ignore"):
        slot = (((h ^ (doc.astype(np.uint64) << np.uint64(32))) * np.uint64(BASE)) >> np.uint64(64 - bits)).astype(np.int64)
    table = np.full(1 << bits, -1, np.int64)
    left = np.arange(n)
    while len(left):
        looked = slot[left]
        takers = left[table[looked] < 0]
        table[slot[takers[::-1]]] = takers[::-1]  # the first taker is written last
        owner = table[looked]
        settled = owner == left
        first[left[settled]] = True
        k = np.flatnonzero(~settled & (doc[owner] == doc[left]) & (h[owner] == h[left]) & (size[owner] == size[left]))
        settled[k] = equal_spans(buffer, begin[owner[k]], begin[left[k]], size[left[k]])
        left = left[~settled]
        slot[left] = (slot[left] + 1) & ((1 << bits) - 1)
    return first


def read_block(block: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Capitals, code points and symbols of each text that begins at `begins`
    in a block, and begins and ends of its words.  The block's last byte and
    the last byte of each text is a blank."""
    kind = CLASS[block]
    state = np.empty_like(kind)
    state[0] = GAP
    state[1:] = NEXT[kind[:-1]]
    events = EVENTS[state * np.uint8(len(NEXT)) + kind]
    counts = [np.add.reduceat((events & bit) != 0, begins, dtype=np.int64) for bit in (IS_CAPITAL, IS_POINT, IS_SYMBOL)]
    return np.array(counts), np.flatnonzero(events & BEGIN), np.flatnonzero(events & END)


def blocks(buffer: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a text with a blank at its end into blocks of about `PIECE` bytes
    that end with a blank."""
    at = 0
    while at < len(buffer):
        end = min(at + PIECE, len(buffer))
        while buffer[end - 1] not in b" \t\n\v\f\r":
            blank = np.flatnonzero(CLASS[buffer[at:end]] == BLANK) if end - at <= PIECE else ()
            end = at + int(blank[-1]) + 1 if len(blank) else min(end + PIECE, len(buffer))
            if not len(blank) and end < len(buffer):  # a word longer than a block: on to its end
                more = np.flatnonzero(CLASS[buffer[end - PIECE : end]] == BLANK)
                end = end - PIECE + int(more[0]) + 1 if len(more) else end
        yield at, end
        at = end


def text_counts(texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """Words, distinct words, capitals, code points and symbols of each text."""
    if not texts:
        return []
    buffer = np.frombuffer(b" ".join([*texts, bytes(8)]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = ends - [len(t) + 1 for t in texts]
    if len(texts) > 1:
        counts, begin, end = read_block(buffer[: ends[-1]], begins)
        doc = np.searchsorted(ends, begin, "right")
        h = span_hashes(buffer[: ends[-1]], begin, end)
    else:  # one long text, block by block
        counts, parts = np.zeros((3, 1), np.int64), []
        for at, stop in blocks(buffer[: ends[-1]]):
            c, b, e = read_block(buffer[at:stop], np.zeros(1, np.int64))
            counts += c
            parts.append((b + at, e + at, span_hashes(buffer[at:stop], b, e)))
        begin, end, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        doc = np.zeros(len(begin), np.int64)
    first = first_spans(buffer, doc, begin, end - begin, h)
    words = np.bincount(doc, minlength=len(texts))
    distinct = np.bincount(doc[first], minlength=len(texts))
    capitals, points, symbols = counts
    return list(zip(*(x.tolist() for x in (words, distinct, capitals, points - 1, symbols)), strict=True))  # without the blank put behind


COUNTS = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("digest", pa.binary()),
                    *[(k, pa.int64()) for k in ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")]])


def _read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        found = text_counts([r[2] for r in rows])
        return arrow_batch([(i, s, hashlib.blake2b(t, digest_size=16).digest(), *c) for (i, s, t), c in zip(rows, found, strict=True)], COUNTS)

    for batch in batches:
        for i, source, raw in zip(*batch.columns, strict=True):
            raw = raw.as_py() or b""
            if rows and size + len(raw) >= PIECE:
                yield out()
                rows, size = [], 0
            rows.append((i.as_py(), source.as_py(), raw))
            size += len(raw) + 1
    if rows:
        yield out()


def statistics(docs: DataFrame) -> DataFrame:
    """`doc_id, source, digest, n_words, n_distinct, n_capitals, n_points,
    n_symbols` per row of `docs`."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), raw_text("text"))
    return cols.mapInArrow(_read_texts, "doc_id long, source string, digest binary, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long")


# Conditions on the statistics under which a document fails.
FILTERS: dict[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 2 * n_points",
    "D": "n_symbols > 0",
}
COPIES = "E"  # fails if a smaller id has the same text


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS) -> DataFrame:
    """`part, bits, good, toxic, n`: documents per part, set of failed filters
    (bit k for the k-th, the last for copies) and label."""
    bits = sum((F.when(F.expr(c), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(filters.values())), F.lit(0))
    rows = statistics(docs).select("doc_id", F.col("source").alias("part"), "digest", bits.alias("bits"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    key = ["digest", "part", "bits", "good", "toxic"]
    named = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").na.fill(False, ["good", "toxic"])
    unnamed = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    # repeated rows first, so that a text's smallest id is one row with its number of documents
    alike = named.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    texts = alike.groupBy(*key).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("m"))
    first = F.min("m.doc_id").over(Window.partitionBy("digest"))  # at most four rows a text and part
    originals = F.when(F.col("m.doc_id") == F.col("first"), F.col("m.n")).otherwise(F.lit(0))
    split = texts.withColumn("first", first).select(*key[1:], "n", originals.alias("kept"))
    copy = 1 << len(filters)
    cells = split.select(*key[1:], F.inline(F.array(
        F.struct(F.lit(0).alias("copy"), F.col("kept").alias("n_docs")), F.struct(F.lit(copy).alias("copy"), (F.col("n") - F.col("kept")).alias("n_docs")))))
    cells = cells.select("part", (F.col("bits") + F.col("copy")).alias("bits"), "good", "toxic", F.col("n_docs").alias("n"))
    cells = cells.unionByName(unnamed.select("part", "bits", "good", "toxic", F.lit(1).cast("long").alias("n")))
    return cells.groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n")).where("n > 0")


def chain_steps(names: list[str]):
    """`(order, step, filter's index, bits of the filters before)` of every
    order and step."""
    return [("".join(names[k] for k in order), step + 1, k, sum(1 << j for j in order[:step]))
            for order in permutations(range(len(names))) for step, k in enumerate(order)]


RESULT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                    *[(k, pa.int64()) for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def _chains(names: list[str]):
    """Every order and step of a part from its counts, one row of cells a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = chain_steps(names)
        sets = np.arange(1 << len(names))
        bit = np.array([1 << k for _, _, k, _ in steps])[:, None]
        before = np.array([b for *_, b in steps])[:, None]
        fails, gone = (sets & bit) > 0, (sets & before) > 0
        kept, removed, redundant, unique = ~fails & ~gone, fails & ~gone, fails & gone, sets == bit
        which = np.array([k for _, _, k, _ in steps])
        for batch in batches:
            for part, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.zeros((3, 1 << len(names)), np.int64)  # all, good, toxic documents by set of failures
                for c in cells:
                    n[0, c["bits"]] += c["n"]
                    n[1, c["bits"]] += c["n"] * c["good"]
                    n[2, c["bits"]] += c["n"] * c["toxic"]
                count = [m @ n[0] for m in (kept, removed, redundant, unique)]
                total = np.array([count[1][which == k].sum() for k in range(len(names))])
                values = [*count, removed @ n[1], removed @ n[2], total[which]]
                yield arrow_batch(list(zip([part] * len(steps), [s[0] for s in steps], [s[1] for s in steps], *(v.tolist() for v in values), strict=True)), RESULT)

    return run


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step: `kept` after it,
    `removed` here, `redundant` (fail this filter, removed before),
    `unique_fails` (fail this filter alone), `good_lost`, `toxic_lost` (labelled
    documents removed here) and `shapley` (this filter's `removed` over all
    orders)."""
    cells = failures(docs, labels, filters).groupBy("part").agg(F.collect_list(F.struct("bits", "good", "toxic", "n")).alias("cells"))  # 4 * 2^filters at most
    return cells.mapInArrow(_chains([*filters, COPIES]), "part string, filter_order string, step int, kept long, removed long, redundant long, "
                            "unique_fails long, good_lost long, toxic_lost long, shapley long")
