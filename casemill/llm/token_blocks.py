"""Token-id files in patched frame-of-reference blocks.

A shard file holds whole documents in ascending order of their id:

    magic "PFORTOK1", then little-endian u32: major, minor, documents,
    blocks, block length; u64: tokens
    per document: u8 (1: the id is null), i64 id, u32 tokens
    per block:    u64 byte offset of the block, from the start of the file
    per block:    u32 minimum, u8 width, u16 exceptions, then the packed low
                  bits (value - minimum, `width` bits each, first value in
                  the lowest bits), the u16 positions and the u32 values of
                  the exceptions
    one byte 0x00

A block subtracts its minimum and packs at the smallest width that fits a
given percentile of its values; larger ones are exceptions, stored whole in a
list beside the block.  The last block of a shard may be shorter.  `major` and
`minor` are the task and the file within the task, so the shards' order is the
order of their documents.

Null ids come first, in their own order; rows with equal ids are ordered by
text and kept.  A null or empty text is a document of the end id alone.
A document longer than a shard makes a longer shard; it is never split.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casemill.llm.common import arrow_batch, as_text, cut, join_small, raw_text, read_blobs, slices, write_blobs

MAGIC = b"PFORTOK1"
HEAD = struct.Struct("<8s5IQ")
DOC = np.dtype([("null", "u1"), ("id", "<i8"), ("n", "<u4")])
BLOCK = struct.Struct("<IBH")
GROUP = 256  # blocks packed at a time


# -- the block codec ---------------------------------------------------------

def _low_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of u32 -> rows of bytes with `width` bits per value."""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(*values.shape, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def _from_bits(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    """Rows of packed bytes -> rows of `n` u32."""
    bits = np.unpackbits(packed, axis=1, count=n * width, bitorder="little").reshape(len(packed), n, width)
    full = np.zeros((len(packed), n, 32), np.uint8)
    full[:, :, :width] = bits
    return np.packbits(full, axis=2, bitorder="little").view("<u4").reshape(len(packed), n)


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))) + 1, 0).astype(int)


def pack_blocks(ids: np.ndarray, block: int, percentile: float) -> list[bytes]:
    out: list[bytes] = []
    whole = len(ids) // block * block
    parts = [ids[:whole].reshape(-1, block)] + ([ids[whole:].reshape(1, -1)] if whole < len(ids) else [])
    for part in parts:
        rank = max(0, int(np.ceil(percentile * part.shape[1])) - 1)
        for at in range(0, len(part), GROUP):
            rows = part[at : at + GROUP]
            low = rows.min(axis=1)
            delta = rows - low[:, None]
            width = _bit_length(np.partition(delta, rank, axis=1)[:, rank])
            made: list[bytes] = [b""] * len(rows)
            for w in np.unique(width):
                which = np.flatnonzero(width == w)
                bits = _low_bits(delta[which], int(w))
                over = (delta[which].astype(np.uint64) >> np.uint64(w)) > 0
                for k, i in enumerate(which):
                    pos = np.flatnonzero(over[k])
                    made[i] = b"".join((BLOCK.pack(int(low[i]), int(w), len(pos)), bits[k].tobytes(),
                                        pos.astype("<u2").tobytes(), rows[i][pos].astype("<u4").tobytes()))
            out += made
    return out


def unpack_blocks(content: bytes, starts: np.ndarray, total: int, block: int) -> np.ndarray:
    out = np.empty(total, np.uint32)
    for at in range(0, len(starts), GROUP):
        group: dict[tuple[int, int], list] = {}
        for b in range(at, min(at + GROUP, len(starts))):
            n = min(block, total - b * block)
            low, width, n_over = BLOCK.unpack_from(content, starts[b])
            group.setdefault((n, width), []).append((b, low, n_over, int(starts[b]) + BLOCK.size))
        for (n, width), items in group.items():
            size = (n * width + 7) // 8
            packed = np.stack([np.frombuffer(content, np.uint8, size, p) for *_, p in items])
            values = _from_bits(packed, n, width) + np.array([low for _, low, _, _ in items], np.uint32)[:, None]
            for row, (b, _, n_over, p) in zip(values, items, strict=True):
                pos = np.frombuffer(content, "<u2", n_over, p + size)
                row[pos] = np.frombuffer(content, "<u4", n_over, p + size + 2 * n_over)
                out[b * block : b * block + n] = row
    return out


def pack_shard(major: int, minor: int, doc_ids: list[int | None], counts: list[int], ids: np.ndarray,
               block: int, percentile: float) -> bytes:
    blocks = pack_blocks(ids, block, percentile)
    docs = np.array([(i is None, i or 0, n) for i, n in zip(doc_ids, counts, strict=True)], DOC)
    first = HEAD.size + docs.nbytes + 8 * len(blocks)
    starts = first + np.cumsum([0, *map(len, blocks)][: len(blocks)], dtype="<u8") if blocks else np.empty(0, "<u8")
    head = HEAD.pack(MAGIC, major, minor, len(docs), len(blocks), block, len(ids))
    return b"".join((head, docs.tobytes(), starts.astype("<u8").tobytes(), *blocks, b"\0"))


def unpack_shard(content: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
    """`(major, minor, documents, ids)` of a shard file."""
    magic, major, minor, n_docs, n_blocks, block, total = HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    docs = np.frombuffer(content, DOC, n_docs, HEAD.size)
    starts = np.frombuffer(content, "<u8", n_blocks, HEAD.size + docs.nbytes)
    return major, minor, docs, unpack_blocks(content, starts.astype(np.int64), total, block)


# -- encoding ----------------------------------------------------------------

# a full stop or comma behind a digit or Latin-1 letter and before a space
POINT = re.compile(r"([.,])(?<=[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF].)(?=[ \n]|\Z)")
SMALL = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))  # Latin-1 small letters
LONG = 64  # characters; longer chunks are not kept


class Encoder:
    """Ids of texts by the tokenizers library.

    Where the tokenizer provably never sees across a space (its normaliser and
    pre-tokenizer drop spaces, and no added token holds one), a text is cut
    into chunks between spaces and line feeds, and each distinct chunk of a
    group of texts meets the library once.  Where it also parts a word from a
    full stop or comma behind it, and reads capitals like small letters, these
    are taken off first, so that fewer chunks are distinct.  Otherwise whole
    texts go through the library.

    The ids of up to `limit` chunks are kept in two generations: when the
    young one is full it becomes the old one, and what is used again is moved
    on.
    """

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.half = limit // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.separable = self._parts("a  b\nc") == ["a", "b", "c"] and not any(c.isspace() for t in added for c in t)
        self.points = self._parts("a, b1. \u00e9.") == [*self._parts("a"), *self._parts(","), *self._parts("b1"),
                                                       *self._parts("."), *self._parts("\u00e9"), *self._parts(".")]
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.caseless = self._parts(letters.upper()) == self._parts(letters)
        # the code of each small letter, if any run of them is one pre-token
        coded = {c: "".join(self._parts(c)) for c in SMALL}
        one = self._parts(SMALL) == ["".join(coded.values())] and all(self._parts(c) == [coded[c]] for c in SMALL)
        self.plain = str.maketrans(coded) if one else None
        # no added token may be cut or brought about by the steps above
        self.apart = {c for t in added for c in t[:1]}

    def _parts(self, text: str) -> list[str]:
        norm = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        return [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm)] if self.tok.pre_tokenizer else [norm]

    def prepared(self, text: str) -> str:
        """The text with single spaces where chunks are parted."""
        if not any(c in text for c in self.apart):
            if self.caseless and text.isascii():
                text = text.lower()
            if self.points:
                text = POINT.sub(r" \1", text)
        return text.replace("\n", " ")

    def many(self, texts: list[str]) -> list[bytes]:
        """Little-endian u32 ids of each text."""
        if not self.separable:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        if not texts:
            return []
        parts = pc.split_pattern(pa.array([self.prepared(t) for t in texts], pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        # lay the chunks' ids one behind the other, as the texts have them
        laid = pa.array(ids, pa.large_binary()).take(coded.indices)
        offsets, data = np.frombuffer(laid.buffers()[1], np.int64), memoryview(laid.buffers()[2] or b"")
        at = offsets[parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        here = dict(zip(chunks, map(self.young.get, chunks), strict=True))
        fresh = []
        for k in [k for k, ids in here.items() if ids is None]:
            ids = self.old.get(k)
            if ids is None:
                fresh.append(k)
            else:
                here[k] = self.young[k] = ids
        self._learn(fresh, here)
        return list(here.values())

    def _learn(self, chunks: list[str], here: dict[str, bytes]) -> None:
        """Let the library encode `chunks`: those of plain small letters, one
        pre-token each, by its model alone, the others by the whole."""
        odd, pack = [], (array.tobytes if sys.byteorder == "little" else lambda ids: np.array(ids, "<u4").tobytes())
        for k in chunks:
            small = k.lower() if self.caseless and k.isascii() else k
            if self.plain is not None and small and not small.strip(SMALL) and len(k) <= LONG:
                coded = small if k.isascii() else k.translate(self.plain)
                here[k] = pack(array("I", [t.id for t in self.tok.model.tokenize(coded)]))
            else:
                odd.append(k)
        for at in range(0, len(odd), 1024):
            part = odd[at : at + 1024]
            made = self.tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(made.ids, "<u4").tobytes()
            bounds = 4 * np.searchsorted(np.array(made.word_ids, np.int64), np.arange(len(part) + 1))
            for k, a, b in zip(part, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                here[k] = ids[a:b]
        self.young.update((k, here[k]) for k in chunks if len(k) <= LONG)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -- writing and reading -----------------------------------------------------

GROUP_BYTES = 8 << 20  # text encoded at a time
EQUAL_ROWS = 1024  # rows of one id and text that may stay together


BLOB = pa.schema([("blob", pa.binary())])
READ = pa.schema([("major", pa.int64()), ("minor", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()),
                  ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, shard_tokens: int = 1 << 21,
                      block: int = 1024, percentile: float = 0.95, equal_rows: int = EQUAL_ROWS) -> None:
    """Encode every text of `docs` (`doc_id`, `text`), append `end_id`, and
    write shard files below `path` in ascending order of the id.

    One range shuffle puts the documents in order (a frequent id is spread by
    its texts' hashes, a frequent row as `dealt` says); each task then encodes
    and writes its own range, one file per about `shard_tokens` tokens.
    """
    if not 0 < block <= 1 << 16:
        raise ValueError("a block holds 1 to 65536 ids")
    end = int(end_id).to_bytes(4, "little")

    def write(batches):
        enc, major, minor = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        pieces: list[bytes] = []
        size = 0
        for batch in batches:
            for part in slices(batch, batch.num_rows, GROUP_BYTES):
                some, raws = (c.to_pylist() for c in part.columns)
                for i, ids in zip(some, enc.many([as_text(r) for r in raws]), strict=True):
                    ids += end
                    doc_ids.append(i)
                    pieces.append(ids)
                    size += len(ids) // 4
                    if size >= shard_tokens:
                        yield arrow_batch([(shard(major, minor, doc_ids, pieces),)], BLOB)
                        doc_ids, pieces, size, minor = [], [], 0, minor + 1
        if doc_ids:
            yield arrow_batch([(shard(major, minor, doc_ids, pieces),)], BLOB)
        enc.old = {}  # the worker lives on: it keeps the young generation alone
        pa.default_memory_pool().release_unused()

    def shard(major, minor, doc_ids, pieces):
        return pack_shard(major, minor, doc_ids, [len(p) // 4 for p in pieces],
                          np.frombuffer(b"".join(pieces), "<u4"), block, percentile)

    order = dealt(docs, equal_rows).repartitionByRange("doc_id", "tie", "place")
    order = order.sortWithinPartitions("doc_id", "tie", "place", "text").select("doc_id", "text")
    write_blobs(order.mapInArrow(write, "blob binary"), path)


def dealt(docs: DataFrame, equal_rows: int = EQUAL_ROWS) -> DataFrame:
    """`doc_id, tie, place, text` per row of `docs`: `tie` is the text's hash,
    and rows of an id and text that occurs more than `equal_rows` times are
    numbered by `place`, so that ranges can part them.

    Counts go by id and hash and combine before they are shuffled.  Frequent
    rows are reduced to one with a count; that is cut into parts which are
    spread before they become rows again.  Numbers given to rows where they lie
    would not do: a task that runs again may meet its rows in another order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), raw_text("text"))
    often = rows.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > equal_rows)
    often = cut(often.select("doc_id", "tie"), "token-often")
    if often.isEmpty():
        return rows.select("doc_id", "tie", F.lit(0).cast("long").alias("place"), "text")
    rest = join_small(rows, often, ["doc_id", "tie"], "left_anti")
    units = join_small(rows, often, ["doc_id", "tie"], "left_semi").groupBy("doc_id", "tie", "text").agg(F.count(F.lit(1)).alias("n"))
    step = F.lit(equal_rows).cast("long")
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("begin")
    parts = units.select("*", begin).repartition("doc_id", "tie", "begin")
    place = F.explode(F.sequence(F.col("begin"), F.least(F.col("n"), F.col("begin") + step) - 1)).alias("place")
    again = cut(parts.select("doc_id", "tie", place, "text"), "token-equal")
    return rest.select("doc_id", "tie", F.lit(0).cast("long").alias("place"), "text").unionByName(again)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """`major, minor, doc_id, place, offset, n_tokens, ids_crc32` of every
    document below `path`; `offset` counts the ids before it in its shard."""

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                major, minor, docs, ids = unpack_shard(content.as_py())
                starts = np.cumsum(docs["n"], dtype=np.int64) - docs["n"]
                raw = ids.astype("<u4").tobytes()
                yield arrow_batch([
                    (major, minor, None if d["null"] else int(d["id"]), k, int(s), int(d["n"]), zlib.crc32(raw[4 * s : 4 * (s + int(d["n"]))]))
                    for k, (d, s) in enumerate(zip(docs, starts.tolist(), strict=True))], READ)

    return read_blobs(spark, path).select("content").mapInArrow(
        read, "major long, minor long, doc_id long, place long, offset long, n_tokens long, ids_crc32 long")


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document below `path`;
    `start` counts the ids of all documents before it.

    Only one row per shard file goes through the ordered running sum.
    """
    read = cut(read_token_files(spark, path), "token-index")
    totals = read.groupBy("major", "minor").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("major", "minor").rowsBetween(Window.unboundedPreceding, -1))
    shards = totals.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    return read.join(shards, ["major", "minor"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
