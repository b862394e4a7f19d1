"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import scratch_path

# A word is a run of characters other than the space and \t \n \v \f \r.
# `bytes.split()` cuts UTF-8 text at exactly these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"


def reachable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library also when the
    session was started elsewhere.  A cluster gets it with `--py-files`."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a table in the shared folder and read it back, so later
    steps neither recompute it nor depend on any one executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block, shuffle files go as soon as the query that made them
    ends (Spark 4.1 or later), so that steps written by `cut` do not pile up
    what none will read again.  The session's own setting is put back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def raw_text(column: str) -> Column:
    """The column's UTF-8 bytes: Python splits and hashes bytes faster than
    text, and malformed sequences cannot fail a batch."""
    return F.col(column).cast("binary").alias(column)


def as_text(raw: bytes | None) -> str:
    return "" if raw is None else raw.decode("utf-8", "replace")


def count_words(column: Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


SLICE_BYTES = 2 << 20  # text that a task takes out of an Arrow batch at a time


def slices(batch: pa.RecordBatch, most_rows: int = 256, most_bytes: int = SLICE_BYTES, column: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `most_rows` rows and about `most_bytes`
    bytes in all its columns (or in one); a larger row is a slice of its own."""
    if column is None:
        size = sum((_lengths(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64))
    else:
        size = _lengths(batch.column(column))
    before = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(before, before[at] + most_bytes, "right")) - 1
        end = min(max(at + 1, end), at + most_rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _lengths(column: pa.Array) -> np.ndarray:
    if pa.types.is_binary(column.type) or pa.types.is_string(column.type) or pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.zeros(len(column), np.int64)


def arrow_map(fn: Callable[[list[tuple]], list[tuple]], schema: pa.Schema, step: int = 256):
    """A `mapInArrow` function that hands `fn` at most `step` input rows at a
    time (tuples in column order), bounded in bytes, and emits the rows it
    returns.  At the end of a task Arrow gives its unused memory back: workers
    live on and serve the next stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, step):
                rows = fn(list(zip(*(c.to_pylist() for c in part.columns), strict=True)))
                yield arrow_batch(rows, schema)
        pa.default_memory_pool().release_unused()

    return run


def arrow_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def sample_at_most(df: DataFrame, bound: int, key: Column) -> DataFrame:
    """About `bound` rows of `df` at most, chosen by the hash of `key` alone
    (the same rows whatever the partitioning); all rows when there are fewer.
    Rows with equal keys are chosen or left together."""
    n = df.count()
    if n <= bound:
        return df
    slots = 1 << 20
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(slots)) < F.lit(int(slots * bound / n)))


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that are none of `columns` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def scalar(df: DataFrame):
    """The single value of a one-row, one-column frame (an aggregate)."""
    return df.first()[0]


def write_blobs(blobs: DataFrame, path: str) -> None:
    """Write each row's `blob` (binary, last byte 0x00) as one file.

    The text writer copies a string's bytes as they are and then adds the line
    separator, so the blob is passed without its last byte and the separator
    is that byte.  Task commits go through Spark's file commit protocol: a
    retried task leaves no half-written file.
    """
    body = F.expr("substring(blob, 1, length(blob) - 1)").cast("string").alias("value")
    blobs.select(body).write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """`(path, content)` of every file below `path`, one row each."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int = 1_000_000) -> DataFrame:
    """Null-safe join on `on`.  `right` (fixed-width columns, already written)
    is counted: up to `max_rows` rows, some tens of MB, it is broadcast and
    `left` stays where it is; beyond that both sides are shuffled."""
    other = right.select(*[F.col(c).alias(f"right_{c}") if c in on else F.col(c) for c in right.columns])
    same = [left[c].eqNullSafe(other[f"right_{c}"]) for c in on]
    joined = left.join(F.broadcast(other) if right.count() <= max_rows else other, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"right_{c}" for c in on])
