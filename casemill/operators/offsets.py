"""Per-group, per-partition stream positions kept in a ledger table.

The ledger `(groupid, topic, kafka_partition, kafka_offset)` is keyed by its
first three columns; an advance replaces the stored position of every
partition the batch touched with `max(offset) + 1` (the next offset to read).
Structured Streaming's own checkpoint is the source of truth for a running
query; the ledger is the shared, queryable record of positions and the way to
migrate a start position into a new query (`starting_offsets_json`).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.operators.merge import OFFSET_LEDGER, make_ord, replace_merge
from casemill.schemas import LEDGER_COLUMNS

def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("groupid").cast("string"), F.col("topic").cast("string"),
        F.col("kafka_partition").cast("int"), F.col("kafka_offset").cast("bigint"),
    )


def read_ledger(ledger: DataFrame, group: str, topic: str | None = None) -> DataFrame:
    """Stored positions of one group (and one topic when given)."""
    out = ledger.where(F.col("groupid") == F.lit(group))
    if topic is not None:
        out = out.where(F.col("topic") == F.lit(topic))
    return _typed(out)


def batch_end_offsets(batch: DataFrame, group: str) -> DataFrame:
    """Next offset per (topic, partition) of a batch of Kafka-shaped rows.

    Partial aggregation combines map-side, so the shuffle carries one row per
    (task, partition) however large the batch is.
    """
    return batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("kafka_offset")).select(
        F.lit(group).alias("groupid"), F.col("topic"),
        F.col("partition").cast("int").alias("kafka_partition"), F.col("kafka_offset").cast("bigint"),
    )


def advance_ledger(ledger: DataFrame | None, batch: DataFrame, group: str, batch_id: int = 0) -> DataFrame:
    """Ledger after a batch: replace the position of every touched partition."""
    ends = batch_end_offsets(batch, group)
    types = {"kafka_partition": T.IntegerType(), "kafka_offset": T.LongType()}
    target = _typed(ledger) if ledger is not None else None
    return replace_merge(target, ends, OFFSET_LEDGER, ord=make_ord(batch_id, 0), types=types).select(*LEDGER_COLUMNS)


def resolve_start_offsets(ledger: DataFrame, earliest: DataFrame, group: str, topic: str) -> DataFrame:
    """Start position per partition from the ledger and the earliest offsets.

    `earliest` is `(topic, partition, earliest_offset)` for every partition
    that exists now.  A stored position below the earliest available one is
    clamped up (`lost` counts the skipped messages); a partition that the
    ledger does not know starts at its earliest offset.
    """
    stored = read_ledger(ledger, group, topic).select(
        F.col("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("stored"),
    )
    e = earliest.where(F.col("topic") == F.lit(topic)).select(
        "topic", F.col("partition").cast("int").alias("partition"), F.col("earliest_offset").cast("bigint"),
    )
    j = e.join(stored, ["topic", "partition"], "left")
    return j.select(
        "topic", "partition",
        F.greatest(F.col("stored"), F.col("earliest_offset")).alias("start_offset"),
        F.coalesce(F.greatest(F.col("earliest_offset") - F.col("stored"), F.lit(0).cast("bigint")),
                   F.lit(0).cast("bigint")).alias("lost"),
    )


def starting_offsets_json(resolved_rows) -> str:
    """`startingOffsets` option text for the Kafka source from resolved rows.

    Takes the (small, one row per partition) collected result of
    `resolve_start_offsets`.
    """
    spec: dict[str, dict[str, int]] = {}
    for r in resolved_rows:
        spec.setdefault(r["topic"], {})[str(r["partition"])] = int(r["start_offset"])
    return json.dumps(spec, sort_keys=True)
