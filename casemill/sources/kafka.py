"""Kafka source (Structured Streaming) and the Kafka-shaped row layout.

The Kafka connector jar is a deployment dependency; everything downstream
works on any DataFrame with the Kafka columns `key value topic partition
offset timestamp`, so a file source of such rows drives the same operators
(that is how the tests run the streams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.schemas import KAFKA_SCHEMA


def kafka_options(servers: str, topics: list[str] | str, *, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = False,
                  min_partitions: int | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for `readStream.format("kafka")`.

    - `starting_offsets` is `earliest` for a first start, or the JSON from
      `offsets.starting_offsets_json` to resume from a ledger; once the query
      has a checkpoint, the checkpoint decides.
    - `max_offsets_per_trigger` caps a micro-batch (rate x partitions x
      seconds reproduces a per-partition rate cap).
    - `fail_on_data_loss=False`: offsets removed by retention are skipped,
      matching the clamp-to-earliest rule of the ledger.
    - `min_partitions` (e.g. the executor core count) splits the offset
      range of a hot Kafka partition over several tasks, so one partition
      holding a third of the messages is not parsed by one task.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update(extra or {})
    return opts


def rate_cap(records_per_second_per_partition: int, partitions: int, batch_seconds: float) -> int:
    """`maxOffsetsPerTrigger` equivalent of a per-partition rate cap."""
    return int(records_per_second_per_partition * partitions * batch_seconds)


def kafka_source(spark: SparkSession, servers: str, topics: list[str] | str, **kw) -> DataFrame:
    """Streaming Kafka DataFrame with string key/value."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **kw)).load()
    return kafka_shaped(raw)


def kafka_shaped(df: DataFrame) -> DataFrame:
    """Cast a Kafka (or Kafka-like) frame to the canonical column types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KAFKA_SCHEMA.fields])


def file_source(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: str | None = None) -> DataFrame:
    """A stream of Kafka-shaped rows from parquet files, with the cap on what
    a micro-batch takes that `maxOffsetsPerTrigger` is for a topic.  Give one."""
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(folder)
