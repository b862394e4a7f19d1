"""Feeds for streams from tables: a file source of Kafka-shaped rows stands in
for a topic where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators.profile_store import ProfileStore
from casemill.schemas import KAFKA_SCHEMA
from casemill.session import scratch_path
from casemill.streaming.drivers import (
    Profiles,
    StreamPaths,
    current_table,
    handler,
    last_complete_batch,
    start_case_stream,
    start_intake_stream,
    start_update_stream,
)


def stage_source(spark: SparkSession, messages: DataFrame, folder: str, files: int = 4,
                 by: str = "partition") -> None:
    """Write Kafka-shaped rows as files, all rows of one `by` value (a Kafka
    partition, or a key) per file: a stand-in for a topic when no broker is
    at hand."""
    (messages.select(*[F.col(f.name).cast(f.dataType) for f in KAFKA_SCHEMA.fields])
     .repartition(files, by).write.mode("overwrite").parquet(folder))


def slices(messages: DataFrame, n: int) -> list[DataFrame]:
    """`messages` in `n` parts of ascending offsets."""
    top = messages.agg(F.max("offset")).first()[0]
    part = F.floor(F.col("offset") * n / F.lit((0 if top is None else int(top)) + 1))
    return [messages.where(part == k) for k in range(n)]


class Replay:
    """A file source of Kafka-shaped rows and the stream over it: `feed`
    appends messages, written by as many tasks as they come in, and runs the
    query from its checkpoint until they are processed, in one micro-batch."""

    def __init__(self, spark: SparkSession, kind: str, paths: StreamPaths, as_of: str | None = None, group: str | None = None,
                 extracted: Profiles | ProfileStore | None = None, intake_topic: str | None = None, update_topic: str | None = None):
        self.spark, self.kind, self.paths, self.as_of = spark, kind, paths, as_of
        self.group, self.extracted = group or f"case_{kind}", extracted
        self.topics = (intake_topic, update_topic)

    def again(self, messages: DataFrame) -> None:
        """Run the last batch once more, as the query does when it stops
        before its checkpoint knows that the batch was handled."""
        handle = handler(self.kind, self.paths, self.group, self.as_of, extracted=self.extracted, topics=self.topics)
        handle(messages.select(*[F.col(f.name).cast(f.dataType) for f in KAFKA_SCHEMA.fields]), last_complete_batch(self.spark, self.paths))

    def feed(self, messages: DataFrame) -> None:
        src = f"{self.paths.root}/source"
        messages.select(*[F.col(f.name).cast(f.dataType) for f in KAFKA_SCHEMA.fields]).write.mode("append").parquet(src)
        source = self.spark.readStream.schema(KAFKA_SCHEMA).parquet(src)
        trigger = {"availableNow": True}
        if self.kind == "cases":
            q = start_case_stream(source, None, self.paths, self.group, *self.topics, self.as_of, trigger=trigger, extracted=self.extracted)
        elif self.kind == "intake":
            q = start_intake_stream(source, None, self.paths, self.group, self.as_of, trigger=trigger, extracted=self.extracted)
        else:
            q = start_update_stream(source, self.paths, self.group, self.as_of, trigger=trigger)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def stored_summary(spark: SparkSession, profiles: DataFrame, folder: str, parts: int = 8) -> ProfileStore:
    """A profile store with the documents of `profiles`."""
    store = ProfileStore(spark, folder, parts)
    store.add(profiles, 0)
    return store


def run_stream_to_table(spark: SparkSession, kind: str, messages: DataFrame, snapshot: DataFrame | None,
                        profiles: DataFrame | None = None, as_of: str | None = None,
                        group: str | None = None, batches: int = 3, intake_topic: str | None = None,
                        update_topic: str | None = None) -> DataFrame:
    """Feed `messages` to the stream in `batches` micro-batches of ascending
    offsets, so that the messages of one key span them, and return the folded
    table.  The query is restarted from its checkpoint for each."""
    paths = StreamPaths(scratch_path(spark, f"stream-{kind}"))
    extracted = None if profiles is None else stored_summary(spark, profiles, f"{paths.root}/profile_summary")
    replay = Replay(spark, kind, paths, as_of, group, extracted, intake_topic, update_topic)
    for part in slices(messages, batches):
        replay.feed(part)
    return current_table(spark, paths, snapshot)
