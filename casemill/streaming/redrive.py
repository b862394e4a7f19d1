"""Corrected messages enter where the quarantined ones stood.

A message that went to quarantine has a position (topic, partition, offset) and
the batch it came in, and so a place in the order of the table.  `redrive`
takes corrected values for such positions, parses (and enriches) them like any
message and logs their changes with that batch: a replace or update that came
after the bad message still wins over it, an update that found no case now
applies to the case that the corrected message inserts.

Each position is added once.  What cannot be added is returned with a reason:

- `not_quarantined`: no message of this root was quarantined there;
- `redriven`: an earlier redrive has added it;
- `closed`: a snapshot may hold its batch, so its place is gone (send the
  message anew), or the batch is running again now;
- `unknown_topic`, or the reason why the corrected value is bad too: it may be
  corrected once more.

A redrive writes to folders of its own and counts from the moment its file in
the order is renamed.  One that died, or that a compaction or a later redrive
overtook, leaves nothing behind that is read.

Scale: the reports hold bad messages alone; corrections and reports meet in one
join on the position, and only corrected messages are parsed and enriched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators.merge import INTAKE_RANK, UPDATE_RANK, case_changes, history_changes, update_changes
from casemill.operators.parse import CASE_SCHEMA, REASON, UPDATE_SCHEMA, classify, split
from casemill.operators.profile import enrich_cases
from casemill.operators.profile_store import ProfileStore
from casemill.streaming.drivers import Profiles, StreamPaths, _batch_profiles, order_of, read_quarantine

POSITION = ["topic", "partition", "offset"]
POSITION_DDL = "topic string, partition int, offset bigint"
REJECTED_DDL = f"{POSITION_DDL}, reason string"


def _kept(df: DataFrame, folder: str) -> DataFrame:
    """`df` written and read back."""
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _resolved(spark: SparkSession, paths: StreamPaths, done: set[int]) -> DataFrame:
    """Positions that finished redrives have added."""
    at = [f"{paths.root}/redrives/{d}/resolved" for d in sorted(done)]
    return spark.read.schema(POSITION_DDL).parquet(*at) if at else spark.createDataFrame([], POSITION_DDL)


def one_each(corrections: DataFrame) -> DataFrame:
    """One value per position: that of the highest `version` (if there is such
    a column; null is lowest), between equal ones the greatest value."""
    version = F.col("version") if "version" in corrections.columns else F.lit(0)
    sent = corrections.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
                              F.struct(version.alias("version"), F.col("value").cast("string").alias("value")).alias("v"))
    return sent.groupBy(*POSITION).agg(F.max("v").alias("v")).select(*POSITION, F.col("v.value").alias("value"))


def open_quarantine(spark: SparkSession, paths: StreamPaths) -> DataFrame | None:
    """Quarantined messages that no redrive has added; None without reports."""
    bad = read_quarantine(spark, paths)
    if bad is None:
        return None
    done = _resolved(spark, paths, order_of(spark, paths).redriven(paths.root))
    return bad.join(done, POSITION, "left_anti").select(*bad.columns)


def redrive(spark: SparkSession, paths: StreamPaths, corrections: DataFrame, intake_topic: str | None = None,
            update_topic: str | None = None, as_of: str | None = None, profiles: Profiles | None = None,
            profile_addresses: bool = True, extracted: Profiles | ProfileStore | None = None,
            write_history: bool = False) -> DataFrame:
    """Add corrected messages (`topic`, `partition`, `offset`, `value` and, if
    several may come for one position, `version`); returns those that were not
    added, as (`topic`, `partition`, `offset`, `reason`).

    Settings as for the stream: with `write_history`, the corrected case
    messages go to the history at their place as well."""
    if intake_topic is None and update_topic is None:
        raise ValueError("name the topic of the case messages, of the updates, or both")
    order = order_of(spark, paths)
    number, closed, done = order.begin_redrive(paths.root)
    folder = f"{paths.root}/redrives/{number}"
    mine = [(b.id,) for b in order.complete() if (b.root, b.log) == (paths.root, "stream") and b.place > closed]
    bad = read_quarantine(spark, paths)
    if bad is None:
        bad = spark.createDataFrame([], f"{POSITION_DDL}, batch_id bigint")
    first = bad.groupBy(*POSITION).agg(F.min(F.col("batch_id").cast("bigint")).alias("batch_id"))
    batches = spark.createDataFrame(mine, "batch_id bigint").withColumn("is_open", F.lit(True))  # a row per unfolded batch
    before = _resolved(spark, paths, done).withColumn("was_added", F.lit(True))
    found = one_each(corrections).join(first, POSITION, "left").join(before, POSITION, "left").join(F.broadcast(batches), "batch_id", "left")
    reason = (F.when(F.col("batch_id").isNull(), F.lit("not_quarantined")).when(F.col("was_added"), F.lit("redriven"))
              .when(F.col("is_open").isNull(), F.lit("closed"))
              .when(~F.col("topic").isin(*[t for t in (intake_topic, update_topic) if t is not None]), F.lit("unknown_topic")))
    placed = _kept(found.select(*POSITION, "value", "batch_id", reason.alias(REASON)), f"{folder}/placed")

    usable = placed.where(F.col(REASON).isNull())
    where = usable.select(*POSITION, "batch_id")
    changes, rejected, added = [], [placed.where(F.col(REASON).isNotNull()).select(*POSITION, REASON)], []
    for topic, schema in ((intake_topic, CASE_SCHEMA), (update_topic, UPDATE_SCHEMA)):
        if topic is None:
            continue
        valid, still_bad = split(classify(usable.where(F.col("topic") == topic).select(*POSITION, "value"), schema))
        valid = valid.join(where, POSITION)
        added.append(valid.select(*POSITION))
        rejected.append(still_bad.select(*POSITION, REASON))
        if schema is UPDATE_SCHEMA:
            changes.append(update_changes(valid, as_of, "batch_id", UPDATE_RANK))
            continue
        rows = enrich_cases(valid, _batch_profiles(valid, profiles, extracted), as_of, profile_addresses)
        changes.append(case_changes(rows, "batch_id", INTAKE_RANK))
        if write_history:
            _write(history_changes(rows, "batch_id"), f"{paths.redriven_history}/redrive={number}")
    for frame in changes:
        _write(frame, f"{paths.redriven}/redrive={number}")
    for frame in added:
        frame.write.mode("append").parquet(f"{folder}/resolved")
    for frame in rejected:
        frame.write.mode("append").parquet(f"{folder}/rejected")
    order.finish_redrive(paths.root, number)
    return spark.read.schema(REJECTED_DDL).parquet(f"{folder}/rejected")


def _write(changes: DataFrame, folder: str) -> None:
    changes.withColumn("batch_id", F.col("ord.batch_id")).write.mode("append").partitionBy("batch_id").parquet(folder)
