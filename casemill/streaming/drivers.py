"""Case streams: both topics in one query, or intake / updates alone.

Each micro-batch (foreachBatch) is parsed, routed or enriched, and written
as change rows to `changes/batch_id=N`, its quarantined messages to
`report/batch_id=N` and the positions reached to `ledger/batch_id=N`.  Every
write overwrites its own batch folder, so a batch replayed after a failure (the
query checkpoint commits only after the handler returns) produces the same
files instead of duplicates.  Profile backfills have folders and ids of their
own (`backfills`).

Which batches are complete, and in which order they apply, is kept by `Order`
(order.py), without a clock: also across several roots that feed one table
(`StreamPaths.beside`), and the same after replays.  Readers read the folders of
complete batches alone.

Corrected messages of earlier batches are added in folders of their own
(`redriven`, see redrive.py) and read with the batch they came in.

`compact` folds what is complete into a new snapshot in the shared folder and
returns a `LogMark` of what the snapshot holds, one for all roots; later reads
take the rest.  `prune_log` removes what a snapshot holds.

The engine runs no micro-batch when a stateless query has no new data; a
batch that still arrives empty (the reference's empty-batch skip) is
detected on the persisted frame, so the probe only fills cache partitions
the sinks read anyway, and nothing is written for it.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casemill.operators.merge import (
    CASE_HISTORY,
    CASE_REPORT,
    INTAKE_RANK,
    OFFSET_LEDGER,
    ORD_TYPE,
    UPDATE_RANK,
    TableSpec,
    case_changes,
    empty_table,
    fold_changes,
    history_changes,
    make_ord,
    update_changes,
)
from casemill.operators.backfill import backfill, profiles_of
from casemill.operators.offsets import batch_end_offsets
from casemill.operators.parse import CASE_SCHEMA, META_COLUMNS, REASON, UPDATE_SCHEMA, classify, split
from casemill.operators.profile import enrich_cases
from casemill.operators.profile_store import ProfileStore
from casemill.schemas import CASE_FIELDS, LEDGER_COLUMNS, UPDATE_FIELDS, string_struct
from casemill.sources.files import exists, hadoop, names
from casemill.sources.parts import PartTable
from casemill.streaming.order import Batch, LogMark, Order

LEDGER_DDL = "groupid string, topic string, kafka_partition int, kafka_offset bigint"


@dataclass(frozen=True)
class StreamPaths:
    """Folders of one query.  `beside` names the roots of other queries that
    feed the same table: their batches and this one's have one order."""

    root: str
    beside: tuple[str, ...] = ()

    @property
    def changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def report(self) -> str:
        """Quarantined messages per batch."""
        return f"{self.root}/report"

    @property
    def ledger(self) -> str:
        """Per batch, the positions of all partitions after it."""
        return f"{self.root}/ledger"

    @property
    def backfills(self) -> str:
        return f"{self.root}/backfills"

    @property
    def redriven(self) -> str:
        """Per redrive and batch, the changes of corrected messages."""
        return f"{self.root}/redriven"

    @property
    def redriven_history(self) -> str:
        return f"{self.root}/redriven_history"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def order_of(spark: SparkSession, paths: StreamPaths | list[StreamPaths]) -> Order:
    """The order of the table that these roots and those beside them feed."""
    roots = paths if isinstance(paths, list) else [paths]
    return Order(spark, [r for p in roots for r in (p.root, *p.beside)])


# a profile table, or what returns it as it is now
Profiles = DataFrame | Callable[[SparkSession], DataFrame]


def _now(source: Profiles | None, spark: SparkSession) -> DataFrame | None:
    return source(spark) if callable(source) else source


def _read(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table below `folder`; None only where there is none yet."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _write_batch(df: DataFrame, folder: str, batch_id: int, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{folder}/batch_id={batch_id}")


def _write_report(paths: StreamPaths, batch_id: int, quarantine: DataFrame) -> None:
    columns = ["reason", "value", "topic", F.col("partition").cast("int"), F.col("offset").cast("bigint")]
    _write_batch(quarantine.select(*columns), paths.report, batch_id)


def _write_ledger(spark: SparkSession, paths: StreamPaths, batch_id: int, ends: DataFrame) -> None:
    """The ledger after a batch: the one after the batch before, with the
    positions that this one reached.  A few rows, however many batches were."""
    before = last_complete_batch(spark, paths, below=batch_id)
    rows = ends.select(*LEDGER_COLUMNS, F.lit(1).alias("n"))
    if before is not None:
        held = spark.read.schema(LEDGER_DDL).parquet(f"{paths.ledger}/batch_id={before}")
        rows = rows.unionByName(held.withColumn("n", F.lit(0)))
    latest = rows.groupBy(*OFFSET_LEDGER.keys).agg(F.max_by("kafka_offset", "n").alias("kafka_offset"))
    _write_batch(latest.coalesce(1), paths.ledger, batch_id)


def _batch_profiles(valid: DataFrame, profiles: Profiles | None, extracted: Profiles | ProfileStore | None) -> DataFrame:
    """Extracted profile rows for the phones of one micro-batch, from the
    tables as they are now (where a reader was given, not a frame).

    From a `ProfileStore` only the parts are read that hold the batch's
    phones.  Another precomputed summary (`extract_profile` run as a batch job
    over the whole profile table) is semi-joined whole; otherwise the raw
    documents of the batch's phones are parsed."""
    spark = valid.sparkSession
    phones = valid.select(F.col("mobile").alias("phone")).distinct()
    if isinstance(extracted, ProfileStore):
        return extracted.of(phones)
    return profiles_of(phones, _now(profiles, spark), extracted=_now(extracted, spark))


def _classified(batch: DataFrame, schema: T.StructType, topics: tuple[str, ...] = ()) -> DataFrame:
    """`classify`, with the text of quarantined messages alone: nothing reads
    that of the others again, and it is most of what a kept batch would hold.
    Messages of other topics than `topics`, if any are named, are quarantined."""
    rows = classify(batch, schema)
    if topics:
        known = F.coalesce(F.col("topic").isin(*topics), F.lit(False))
        rows = rows.withColumn(REASON, F.when(known, F.col(REASON)).otherwise(F.lit("unknown_topic")))
    return rows.withColumn("value", F.when(F.col(REASON).isNotNull(), F.col("value")))


def _handler(kind: str, paths: StreamPaths, group: str, as_of: str | None, profiles: Profiles | None,
             profile_addresses: bool, write_history: bool = False, extracted: Profiles | ProfileStore | None = None):
    schema = CASE_SCHEMA if kind == "intake" else UPDATE_SCHEMA

    def handle(batch: DataFrame, batch_id: int) -> None:
        classified = _classified(batch, schema).persist()
        held = [classified]
        try:
            if classified.isEmpty():  # probes the cached frame: nothing to write, positions unchanged
                return
            order = order_of(batch.sparkSession, paths)
            order.begin(paths.root, batch_id)
            valid, quarantine = split(classified)
            if kind == "intake":
                enriched = enrich_cases(valid, _batch_profiles(valid, profiles, extracted), as_of, profile_addresses)
                if write_history:
                    enriched = enriched.persist()
                    held.append(enriched)
                    _write_batch(history_changes(enriched, batch_id), paths.history, batch_id)
                changes = case_changes(enriched, batch_id, INTAKE_RANK)
            else:
                changes = update_changes(valid, as_of, batch_id, UPDATE_RANK)
            _write_batch(changes, paths.changes, batch_id)
            _write_report(paths, batch_id, quarantine)
            _write_ledger(batch.sparkSession, paths, batch_id, batch_end_offsets(classified, group))
            order.finish(paths.root, batch_id)
        finally:
            for df in held:
                df.unpersist()

    return handle


def _case_handler(paths: StreamPaths, group: str, intake_topic: str, update_topic: str, as_of: str | None,
                  profiles: Profiles | None, profile_addresses: bool, extracted: Profiles | ProfileStore | None = None,
                  write_history: bool = False):
    """One micro-batch holding both topics: intake replaces apply before the
    batch's updates (topic rank), so the order between the topics is defined.

    The source is read once and each message parsed once, by the fields of
    both kinds: what is kept is the parsed rows, never the batch's text."""
    both = string_struct([*CASE_FIELDS, *[f for f in UPDATE_FIELDS if f not in CASE_FIELDS]])

    def handle(batch: DataFrame, batch_id: int) -> None:
        classified = _classified(batch, both, (intake_topic, update_topic)).persist()
        held = [classified]
        try:
            if classified.isEmpty():  # probes the cached frame: nothing to write, positions unchanged
                return
            order = order_of(batch.sparkSession, paths)
            order.begin(paths.root, batch_id)
            valid, quarantine = split(classified)
            valid_i, valid_u = (valid.where(F.col("topic") == topic).select(*fields, *META_COLUMNS)
                                for topic, fields in ((intake_topic, CASE_FIELDS), (update_topic, UPDATE_FIELDS)))
            enriched = enrich_cases(valid_i, _batch_profiles(valid_i, profiles, extracted), as_of, profile_addresses)
            if write_history:
                enriched = enriched.persist()
                held.append(enriched)
                _write_batch(history_changes(enriched, batch_id), paths.history, batch_id)
            changes = case_changes(enriched, batch_id, INTAKE_RANK).unionByName(
                update_changes(valid_u, as_of, batch_id, UPDATE_RANK))
            _write_batch(changes, paths.changes, batch_id)
            _write_report(paths, batch_id, quarantine)
            _write_ledger(batch.sparkSession, paths, batch_id, batch_end_offsets(classified, group))
            order.finish(paths.root, batch_id)
        finally:
            for df in held:
                df.unpersist()

    return handle


def handler(kind: str, paths: StreamPaths, group: str, as_of: str | None = None, profiles: Profiles | None = None,
            profile_addresses: bool = True, write_history: bool = False, extracted: Profiles | ProfileStore | None = None,
            topics: tuple[str | None, str | None] = (None, None)) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` function of a stream of `kind` `cases` (both
    `topics`), `intake` or `update`, for a writer of the caller's own."""
    if kind == "cases":
        return _case_handler(paths, group, *topics, as_of, profiles, profile_addresses, extracted, write_history)
    return _handler(kind, paths, group, as_of, profiles, profile_addresses, write_history, extracted)


def start_case_stream(source: DataFrame, profiles: Profiles | None, paths: StreamPaths, group: str,
                      intake_topic: str, update_topic: str, as_of: str | None = None,
                      profile_addresses: bool = True, trigger: dict | None = None,
                      query_name: str | None = None, extracted: Profiles | ProfileStore | None = None,
                      write_history: bool = False) -> StreamingQuery:
    """Both topics in one query: the recommended way to feed one case table.

    `profiles` may be a function of the session that reads the table: it is
    called per micro-batch, so a running stream sees profiles as they are
    then; a frame keeps the files it was made of.  `extracted`: a stored
    `extract_profile` result to enrich from instead of parsing raw profile
    documents in every micro-batch (the choice for a large profile table).  `write_history` also maintains case_history."""
    handler = _case_handler(paths, group, intake_topic, update_topic, as_of, profiles, profile_addresses,
                            extracted, write_history)
    writer = source.writeStream.foreachBatch(handler).option("checkpointLocation", paths.checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "2 seconds"}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def _start(kind: str, source: DataFrame, paths: StreamPaths, group: str, as_of: str | None,
           profiles: Profiles | None, profile_addresses: bool, trigger: dict | None,
           query_name: str | None, write_history: bool = False,
           extracted: Profiles | ProfileStore | None = None) -> StreamingQuery:
    handler = _handler(kind, paths, group, as_of, profiles, profile_addresses, write_history, extracted)
    writer = (source.writeStream.foreachBatch(handler)
              .option("checkpointLocation", paths.checkpoint))
    writer = writer.trigger(**(trigger or {"processingTime": "2 seconds"}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def start_intake_stream(source: DataFrame, profiles: Profiles | None, paths: StreamPaths, group: str,
                        as_of: str | None = None, profile_addresses: bool = True,
                        trigger: dict | None = None, query_name: str | None = None,
                        write_history: bool = False, extracted: Profiles | ProfileStore | None = None) -> StreamingQuery:
    """Case messages -> enriched replaces in the change log (and, with
    `write_history`, full-row replaces of case_history).  `extracted` as in
    `start_case_stream`."""
    return _start("intake", source, paths, group, as_of, profiles, profile_addresses, trigger, query_name,
                  write_history, extracted)


def start_update_stream(source: DataFrame, paths: StreamPaths, group: str, as_of: str | None = None,
                        trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Update messages -> routed updates in the change log."""
    return _start("update", source, paths, group, as_of, None, True, trigger, query_name)


def _rows(spark: SparkSession, batches: list[Batch], folder: str, table: TableSpec, redriven: bool = False) -> DataFrame | None:
    """Change rows of the given batches below each root's `folder`, ordered by
    the batches' places.  Only these batches' folders are listed and read;
    with `redriven`, those that finished redrives have for them."""
    schema = T.StructType([
        T.StructField("op", T.StringType()), *[T.StructField(k, T.StringType()) for k in table.keys],
        T.StructField("ord", ORD_TYPE), T.StructField("mask", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in table.value_columns]])
    out = None
    for root in sorted({b.root for b in batches}):
        mine = [b for b in batches if b.root == root]
        at = [f"batch_id={b.id}" for b in mine]
        if redriven:
            redrives = [f"redrive={d}" for d in sorted(Order(spark, [root]).redriven(root))]
            at = [f"{r}/{b}" for r in redrives for b in sorted(set(at) & set(names(spark, f"{root}/{folder}/{r}")))]
        if not at:
            continue
        read = spark.read.schema(schema).option("basePath", f"{root}/{folder}").parquet(*[f"{root}/{folder}/{x}" for x in at])
        keys = spark.createDataFrame([(b.id, b.key, b.rank) for b in mine], "batch_id bigint, at bigint, root_rank int")
        rows = read.withColumn("batch_id", F.col("batch_id").cast("bigint")).join(F.broadcast(keys), "batch_id")  # a row per unfolded batch
        if mine[0].log == "backfill":  # behind the batches of its place, by its own id
            ord = make_ord(F.col("at"), F.col("ord.topic_rank"), F.col("batch_id"), F.col("root_rank"))
        else:
            ord = make_ord(F.col("at"), F.col("ord.topic_rank"), F.col("ord.offset"), F.col("ord.partition"))
        rows = rows.withColumn("ord", ord).drop("at", "root_rank", "batch_id", "redrive")
        out = rows if out is None else out.unionByName(rows)
    return out


def _log(spark: SparkSession, batches: list[Batch]) -> DataFrame | None:
    """Change rows of stream batches, corrected messages and backfills; None
    if there are none."""
    stream, backfills = ([b for b in batches if b.log == log] for log in ("stream", "backfill"))
    return _union(_rows(spark, stream, "changes", CASE_REPORT), _rows(spark, stream, "redriven", CASE_REPORT, redriven=True),
                  _rows(spark, backfills, "backfills", CASE_REPORT))


def _union(*frames: DataFrame | None) -> DataFrame | None:
    frames = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, frames) if frames else None


def read_change_log(spark: SparkSession, paths: StreamPaths | list[StreamPaths], mark: LogMark | None = None) -> DataFrame | None:
    """Change rows of all complete stream batches and backfills that `mark`
    does not hold; None if there are none."""
    return _log(spark, order_of(spark, paths).complete(mark))


def current_table(spark: SparkSession, paths: StreamPaths | list[StreamPaths], snapshot: DataFrame | None,
                  mark: LogMark | None = None) -> DataFrame:
    """case_report now: the complete changes folded over the snapshot.

    `mark` is what `compact` returned with the snapshot; only the rest is
    read, and the snapshot itself is the answer when there is no rest.  Several
    roots (an intake query and an update query, say) fold together; a mark
    holds for the roots that were compacted together, and for no others."""
    log = read_change_log(spark, paths, mark)
    if log is None:
        return snapshot if snapshot is not None else empty_table(spark, CASE_REPORT)
    return fold_changes(log, snapshot, CASE_REPORT)


def last_complete_batch(spark: SparkSession, paths: StreamPaths, below: int | None = None) -> int | None:
    """Highest id of a complete stream batch of this root."""
    done = [b.id for b in Order(spark, [paths.root]).complete() if b.log == "stream" and (below is None or b.id < below)]
    return max(done, default=None)


def log_backfill(spark: SparkSession, paths: StreamPaths, ids: DataFrame, snapshot: DataFrame | None,
                 profiles: Profiles | None, columns: list[str], mark: LogMark | None = None,
                 extracted: Profiles | ProfileStore | None = None) -> DataFrame:
    """Run a profile backfill against the table and log its changes; returns
    the missing ids.

    It reads the table as of the highest stable place and its changes stand
    right behind that: a batch that completes or is replayed meanwhile keeps
    its own place.  Snapshot and log are reduced to the listed ids before they
    are folded, and profiles to the phones found.
    """
    order = order_of(spark, paths)
    batch_id, place = order.begin_backfill(paths.root)
    ids = ids.select(CASE_REPORT.keys[0]).distinct()
    listed = lambda df: None if df is None else df.join(ids, CASE_REPORT.keys[0], "left_semi")
    log = listed(_log(spark, order.as_of(place, mark, (paths.root, batch_id))))
    mine = listed(snapshot)
    cases = mine if log is None else fold_changes(log, mine, CASE_REPORT)
    if cases is None:
        cases = empty_table(spark, CASE_REPORT)
    changes, missing = backfill(ids, cases, _now(profiles, spark), columns, batch_id=batch_id, extracted=_now(extracted, spark))
    _write_batch(changes, paths.backfills, batch_id)
    order.finish_backfill(paths.root, batch_id)
    return missing


def read_quarantine(spark: SparkSession, paths: StreamPaths) -> DataFrame | None:
    """Quarantined messages of all batches (reason, raw value, position)."""
    return _read(spark, paths.report)


def current_history(spark: SparkSession, paths: StreamPaths | list[StreamPaths], snapshot: DataFrame | None,
                    mark: LogMark | None = None) -> DataFrame | None:
    """case_history now (streams started with `write_history`): complete
    batches that `mark` does not hold folded over the snapshot."""
    return _history(spark, order_of(spark, paths).complete(mark), snapshot)


def _history(spark: SparkSession, batches: list[Batch], snapshot: DataFrame | None) -> DataFrame | None:
    written = [b for b in batches if b.log == "stream" and exists(spark, f"{b.root}/history/batch_id={b.id}")]
    log = _union(_rows(spark, written, "history", CASE_HISTORY),
                 _rows(spark, [b for b in batches if b.log == "stream"], "redriven_history", CASE_HISTORY, redriven=True))
    return snapshot if log is None else fold_changes(log, snapshot, CASE_HISTORY)


def current_ledger(spark: SparkSession, paths: StreamPaths) -> DataFrame | None:
    """The offset ledger now: per (group, topic, partition) the position
    after the latest batch, whose few rows are all that is read."""
    last = last_complete_batch(spark, paths)
    return None if last is None else spark.read.schema(LEDGER_DDL).parquet(f"{paths.ledger}/batch_id={last}")


def compact(spark: SparkSession, paths: StreamPaths | list[StreamPaths], snapshot: DataFrame | None, out: str,
            buckets: int | None = None, table_name: str | None = None, mark: LogMark | None = None) -> tuple[DataFrame, LogMark]:
    """Fold the complete logs of all roots into a new snapshot; returns it
    with the mark of what it holds, to be passed to `current_table` from then on.

    `out` must be a new folder (version it, e.g. `snapshot-v2`): the old
    snapshot is read while the new one is written.  The snapshot holds what is
    ordered up to the highest stable place; batches that are not finished, and
    all behind them, stay in the log.  The write cuts the lineage of the log.
    With `buckets` the snapshot is stored bucketed and sorted by the key, under
    `table_name` and a fresh suffix, so the next fold joins it without
    shuffling the snapshot side.
    """
    order = order_of(spark, paths)
    held = order.hold()
    log = _log(spark, order.complete(mark, held))
    if log is not None:
        folded = fold_changes(log, snapshot, CASE_REPORT)
    else:
        folded = snapshot if snapshot is not None else empty_table(spark, CASE_REPORT)
    if buckets is None:
        folded.write.mode("errorifexists").parquet(out)
        return spark.read.parquet(out), held
    name = f"{table_name or 'case_report_snapshot'}_{uuid.uuid4().hex[:12]}"
    (folded.write.mode("errorifexists").option("path", out).format("parquet")
     .bucketBy(buckets, *CASE_REPORT.keys).sortBy(*CASE_REPORT.keys).saveAsTable(name))
    return spark.table(name), held


def parted_snapshot(spark: SparkSession, folder: str, parts: int = 64) -> PartTable:
    """A case_report snapshot in parts by the hash of its key."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CASE_REPORT.columns])
    return PartTable(spark, folder, CASE_REPORT.keys[0], schema, parts)


def snapshot_mark(snapshot: PartTable) -> LogMark | None:
    """What a parted snapshot holds: the mark that its version was written with."""
    note = snapshot.version().note
    return LogMark(note["place"], tuple((r, n) for r, n in note["backfills"])) if note else None


def compact_parts(spark: SparkSession, paths: StreamPaths | list[StreamPaths], snapshot: PartTable) -> LogMark:
    """Fold the complete logs of all roots into a parted snapshot.  Only the
    parts that a changed key is in are read and written; the version and its
    mark begin to exist together."""
    order = order_of(spark, paths)
    before = snapshot_mark(snapshot)
    held = order.hold()
    log = _log(spark, order.complete(before, held))
    note = {"place": held.place, "backfills": held.backfills}
    number = snapshot.version().number + 1
    if log is None:
        snapshot.replace(empty_table(spark, CASE_REPORT), [], number, note)
        return held
    touched = snapshot.touched(log)
    snapshot.replace(fold_changes(log, snapshot.read(touched), CASE_REPORT), touched, number, note)
    return held


def compact_history(spark: SparkSession, paths: StreamPaths | list[StreamPaths], history: DataFrame | None, out: str,
                    held: LogMark, mark: LogMark | None = None) -> DataFrame:
    """Fold the history of the batches that `held` holds (and `mark` does not)
    into a new history snapshot: `held` is what `compact` returned, so changes
    and history go by one mark.  Run it before `prune_log`."""
    folded = _history(spark, order_of(spark, paths).complete(mark, held), history)
    (empty_table(spark, CASE_HISTORY) if folded is None else folded).write.mode("errorifexists").parquet(out)
    return spark.read.parquet(out)


def prune_log(spark: SparkSession, paths: StreamPaths | list[StreamPaths], mark: LogMark) -> list[str]:
    """Remove the batch folders that the snapshot with `mark` holds; returns
    them.  The snapshot (and the history's) must be written; earlier marks are
    of no use afterwards.  Quarantined messages stay."""
    removed = order_of(spark, paths).prune(mark, {"stream": "changes,history,ledger", "backfill": "backfills"})
    for root, batch in [path.split("/changes/") for path in removed if "/changes/" in path]:
        for folder in ("redriven", "redriven_history"):
            for redrive in names(spark, f"{root}/{folder}"):
                fs, at = hadoop(spark, f"{root}/{folder}/{redrive}/{batch}")
                fs.delete(at, True)
    return removed
