"""Query catalogue: one plan per operator family, over the driver tables.

Every query reads the given tables through `derived` and returns a DataFrame;
column names match the oracle SQL in `casemill.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators import backfill as bf
from casemill.operators.merge import (
    CASE_REPORT,
    INTAKE_RANK,
    UPDATE_RANK,
    case_changes,
    fold_changes,
    history_merge,
    status_route,
    update_changes,
)
from casemill.operators.offsets import advance_ledger, resolve_start_offsets
from casemill.operators.parse import parse_cases, parse_updates, quarantine_counts
from casemill.operators.positions import audit_positions
from casemill.operators.profile import enrich_cases, extract_profile
from casemill.operators.variant_docs import drift_report, parse_variant_docs
from casemill.plans import derived as D
from casemill.plans.jobs import intake_batch
from casemill.schemas import CASE_FIELDS, UPDATE_FIELDS
from casemill.session import scratch_path
from casemill.sources.idlist import read_id_list
from casemill.sources.ranges import even_parts

AS_OF = D.AS_OF
BATCH_SPAN = 5000  # offsets per batch in the multi-batch change-log query


def q_case_parse(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = parse_cases(D.case_messages(spark, sf))
    return valid.select(*CASE_FIELDS, "topic", "partition", "offset")


def q_case_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, quarantine = parse_cases(D.case_messages(spark, sf))
    return quarantine_counts(quarantine)


def q_update_parse(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = parse_updates(D.update_messages(spark, sf))
    return valid.select(*UPDATE_FIELDS, "topic", "partition", "offset")


def q_status_route(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = parse_updates(D.update_messages(spark, sf))
    return status_route(valid).select("seqNo", "overdueId", "status", "op")


def q_profile_top_ten(spark: SparkSession, sf: str) -> DataFrame:
    return extract_profile(D.profiles(spark, sf), columns=["call_record_top_ten"])


def q_profile_address(spark: SparkSession, sf: str) -> DataFrame:
    return extract_profile(D.profiles(spark, sf), columns=["address_detail"])


def q_profile_shared_address(spark: SparkSession, sf: str) -> DataFrame:
    return extract_profile(D.profiles(spark, sf), columns=["shared_address"])


def _enriched(spark: SparkSession, sf: str, full: bool) -> DataFrame:
    valid, _ = parse_cases(D.case_messages(spark, sf))
    out = enrich_cases(valid, extract_profile(D.profiles(spark, sf)), AS_OF, profile_addresses=full)
    return out.select(*CASE_FIELDS, "offset", "profile_status")


def q_enrich_case_full(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf, True)


def q_enrich_case_basic(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf, False)


def q_case_replace(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = parse_cases(D.case_messages(spark, sf))
    return fold_changes(case_changes(valid), D.existing_cases(spark, sf), CASE_REPORT)


def q_case_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: parse -> enrich -> replace into the case table."""
    res = intake_batch(D.case_messages(spark, sf), D.profiles(spark, sf), AS_OF)
    return fold_changes(res.changes, D.existing_cases(spark, sf), CASE_REPORT)


def q_case_intake_basic(spark: SparkSession, sf: str) -> DataFrame:
    """Document-store variant: bare profile documents matched by their own
    `baseInfo.mobile`, company and permanent address kept from the message."""
    bare = D.profiles(spark, sf).select("part", "doc")
    res = intake_batch(D.case_messages(spark, sf), bare, AS_OF, profile_addresses=False)
    return fold_changes(res.changes, D.existing_cases(spark, sf), CASE_REPORT)


def q_history_replace(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = parse_cases(D.case_messages(spark, sf))
    return history_merge(D.existing_history(spark, sf), valid)


def _updates(spark: SparkSession, sf: str, which: str | None) -> DataFrame:
    valid, _ = parse_updates(D.update_messages(spark, sf))
    ch = update_changes(valid, AS_OF)
    if which is not None:
        ch = ch.where(F.col("op") == which)
    return fold_changes(ch, D.existing_cases(spark, sf), CASE_REPORT, inserts=False)


def q_update_normal(spark: SparkSession, sf: str) -> DataFrame:
    return _updates(spark, sf, "U")


def q_update_close(spark: SparkSession, sf: str) -> DataFrame:
    return _updates(spark, sf, "C")


def q_update_fold(spark: SparkSession, sf: str) -> DataFrame:
    return _updates(spark, sf, None)


def q_change_log_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Replaces and updates over several batches (batch = offset div 5000)."""
    batch = lambda: F.floor(F.col("offset") / BATCH_SPAN)
    intake = parse_cases(D.case_messages(spark, sf))[0]
    r = case_changes(intake, batch_id=batch(), topic_rank=INTAKE_RANK)
    upd = parse_updates(D.update_messages(spark, sf))[0]
    u = update_changes(upd, AS_OF, batch_id=batch(), topic_rank=UPDATE_RANK)
    return fold_changes(r.unionByName(u), D.existing_cases(spark, sf), CASE_REPORT)


def _backfill(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    ids = bf.normalize_ids(D.id_lines(spark, sf))
    return bf.apply_backfill(ids, D.existing_cases(spark, sf), D.profiles(spark, sf), columns)


def q_backfill_address(spark: SparkSession, sf: str) -> DataFrame:
    return _backfill(spark, sf, ["address_detail"])


def q_backfill_address_top_ten(spark: SparkSession, sf: str) -> DataFrame:
    return _backfill(spark, sf, ["address_detail", "call_record_top_ten"])


def q_backfill_company_address(spark: SparkSession, sf: str) -> DataFrame:
    return _backfill(spark, sf, ["company_address", "permanent_address"])


def q_missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = bf.normalize_ids(D.id_lines(spark, sf))
    return bf.missing_ids(ids, D.existing_cases(spark, sf))


def q_extract_cases(spark: SparkSession, sf: str) -> DataFrame:
    ids = bf.normalize_ids(D.id_lines(spark, sf))
    return bf.extract_cases(ids, D.increment_table(spark, sf))


def q_ledger_advance(spark: SparkSession, sf: str) -> DataFrame:
    return advance_ledger(D.stale_ledger(spark, sf), D.update_messages(spark, sf), D.UPDATE_GROUP)


def q_ledger_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_start_offsets(D.resume_ledger(spark, sf), D.earliest_offsets(spark, sf),
                                 D.UPDATE_GROUP, D.UPDATE_TOPIC)


def q_stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    from casemill.plans.replay import run_stream_to_table
    return run_stream_to_table(spark, "intake", D.case_messages(spark, sf), D.existing_cases(spark, sf),
                               profiles=D.profiles(spark, sf), as_of=AS_OF)


def q_stream_update(spark: SparkSession, sf: str) -> DataFrame:
    from casemill.plans.replay import run_stream_to_table
    return run_stream_to_table(spark, "update", D.update_messages(spark, sf), D.existing_cases(spark, sf),
                               as_of=AS_OF)


def q_stream_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Both topics in one stream feeding one case table."""
    from casemill.plans.replay import run_stream_to_table
    msgs = D.case_messages(spark, sf).unionByName(D.update_messages(spark, sf))
    return run_stream_to_table(spark, "cases", msgs, D.existing_cases(spark, sf), profiles=D.profiles(spark, sf),
                               as_of=AS_OF, intake_topic=D.INTAKE_TOPIC, update_topic=D.UPDATE_TOPIC)


def q_stream_backfill_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Intake in three batches of ascending offsets; a backfill is logged and
    the log compacted before the last one."""
    from casemill.plans import replay as R
    from casemill.streaming import drivers as S
    paths = S.StreamPaths(scratch_path(spark, "stream-compact"))
    profiles = D.profiles(spark, sf)
    replay = R.Replay(spark, "intake", paths, AS_OF, extracted=R.stored_summary(spark, profiles, f"{paths.root}/profile_summary"))
    first, second, third = R.slices(D.case_messages(spark, sf), 3)
    replay.feed(first)
    replay.feed(second)
    ids = bf.normalize_ids(D.id_lines(spark, sf))
    S.log_backfill(spark, paths, ids, D.existing_cases(spark, sf), profiles, ["company_address", "permanent_address"])
    snapshot, mark = S.compact(spark, paths, D.existing_cases(spark, sf), f"{paths.root}/snapshot")
    replay.feed(third)
    return S.current_table(spark, paths, snapshot, mark)


def q_stream_two_roots(spark: SparkSession, sf: str) -> DataFrame:
    """An intake query and an update query, each with a root of its own, feed
    one table.  After their first batches a backfill is logged, the intake
    batch is replayed and both roots are compacted and pruned; two batches of
    each follow."""
    from casemill.plans import replay as R
    from casemill.streaming import drivers as S
    a, b = scratch_path(spark, "stream-root-a"), scratch_path(spark, "stream-root-b")
    one, two = S.StreamPaths(a, beside=(b,)), S.StreamPaths(b, beside=(a,))
    profiles, cases = D.profiles(spark, sf), D.existing_cases(spark, sf)
    intake = R.Replay(spark, "intake", one, AS_OF, extracted=R.stored_summary(spark, profiles, f"{a}/profile_summary"))
    update = R.Replay(spark, "update", two, AS_OF)
    first, *later = zip(R.slices(D.case_messages(spark, sf), 3), R.slices(D.update_messages(spark, sf), 3), strict=True)
    intake.feed(first[0])
    update.feed(first[1])
    ids = bf.normalize_ids(D.id_lines(spark, sf))
    S.log_backfill(spark, two, ids, cases, profiles, ["company_address", "permanent_address"])
    intake.again(first[0])
    snapshot, mark = S.compact(spark, [one, two], cases, f"{a}/snapshot")
    S.prune_log(spark, [one, two], mark)
    for messages, updates in later:
        intake.feed(messages)
        update.feed(updates)
    return S.current_table(spark, [one, two], snapshot, mark)


def q_stream_redrive(spark: SparkSession, sf: str) -> DataFrame:
    """Intake in three batches; after two of them corrected messages enter at
    the places of the quarantined ones (those of the third batch are not there
    yet), and the log is compacted."""
    from casemill.plans import replay as R
    from casemill.streaming import drivers as S
    from casemill.streaming.redrive import redrive
    paths = S.StreamPaths(scratch_path(spark, "stream-redrive"))
    store = R.stored_summary(spark, D.profiles(spark, sf), f"{paths.root}/profile_summary")
    replay = R.Replay(spark, "intake", paths, AS_OF, extracted=store)
    first, second, third = R.slices(D.case_messages(spark, sf), 3)
    replay.feed(first)
    replay.feed(second)
    redrive(spark, paths, D.case_corrections(spark, sf), intake_topic=D.INTAKE_TOPIC, as_of=AS_OF, extracted=store)
    snapshot, mark = S.compact(spark, paths, D.existing_cases(spark, sf), f"{paths.root}/snapshot")
    replay.feed(third)
    return S.current_table(spark, paths, snapshot, mark)


def q_stream_compact_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Updates in three batches over a snapshot in parts; after the first two
    the parts they touch are compacted."""
    from casemill.plans import replay as R
    from casemill.streaming import drivers as S
    paths = S.StreamPaths(scratch_path(spark, "stream-parts"))
    snapshot = S.parted_snapshot(spark, f"{paths.root}/snapshot", parts=16)
    snapshot.replace(D.existing_cases(spark, sf), range(16), 0)
    replay = R.Replay(spark, "update", paths, AS_OF)
    *first, last = R.slices(D.update_messages(spark, sf), 3)
    for part in first:
        replay.feed(part)
        S.prune_log(spark, paths, S.compact_parts(spark, paths, snapshot))
    replay.feed(last)
    return S.current_table(spark, paths, snapshot.read(), S.snapshot_mark(snapshot))


def q_profile_store(spark: SparkSession, sf: str) -> DataFrame:
    """Profile documents added to a store in three parts."""
    from casemill.operators.profile_store import ProfileStore
    store = ProfileStore(spark, scratch_path(spark, "profile-store"), parts=16)
    docs = D.profiles(spark, sf)
    for k in range(3):
        store.add(docs.where(F.col("part") % 3 == k), k)
    return store.read().select("phone", "call_record_top_ten", "address_detail", "shared_address")


def q_profile_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Bare documents of two shapes, read without a declared schema."""
    bare = D.undeclared_profiles(spark, sf).select("part", "doc")
    return extract_profile(bare, parse=parse_variant_docs).select("phone", "call_record_top_ten", "address_detail", "shared_address")


def q_profile_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Paths and types of documents of two shapes against the declared ones.
    The names of peers, keys in one of the shapes, go by one name."""
    report = drift_report(D.undeclared_profiles(spark, sf))
    path = F.regexp_replace("path", r"(call_contact_detail\.).*", "$1*")
    return report.groupBy(path.alias("path"), "type", "status").agg(F.sum("n_values").alias("n_values"))


def q_position_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Lost and repeated spans, looked for in ranges of 300 offsets."""
    return audit_positions(D.consumed_positions(spark, sf), span=300)


def q_even_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Every row and whether the part that held it, of eight over a column, is
    at most twice as large as the smallest one."""
    rows, out = D.uneven_orders(spark, sf), []
    for column in ("steep", "label"):
        parts = even_parts(rows, column, 8)
        for k, part in enumerate(parts):
            out.append(part.select(F.lit(column).alias("cut_by"), "o_orderkey", F.lit(k).alias("part")))
    held = reduce(DataFrame.unionByName, out)
    sizes = held.groupBy("cut_by", "part").agg(F.count(F.lit(1)).alias("n"))
    least = sizes.groupBy("cut_by").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("parts"))
    even = sizes.join(least, "cut_by").select("cut_by", "part", "parts", (F.col("n") <= 2 * F.col("least")).alias("is_even"))
    return held.join(even, ["cut_by", "part"]).select("cut_by", "o_orderkey", "is_even", "parts")


def q_id_list(spark: SparkSession, sf: str) -> DataFrame:
    """An id list written as text lines and read back."""
    path = scratch_path(spark, "id-list")
    D.id_lines(spark, sf).write.text(path)
    return read_id_list(spark, path)


def q_extract_text(spark: SparkSession, sf: str) -> DataFrame:
    """The extract appended as delimited text and read back."""
    path = scratch_path(spark, "extract")
    bf.write_extract(q_extract_cases(spark, sf), path)
    schema = ", ".join(f"{c} string" for c in bf.EXTRACT_COLUMNS)
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def q_case_parse_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Case messages whose values arrive as UTF-8 bytes."""
    msgs = D.case_messages(spark, sf).withColumn("value", F.col("value").cast("binary"))
    return parse_cases(msgs)[0].select(*CASE_FIELDS, "topic", "partition", "offset")


def q_profile_status(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of which most documents are unusable."""
    return extract_profile(D.odd_profiles(spark, sf), columns=["address_detail", "profile_status"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "case_parse": q_case_parse,
    "case_quarantine": q_case_quarantine,
    "update_parse": q_update_parse,
    "status_route": q_status_route,
    "profile_top_ten": q_profile_top_ten,
    "profile_address": q_profile_address,
    "profile_shared_address": q_profile_shared_address,
    "enrich_case_full": q_enrich_case_full,
    "enrich_case_basic": q_enrich_case_basic,
    "case_replace": q_case_replace,
    "case_intake": q_case_intake,
    "case_intake_basic": q_case_intake_basic,
    "history_replace": q_history_replace,
    "update_normal": q_update_normal,
    "update_close": q_update_close,
    "update_fold": q_update_fold,
    "change_log_fold": q_change_log_fold,
    "backfill_address": q_backfill_address,
    "backfill_address_top_ten": q_backfill_address_top_ten,
    "backfill_company_address": q_backfill_company_address,
    "missing_ids": q_missing_ids,
    "extract_cases": q_extract_cases,
    "ledger_advance": q_ledger_advance,
    "ledger_resolve": q_ledger_resolve,
    "stream_intake": q_stream_intake,
    "stream_update": q_stream_update,
    "stream_cases": q_stream_cases,
    "stream_backfill_compact": q_stream_backfill_compact,
    "stream_two_roots": q_stream_two_roots,
    "stream_redrive": q_stream_redrive,
    "stream_compact_parts": q_stream_compact_parts,
    "profile_store": q_profile_store,
    "profile_variant": q_profile_variant,
    "profile_drift": q_profile_drift,
    "position_audit": q_position_audit,
    "even_ranges": q_even_ranges,
    "id_list": q_id_list,
    "extract_text": q_extract_text,
    "case_parse_binary": q_case_parse_binary,
    "profile_status": q_profile_status,
}
