"""The reference's jobs as DataFrame plans (batch form; the stream drivers
call the same functions once per micro-batch)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.operators.backfill import profiles_of
from casemill.operators.merge import INTAKE_RANK, UPDATE_RANK, case_changes, update_changes
from casemill.operators.parse import parse_cases, parse_updates
from casemill.operators.profile import enrich_cases
from casemill.session import scratch_path


@dataclass
class BatchResult:
    changes: DataFrame
    quarantine: DataFrame


def intake_batch(messages: DataFrame, profiles: DataFrame, as_of: str | None = None, batch_id=0,
                 profile_addresses: bool = True, topic_rank: int = INTAKE_RANK) -> BatchResult:
    """Case messages -> enriched full-row replaces for case_report."""
    valid, quarantine = parse_cases(messages)
    # kept as files: bare documents are looked for by the phones twice, and the
    # messages are not to be parsed for each
    path = scratch_path(messages.sparkSession, "intake-phones")
    valid.select(F.col("mobile").alias("phone")).distinct().write.parquet(path)
    phones = messages.sparkSession.read.schema("phone string").parquet(path)
    enriched = enrich_cases(valid, profiles_of(phones, profiles), as_of, profile_addresses)
    return BatchResult(case_changes(enriched, batch_id, topic_rank), quarantine)


def update_batch(messages: DataFrame, as_of: str | None = None, batch_id=0,
                 topic_rank: int = UPDATE_RANK) -> BatchResult:
    """Update messages -> status-routed update changes for case_report."""
    valid, quarantine = parse_updates(messages)
    return BatchResult(update_changes(valid, as_of, batch_id, topic_rank), quarantine)
