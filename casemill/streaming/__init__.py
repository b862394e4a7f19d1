"""Structured Streaming drivers (foreachBatch over Kafka-shaped sources)."""

from casemill.streaming.drivers import (
    StreamPaths,
    compact,
    compact_history,
    compact_parts,
    current_history,
    current_ledger,
    current_table,
    log_backfill,
    order_of,
    parted_snapshot,
    prune_log,
    read_change_log,
    read_quarantine,
    snapshot_mark,
    start_case_stream,
    start_intake_stream,
    start_update_stream,
)
from casemill.streaming.order import LogMark
from casemill.streaming.redrive import open_quarantine, redrive

__all__ = [
    "LogMark", "StreamPaths", "compact", "current_history", "current_ledger", "current_table", "log_backfill", "order_of", "prune_log", "compact_history",
    "compact_parts", "open_quarantine", "parted_snapshot", "redrive", "snapshot_mark",
    "read_change_log", "read_quarantine", "start_case_stream", "start_intake_stream",
    "start_update_stream",
]
