"""Id lists: text files, one id per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.operators.backfill import normalize_ids
from casemill.schemas import CASE_KEY


def read_id_list(spark: SparkSession, path: str, name: str = CASE_KEY) -> DataFrame:
    """Distinct, trimmed, non-blank ids from text files at `path`."""
    return normalize_ids(spark.read.text(path), "value", name)
