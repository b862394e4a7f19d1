"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing,
token files.  Each stage works on all that its predecessor kept; between
stages the documents are written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casemill.llm import decontam, minhash, mixing, quality, token_blocks
from casemill.llm.common import cut, reachable
from casemill.llm.queries import tokenizer
from casemill.session import scratch_path
from casemill.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity of 0.8 or more)."""
    return minhash.keep_one_of_each(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix; returns their index, read back from the files."""
    path = scratch_path(spark, "corpus-tokens")
    token_blocks.write_token_files(docs, tokenizer("word_bpe_49k.json"), path, end_id=2)
    return token_blocks.document_index(spark, path)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_files", token_files),
]

# Learned rules, sampling and file encoding have no SQL form; the stages are
# tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
