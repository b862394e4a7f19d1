"""Stored profile summaries that grow with the documents added to them.

The state holds added-up counts per (phone, peer) and minima per phone, which
merge: new documents are counted alone and added.  The top ten are ranked again
for the phones of the new documents.  State and summary are cut into parts by a
hash of the phone; an addition rewrites the parts it touches, and a lookup
reads the parts of its phones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.operators.profile import EXTRACTED_COLUMNS, STATE_DDL, merge_state, profile_state, rank_state
from casemill.session import scratch_path
from casemill.sources.parts import PartTable

SUMMARY = T.StructType([T.StructField(c, T.StringType()) for c in EXTRACTED_COLUMNS])


class ProfileStore:
    def __init__(self, spark: SparkSession, folder: str, parts: int = 64):
        self.spark = spark
        self.state = PartTable(spark, f"{folder}/state", "phone", T.StructType.fromDDL(STATE_DDL), parts)
        self.summary = PartTable(spark, f"{folder}/summary", "phone", SUMMARY, parts)

    def add(self, profiles: DataFrame, number: int) -> None:
        """Add the documents of `profiles`, the `number`-th addition (numbers
        ascend).  An addition that stopped half-way is finished by the same
        call; one that was finished is not added again."""
        if number <= self.summary.version().number:
            return
        path = scratch_path(self.spark, "profile-new")
        profile_state(profiles).where("phone IS NOT NULL").write.parquet(path)
        new = self.spark.read.schema(self.state.schema).parquet(path)
        touched = self.state.touched(new)
        if number > self.state.version().number:
            merged = merge_state(self.state.read(touched).unionByName(new)) if touched else new
            self.state.replace(merged, touched, number)
        phones = new.select("phone").distinct()
        ranked = rank_state(self.state.read(touched).join(phones, "phone", "left_semi"))
        others = self.summary.read(touched).join(phones, "phone", "left_anti")
        self.summary.replace(others.unionByName(ranked.select(*EXTRACTED_COLUMNS)), touched, number)

    def read(self) -> DataFrame:
        """The summary of all phones, as `extract_profile` returns it."""
        return self.summary.read()

    def of(self, phones: DataFrame) -> DataFrame:
        """The summary of `phones` (one `phone` column).  Only the parts that
        these are in are listed and read; which ones is at most one number a
        part."""
        phones = phones.select(F.col("phone").cast("string").alias("phone")).where("phone IS NOT NULL")
        return self.summary.read(self.summary.touched(phones)).join(phones.distinct(), "phone", "left_semi")
