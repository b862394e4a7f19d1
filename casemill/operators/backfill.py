"""Id-list jobs: profile backfills, missing-id report and the extract.

An id list is a text source, one id per line.  Ids are trimmed, blanks
dropped and repeats removed (one distributed `distinct`), then joined to the
case table: one join for the whole list instead of one lookup per id.  The
join strategy is left to AQE: the id side is broadcast only when its measured
size is under the threshold, else both sides are shuffled on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.operators.merge import BACKFILL_RANK, CASE_REPORT, column_changes, fold_changes
from casemill.operators.profile import extract_profile
from casemill.schemas import CASE_KEY, PROFILE_ADDRESS_KEY, UNKNOWN

# backfill column -> extracted profile column
BACKFILL_SOURCES = {
    "address_detail": "address_detail",
    "call_record_top_ten": "call_record_top_ten",
    "company_address": "shared_address",
    "permanent_address": "shared_address",
}


def normalize_ids(lines: DataFrame, column: str = "value", name: str = CASE_KEY) -> DataFrame:
    """Id-list lines -> distinct, trimmed, non-blank ids (string)."""
    ids = lines.select(F.trim(F.col(column).cast("string")).alias(name))
    return ids.where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def profiles_of(phones: DataFrame, profiles: DataFrame | None, address_key: str = PROFILE_ADDRESS_KEY,
                extracted: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """Extracted profile rows of `phones` (one `phone` column) alone.

    Only the documents of these phones are parsed.  Bare documents carry their
    phone inside: it alone is read from each, and those with another phone are
    left out before the parse (one whose phone is not found this way is parsed,
    so a document that is not quite JSON is judged as before).  `extracted` is a
    stored summary to read instead of documents."""
    if extracted is not None:
        return extracted.join(phones, "phone", "left_semi")
    if "phone" in profiles.columns:
        mine = profiles.withColumn("phone", F.col("phone").cast("string")).join(phones, "phone", "left_semi")
        return extract_profile(mine, address_key, columns=columns)
    unknown = "\0"  # stands for a phone that was not found
    inside = F.coalesce(F.get_json_object("doc", "$.baseInfo.mobile"), F.lit(unknown))
    wanted = phones.select(F.col("phone").alias("_inside")).unionByName(phones.sparkSession.createDataFrame([(unknown,)], "_inside string"))
    mine = profiles.withColumn("_inside", inside).join(wanted, "_inside", "left_semi").drop("_inside")
    return extract_profile(mine, address_key, columns=columns).join(phones, "phone", "left_semi")


def backfill(ids: DataFrame, cases: DataFrame, profiles: DataFrame, columns: list[str],
             batch_id: int = 0, address_key: str = PROFILE_ADDRESS_KEY,
             extracted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(change rows, missing ids) for a profile backfill of `columns`.

    `ids` holds normalized ids in `overdue_id`; `cases` is the case table.
    Each listed case gets the chosen profile columns for its phone (UNKNOWN
    when the phone has no usable profile); ids with no case are reported.
    """
    unknown = [c for c in columns if c not in BACKFILL_SOURCES]
    if unknown:
        raise ValueError(f"no profile source for columns {unknown}")
    targets = cases.select(CASE_KEY, "phone").join(ids, CASE_KEY, "left_semi")
    phones = targets.select(F.col("phone").cast("string").alias("phone")).where("phone IS NOT NULL").distinct()
    ex = profiles_of(phones, profiles, address_key, extracted, [BACKFILL_SOURCES[c] for c in columns])
    ex = ex.select(F.col("phone").alias("_p"), *[F.col(BACKFILL_SOURCES[c]).alias(c) for c in columns])
    rows = targets.join(ex, targets["phone"] == ex["_p"], "left")
    rows = rows.select(CASE_KEY, *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in columns])
    changes = column_changes(rows, columns, batch_id=batch_id, topic_rank=BACKFILL_RANK)
    return changes, missing_ids(ids, cases)


def missing_ids(ids: DataFrame, cases: DataFrame) -> DataFrame:
    """Listed ids that match no case."""
    return ids.join(cases.select(CASE_KEY), CASE_KEY, "left_anti")


def apply_backfill(ids: DataFrame, cases: DataFrame, profiles: DataFrame, columns: list[str],
                   batch_id: int = 0) -> DataFrame:
    """The case table after a backfill (fold of the backfill changes)."""
    changes, _ = backfill(ids, cases, profiles, columns, batch_id)
    return fold_changes(changes, cases, CASE_REPORT, inserts=False)


EXTRACT_COLUMNS = ["overdueId", "address", "callRecordTopTen"]


def extract_cases(ids: DataFrame, increment: DataFrame, key: str = "overdueId") -> DataFrame:
    """All increment rows whose key is listed (string equality), 3 columns."""
    inc = increment.select(*[F.col(c).cast("string").alias(c) for c in EXTRACT_COLUMNS])
    ids = ids.select(F.col(ids.columns[0]).alias(key))
    return inc.join(ids, key, "left_semi").select(*EXTRACT_COLUMNS)


def write_extract(df: DataFrame, path: str, sep: str = "\t", single_file: bool = False) -> None:
    """Append the extract as delimited text (one write for the whole list).

    Every task writes its own file by default.  `single_file=True` mirrors
    the one-file output of the original job by funnelling all rows through
    one task; use it only for extracts known to be small.
    """
    out = df.repartition(1) if single_file else df  # the join before it stays distributed
    out.write.mode("append").option("sep", sep).option("header", "false").csv(path)
