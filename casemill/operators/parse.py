"""Message parsing with quarantine (JSON text -> typed record).

A message is parsed once with `from_json` against a declared schema (never
inferred).  Each message gets a quarantine reason or NULL; the valid and the
quarantined rows are two filters over the same projection, so a caller that
needs both should persist the classified frame (the stream driver does).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.columns import message_class
from casemill.schemas import (
    CASE_KEY_FIELD,
    CASE_SCHEMA,
    CORRUPT_COLUMN,
    EXACT_FIELDS,
    UPDATE_SCHEMA,
    with_corrupt,
)

REASON = "reason"
META_COLUMNS = ["topic", "partition", "offset"]
QUARANTINE_COLUMNS = [REASON, "value", "topic", "partition", "offset"]


def _text_value(messages: DataFrame) -> DataFrame:
    dtype = messages.schema["value"].dataType
    if isinstance(dtype, T.BinaryType):
        return messages.withColumn("value", F.col("value").cast("string"))
    return messages


def _number(field: str) -> Column:
    """Whether the parsed field begins like what casts to a number (a cast that
    fails costs an exception)."""
    return F.col("_m")[field].rlike(r"^[\s\p{Cntrl}]*+([-+.0-9]|(?i:inf|nan))")


def _as_sent(field: str) -> Column:
    """A field with a number's digits as the message has them (`1.50`): the
    last number behind the field's name that equals the parsed value."""
    parsed = F.col("_m")[field]
    sent = F.regexp_extract_all(F.col("value"), F.lit(f'"{field}"\\s*:\\s*(-?[0-9][0-9eE.+-]*)'), F.lit(1))
    same = F.filter(sent, lambda x: x.try_cast("double") == parsed.try_cast("double"))
    return F.coalesce(F.when(F.col("_n") & _number(field), F.try_element_at(same, F.lit(-1))), parsed)


def classify(
    messages: DataFrame,
    schema: T.StructType,
    *,
    phone_field: str | None = "mobile",
    key_field: str | None = CASE_KEY_FIELD,
    exact_fields: list[str] | None = None,
) -> DataFrame:
    """All messages with their fields, Kafka position and a `reason` column.

    `reason` is NULL for a usable record, else one of `empty`, `json_null`,
    `corrupt`, `no_phone` (records without a phone are never written) or
    `no_key` (nothing to replace or update).
    """
    messages = _text_value(messages)
    parse_schema = with_corrupt(schema)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json(F.col("value"), parse_schema, opts)
    meta = [c for c in META_COLUMNS if c in messages.columns]
    fields = [f.name for f in schema.fields]
    exact = [f for f in (EXACT_FIELDS if exact_fields is None else exact_fields) if f in fields]
    # The parse is produced by a one-row generator: predicates on its result
    # (the quarantine split) cannot be pushed below a Generate, so every
    # message is parsed exactly once instead of once per reference.
    df = messages.select(F.col("value"), *meta, F.inline(F.array(F.struct(parsed.alias("_m")))))
    if exact:
        # amounts sent as strings are exact already; digits are only looked up
        # in messages where an exact field carries a JSON number.  The text is
        # searched only where one reads as a number, and the names are tried in
        # messages alone that have a number behind a colon.
        number = '"(' + "|".join(exact) + ')"\\s*:\\s*-?[0-9]'
        named = F.col("value").rlike(':\\s*+[-0-9]') & F.col("value").rlike(number)
        df = df.withColumn("_n", F.when(reduce(lambda x, y: x | y, map(_number, exact)), named).otherwise(F.lit(False)))
    cols = [(_as_sent(f) if f in exact else F.col("_m")[f]).alias(f) for f in fields]
    phone = F.col("_m")[phone_field] if phone_field else None
    key = F.col("_m")[key_field] if key_field else None
    reason = message_class(F.col("value"), F.col("_m"), phone, key)
    return df.select(*cols, *meta, F.col("value"), reason.alias(REASON))


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantine rows) from a classified frame."""
    valid = classified.where(F.col(REASON).isNull()).drop(REASON, "value")
    quarantine = classified.where(F.col(REASON).isNotNull()).select(
        *[c for c in QUARANTINE_COLUMNS if c in classified.columns]
    )
    return valid, quarantine


def parse_cases(messages: DataFrame, exact_fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Case messages -> (valid case records, quarantine)."""
    return split(classify(messages, CASE_SCHEMA, exact_fields=exact_fields))


def parse_updates(messages: DataFrame, exact_fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Update messages -> (valid update records, quarantine)."""
    return split(classify(messages, UPDATE_SCHEMA, exact_fields=exact_fields))


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per quarantine reason (log-safe: counts only, no message text)."""
    return quarantine.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
