"""Column-level building blocks shared by the operators.

All of these return `Column` expressions that stay inside whole-stage codegen
(or, for higher-order functions, inside the JVM); none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill.schemas import CORRUPT_COLUMN, DATE_FORMAT, UNKNOWN


def as_of_date(as_of: str | None) -> Column:
    """Run date as `yyyy-MM-dd` text.

    `as_of=None` means "today", evaluated once per query (per micro-batch in a
    stream), so a long-running job never carries a stale start date.
    """
    if as_of is None:
        return F.date_format(F.current_date(), DATE_FORMAT)
    return F.date_format(F.to_date(F.lit(as_of)), DATE_FORMAT)


def message_class(raw: Column, parsed: Column, phone: Column | None, key: Column | None = None) -> Column:
    """Classify one message: NULL when it is usable, else a quarantine reason.

    Order matters: a message is `empty` before it is `json_null`, before it
    is `corrupt`, before it lacks a phone, before it lacks its key.
    """
    trimmed = F.trim(raw)
    reason = (
        F.when(raw.isNull() | (trimmed == ""), F.lit("empty"))
        .when(trimmed == "null", F.lit("json_null"))
        .when(parsed.isNull() | parsed[CORRUPT_COLUMN].isNotNull(), F.lit("corrupt"))
    )
    if phone is not None:
        reason = reason.when(phone.isNull(), F.lit("no_phone"))
    if key is not None:
        reason = reason.when(key.isNull(), F.lit("no_key"))
    return reason


def first_value_for_key(entries: Column, key: str) -> Column:
    """`value` of the first `{key, value}` entry whose key equals `key`."""
    hit = F.filter(entries, lambda e: e["key"] == F.lit(key))
    return F.get(hit, 0)["value"]


def join_or_default(values: Column, sep: str = ",") -> Column:
    """Comma-joined list, or the UNKNOWN text when the list is NULL or empty.

    `concat_ws` over a NULL array gives '' (not NULL), so test the size first.
    """
    return F.when(F.size(values) > 0, F.concat_ws(sep, values)).otherwise(F.lit(UNKNOWN))
