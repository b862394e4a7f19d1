"""Even range scans: disjoint predicates that cut a table by one column.

Equal steps between a smallest and a greatest value give uneven parts where
values are not spread evenly.  Here the bounds are quantiles, taken from a
sketch that Spark adds up per task (`approx_percentile`), so every part holds
about the same number of rows.  The predicates are SQL text on the bare column:
they are pushed into a parquet scan (row groups outside are skipped) or into a
database (`read_jdbc_even`), and each row fits exactly one of them; the first
takes the nulls too.

Strings have no quantiles of their own.  Smallest and greatest value share a
prefix that every value between them has; the seven bytes behind it make a
number of the same order, whose quantiles cut the strings, and each bound
becomes the smallest string of its part.  Strings that agree in those bytes stay
together.

A value that more rows have than a part should hold cannot be cut by its own
column: it gets a part for itself and what lies up to the next bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000  # a bound is off by at most rows / ACCURACY places
CODE_BYTES = 7  # of a string, behind the shared prefix; fits a positive long
ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _shared(low: bytes, high: bytes) -> int:
    """Bytes that both begin with."""
    n = 0
    while n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return n


def _code(column: str, skip: int) -> Column:
    """The `CODE_BYTES` bytes behind the first `skip` ones, as a number."""
    piece = F.substring(F.encode(F.col(_name(column)), "UTF-8"), skip + 1, CODE_BYTES)
    return F.conv(F.rpad(F.hex(piece), 2 * CODE_BYTES, "0"), 16, 10).cast("bigint")


def even_bounds(df: DataFrame, column: str, parts: int, accuracy: int = ACCURACY) -> list:
    """Up to `parts` - 1 ascending values of `column`, distinct, that cut its
    rows into parts of about equal size; empty if there is nothing to cut.
    NaN counts as the greatest value, as Spark orders it, but is no bound."""
    if parts < 1:
        raise ValueError("at least one part")
    dtype = df.schema[column].dataType
    values = df.select(column).where(F.col(_name(column)).isNotNull())
    cuts = F.lit([k / parts for k in range(1, parts)] or [0.5])
    if parts == 1:
        return []
    if isinstance(dtype, ORDERED):
        row = values.agg(F.percentile_approx(_name(column), cuts, accuracy).alias("b"), F.min(_name(column)).alias("low")).first()
        found = {b for b in row["b"] or [] if b == b and b != row["low"]}
        return sorted(found)
    if not isinstance(dtype, T.StringType):
        raise ValueError(f"{column}: no ranges over {dtype.simpleString()}")
    ends = values.agg(F.min(_name(column)).alias("low"), F.max(_name(column)).alias("high")).first()
    if ends["low"] is None or ends["low"] == ends["high"]:
        return []
    code = _code(column, _shared(ends["low"].encode(), ends["high"].encode()))
    cut = sorted(set(values.agg(F.percentile_approx(code, cuts, accuracy)).first()[0]))
    part = sum((code >= F.lit(c)).cast("int") for c in cut)  # one of at most `parts` numbers
    first = values.groupBy(part.alias("part")).agg(F.min(_name(column)).alias("low")).collect()
    return sorted({r["low"] for r in first} - {ends["low"]})


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return str(value)
    kind = "TIMESTAMP" if hasattr(value, "hour") else "DATE"
    return f"{kind} '{value}'"


def range_predicates(column: str, bounds: list, quoted: str | None = None) -> list[str]:
    """SQL conditions, one per part, of which every row fits exactly one.
    `quoted`: the column as the reading side writes it (backticks if not given).

    A backslash in a string bound stands for itself in a database and would
    not in Spark's SQL; use `range_filters` on frames."""
    name = quoted or _name(column)
    if not bounds:
        return ["1 = 1"]
    ends = [_literal(b) for b in bounds]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(ends, ends[1:])]
    return [f"{name} < {ends[0]} OR {name} IS NULL", *inner, f"{name} >= {ends[-1]}"]


def range_filters(column: str, bounds: list) -> list[Column]:
    """The same conditions as columns."""
    c = F.col(_name(column))
    if not bounds:
        return [F.lit(True)]
    inner = [(c >= F.lit(a)) & (c < F.lit(b)) for a, b in zip(bounds, bounds[1:])]
    return [(c < F.lit(bounds[0])) | c.isNull(), *inner, c >= F.lit(bounds[-1])]


def even_parts(df: DataFrame, column: str, parts: int, accuracy: int = ACCURACY) -> list[DataFrame]:
    """`df` cut into frames of about equal size, each with its own pushed-down range."""
    return [df.where(f) for f in range_filters(column, even_bounds(df, column, parts, accuracy))]
