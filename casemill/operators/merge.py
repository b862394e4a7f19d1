"""Keyed tables as an append-only change log plus a column-wise fold.

Parquet tables have no MERGE and the JDBC writer has no upsert, so every
write becomes change rows `(op, keys, ord, mask, columns...)`:

- `op`   `R` full-row replace, `U` normal update, `C` close update,
         `E` column backfill (and any other partial update);
- `ord`  struct(batch_id, topic_rank, offset, partition): the apply order;
- `mask` bit i set = the change writes column i of the table.

Folding, per key and per column, takes the value of the last change (by
`ord`) that writes the column.  A replace writes every column (NULL for the
ones it does not carry), so anything before the last replace loses by itself.
A key with neither a snapshot row nor a replace yields nothing: an update
never inserts.  Nulls inside the log overwrite (a written NULL is a value);
against the snapshot a per-column hit flag tells "not written" from "written
NULL".

Scale: the fold is one `groupBy(keys)` whose `max_by` aggregates combine
map-side, so a hot key (even a third of all changes) is reduced before the
shuffle; the result is one row per key and joins the snapshot (one row per
key) without skew.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.columns import as_of_date
from casemill.schemas import (
    CASE_HISTORY_COLUMNS,
    CASE_KEY,
    CASE_KEY_FIELD,
    CASE_REPORT_COLUMNS,
    CASE_REPORT_MAPPING,
    CONSTANTS,
    CLOSE_STATUS,
    CLOSE_UPDATE_SET,
    HISTORY_BLANK_COLUMNS,
    HISTORY_KEY,
    LEDGER_COLUMNS,
    NORMAL_UPDATE_SET,
)

ORD_TYPE = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("topic_rank", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("partition", T.IntegerType()),
])


@dataclass(frozen=True)
class TableSpec:
    """A keyed table and the column sets its writers may write ("shapes").

    Columns that every shape writes together form one atom; the fold keeps
    one `max_by` per atom (a struct of its columns) instead of one per
    column, which keeps the aggregation small for wide tables.
    """

    keys: tuple[str, ...]
    columns: tuple[str, ...]
    shapes: tuple[tuple[str, ...], ...] = ()

    def __post_init__(self):
        if len(self.columns) > 63:
            raise ValueError("a change mask covers at most 63 columns")

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    def bit(self, column: str) -> int:
        return 1 << self.columns.index(column)

    def mask_of(self, columns) -> int:
        return reduce(lambda a, c: a | self.bit(c), columns, 0)

    @property
    def full_mask(self) -> int:
        return self.mask_of(self.columns)

    @property
    def atoms(self) -> list[list[str]]:
        """Value columns grouped by the set of shapes that write them."""
        groups: dict[tuple[int, ...], list[str]] = {}
        for c in self.value_columns:
            sig = tuple(i for i, sh in enumerate(self.shapes) if c in sh)
            groups.setdefault(sig, []).append(c)
        return list(groups.values())

    def check_shape(self, columns) -> None:
        """A partial write must be a union of atoms, else the fold could not
        tell which of an atom's columns it wrote."""
        cols = set(columns)
        for atom in self.atoms:
            if cols & set(atom) and not set(atom) <= cols:
                raise ValueError(f"columns {sorted(cols)} split the write group {atom}; "
                                 "declare the shape in the table spec")

    def with_shape(self, columns) -> "TableSpec":
        return TableSpec(self.keys, self.columns, self.shapes + (tuple(columns),))


# Write shapes of case_report: full replace, normal update, close update and
# the three profile backfills.
CASE_REPORT = TableSpec((CASE_KEY,), tuple(CASE_REPORT_COLUMNS), (
    tuple(CASE_REPORT_COLUMNS),
    tuple(c for c, _ in NORMAL_UPDATE_SET),
    tuple(c for c, _ in CLOSE_UPDATE_SET),
    ("address_detail",),
    ("address_detail", "call_record_top_ten"),
    ("company_address", "permanent_address"),
))
CASE_HISTORY = TableSpec((HISTORY_KEY,), tuple(CASE_HISTORY_COLUMNS), (tuple(CASE_HISTORY_COLUMNS),))
OFFSET_LEDGER = TableSpec(("groupid", "topic", "kafka_partition"), tuple(LEDGER_COLUMNS), (tuple(LEDGER_COLUMNS),))

# topic ranks: within one batch intake applies before updates, then backfills
INTAKE_RANK, UPDATE_RANK, BACKFILL_RANK = 0, 1, 2


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def make_ord(batch_id, topic_rank, offset: Column | None = None, partition: Column | None = None) -> Column:
    """The apply order of a change (a struct compared field by field, laid
    out as `ORD_TYPE`)."""
    return F.struct(
        _as_col(batch_id).cast("bigint").alias("batch_id"),
        _as_col(topic_rank).cast("int").alias("topic_rank"),
        _as_col(0 if offset is None else offset).cast("bigint").alias("offset"),
        _as_col(0 if partition is None else partition).cast("int").alias("partition"),
    )


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql(v) -> Column:
    return F.expr(v) if isinstance(v, str) else v


def change_rows(rows: DataFrame, table: TableSpec, op, ord: Column, values: dict[str, Column | str],
                mask, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Change rows in the table's layout from `rows`.

    `values` maps a table column to its expression (a Column or SQL text);
    keys must be included.  Columns not in `values` are NULL (and, unless
    `mask` says so, untouched).  Wide projections are built as SQL text: one
    call per column instead of one per expression node.
    """
    types = types or {}
    op_c = op if isinstance(op, Column) else F.lit(op)
    mask_c = mask if isinstance(mask, Column) else F.lit(mask).cast("bigint")
    cols = [op_c.alias("op")]
    cols += [_sql(values[k]).alias(k) for k in table.keys]
    cols += [ord.alias("ord"), mask_c.cast("bigint").alias("mask")]
    for c in table.value_columns:
        dtype = types.get(c, T.StringType()).simpleString()
        v = values.get(c, "NULL")
        if isinstance(v, str):
            cols.append(F.expr(f"CAST({v} AS {dtype}) AS {_q(c)}"))
        else:
            cols.append(v.cast(dtype).alias(c))
    cond = " AND ".join(f"{_q(k)} IS NOT NULL" for k in table.keys)
    return rows.select(*cols).where(cond)


def fold_changes(changes: DataFrame, snapshot: DataFrame | None, table: TableSpec = CASE_REPORT,
                 inserts: bool = True) -> DataFrame:
    """Apply a change log to a snapshot; returns the table (snapshot layout).

    `inserts=False` is for logs the caller knows hold no replace (updates
    and backfills only): no key can be added, so the snapshot is left-joined
    to the folded changes, which lets AQE broadcast the (usually small)
    folded side instead of shuffling the whole snapshot.  A snapshot written
    bucketed by the key (`streaming.compact(..., buckets=n)`) is joined
    without a shuffle of its side either way.
    """
    keys = list(table.keys)
    atoms = table.atoms
    aggs = ["bool_or(op = 'R') AS _has_r"]
    for i, atom in enumerate(atoms):
        touch = f"(mask & {table.mask_of(atom)}) <> 0"
        fields = ", ".join(_q(c) for c in atom)
        aggs.append(f"max_by(struct({fields}), CASE WHEN {touch} THEN ord END) AS _v{i}")
        aggs.append(f"bool_or({touch}) AS _h{i}")
    folded = changes.groupBy(*keys).agg(*[F.expr(a) for a in aggs])
    where = {c: i for i, atom in enumerate(atoms) for c in atom}

    if snapshot is None:
        out = folded.where("_has_r")
        return out.selectExpr(*[_q(c) if c in keys else f"_v{where[c]}.{_q(c)} AS {_q(c)}" for c in table.columns])

    # the snapshot's columns go by names of their own, not as one struct, which
    # every output column would build anew where the log turns out to be empty
    held = [f"{_q(c)} AS {_q('_s_' + c)}" for c in table.value_columns]
    snap = snapshot.selectExpr(*[_q(k) for k in keys], *held, "true AS _in_snap")
    joined = snap.join(folded, on=keys, how="full_outer" if inserts else "left")
    has_r = "coalesce(_has_r, false)"
    exprs = []
    for c in table.columns:
        if c in keys:
            exprs.append(_q(c))
            continue
        i = where[c]
        exprs.append(f"CASE WHEN {has_r} OR coalesce(_h{i}, false) THEN _v{i}.{_q(c)} ELSE {_q('_s_' + c)} END AS {_q(c)}")
    return joined.where(f"_in_snap IS NOT NULL OR {has_r}").selectExpr(*exprs)


def empty_table(spark, table: TableSpec, types: dict[str, T.DataType] | None = None) -> DataFrame:
    types = types or {}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in table.columns])
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------
# case_report changes
# ---------------------------------------------------------------------------

def _record_ord(rows: DataFrame, batch_id, topic_rank: int) -> Column:
    offset = F.col("offset") if "offset" in rows.columns else None
    partition = F.col("partition") if "partition" in rows.columns else None
    if isinstance(batch_id, str):
        batch_id = F.col(batch_id)
    return make_ord(batch_id, topic_rank, offset, partition)


def case_changes(records: DataFrame, batch_id=0, topic_rank: int = INTAKE_RANK) -> DataFrame:
    """Full-row replaces (op R) from complete case records.

    Every case_report column is written; the two update-only columns become
    NULL, as a replace (delete + insert) does.
    """
    values = {col: _q(field) for col, field in CASE_REPORT_MAPPING}
    return change_rows(records, CASE_REPORT, "R", _record_ord(records, batch_id, topic_rank),
                       values, CASE_REPORT.full_mask)


def _set_expr(spec: str) -> str:
    if spec.startswith("="):
        return "'" + CONSTANTS[spec[1:]] + "'"
    if spec == "@as_of":
        return "run_date_text"
    return _q(spec)


def update_changes(updates: DataFrame, as_of: str | None = None, batch_id=0,
                   topic_rank: int = UPDATE_RANK) -> DataFrame:
    """Status-routed updates: `CLOSE` -> op C (15 columns), else op U (11).

    A NULL status takes the normal branch (null-safe compare).
    """
    is_close = f"(status <=> '{CLOSE_STATUS}')"
    normal = dict(NORMAL_UPDATE_SET)
    close = dict(CLOSE_UPDATE_SET)
    values: dict[str, Column | str] = {CASE_KEY: _q(CASE_KEY_FIELD)}
    for col in CASE_REPORT.value_columns:
        if col not in normal and col not in close:
            continue
        n = _set_expr(normal[col]) if col in normal else "NULL"
        c = _set_expr(close[col]) if col in close else "NULL"
        values[col] = f"CASE WHEN {is_close} THEN {c} ELSE {n} END"
    mask = F.expr(f"CASE WHEN {is_close} THEN {CASE_REPORT.mask_of(close)} ELSE {CASE_REPORT.mask_of(normal)} END")
    op = F.expr(f"CASE WHEN {is_close} THEN 'C' ELSE 'U' END")
    updates = updates.withColumn("run_date_text", as_of_date(as_of))
    return change_rows(updates, CASE_REPORT, op, _record_ord(updates, batch_id, topic_rank), values, mask)


def status_route(updates: DataFrame) -> DataFrame:
    """The branch each update takes: `C` for status CLOSE, else `U`."""
    is_close = F.col("status").eqNullSafe(F.lit(CLOSE_STATUS))
    return updates.withColumn("op", F.when(is_close, F.lit("C")).otherwise(F.lit("U")))


def column_changes(rows: DataFrame, columns: list[str], batch_id=0, topic_rank: int = BACKFILL_RANK,
                   table: TableSpec = CASE_REPORT) -> DataFrame:
    """Partial updates (op E) of `columns` from rows carrying keys + columns."""
    table.check_shape(columns)
    values = {k: _q(k) for k in table.keys}
    values.update({c: _q(c) for c in columns})
    return change_rows(rows, table, "E", _record_ord(rows, batch_id, topic_rank), values, table.mask_of(columns))


def replace_merge(target: DataFrame | None, rows: DataFrame, table: TableSpec = CASE_REPORT,
                  ord: Column | None = None, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """REPLACE semantics: the last row per key (by `ord`) replaces the target row."""
    ord = ord if ord is not None else _record_ord(rows, 0, INTAKE_RANK)
    values = {c: _q(c) for c in table.columns if c in rows.columns}
    ch = change_rows(rows, table, "R", ord, values, table.full_mask, types)
    return fold_changes(ch, target, table)


def update_merge(target: DataFrame, rows: DataFrame, columns: list[str], table: TableSpec = CASE_REPORT,
                 ord: Column | None = None, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """UPDATE semantics: write `columns` on existing keys only (last write wins)."""
    table = table.with_shape(columns)
    ord = ord if ord is not None else _record_ord(rows, 0, BACKFILL_RANK)
    values = {c: _q(c) for c in list(table.keys) + list(columns)}
    ch = change_rows(rows, table, "E", ord, values, table.mask_of(columns), types)
    return fold_changes(ch, target, table, inserts=False)


# ---------------------------------------------------------------------------
# case_history
# ---------------------------------------------------------------------------

def history_changes(records: DataFrame, batch_id=0, topic_rank: int = INTAKE_RANK) -> DataFrame:
    """Full-row replaces into case_history: same-named fields, blank `address`."""
    values = {c: ("''" if c in HISTORY_BLANK_COLUMNS else _q(c)) for c in CASE_HISTORY_COLUMNS}
    return change_rows(records, CASE_HISTORY, "R", _record_ord(records, batch_id, topic_rank),
                       values, CASE_HISTORY.full_mask)


def history_merge(history: DataFrame | None, records: DataFrame, batch_id=0) -> DataFrame:
    return fold_changes(history_changes(records, batch_id), history, CASE_HISTORY)
