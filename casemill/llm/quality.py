"""Quality rules as a learned decision list.

`text_stats` measures every whole text.  `learn` fits an ordered list of
interpretable rules to labelled statistics by sequential covering: a rule is
grown condition by condition (the threshold with the largest information gain
over the documents it covers), pruned from its end on held-back documents,
and kept while it is precise; the documents it covers are then removed and the
next rule is grown.  `as_column` emits the list as one ordered conditional
expression, so applying it is a plain projection.

Null and empty texts have zeros everywhere and fail the base rule.  Documents
without a label take no part in learning; a document labelled more than once
is learnt from each different label, repeated documents are learnt once, and
labels of unknown documents are ignored.  With
no labels (or none of one class) the list is empty and only the base rule
rejects.  Repeated rows are judged row by row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casemill.llm.common import arrow_map, as_text, cut, join_small, raw_text, sample_at_most, slices

SYMBOLS = re.compile(rb"[#*$%&|<>]")
WINDOW = 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_letters"]
STATS_SCHEMA = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in STATS])
STATS_DDL = ", ".join(f"{c} long" for c in STATS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside some `window`-word run that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # name each run by the pair of its halves' names: 1, 2, 4, 8 words exactly
    size = 1
    while size < window:
        step = min(size, window - size)
        pair = code[: len(code) - step] * (len(words) + 1) + code[step:]
        code = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size += step
    repeated = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(raw: bytes | None) -> tuple[int, ...]:
    raw = raw or b""
    words = raw.split()
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    n_lines = sum(lines.values())
    text = as_text(raw)
    return (
        len(words),
        len(as_text(b"".join(words))),
        len(SYMBOLS.findall(raw)),
        n_lines - len(lines),
        repeated_words(words),
        n_lines,
        len(set(words)),
        sum(n for c, n in Counter(text).items() if c.isalpha()),
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """`doc_id` and the statistics `STATS` of every row's whole text."""

    def stats(rows):
        return [(i, *measure(raw)) for i, raw in rows]

    cols = docs.select(F.col("doc_id").cast("long"), raw_text("text"))
    return cols.mapInArrow(arrow_map(stats, STATS_SCHEMA), f"doc_id long, {STATS_DDL}")


def base_failed(at: str = "") -> Column:
    """The base rule on statistics whose columns begin with `at`."""
    words = F.col(f"{at}n_words")
    return (words < 20) | (F.col(f"{at}n_repeat_words") * 100 > words * 30)


# Features the rules may test: a ratio of two statistics, or one of them.
FEATURES: dict[str, tuple[str, str | None]] = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "letters_per_char": ("n_letters", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct_words", "n_words"),
    "words": ("n_words", None),
}


def feature_columns(at: str = "") -> list[Column]:
    """The features in thousandths, as whole numbers: learning and applying
    compare the same integers, so no rounding can part them."""
    cols = []
    for name, (over, under) in FEATURES.items():
        value = F.col(at + over)
        if under is not None:
            value = F.floor(value * 1000 / F.greatest(F.col(at + under), F.lit(1)))
        cols.append(value.cast("long").alias(f"{at}f_{name}"))
    return cols


@dataclass(frozen=True)
class Condition:
    feature: str
    at_most: bool
    threshold: int

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.at_most else '>='} {self.threshold}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= x[c.feature] <= c.threshold if c.at_most else x[c.feature] >= c.threshold
    return hit


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        hit = covers(rule, x, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (0.0, None)
        for name in FEATURES:
            v = x[name]
            cand = np.unique(np.quantile(v[hit & bad], np.linspace(0, 1, 33), method="nearest"))
            vp, vn = np.sort(v[hit & bad]), np.sort(v[hit & ~bad])
            for at_most in (True, False):
                if at_most:
                    ps, ns = np.searchsorted(vp, cand, "right"), np.searchsorted(vn, cand, "right")
                else:
                    ps, ns = p - np.searchsorted(vp, cand, "left"), n - np.searchsorted(vn, cand, "left")
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), Condition(name, at_most, int(cand[k])))
        if best[1] is None:
            break
        rule = (*rule, best[1])
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n) on held-back
    documents; the shortest of equals."""

    def worth(r: Rule) -> float:
        hit = covers(r, x, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(x: dict[str, np.ndarray], bad: np.ndarray, held_back: np.ndarray, max_rules: int = 16,
          max_conditions: int = 4, min_precision: float = 0.97) -> list[Rule]:
    """The rejecting rules, in order.  `held_back` marks the documents that
    prune; a rule must be right on `min_precision` of all it covers and cover
    at least 3 bad documents (0.05 % of the rows where that is more)."""
    rules: list[Rule] = []
    left, least = np.ones(len(bad), bool), max(3, int(0.0005 * len(bad)))
    while len(rules) < max_rules and (left & bad & ~held_back).any():
        part = lambda keep: ({k: v[keep] for k, v in x.items()}, bad[keep])
        rule = _prune(_grow(*part(left & ~held_back), max_conditions), *part(left & held_back))
        hit = covers(rule, x, len(bad)) & left
        right = int((hit & bad).sum())
        if not rule or right < least or right < min_precision * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def as_column(rules: list[Rule], at: str = "") -> Column:
    """The list as one ordered conditional expression: true keeps."""
    out = F.when(base_failed(at), F.lit(False))
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            v = F.col(f"{at}f_{c.feature}")
            test = test & ((v <= c.threshold) if c.at_most else (v >= c.threshold))
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def learn_rules(stats: DataFrame, labels: DataFrame, max_train: int = 100_000) -> list[Rule]:
    """Rules from at most about `max_train` labelled rows that the base rule
    does not already reject.  Equal rows of an id count once and so do equal
    labels, so an id repeated on both sides does not multiply; the sample goes
    by the hash of a whole row, so its bound is one on rows, not on ids."""
    lab = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias("bad"))
    seen = stats.where(~base_failed()).select("doc_id", *feature_columns()).distinct()
    rows = seen.join(lab.distinct(), "doc_id")
    rows = sample_at_most(rows, max_train, F.struct(*rows.columns))
    held = (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("held")
    pdf = rows.select("doc_id", "bad", held, *[f"f_{name}" for name in FEATURES]).toPandas()
    pdf = pdf.sort_values(list(pdf.columns), kind="stable")
    if not len(pdf) or pdf.bad.all() or not pdf.bad.any():
        return []
    x = {name: pdf[f"f_{name}"].to_numpy(np.int64) for name in FEATURES}
    return learn(x, pdf.bad.to_numpy(bool), pdf.held.to_numpy(bool))


def judge(docs: DataFrame, labels: DataFrame, max_train: int = 100_000) -> tuple[DataFrame, list[Rule]]:
    """Statistics, `base_failed` and `kept` per row of `docs`, and the rules."""
    stats = cut(text_stats(docs), "quality-stats")
    rules = learn_rules(stats, labels, max_train)
    judged = stats.select("*", *feature_columns()).select(
        "doc_id", *STATS, base_failed().alias("base_failed"), as_column(rules).alias("kept"))
    return judged, rules


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = 100_000) -> DataFrame:
    """The rows of `docs` that the rules learnt from them keep, all columns
    kept.  Every row is measured and judged where it is: texts are neither
    joined nor shuffled.  For learning, the labelled rows are measured first."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("quality IS NOT NULL")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = cut(lab.select("doc_id").distinct(), "quality-labelled")
    train = cut(text_stats(join_small(named, labelled, ["doc_id"], "left_semi")), "quality-train")
    rules = learn_rules(train, lab, max_train)
    columns, mark = docs.columns, "measured_"
    at = columns.index("text")
    while any(c.startswith(mark) for c in columns):
        mark += "_"
    schema = StructType([*docs.schema.fields, *[StructField(mark + c, LongType()) for c in STATS]])

    def measured(batches):
        for batch in batches:
            for part in slices(batch, column=at):
                texts = part.column(at).to_pylist()
                rows = [measure(None if t is None else t.encode("utf-8", "replace")) for t in texts]
                cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=schema.names)
        pa.default_memory_pool().release_unused()

    rows = docs.mapInArrow(measured, schema).select("*", *feature_columns(mark))
    return rows.where(as_column(rules, mark)).select(*columns)
