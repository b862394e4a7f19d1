"""URL filter: rules, and a character language-model ratio for the rest.

URLs that a rule decides are the labelled sample.  Two character models, one
of accepted and one of rejected URLs, are learnt from them: variable-order
Markov models whose contexts have up to three symbols, each order smoothed
with the next shorter one.  A URL without a rule is judged by the difference of
its two log-likelihoods per symbol, against a threshold calibrated on labelled
URLs that were not learnt from.

Everything is DataFrame expressions.  A URL is mapped to 32 symbols (letters;
digits; `/`; `.`; joiners; query marks; the rest), so a model is a table of
32 ** 3 contexts with 32 numbers each, whatever the number of URLs: that table
is broadcast, about 8 MB.  Log-ratios are whole thousandths, so sums do not
depend on the order of rows.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased.
Path: then up to `?`, `#` or the end.  A null url, or one without `://`, has
both empty and fits no rule.  A rule fits its host and all subdomains if the
path starts with the rule's; the longest fitting rule wins.  A null or empty
url has score 0.  With labelled URLs of one class only, or none, the threshold
lets everything pass.  Repeated URLs are scored once and answered row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casemill.llm.common import cut

ORDER = 3  # longest context
N = 32  # symbols
CONTEXTS = N**ORDER
START = 28  # the symbol of "/" stands before the first one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# classes of characters and the character that stands for each; its code's low
# five bits are the symbol's number, as for the letters
CLASSES = {"0123456789": "{", "/": "|", ".": "}", "-_+%~,:;@!$'()*": "~", "?=&#": "`"}


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (nulls: none); of rules
    of one length the first given."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, allow = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.allow)).otherwise(allow)
    return name, allow


def symbols(url: Column) -> Column:
    """Array of symbol numbers 0 to 31 of a URL's characters."""
    known = "".join(CLASSES)
    marks = "".join(mark * len(chars) for chars, mark in CLASSES.items())
    text = F.regexp_replace(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), r"[^a-z0-9/.\-_+%~,:;@!$'()*?=&#]", "\x7f")
    return F.transform(F.split(F.translate(text, known, marks), ""), lambda c: F.ascii(c).bitwiseAND(N - 1))


def grams(url: Column) -> Column:
    """Per position the context and the symbol as one number below 32 ** 4."""
    padded = F.concat(F.array(*[F.lit(START)] * ORDER), symbols(url))

    def windows(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(ORDER), F.size(s) - 1), lambda k: (
            ((F.get(s, k - 3) * N + F.get(s, k - 2)) * N + F.get(s, k - 1)) * N + F.get(s, k)).cast("long"))

    # the outer transform binds the symbols once for all positions
    return F.when(F.length(url) > 0, F.get(F.transform(F.array(padded), windows), F.lit(0)))


def _vectors(counts: DataFrame, order: int) -> DataFrame:
    """`c{order}` and per class an array of 32 counts and their total for
    contexts of `order` symbols."""
    kept = F.floor(F.col("gram") / N) % (N**order)
    symbol = F.col("gram") % N
    one = lambda kind, k: F.sum(F.when(symbol == k, F.col(kind)).otherwise(0)).alias(f"{kind}{k}")
    sums = counts.groupBy(kept.cast("long").alias(f"c{order}")).agg(*[one(kind, k) for kind in ("good", "bad") for k in range(N)])
    out = [f"c{order}"]
    for kind in ("good", "bad"):
        cells = [F.col(f"{kind}{k}") for k in range(N)]
        out += [F.array(*cells).alias(f"{kind}_at_{order}"), sum(cells[1:], cells[0]).alias(f"{kind}_all_{order}")]
    return sums.select(*out)


def learn(labelled: DataFrame, smoothing: float = 4.0) -> DataFrame:
    """The models of (`url`, `allow`) rows as one table: per context the 32
    log-ratios ln P(symbol | context, accepted) / P(..., rejected), in
    thousandths.  Each order adds `smoothing` draws of the next shorter one;
    a context that was never seen is therefore its longest seen suffix."""
    spark = labelled.sparkSession
    seen = labelled.select("allow", F.explode(grams(F.col("url"))).alias("gram"))
    counts = cut(seen.groupBy("gram").agg(F.sum(F.when(F.col("allow"), 1).otherwise(0)).alias("good"),
                                          F.sum(F.when(F.col("allow"), 0).otherwise(1)).alias("bad")), "url-grams")
    table = spark.range(CONTEXTS).select(F.col("id").alias("c3"))
    for order in range(ORDER, -1, -1):
        table = table.withColumn(f"c{order}", F.col("c3") % (N**order))
        table = table.join(F.broadcast(_vectors(counts, order)), f"c{order}", "left")

    def smoothed(kind: str, symbol: Column) -> Column:
        p = F.lit(1.0 / N)
        for order in range(ORDER + 1):
            seen = F.coalesce(F.get(f"{kind}_at_{order}", symbol), F.lit(0))
            p = (seen + smoothing * p) / (F.coalesce(f"{kind}_all_{order}", F.lit(0)) + smoothing)
        return p

    ratio = F.transform(F.sequence(F.lit(0), F.lit(N - 1)), lambda k: F.round(
        F.log(smoothed("good", k) / smoothed("bad", k)) * 1000).cast("int"))
    return cut(table.select(F.col("c3").cast("int").alias("context"), ratio.alias("ratios")), "url-model")


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """`url, ratio` per distinct non-null url: the mean log-ratio of its
    symbols in whole thousandths (0 for an empty one)."""
    one = urls.select("url").where("url IS NOT NULL").distinct()
    rows = one.select("url", F.explode_outer(grams(F.col("url"))).alias("gram"))
    rows = rows.withColumn("context", F.floor(F.col("gram") / N).cast("int"))
    rows = rows.join(F.broadcast(model), "context", "left")
    value = F.coalesce(F.get("ratios", F.col("gram") % N), F.lit(0))
    return rows.groupBy("url").agg((F.sum(value) / F.count(F.lit(1))).alias("mean")).select(
        "url", F.round("mean").cast("int").alias("ratio"))


def calibrate(scored: DataFrame) -> int | None:
    """The threshold, in thousandths, that separates the (`ratio`, `allow`)
    rows best: it passes the largest share of accepted plus blocks the largest
    share of rejected ones, and is the lowest of equals.  Null without rows of
    both classes.  Rows are reduced to counts per ratio first."""
    bins = scored.groupBy("ratio").agg(F.sum(F.when(F.col("allow"), 1).otherwise(0)).alias("good"),
                                       F.sum(F.when(F.col("allow"), 0).otherwise(1)).alias("bad"))
    below = Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    good, bad = F.sum("good").over(every), F.sum("bad").over(every)
    passed = good - F.coalesce(F.sum("good").over(below), F.lit(0))
    blocked = F.coalesce(F.sum("bad").over(below), F.lit(0))
    worth = F.when((good > 0) & (bad > 0), passed * bad + blocked * good)
    best = bins.select("ratio", worth.alias("worth")).where("worth IS NOT NULL").orderBy(F.desc("worth"), "ratio").first()
    return None if best is None else int(best["ratio"])


def judge(pages: DataFrame, rules: list[Rule], smoothing: float = 4.0) -> DataFrame:
    """`page_id, url, host, path, rule, verdict, score` per row of `pages`
    (`page_id`, `url`); `score` is in natural-log units per symbol.

    Labelled URLs whose crc32 mod 5 is 0 calibrate, the others teach.
    """
    host, path = host_and_path(F.col("url"))
    ruled = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, allow = best_rule(rules, F.col("host"), F.col("path"))
    ruled = ruled.select("*", name.alias("rule"), allow.alias("allow"))
    labelled = ruled.where("allow IS NOT NULL").select("url", "allow")
    teaches = F.crc32(F.col("url").cast("binary")) % 5 != 0
    scored = cut(score(pages, learn(labelled.where(teaches), smoothing)), "url-scores")
    threshold = calibrate(labelled.where(~teaches).join(scored, "url").select("ratio", "allow"))
    out = ruled.join(scored, "url", "left")
    ratio = F.coalesce(F.col("ratio"), F.lit(0))
    passes = F.lit(True) if threshold is None else ratio >= threshold
    verdict = F.when(F.coalesce(F.col("allow"), passes), F.lit("allow")).otherwise(F.lit("block"))
    return out.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), (ratio / 1000.0).alias("score"))
