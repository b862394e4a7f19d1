"""The training-data queries: each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import bktree, decontam, divergence, filter_audit, fuzzy_lines, langid, minhash, mixing, quality, token_blocks, token_count, url_model, warc
from casemill.llm.common import reachable
from casemill.session import scratch_path
from casemill.sources.tables import read_table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.convert_to_files(warc.export_arc(read_table(spark, sf_dir, "pages")), path)
    return warc.read_warc(spark, path).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


# The rules of the URL filter, as (host, path, allow).
URL_RULES = [url_model.Rule("net", "/", False), url_model.Rule("example.net", "/en/", True),
             url_model.Rule("example.com", "/de/", False), url_model.Rule("org", "/fr/", True)]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_model.judge(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.per_document(mixing.plan_mix(read_table(spark, sf_dir, "documents")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_blocks.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), path, end_id=2)
    return token_blocks.document_index(spark, path)


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fuzzy_lines.per_document(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_lines", F.size("dropped").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped_lines"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "n_tiles")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bktree.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def _on_workers(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op3_language": op3_language,
    "op4_mixing": op4_mixing,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_token_files": op7_token_files,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_divergence": op11_divergence,
    "op12_filter_audit": op12_filter_audit,
    "op13_simhash": op13_simhash,
}
QUERIES = {name: _on_workers(query) for name, query in QUERIES.items()}

# Five hexadecimal digits are four base-32 letters.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', 1 + ((CAST('0x' || substr(h, {5 * k + 1}, 5) AS INTEGER) >> {shift}) & 31), 1)"
    for k in range(8) for shift in (15, 10, 5, 0))

OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Pairs are counted on distinct sets, so that copies do not multiply.
OP5_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS sh
  FROM w),
n AS (SELECT min(doc_id) AS node, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
x AS (SELECT node, n, unnest(sh) AS g FROM n),
l AS (
  SELECT a.node AS a, b.node AS b FROM x a JOIN x b ON a.g = b.g AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT node, node AS seen FROM n UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS root FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.root, s.doc_id) AS kept
FROM s LEFT JOIN n ON n.sh = s.sh LEFT JOIN c ON c.node = n.node"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_F = "(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

# Shares of every kept term in every group, pairs of groups term by term.
OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS w FROM documents),
c AS (SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY lang, term HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
full_counts AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0)::HUGEINT AS n
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM c GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
p AS (
  SELECT lang, source, term, n,
    1 + (1000000000 * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w)::HUGEINT AS p,
    1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) OVER w + 2 * count(*) OVER w)::HUGEINT AS q
  FROM full_counts WINDOW w AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum({_F.format(p='x.p', q='y.p')}) FROM p x JOIN p y ON x.term = y.term AND x.lang = y.lang
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, term AS item, {_F.format(p='p', q='q')} AS value,
      row_number() OVER (PARTITION BY lang, source ORDER BY {_F.format(p='p', q='q')} DESC, encode(term)) AS rank
    FROM p WHERE n > 0 AND p > q) WHERE rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked"""

# Failure bits of each document, then every order and step from their counts.
OP12_SQL = f"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)::INT AS bits
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
h AS (SELECT part, bits, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(x, bit)),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) r(step)),
r AS (
  SELECT h.part, s.filter_order, s.step, s.bit,
    coalesce(sum(n) FILTER (h.bits & (before | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (h.bits & before = 0 AND h.bits & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (h.bits & before > 0 AND h.bits & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (h.bits = bit), 0) AS unique_fails,
    coalesce(sum(n) FILTER (h.bits & before = 0 AND h.bits & bit > 0 AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (h.bits & before = 0 AND h.bits & bit > 0 AND toxic), 0) AS toxic_lost
  FROM h, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r"""

ORACLE_SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op5_near_duplicates": OP5_SQL, "op11_divergence": OP11_SQL, "op12_filter_audit": OP12_SQL}
