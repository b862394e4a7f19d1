import re
from collections import Counter

import numpy as np
from casemill.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = W.findall(text or "")
    lines = [x for x in (text or "").split("\n") if W.search(x)]
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


TEXTS = ["", " \n\n ", "one", "a b c d e f g h a b c d e f g h", "a a a a a a a a a a", "x\ny\nx\n x\nx", "é#*$ ü%&|<> z",
         "\n".join(["w1 w2 w3 w4 w5 w6 w7 w8 w9"] * 3 + ["tail"]), "p q " * 4000, "\x0b\x0cq\x1cr"]


def test_statistics_equal_brute_force(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (3, TEXTS[3])]
    got = sorted(tuple(r)[:6] for r in quality.text_stats(docs(*rows)).collect())
    assert got == sorted((i, *brute(t)) for i, t in rows)


def test_rules_on_sf_table_and_expression_matches_numpy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged, rules = quality.judge(d, lab)
    rows = {r.doc_id: r for r in judged.collect()}
    assert rules and len(rows) == 1000
    for r in rows.values():
        x = {n: np.array([r[a] if b is None else r[a] * 1000 // max(r[b], 1)]) for n, (a, b) in quality.FEATURES.items()}
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and not any(quality.covers(rule, x, 1)[0] for rule in rules))


def test_verdicts_on_labels_that_were_not_learnt(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged, _ = quality.judge(d, lab.where("doc_id % 5 <> 0"))
    truth = judged.where("NOT base_failed").join(lab.where("doc_id % 5 = 0"), "doc_id").collect()
    assert np.mean([r.kept for r in truth if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in truth if r.quality == 0]) < 0.1


def test_without_labels_only_the_base_rule_rejects(spark, docs):
    d = docs((1, "w " * 30), (2, None), (None, " ".join(map(str, range(40)))))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged, rules = quality.judge(d, none)
    assert rules == [] and {r.doc_id: r.kept for r in judged.collect()} == {1: False, 2: False, None: True}
    assert quality.judge(docs(), none)[0].count() == 0


def test_training_rows_are_bounded_where_one_id_holds_them(spark, monkeypatch):
    stats = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS doc_id", "100 + id AS n_words", "500 + id AS word_chars",
                                         "id % 50 AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words", "9L AS n_lines",
                                         "50L AS n_distinct_words", "400L AS n_letters")
    stats = stats.unionAll(stats)
    labels = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "CAST(id % 2 AS INT) AS quality")
    seen = []
    monkeypatch.setattr(quality, "learn", lambda x, bad, held: seen.append(len(bad)) or [])
    quality.learn_rules(stats, labels, 10_000)
    quality.learn_rules(stats, labels, 500)
    want = {(7, w, b) for w in range(100, 4100, 2) for b in (0, 1)} | {(i, 100 + i, i % 2) for i in range(1, 4000, 2) if i % 3}
    want |= {(7, 107, b) for b in (0, 1)}
    assert seen[0] == len(want) and 350 < seen[1] < 650


def test_covering_learns_an_interval():
    v = np.arange(1000)
    x = {n: np.zeros(1000, np.int64) for n in quality.FEATURES} | {"words": v}
    bad = (v >= 300) & (v < 500)
    rules = quality.learn(x, bad, v % 3 == 0)
    got = np.any([quality.covers(r, x, 1000) for r in rules], axis=0)
    assert (got == bad).mean() > 0.97


def test_keep_good_keeps_what_the_list_keeps(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    wide = d.selectExpr("*", "1 AS n_words", "'x' AS measured_n_words", "2 AS f_words")
    kept = quality.keep_good(wide, lab)
    judged, _ = quality.judge(d, lab)
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.where("kept").collect())
