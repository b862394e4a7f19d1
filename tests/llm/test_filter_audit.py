import random
import re

import duckdb
import numpy as np
import pytest
from casemill.llm import filter_audit as fa
from casemill.llm.queries import OP12_SQL

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def from_sql(sql, columns, **frames):
    """Rows of DuckDB SQL over Spark frames."""
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(f"{name}_arrow", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    res = con.execute(sql)
    at = [[d[0] for d in res.description].index(c) for c in columns]
    return [tuple(row[k] for k in at) for row in res.fetchall()]


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    points = sum(1 for c in text if not 0x80 <= c <= 0xBF)
    return len(words), len(set(words)), len(re.findall(rb"[A-Z]", text)), points, len(re.findall(rb"[#$%&*|]", text))


def some_texts(seed, n):
    r = random.Random(seed)
    words = ["a", "A", "Ab", "é", "日本語", "x" * 70, "x" * 69 + "y", "#", "50%", "\x00", "\x0b", "\x1f", "word", "wordwordw", "wordwordx", "😀"]
    return ["".join(r.choice(words) + r.choice([" ", "\n", "\t", "", "  ", "\r\n"]) for _ in range(r.randint(0, 60))).encode() for _ in range(n)]


def test_transducer_equals_regular_expressions():
    texts = some_texts(1, 300) + [b"", b" ", b"a", bytes([0xFF, 0x80, 65]), b" A  b "]
    assert fa.text_counts(texts) == [plain(t) for t in texts]
    assert [fa.text_counts([t])[0] for t in texts[:60]] == [plain(t) for t in texts[:60]]


@pytest.mark.parametrize("piece", [16, 50, 1000])
def test_one_text_in_blocks(monkeypatch, piece):
    monkeypatch.setattr(fa, "PIECE", piece)
    for t in some_texts(2, 40) + [b"x" * 5000, b"x" * 5000 + b" y " + b"x" * 5000, b"a " * 3000]:
        assert fa.text_counts([t]) == [plain(t)]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(fa, "span_hashes", lambda block, begin, end: np.zeros(len(begin), np.uint64))
    texts = some_texts(3, 30)
    assert fa.text_counts(texts) == [plain(t) for t in texts]


def test_a_text_of_twenty_megabytes():
    text = b" ".join(b"%d" % (k * k % 70_001) for k in range(3_600_000))
    assert len(text) > 19_000_000 and fa.text_counts([text]) == [plain(text)]


def test_edge_rows_match_sql(spark):
    r = random.Random(4)
    pool = ["", None, "A" * 9, "one two # three", " ".join(f"w{k}" for k in range(250)), "same " * 300, " ".join(f"W{k}" for k in range(220)), "ü" * 30, " \t"]
    rows = [(i, r.choice(pool), r.choice(["s1", "s2", None, ""])) for i in range(120)]
    rows += [(3, "twice", "s1")] * 2 + [(4, "twice", "s2"), (None, "twice", "s1"), (None, None, None), (None, "alone", "s3")]
    docs = spark.createDataFrame([(*x, 1, True, 5) for x in rows], "doc_id long, text string, source string, bits int, good boolean, n long")
    labels = spark.createDataFrame([(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(80)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)], LABELS)
    got = [tuple(x) for x in fa.audit(docs, labels).collect()]
    want = from_sql(OP12_SQL, COLUMNS, documents=docs, labels=labels)
    assert sorted(got) == sorted(want) and len(got) == 4 * 120 * 5
    assert {x[0] for x in got} == {"s1", "s2", "s3", ""}
    assert fa.audit(docs.limit(0), labels).collect() == []
    assert fa.audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").isEmpty()


def test_steps_add_up(spark):
    docs = spark.createDataFrame([(i, "w " * (i * 10) + "#" * (i % 3), f"s{i % 2}") for i in range(60)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    rows = fa.audit(docs, labels, {"A": "n_words < 200", "D": "n_symbols > 0"}).collect()
    assert len(rows) == 2 * 6 * 3
    last = {}
    for x in sorted(rows, key=lambda x: (x.part, x.filter_order, x.step)):
        before = last.get((x.part, x.filter_order), 30)
        assert x.kept + x.removed == before
        last[x.part, x.filter_order] = x.kept
    assert all(len({v for (p, _), v in last.items() if p == part}) == 1 for part in ("s0", "s1"))  # every order ends with the same rows
