import random

import pyarrow as pa
from casemill.llm import divergence as dv
from casemill.llm.queries import OP11_SQL
from test_filter_audit import from_sql


def test_tree_sums_equal_term_by_term():
    r = random.Random(5)
    groups = [(s, r.randint(50, 5000)) for s in range(6)]
    p = lambda n, total: 1 + 10**9 * (n + 2) // (total + 80)
    rows = []
    for _ in range(300):
        path = []
        for s, total in groups:
            n = r.choice([0, 0, 1, 1, 2, 7])
            path += [s, n, p(n, total), p(0, total)] if n else []
        rows.append(("en" if r.random() < 0.7 else "de", path, r.randint(1, 4)))
    want = {}
    for lang, path, terms in rows:
        items = list(zip(*[iter(path)] * 4))
        for j, (b, _, y, y0) in enumerate(items):
            for a, _, x, x0 in items[:j]:
                f = lambda u, v: (u - v) ** 2 // (u + v)
                want[lang, a, b] = want.get((lang, a, b), 0) + terms * (f(x, y) - f(x, y0) - f(x0, y) + f(x0, y0))
    rows.sort()
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 37]), (pa.string(), pa.list_(pa.int64()), pa.int64()))], ["lang", "path", "terms"])
               for at in range(0, len(rows), 37)]
    got = {}
    for out in dv._tree(iter(batches)):
        for x in out.to_pylist():
            got[x["lang"], x["a"], x["b"]] = got.get((x["lang"], x["a"], x["b"]), 0) + x["value"]
    assert got == {k: v for k, v in want.items() if v}


def test_a_branch_shares_its_prefix():
    b = dv.Branch()
    b.insert("en", [0, 1, 10, 2, 1, 1, 11, 3], 2)
    b.insert("en", [0, 1, 10, 2, 2, 4, 12, 3], 5)
    assert b.terms == [7, 5] and [i[0] for i in b.items] == [0, 2]
    b.insert("fr", [0, 1, 10, 2], 1)
    assert b.terms == [1] and set(b.sums) == {("en", 1), ("en", 2)}


def test_edge_rows_match_sql(spark):
    r = random.Random(1)
    vocabulary = ["Alpha", "beta", "GAMMA", "délta", "日本", "x", "Straße", "o'neil", "a1b2", "ΑΒ"]
    rows = []
    for i in range(160):
        words = [r.choice(vocabulary[: r.randint(1, 10)]) for _ in range(r.randint(0, 30))]
        rows.append((i, " ".join(words), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", None, "S3", "é"])))
    rows += [(1, "Alpha alpha", "en", "s1")] * 3 + [(None, "Alpha", "en", "s1"), (500, None, "en", "none"), (501, "", "xx", "only"), (502, "rare words", "xx", "other"),
                                                   (503, "word-" * 40_000, "de", "s1")]
    df = spark.createDataFrame([(*x, 7, "t", 1.5) for x in rows], "doc_id long, text string, lang string, source string, n long, term string, value double")
    got = [tuple(x) for x in dv.audit(df).collect()]
    want = from_sql(OP11_SQL, ["lang", "source", "part", "item", "value", "rank"], documents=df)
    assert sorted(got) == sorted(want) and len(got) > 40
    assert {x[4] for x in got if x[0] == "xx"} == {0}
    small = df.where("text IS NOT NULL").limit(0)
    assert dv.audit(small).collect() == []


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    rows = [(i, f"a b{i % 7} c{i}", "en", f"s{i % 3}") for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 60), pa.array([x[3] for x in rows]), pa.array([x[1].encode() for x in rows])], ["lang", "source", "text"])
    whole = [out.to_pylist() for out in dv._count_terms(iter([batch]))]
    monkeypatch.setattr(dv, "ENTRIES", 5)
    parts = [out.to_pylist() for out in dv._count_terms(iter([batch]))]
    add = lambda outs: {k: sum(x["n"] for o in outs for x in o if (x["source"], x["term"]) == k) for o in outs for x in o for k in [(x["source"], x["term"])]}
    assert len(parts) > len(whole) and add(parts) == add(whole)
