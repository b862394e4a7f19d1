import random
import re

import pytest
from casemill.llm import minhash
from casemill.llm.components import connected

W = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def shingle_set(text):
    w = W.findall(lower(text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    near = {(a, b) for group in owners.values() for k, b in enumerate(group) for a in group[:k]}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            root[find(b)] = find(a)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((i, len(s), least[find(k)], i == least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def near_copies(seed, n_words, n, change):
    r = random.Random(seed)
    base = [f"w{r.randint(0, 500)}" for _ in range(n_words)]
    return [" ".join(w if r.random() > change else f"x{r.randint(0, 10**6)}" for w in base) for _ in range(n)]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force_on_sf_table(spark, percent):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert result(minhash.near_duplicates(d, percent)) == brute([tuple(r) for r in d.collect()], percent)


def test_groups_near_the_threshold_need_more_rounds(spark, docs):
    texts = [t for k in range(4) for t in near_copies(k, 120, 60, 0.008 + 0.004 * k)]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    want = brute(rows, 85)
    for levels in (0, 1, 3):
        assert result(minhash.near_duplicates(docs(*rows), 85, bound=4, levels=levels)) == want


def test_truncated_and_extended_copies(spark, docs):
    r = random.Random(9)
    base = [f"w{r.randint(0, 900)}" for _ in range(200)]
    rows = []
    for k in range(120):
        at, n = r.choice([0, 0, 5]), r.randint(120, 200)
        rows.append((k, " ".join(base[at:n] + [f"t{r.randint(0, 30)}" for _ in range(r.choice([0, 0, 3, 12]))])))
    for levels in (1, 3):
        assert result(minhash.near_duplicates(docs(*rows), 85, bound=4, levels=levels)) == brute(rows, 85)


def test_edge_rows(spark, docs):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one TWO"), (10, "two one"), (None, "one two"), (11, "a b c d e"),
            (11, "a b c d e"), (12, "a b c d e f"), (None, "only null id here now"), (13, "É é"), (14, "é é"), (15, "z " * 30000), (16, "Z " * 20000)]
    d = docs(*rows).selectExpr("*", "1 AS node", "2 AS component_id", "3 AS right_doc_id")
    assert result(minhash.near_duplicates(d, 85)) == brute(rows, 85)
    kept = minhash.keep_one_of_each(d, 85)
    assert kept.columns == d.columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    assert ids == [-1, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15]
    assert minhash.near_duplicates(docs(), 85).count() == 0 and minhash.keep_one_of_each(docs()).count() == 0


def test_one_document_stays_per_group_not_per_id(spark, docs):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b + " more"), (None, b), (1, c), (1, d), (1, d), (2, d + " more"), (None, d), (None, "")]
    kept = [(r.doc_id, r.text) for r in minhash.keep_one_of_each(docs(*rows), 85).collect()]
    ours = sorted((i, t) for i, t in kept if i is not None)
    free = sorted(t for i, t in kept if i is None)
    assert ours == [(1, c), (1, d)]
    assert free in (["", a, b], ["", a, b + " more"])


def test_banding_numbers():
    g = minhash.bands_for(85, 1e-5)
    assert 2 * (1 - 0.85**2) ** g <= 1e-5 < 2 * (1 - 0.85**2) ** (g - 1)
    assert 0 < minhash.least_agreement(4 * g, 85, 1e-5) < 0.85 * 4 * g


def test_connected(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 700)]
    root = list(range(800))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    nodes = {x for a, b in edges for x in (a, b) if a != b}
    df = spark.createDataFrame(edges + [(None, 3), (3, None)], "a long, b long")
    assert sorted(map(tuple, connected(df).collect())) == sorted((x, find(x)) for x in nodes)
    assert connected(df.where("false")).count() == 0
