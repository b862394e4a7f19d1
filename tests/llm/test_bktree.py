import random
import re

import pytest
import xxhash
from casemill.llm import bktree
from casemill.sources.tables import read_table


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, prints):
    """component_id per row from all pairs of fingerprints."""
    nodes = sorted(set(prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [least.get(find(p)) for p in prints]


def check(spark, rows, **settings):
    df = spark.createDataFrame([(*x, 9, "n") for x in rows], "doc_id long, text string, print long, key string")
    prints = [brute_print(t) for _, t in rows]
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, brute_components(rows, prints))), key=str)
    got = sorted(((x.doc_id, x.fingerprint, x.component_id) for x in bktree.near_duplicates(df, **settings).collect()), key=str)
    assert got == want
    return want


def copies(seed, groups, size):
    """Texts of 300 words with few changed words, so that fingerprints are a
    few bits apart."""
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randint(0, 5000)}" for _ in range(300)]
        for _ in range(size):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(300)] = f"x{r.randint(0, 99)}"
            out.append(" ".join(words))
    return list(enumerate(out))


def test_tree_finds_all_within_radius():
    r = random.Random(3)
    values = []
    for _ in range(40):
        base = r.getrandbits(64)
        values += [base ^ sum(1 << b for b in r.sample(range(64), k)) for k in (0, 1, 3, 6) for _ in range(3)]
    r.shuffle(values)
    tree = bktree.BKTree()
    for v in values:
        tree.insert(v)
    for radius in (0, 1, 4, 9):
        for v in values[:60] + [0, bktree.ALL]:
            assert sorted(tree.within(v, radius)) == [k for k, w in enumerate(values) if (v ^ w).bit_count() <= radius]
    for at, edges in enumerate(tree.edges):
        assert all((tree.values[at] ^ tree.values[child]).bit_count() == d for d, child in edges.items())


@pytest.mark.parametrize("n", [0, 1, 1000, 10**6, 10**9, 10**12])
def test_masks_meet_every_pair(n):
    r = random.Random(n)
    masks = bktree.shard_masks(n, 4)
    for _ in range(300):
        flips = sum(1 << b for b in r.sample(range(64), 4))
        assert any(m & flips == 0 for m in masks)
    assert max(m.bit_count() for m in masks) >= min(32, len(bin(n)) - 4)


@pytest.mark.parametrize("settings", [{}, {"bound": 4, "most": 1000}, {"bound": 3, "most": 1}])
def test_equals_brute_force(spark, settings):
    want = check(spark, copies(1, 12, 25), **settings)
    assert 12 <= len({c for *_, c in want}) < 200


def test_large_shards_cut_by_further_bits(spark):
    """Fingerprints that agree in most bits, in chains of several components."""
    r = random.Random(8)
    base = r.getrandbits(64)
    values = {base ^ sum(1 << b for b in r.sample(range(20), r.choice([0, 2, 9, 10]))) for _ in range(250)}
    df = spark.createDataFrame([(bktree._signed(v),) for v in values], "print long")
    got = {x.node & bktree.ALL: x.root for x in bktree.link_prints(df, radius=2, bound=3, most=2).collect()}
    nodes, root = sorted(values), {v: v for v in values}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    want, have = {}, {}
    for v in nodes:
        want.setdefault(find(v), set()).add(v)
        have.setdefault(got.get(v, ("alone", v)), set()).add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values())) and 3 < len(want) < len(nodes)


def test_edge_rows(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(5, None), (4, ""), (9, " \t"), (None, ""), (1, "One two"), (2, "one  TWO"), (2, "one  TWO"), (7, "a b c d"), (8, "a b c d e"), (None, "lonely text here"),
            (10, long), (11, long + " x"), (12, "É é"), (13, "é é"), (3, "same 4 words here same 4 words here"), (6, "Same 4 words here same 4 words here")]
    want = check(spark, rows)
    assert (None, "0" * 16, 4) in want and (9, "0" * 16, 4) in want
    assert bktree.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_table(spark):
    rows = [(x.doc_id, x.text) for x in read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    check(spark, rows)
