import random
import time

import numpy as np
from casemill.llm import decontam


def brute_tile(doc, item, min_match):
    """Greedy string tiling by trying every pair of positions."""
    fd, fi, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best, found = min_match - 1, []
        for b in range(len(item)):
            for a in range(len(doc)):
                k = 0
                while a + k < len(doc) and b + k < len(item) and fd[a + k] and fi[b + k] and doc[a + k] == item[b + k]:
                    k += 1
                if k > best:
                    best, found = k, [(b, a)]
                elif k == best and k >= min_match:
                    found.append((b, a))
        if not found:
            return covered
        for b, a in found:
            if all(fd[a:a + best]) and all(fi[b:b + best]):
                fd[a:a + best] = [False] * best
                fi[b:b + best] = [False] * best
                covered += best


def test_tiles_equal_brute_force():
    r = random.Random(5)
    for _ in range(150):
        doc = [r.randint(1, 4) for _ in range(r.randint(0, 40))]
        item = [r.randint(1, 4) for _ in range(r.randint(1, 15))]
        if r.random() < 0.5:
            doc[5:5] = item[len(item) // 2:] + item[:len(item) // 2]
        tiles = decontam.tile(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        assert sum(t[2] for t in tiles) == brute_tile(doc, item, 3)
        for a, b, n in tiles:
            assert doc[a:a + n] == item[b:b + n]


def test_one_repeated_word_does_not_make_all_pairs():
    a, b = np.ones(60_000, np.uint64), np.ones(900, np.uint64)
    a[::701] = 2  # runs of 700, so the item is covered by 700 and 200 words
    begin = time.perf_counter()
    tiles = decontam.tile(a, b, 5)
    assert sorted(t[2] for t in tiles) == [200, 700] and time.perf_counter() - begin < 10
    assert next(decontam.matches(a, b, np.ones(len(a), int), np.ones(len(b), int), 701), None) is None


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def test_verbatim_recased_and_reordered_passages_are_found(spark, docs):
    items = [(i, " ".join(words(20 + i, i))) for i in range(10)]
    bench = spark.createDataFrame(items + [(77, None), (78, ""), (79, "!!"), (80, "short item")], "item_id long, text string")
    w3 = words(23, 3)
    rows = [(1, " ".join(words(300, 99))), (2, f"{' '.join(words(50, 98))} {items[1][1]} tail"), (3, items[2][1].upper().replace(" ", ",\n")),
            (4, " ".join(w3[12:] + words(30, 97) + w3[:12])), (5, " ".join(words(24, 4)[:8])), (6, None), (7, ""), (None, items[5][1]),
            (8, f"a Short. ITEM b"), (2, items[1][1])]
    d = docs(*rows).selectExpr("*", "1 AS item_id", "'x' AS tiles")
    for block_bytes in (1, 1 << 20):
        got = decontam.contaminated(d, bench, block_bytes=block_bytes).collect()
        assert sorted((r.doc_id or -1, r.item_id) for r in got) == [(-1, 5), (2, 1), (2, 1), (3, 2), (4, 3), (8, 80)]
        assert {r.doc_id: r.n_tiles for r in got}[4] == 2
        kept = decontam.decontaminate(d, bench, block_bytes=block_bytes)
        assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5, 6, 7]


def test_each_block_is_written_before_more_are_read(spark, docs, monkeypatch):
    items = [(i, " ".join(words(20, 500 + i))) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    taken, done = [], []

    def blocks(benchmark, block_bytes):
        for item in items:
            taken.append(len(done))
            yield [(item[0], item[1].encode())]

    monkeypatch.setattr(decontam, "item_blocks", blocks)
    rows = [(i, f"x {items[i % 9][1]} y") for i in range(18)] + [(50, " ".join(words(40, 3))), (51, None)]
    named = docs(*rows).selectExpr("*", "1 AS n_bytes", "2 AS HASH_A")
    find = decontam.searcher
    monkeypatch.setattr(decontam, "searcher", lambda *a: done.append(1) or find(*a))
    got = decontam.contaminated(named, bench)
    assert taken == [0, 0, 2, 3, 4, 5, 6, 7, 8]
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i % 9) for i in range(18)]
    kept = decontam.decontaminate(named, bench)
    assert kept.columns == named.columns and sorted(r.doc_id for r in kept.collect()) == [50, 51]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs((1, "a b c d e f")), none).count() == 0
    assert decontam.decontaminate(docs((1, "a b c d e f")), none).count() == 1
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contaminated(docs(), bench).count() == 0
    long = " ".join(["a"] * 20_000) + " a b c d e f"
    assert decontam.contaminated(docs((1, long)), bench).count() == 1


def test_sf_table_equals_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.covered_words for r in decontam.contaminated(d, b).collect()}
    want = {}
    items = [(r.item_id, decontam.words_of(r.text.encode())) for r in b.collect()]
    grams = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for _, w in items]
    for r in d.collect():
        w = decontam.words_of((r.text or "").encode())
        mine = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for (i, x), g in zip(items, grams):
            if mine & g:
                near = [k for k in range(len(w) - 4) if tuple(w[k:k + 5]) in g]
                part = w[max(0, min(near) - 80):max(near) + 80]
                n = brute_tile(part, x, 5)
                if n >= 0.5 * len(x):
                    want[r.doc_id, i] = n
    assert got == want and got
