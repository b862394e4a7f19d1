import random

import pytest
from casemill.llm import mixing


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Reshare the excess by weight until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(full.values())
        shares = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > cap * sizes[s]]
        if not over:
            return full | shares
        full |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 7, None: 50, "é": 3, "z": 0},
                                   {"x": 5}, {None: 4}, {f"s{i}": (i * 37) % 101 for i in range(40)}])
def test_targets(spark, sizes):
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    want = water_fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def corpus(n, seed=1):
    r = random.Random(seed)
    return [(i, "w " * int(r.paretovariate(1.1) * 3), "en", r.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]


def test_mix_meets_targets_with_small_blocks_and_reruns_agree(spark, docs):
    rows = corpus(3000)
    got = mixing.per_document(mixing.plan_mix(docs(*rows), block=16)).collect()
    again = mixing.per_document(mixing.plan_mix(docs(*rows[::-1]).repartition(5), block=16)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    size = {i: len(t.split()) for i, t, *_ in rows}
    source = {i: s for i, _, _, s in rows}
    assert sorted(r.doc_id for r in got) == list(range(3000))
    assert all(r.size == size[r.doc_id] and r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size for r in got)
    want = water_fill({s: sum(n for i, n in size.items() if source[i] == s) for s in set(source.values())})
    for s, target in want.items():
        mine = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine)
        assert all(abs(r.target - target) < 1e-6 for r in mine)
        times = sum(r.taken / r.size for r in mine if r.size)
        assert abs(times - sum(r.target / r.source_size for r in mine if r.size)) <= 3


def test_flight_keeps_sums_and_leaves_two():
    r = random.Random(3)
    for sizes in ([5.0] * 50, [float(r.randint(1, 900)) for _ in range(200)], [1.0, 2.0]):
        p = [0.3] * len(sizes)
        a = [(1.0, s) for s in sizes]
        out = mixing.flight([(i, None, 1) for i in range(len(p))], p, a, 1, 0)
        assert sum(0 < q < 1 for q in out) <= 2 and all(0 <= q <= 1 for q in out)
        assert abs(sum(out) - sum(p)) < 1e-6
        assert abs(sum(q * s for q, s in zip(out, sizes)) - 0.3 * sum(sizes)) < 1e-3
        assert all(q in (0, 1) for q in mixing.landing([(i, None, 1) for i in range(len(p))], out, a, 1))


def test_inclusion_is_unbiased():
    n, hits = 400, [0] * 9
    for seed in range(n):
        keys = [(i, "s", 1) for i in range(9)]
        a = [(1.0, float(1 + i * i)) for i in range(9)]
        out = mixing.landing(keys, mixing.flight(keys, [0.4] * 9, a, seed, 0), a, seed)
        hits = [h + q for h, q in zip(hits, out)]
    assert all(abs(h / n - 0.4) < 0.12 for h in hits)


def test_edge_rows(spark, docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", "en", "a"), (3, "x y", "en", "a"), (None, "q", "en", None), (4, " \n", "en", "b")]
    d = docs(*rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS copies")
    got = mixing.per_document(mixing.plan_mix(d)).collect()
    assert len(got) == 6 and all(r.taken == 0 for r in got if r.size == 0)
    assert len({r.taken for r in got if r.doc_id == 3}) == 1
    mixed = mixing.mix_documents(d).collect()
    assert sum(len((r.text or "").split()) for r in mixed) == sum(r.taken for r in got)
    assert mixing.mix_documents(d).columns == d.columns
    assert mixing.plan_mix(docs()).count() == 0 and mixing.mix_documents(docs()).count() == 0
