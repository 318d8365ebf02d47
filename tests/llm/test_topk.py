import math
import random

import numpy as np

from millrace.llm import topk


def _brute(rows, every, k=5):
    whole = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def _found(spark, rows, every):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    return sorted(tuple(r) for r in topk.top_k(df, f"id % {every} = 0").collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) + (i % 3) for _ in range(6)]) for i in range(900)]
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002, [math.nan] * 6), (1003, [math.inf] * 6), (None, [9.0] * 6)]
    rows += [(1004 + i, rows[0][1]) for i in range(4)] + [rows[7], rows[10], (1010, [1.0, 2.0]), (1020, [3.0, 1.0])]
    assert _found(spark, rows, 10) == _brute(rows, 10)


def test_few_candidates_and_large_values(spark):
    rows = [(0, [1e12, -3.5]), (1, [2e11, 7.25]), (2, [0.0, 0.0])]
    want = _brute(rows, 2)
    limit = 2**63 - 1
    assert _found(spark, rows, 2) == [(a, b, c, max(-limit, min(limit, s))) for a, b, c, s in want]
    assert _found(spark, rows[:1], 2) == []
    assert _found(spark, [], 2) == []


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    points = np.rint(rng.normal(0, 60, (3000, 8)) + 500 * rng.normal(0, 1, (6, 8))[rng.integers(0, 6, 3000)])
    ids = np.arange(3000)
    scores, found = topk.search(topk.BallTree(points), ids, points[:40], ids[:40], np.full(40, topk._LOW), 5)
    for q in range(40):
        all_scores = points @ points[q]
        order = sorted((-s, i) for i, s in enumerate(all_scores) if i != q)[:5]
        assert list(zip(-scores[q], found[q], strict=True)) == order
