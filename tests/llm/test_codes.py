import hashlib
import math
import random

import numpy as np

from millrace.llm import codes


def _brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(rows, digest) by the plain method; rows are (id, vector, label)."""
    kept = [(i, [max(-(2**63), min(2**63 - 1, math.floor(scale * x))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    starts = [min(v for i, v, _ in kept if i == j) for j in ids]
    d = len(starts[0])
    starts = [s for s in starts if len(s) == d]
    cut = [(p * d // parts, (p + 1) * d // parts) for p in range(parts)]
    books = [[s[a:b] for s in starts] for a, b in cut]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            groups = {}
            for _, v, _ in kept:
                if len(v) == d:
                    groups.setdefault(best(v[a:b], books[p])[1], []).append(v[a:b])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, g in kept:
        found = [best(v[a:b], books[p]) for p, (a, b) in enumerate(cut)] if len(v) == d else None
        error = min(sum(x for x, _ in found), 2**63 - 1) if found else None
        out.append([i, "".join(f"{k:02x}" for _, k in found) if found else None, error, g])
        if error is not None:
            sums[g] = sums.get(g, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, min(sums[g], 2**63 - 1) if g in sums else None, digest) for i, c, e, g in out), key=repr)


def _found(spark, rows):
    df = spark.createDataFrame([(i, v, g, 1, "x") for i, v, g in rows], "vec_id long, embedding array<double>, label int, code int, cells string")
    got = codes.compress(df)
    assert got.columns == ["vec_id", "label", "cells", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 7, 0.3) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(300, 0, -1)]
    rows += [(500, None, 1), (501, [1.0, None] * 8, 1), (502, [math.nan] * 16, 2), (503, [math.inf] * 16, 2)]
    rows += [rows[3], (None, [9.0] * 16, 1), (2, [-5.0] * 16, 1), (700, [1.0, 2.0], 7)]
    assert _found(spark, rows) == _brute(rows)


def test_ties_few_rows_odd_lengths_and_large_values(spark):
    ties = [(i, [float(i % 2)] * 8, 0) for i in range(40)]
    assert _found(spark, ties) == _brute(ties)
    few = [(i, [float(i), 0.5, -0.25], None) for i in range(5)]
    assert _found(spark, few) == _brute(few)
    large = [(i, [1e12 * (i - 3), 1e30, -1e30, 0.1 * i] * 3, i % 2) for i in range(20)]
    assert _found(spark, large) == _brute(large)
    empty = [(1, [], 1), (2, [], 1)]
    assert _found(spark, empty) == _brute(empty)
    assert _found(spark, []) == [] == _found(spark, [(1, None, 2)])


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(5)
    entries = rng.integers(-2000, 2000, (16, 8))
    rows = entries[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 8))
    pivots = codes.pick_pivots(entries, 4)
    known = codes._isqrt(codes._distances(rows, pivots))
    moved = entries + rng.integers(-50, 50, entries.shape)
    who, far, evaluated = codes.nearest(rows, known, moved, pivots)
    every = codes._distances(rows, moved)
    assert (who == every.argmin(1)).all() and (far == every.min(1)).all()
    assert evaluated < 0.5 * every.size
