import math

import numpy as np
import pytest

from millrace.operators import neighbours as nb


def _digamma(n):
    return sum(1 / i for i in range(1, n)) - 0.5772156649015329


def _brute(x, y, k=3):
    x, y = (np.array([0.0 if v is None else float(v) for v in c]) for c in (x, y))
    x, y = (c / (c.std() if c.min() < c.max() else 1.0) for c in (x, y))
    n = len(x)
    if n <= k:
        return None
    total = 0.0
    for i in range(n):
        dx, dy = np.abs(x - x[i]), np.abs(y - y[i])
        r = np.nextafter(np.sort(np.delete(np.maximum(dx, dy), i))[k - 1], 0)
        total += _digamma(int((dx <= r).sum())) + _digamma(int((dy <= r).sum()))
    return max(0.0, _digamma(n) + _digamma(k) - total / n)


def _tables():
    rng = np.random.default_rng(4)
    x = rng.normal(size=400)
    skewed = np.exp(3 * rng.normal(size=400))
    return {
        "linear": (x, x + 0.3 * rng.normal(size=400)),
        "apart": (x, rng.normal(size=400)),
        "ties": (rng.integers(0, 7, 400), rng.integers(0, 3, 400)),
        "mixed": (rng.integers(0, 4, 400), x),
        "constant": (np.full(400, 2.5), x),
        "skewed": (skewed, skewed * rng.random(400)),
        "clumps": (np.where(rng.random(400) < 0.6, 1.0, x), np.where(rng.random(400) < 0.6, 0.0, skewed)),
    }


@pytest.mark.parametrize("strip", [40, 100_000])
def test_against_brute_force(spark, monkeypatch, strip):
    monkeypatch.setattr(nb, "STRIP_POINTS", strip)
    for name, (x, y) in _tables().items():
        gap = [None if i % 9 == 0 else float(v) for i, v in enumerate(x)]
        df = spark.createDataFrame([(float(b), a) for a, b in zip(gap, y, strict=True)], "y double, x double")
        got = nb.neighbour_information(df).first()
        assert got["feature"] == "x" and got["mi"] == pytest.approx(_brute(gap, y), abs=1e-6), name


def test_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 3, "y double, x double")
    assert nb.neighbour_information(df).first()["mi"] is None
    assert nb.neighbour_information(df.limit(0)).first()["mi"] is None
    assert nb.neighbour_information(df.union(df)).first()["mi"] == pytest.approx(max(0.0, _brute([2.0] * 6, [1.0] * 6)))


def test_sweep_finds_what_all_pairs_give():
    rng = np.random.default_rng(0)
    for spread in (3, 50, 10**6):
        x, y = rng.integers(0, spread, 300) / 7.0, rng.integers(0, 5, 300) / 3.0
        points, w = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
        got = nb.nearest_distances(*points.T, w, *points.T, np.full(len(points), np.inf), 3, own=True)
        for p, found in zip(points, got, strict=True):
            every = np.repeat(np.abs(points - p).max(1), w)
            every = np.sort(np.delete(every, np.flatnonzero(every == 0)[0]))
            assert np.allclose(found, every[:3]) and math.isfinite(found[0])


@pytest.mark.parametrize("table", [0, 10_000])
def test_questions_of_few_values_are_dealt_out(spark, monkeypatch, table):
    """However few values a coordinate has, no task holds more than its share of the questions."""
    monkeypatch.setattr(nb, "STRIP_POINTS", 40)
    monkeypatch.setattr(nb, "ASKED_ROWS", 50, raising=False)
    monkeypatch.setattr(nb, "TABLE_VALUES", table, raising=False)
    groups = spark.sparkContext.accumulator(0)
    counts = nb._counts

    def watched(before):
        run = counts(before)

        def noted(asked, values):
            groups.add(1)
            assert len(asked) <= 100
            return run(asked, values)

        return noted

    monkeypatch.setattr(nb, "_counts", watched)
    rng = np.random.default_rng(5)
    for name, x in {"few": rng.integers(0, 3, 400) / 3, "clumps": _tables()["clumps"][1]}.items():
        y = x + rng.normal(size=400)
        df = spark.createDataFrame([(float(b), float(a)) for a, b in zip(x, y, strict=True)], "y double, x double")
        assert nb.neighbour_information(df).first()["mi"] == pytest.approx(_brute(x, y), abs=1e-6), name
    assert (groups.value > 0) == (table == 0)


def _asked(spark, monkeypatch, most):
    """Counts the questions to other strips, of which no task may hold more than so many."""
    asked_rows = spark.sparkContext.accumulator(0)
    elsewhere = nb._elsewhere

    def watched(k):
        run = elsewhere(k)

        def noted(asked, points):
            asked_rows.add(len(asked))
            assert len(asked) <= most
            return run(asked, points)

        return noted

    monkeypatch.setattr(nb, "_elsewhere", watched)
    return asked_rows


def test_questions_to_a_strip_are_dealt_out(spark, monkeypatch):
    """However many points reach into a strip, no task holds more than its share of them."""
    monkeypatch.setattr(nb, "STRIP_POINTS", 40)
    monkeypatch.setattr(nb, "ASKED_ROWS", 20)
    asked_rows = _asked(spark, monkeypatch, 40)
    rng = np.random.default_rng(7)
    # Strips of 400 rows by a continuous x are so thin that many points reach into others.
    x, y = rng.random(400), rng.random(400)
    df = spark.createDataFrame([(float(b), float(a)) for a, b in zip(x, y, strict=True)], "y double, x double")
    assert nb.neighbour_information(df).first()["mi"] == pytest.approx(_brute(x, y), abs=1e-6)
    assert asked_rows.value > 200


def test_few_points_of_few_values_ask_other_strips(spark, monkeypatch):
    """A strip that ends a value of x and begins the next isn't in reach of all points of both."""
    monkeypatch.setattr(nb, "STRIP_POINTS", 300)
    asked_rows = _asked(spark, monkeypatch, 10**6)
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, 3000)
    y = x / 4 + rng.random(3000)
    df = spark.createDataFrame([(float(b), float(a)) for a, b in zip(x, y, strict=True)], "y double, x double")
    assert nb.neighbour_information(df).first()["mi"] == pytest.approx(_brute(x, y), abs=1e-6)
    assert 0 < asked_rows.value < 300


def test_strips_in_reach():
    """The search by halves meets the same strips as a look at all boxes."""
    rng = np.random.default_rng(6)
    points = np.unique(np.column_stack([rng.choice([0.0, 1.0, 1.5, *rng.normal(size=40)], 900), rng.integers(0, 60, 900) / 7]), axis=0)
    cuts = np.array_split(points, 60)
    boxes = np.array([(7 * i % 60, p[:, 0].min(), p[:, 0].max(), p[:, 1].min(), p[:, 1].max()) for i, p in enumerate(cuts)])
    boxes = boxes[np.lexsort((boxes[:, 3], boxes[:, 2], boxes[:, 1]))]
    x, y, r = points[::3, 0], points[::3, 1], rng.choice([0.0, 1 / 7, 0.5, 3.0, 50.0], len(points[::3]))
    row, other = nb._reached(boxes)(x, y, r)
    meets = (boxes[:, 1] <= (x + r)[:, None]) & (boxes[:, 2] >= (x - r)[:, None])
    meets &= (boxes[:, 3] <= (y + r)[:, None]) & (boxes[:, 4] >= (y - r)[:, None])
    assert sorted(zip(row, other, strict=True)) == sorted(zip(*np.nonzero(meets), strict=True))
