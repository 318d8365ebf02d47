import random

import pytest

from millrace.operators.ordering import fill_ordered


def _carried(rows, back):
    """By hand: the last value before, then the first one after."""
    placed = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    values = [r[1] for r in placed]
    for i in range(1, len(values)):
        values[i] = values[i - 1] if values[i] is None else values[i]
    for i in range(len(values) - 2, -1, -1) if back else ():
        values[i] = values[i + 1] if values[i] is None else values[i]
    return {r[0]: v for r, v in zip(placed, values, strict=True)}


@pytest.mark.parametrize("block", [8, 65_536])
@pytest.mark.parametrize("back", [True, False])
def test_against_a_loop(spark, block, back):
    rng = random.Random(block)
    places = rng.sample(range(-400, 3_000), 500)
    rows = [(p, rng.choice([None, None, None, None, "a", "b", "", "c"]), None) for p in places]
    # Gaps longer than many blocks, at the ends, too.
    rows = [(p, None if p < -100 or 500 < p < 1_500 or p > 2_700 else v, n) for p, v, n in rows]
    df = spark.createDataFrame(rows, "place long, c0_met string, `odd name` int")
    got = fill_ordered(df, ["c0_met", "odd name"], "place", back, block)
    assert got.columns == df.columns
    found = got.collect()
    assert {r["place"]: r["c0_met"] for r in found} == _carried(rows, back)
    assert len(found) == len(rows) and all(r["odd name"] is None for r in found)


def test_rows_without_a_place_and_empty_tables(spark):
    rows = [(1, None), (2, 5), (None, None), (None, 9), (3, None)]
    df = spark.createDataFrame(rows, "place int, v int")
    found = sorted((r["place"] or 0, r["v"] or 0) for r in fill_ordered(df, ["v"], "place").collect())
    assert found == [(0, 0), (0, 9), (1, 5), (2, 5), (3, 5)]
    assert fill_ordered(df.limit(0), ["v"], "place").collect() == []
    assert fill_ordered(df, [], "place").count() == 5
    with pytest.raises(ValueError):
        fill_ordered(df, ["w"], "place")
