import pytest
from pyspark.sql import functions as F

from millrace.operators import search


def test_a_planted_setting_wins_within_the_budget(spark):
    x, z = F.rand(1) * 8 - 4, F.rand(2) * 8 - 4
    df = spark.range(3000).select("id", x.alias("x"), z.alias("z"))
    df = df.withColumn("y", F.floor("x") * F.floor("z") + 0.0)
    settings = [("forest", 3, 1), ("forest", 10, 9), ("boosted", 2, 1)]
    found = search.successive_halving(df, ["x", "z"], "y", "regression", 6000, settings)
    rows = [tuple(r) for r in found.rounds.orderBy("round", "setting").collect()]
    assert [(r[0], r[1]) for r in rows if r[4]][-1] == (3, "forest/10/9")
    assert [sum(r[0] == i for r in rows) for i in (1, 2, 3)] == [3, 2, 1]
    assert found.rows_spent == sum(r[2] for r in rows) <= 6000
    sizes = [next(r[2] for r in rows if r[0] == i) for i in (1, 2, 3)]
    assert sizes[0] < sizes[1] < sizes[2]
    again = search.successive_halving(df.repartition(7), ["x", "z"], "y", "regression", 6000, settings)
    assert again.rows_spent == found.rows_spent and [r["setting"] for r in again.rounds.filter("kept").orderBy("round", "setting").collect()] == [r[1] for r in rows if r[4]]
    with pytest.raises(ValueError, match="too small"):
        search.successive_halving(df, ["x", "z"], "y", "regression", 1, settings)


def test_cut_never_exceeds():
    assert search._cut([3, 0, 4, 5], 7) == (3, 7)
    assert search._cut([3, 0, 4, 5], 2) == (0, 0)
    assert search._cut([3, 4], 100) == (2, 7)
