import numpy as np
import pandas as pd
import pytest

from millrace.functions.types import nan_to_null
from millrace.operators.quantiles import column_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.63, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 6000
    return pd.DataFrame(
        {
            "plain": rng.normal(size=n),
            "hot": np.where(rng.random(n) < 0.34, 5.0, rng.normal(size=n) * 10),
            "few": rng.integers(0, 3, n).astype(float),
            "skewed": np.exp(rng.normal(size=n) * 5),
            "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
            "fixed": 1.0,
        }
    )


def test_direct_and_searched_agree_with_numpy(spark, frame):
    df = nan_to_null(spark.createDataFrame(frame)).repartition(3)
    direct = column_quantiles(df, frame.columns, PROBS)
    searched = column_quantiles(df, frame.columns, PROBS, direct_limit=10, accuracy=60, final_limit=15)
    for c in frame:
        want = np.nanquantile(frame[c], PROBS)
        np.testing.assert_allclose(direct[c], want, rtol=1e-12)
        np.testing.assert_allclose(searched[c], want, rtol=1e-12)


def test_search_without_narrowing(spark, frame):
    df = spark.createDataFrame(frame[["plain"]])
    got = column_quantiles(df, ["plain"], [0.5], direct_limit=10, final_limit=10_000)
    assert got["plain"][0] == pytest.approx(np.quantile(frame["plain"], 0.5))


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert column_quantiles(df, ["x"], [0.25, 0.5]) == {"x": [None, None]}
    assert column_quantiles(df, [], [0.5]) == {}
