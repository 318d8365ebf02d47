import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import tails


@pytest.mark.parametrize(
    "got, want",
    [
        (lambda: tails.chi2_tail(3.8415, 1), 0.05),
        (lambda: tails.chi2_tail(18.307, 10), 0.05),
        (lambda: tails.t_tail(2.2281, 10), 0.05),
        (lambda: tails.t_tail(1.96, 50000), 0.05),
        (lambda: tails.f_tail(2.37, 4, 10000), 0.0502),
    ],
)
def test_known_values(got, want):
    assert got() == pytest.approx(want, abs=5e-5)


def test_edges():
    assert tails.chi2_tail(0.0, 3) == 1.0
    assert tails.chi2_tail(5.0, 0) == 1.0
    assert tails.t_tail(math.inf, 4) == 0.0
    assert tails.f_tail(math.inf, 2, 9) == 0.0
    assert tails.t_tail(None, 4) is None
    assert tails.f_tail(1.0, 0, 9) is None


def test_t_squared_is_f():
    for t, dof in ((0.3, 4), (1.7, 11), (4.2, 3000), (9.0, 80)):
        assert tails.t_tail(t, dof) == pytest.approx(tails.f_tail(t * t, 1, dof), rel=1e-9)


def test_chi2_one_dof_is_normal_tail():
    for x in (0.01, 1.0, 4.0, 30.0, 200.0):
        assert tails.chi2_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)


def test_columns(spark):
    df = spark.createDataFrame([(3.8415, 1), (None, 2)], "x double, d int")
    got = [r[0] for r in df.select(tails.chi2_pvalue(F.col("x"), F.col("d"))).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-5) and got[1] is None
