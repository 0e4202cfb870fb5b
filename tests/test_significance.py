"""Two-sided p-values against published critical values and exact small cases."""

import math

import pytest
from pyspark.sql import functions as F

from diamondlake.functions.significance import two_sided_p
from diamondlake.operators.validation import verdict

# t, degrees of freedom, p: quantiles of tables, and closed forms for 1 and 2 degrees of freedom.
CASES = [
    (12.7062047, 1, 0.05), (4.30265273, 2, 0.05), (2.0484071, 28, 0.05), (2.7632625, 28, 0.01), (1.9618, 1261, 0.05), (1.0, 1, 0.5),
    (2.0, 2, 1 - 2 / math.sqrt(6)), (2.3094011, 3, 0.104088), (0.0, 5, 1.0), (40.0, 1261, 0.0), (1.959964, 1e9, 0.05),
]


@pytest.mark.parametrize("t, freedom, p", CASES)
def test_p(spark, t, freedom, p):
    got = spark.range(1).select(two_sided_p(F.lit(float(t)), F.lit(freedom)).alias("p"), two_sided_p(F.lit(-float(t)), F.lit(freedom)).alias("m")).first()
    assert math.isclose(got.p, p, abs_tol=2e-5) and math.isclose(got.p, got.m, abs_tol=1e-12)


def test_edges(spark):
    got = spark.range(1).select(
        two_sided_p(F.lit(float("inf")), F.lit(5)).alias("a"), two_sided_p(F.lit(2.0), F.lit(0)).alias("b"), two_sided_p(F.lit(None).cast("double"), F.lit(5)).alias("c"),
    ).first()
    assert got.a == 0.0 and got.b is None and got.c is None


def test_few_pairs_fail(spark):
    """Five pairs with rho 0.8 have p 0.104, which is not significant."""
    rows = [("missing", 0.0), ("out_of_range", 0.0), ("sign_match_rate", 0.9), ("spearman", 0.8), ("domain_ok", 1.0)]
    p = spark.range(1).select(two_sided_p(F.lit(0.8 * math.sqrt(3 / (1 - 0.64))), F.lit(3))).first()[0]
    judged = verdict(spark.createDataFrame([*rows, ("spearman_p", p)], "metric string, value double")).collect()
    assert {r.criterion: r.result for r in judged}["spearman"] == "FAIL" and abs(p - 0.1041) < 1e-3
