"""Two-sided p-value of Student's t as a column expression, for single result rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the Lanczos approximation of the gamma function, g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
# Steps of the continued fraction; it has settled long before for any t and any count.
STEPS = 400


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 0.5."""
    y = x - 1
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (y + i)
    return 0.918938533204672742 + (y + 0.5) * F.log(y + 7.5) - (y + 7.5) + F.log(series)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, two terms a step."""

    def part(numerator: Column, c: Column, d: Column) -> tuple[Column, Column]:
        return 1 + numerator / c, 1 / (1 + numerator * d)

    def step(state: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        c1, d1 = part(even, state["c"], state["d"])
        half = F.struct(c1.alias("c"), d1.alias("d"), (state["h"] * c1 * d1).alias("h"))

        def second(s: Column) -> Column:
            c2, d2 = part(odd, s["c"], s["d"])
            return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * c2 * d2).alias("h"))

        # One-element arrays name the intermediate values, so that none is written out twice.
        return F.transform(F.array(half), second)[0]

    d0 = 1 / (1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    return F.aggregate(F.transform(steps, lambda m: m.cast("double")), start, step, lambda s: s["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta function for x in (0, 1)."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    return F.when(x < (a + 1) / (a + b + 2), front * _fraction(a, b, x) / a).otherwise(1 - front * _fraction(b, a, 1 - x) / b)


def two_sided_p(t: Column, freedom: Column) -> Column:
    """Probability of a value at least as far from 0 as t; 0 for an infinite t, NULL below one degree of freedom."""
    df = freedom.cast("double")
    x = df / (df + t * t)
    inside = incomplete_beta(x, df / 2, F.lit(0.5))
    p = F.when(F.abs(t) == float("inf"), F.lit(0.0)).when(t == 0, F.lit(1.0)).when(x < 1e-300, F.lit(0.0)).otherwise(inside)
    return F.when((df >= 1) & t.isNotNull(), p)
