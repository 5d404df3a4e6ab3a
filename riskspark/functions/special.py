"""Special functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the continued fraction; it needs about the square root of the larger parameter only near the mean.
STEPS = 300
_TINY = 1e-300


def _series(z: Column) -> Column:
    """What ln of the gamma function is beyond Stirling's leading terms, for z of eight or more."""
    square = 1.0 / (z * z)
    return (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - square / 1188) * square) * square) * square) / z


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0: Stirling's series eight places further up."""
    up = z + 8.0
    product = F.lit(1.0)
    for i in range(8):
        product = product * (z + float(i))
    return (up - 0.5) * F.log(up) - up + F.lit(0.9189385332046727) + _series(up) - F.log(product)


def log_beta(a: Column, b: Column) -> Column:
    """ln of the beta function; for a large parameter the difference of two gammas is taken term by term."""
    low, high = F.least(a, b), F.greatest(a, b)
    apart = (high - 0.5) * F.log1p(low / high) + low * (F.log(high + low) - 1.0) + _series(high + low) - _series(high)
    return log_gamma(low) - F.when(high < 10, log_gamma(high + low) - log_gamma(high)).otherwise(apart)


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, by its even and odd terms from the front."""
    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, _TINY).otherwise(v)

    def term(state: Column, factor: Column) -> Column:
        d = 1.0 / safe(1.0 + factor * state["d"])
        c = safe(1.0 + factor / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * d * c).alias("h"))

    def step(state: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return term(state, F.when(k % 2 == 0, even).otherwise(odd))

    d = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(2 * STEPS + 1)), start, step)["h"]


def regularised_beta(x: Column, a: Column, b: Column, rest: Column | None = None) -> Column:
    """The share of the beta function up to x, 0 <= x <= 1, for a, b > 0; NULL with a NULL argument.

    `rest` is 1 - x, where it is known better than the difference would be.
    """
    rest = 1.0 - x if rest is None else rest

    def below(x: Column, rest: Column, a: Column, b: Column) -> Column:
        return F.exp(a * F.log(x) + b * F.log(rest) - log_beta(a, b)) * _fraction(x, a, b) / a
    value = F.when(x < (a + 1.0) / (a + b + 2.0), below(x, rest, a, b)).otherwise(1.0 - below(rest, x, b, a))
    return F.when(x <= 0, 0.0).when(rest <= 0, 1.0).when(x.isNotNull() & a.isNotNull() & b.isNotNull(), value)


def f_tail(f: Column, between: Column, within: Column) -> Column:
    """The probability of an F statistic of at least `f`, with these degrees of freedom."""
    between, within = between.cast("double"), within.cast("double")
    total = within + between * f
    return regularised_beta(within / total, within / 2.0, between / 2.0, between * f / total)
