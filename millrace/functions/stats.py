"""Tail probabilities as column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; a few dozen settle it for the degrees of freedom that occur.
TERMS = 300
_TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series ten steps above x, and down again."""
    z = x + 10
    series = reduce(Column.__add__, [F.lit(c) / F.pow(z, F.lit(k)) for k, c in ((1, 1 / 12), (3, -1 / 360), (5, 1 / 1260), (7, -1 / 1680))])
    steps = reduce(Column.__add__, [F.ln(x + k) for k in range(10)])
    return (z - 0.5) * F.ln(z) - z + math.log(2 * math.pi) / 2 + series - steps


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method, as a fold over its terms."""

    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def step(s: Column, factor: Column) -> Column:
        d = 1 / safe(1 + factor * s.d)
        c = safe(1 + factor / s.c)
        return F.struct(c.alias("c"), d.alias("d"), (s.out * c * d).alias("out"))

    d0 = 1 / safe(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("out"))
    # two factors a term: even and odd places of one sequence, so that every step of the fold is the same small expression
    places = F.sequence(F.lit(2), F.lit(2 * TERMS + 1))

    def factor(k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.transform(places, factor), start, step, lambda s: s.out)


def f_tail(f: Column, df1: Column, df2: Column) -> Column:
    """Probability of an F value above ``f`` with ``df1`` and ``df2`` degrees of freedom; null where one is null or not positive."""
    x = df2 / (df2 + df1 * f)
    a, b = df2.cast("double") / 2, df1.cast("double") / 2

    def part(a: Column, b: Column, x: Column) -> Column:
        lead = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.log1p(-x)) / a
        return lead * _fraction(a, b, x)

    inside = F.when(x < (a + 1) / (a + b + 2), part(a, b, x)).otherwise(1 - part(b, a, 1 - x))
    known = (df1 > 0) & (df2 > 0) & (f >= 0)
    return F.when(known & (x <= 0), 0.0).when(known & (x >= 1), 1.0).when(known, inside)
