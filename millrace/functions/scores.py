"""Scoring expressions. Null means unknown and is never taken for zero: it drops out of the denominator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def curve(x: Column, points: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear through the points, level outside them; null stays null."""
    (x0, y0), *_ = points
    out = F.when(x <= x0, F.lit(float(y0)))
    for (a, ya), (b, yb) in zip(points, points[1:], strict=False):
        out = out.when(x <= b, F.lit(float(ya)) + (x - F.lit(float(a))) * F.lit((yb - ya) / (b - a)))
    return out.when(x.isNotNull(), F.lit(float(points[-1][1])))


def band(x: Column, floors: Sequence[tuple[float, str]], unknown: str = "unknown") -> Column:
    """The name of the first floor, from the highest, that x reaches."""
    ordered = sorted(floors, reverse=True)
    return reduce(lambda out, f: out.when(x >= f[0], F.lit(f[1])), ordered[1:], F.when(x >= ordered[0][0], F.lit(ordered[0][1]))).otherwise(F.lit(unknown))


def known_mean(parts: Sequence[tuple[float, Column]]) -> Column:
    """Mean by weight of the parts that are known; null if none is."""
    total = sum((F.when(c.isNotNull(), F.lit(float(w))).otherwise(0.0) for w, c in parts), F.lit(0.0))
    return F.try_divide(sum((F.coalesce(c * F.lit(float(w)), F.lit(0.0)) for w, c in parts), F.lit(0.0)), total)


def known_share(parts: Sequence[tuple[float, Column]]) -> Column:
    """Share of the weights whose parts are known."""
    return sum((F.when(c.isNotNull(), F.lit(float(w))).otherwise(0.0) for w, c in parts), F.lit(0.0)) / float(sum(w for w, _ in parts))


def log_share(x: Column, full: float) -> Column:
    """Logarithmic share of a count, one at `full` and above."""
    return F.least(F.lit(1.0), F.log10(1 + x) / F.log10(F.lit(1.0 + full)))


def decay(age: Column, half_life: float) -> Column:
    return F.pow(F.lit(0.5), age / F.lit(float(half_life)))


def rounded(x: Column, digits: int = 4) -> Column:
    """Rounded as SQL engines round doubles: the product with the power of ten, halves away from zero. F.round goes by the shortest decimal of x instead, so that 180.57 / -104 (just above -1.73625) would differ. Without a
    negative zero."""
    scale = F.lit(float(10**digits))
    return F.round(x.cast("double") * scale, 0) / scale + F.lit(0.0)


def capped(x: Column, *caps: Column) -> Column:
    """x, at most each cap that is known."""
    return F.least(x, *caps)


def reasons(*checks: tuple[str, Column]) -> Column:
    """Names of the checks that hold, in order; a check that is unknown does not hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks]))


def first_failing(*checks: tuple[str, Column]) -> Column:
    """Name of the first check that holds; null if none does."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in checks], F.lit(None).cast("string"))
