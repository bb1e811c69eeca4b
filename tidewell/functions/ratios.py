"""Media ratios with explicit zero-denominator rules (ANSI mode raises on x/0)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def cpa(cost, conversions) -> Column:
    """cost / conversions; zero conversions -> +inf."""
    cost, conv = _c(cost), _c(conversions)
    return F.when(conv == 0, F.lit(INF)).otherwise(cost / conv)


def roas(revenue, cost) -> Column:
    """revenue / cost; zero cost -> +inf when revenue > 0, else 0."""
    rev, cost = _c(revenue), _c(cost)
    return F.when(cost == 0, F.when(rev > 0, F.lit(INF)).otherwise(F.lit(0.0))).otherwise(rev / cost)


def ltv_cac(ltv, cac) -> Column:
    """ltv / cac with the same zero rule as roas."""
    return roas(ltv, cac)


def round_half(x, digits: int) -> Column:
    """Round half away from zero on the binary value: scale, round to an
    integer, unscale (the same arithmetic numpy / DuckDB use, so every engine
    returns the identical double)."""
    scale = float(10 ** digits)
    return F.round(_c(x) * F.lit(scale), 0) / F.lit(scale)


def money_sum(x) -> Column:
    """Sum carried at micro-unit precision, so the result does not depend on
    the order partial sums are merged in."""
    return round_half(F.sum(_c(x)), 6)
