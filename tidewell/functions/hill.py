"""Hill saturation curve as a column expression."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return x


def hill(spend, vmax, k, s) -> Column:
    """vmax * x^s / (k^s + x^s) with x = max(spend, 0)."""
    x = F.greatest(_c(spend), F.lit(0.0))
    xs = F.pow(x, _c(s))
    return _c(vmax) * xs / (F.pow(_c(k), _c(s)) + xs)
