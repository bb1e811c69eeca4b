"""Partition-independent pseudo-random numbers.

A draw is a pure function of (seed, key, salt): the first 32 bits of
md5("seed:key:salt") mapped to the open interval (0, 1).  The same row always
gets the same number, however the data are partitioned or re-executed after
an executor loss, and the same expression can be written in any SQL engine
that has md5 — which is what makes resampling and synthetic attribution
checkable against an oracle.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(seed: int, key: Column | str, salt: str) -> Column:
    key_col = F.col(key) if isinstance(key, str) else key
    return F.concat_ws(":", F.lit(str(seed)), key_col.cast("string"), F.lit(salt))


def hash_uniform(seed: int, key: Column | str, salt: str) -> Column:
    """Uniform double in (0, 1): (h + 0.5) / 2^32 with h the top 32 md5 bits."""
    h = F.conv(F.substring(F.md5(_key(seed, key, salt)), 1, 8), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(TWO_32)


def hash_normal(seed: int, key: Column | str, salt: str) -> Column:
    """Standard normal by Box-Muller on two independent hashed uniforms."""
    u1 = hash_uniform(seed, key, salt + ":n1")
    u2 = hash_uniform(seed, key, salt + ":n2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def poisson1_thresholds(max_k: int = 16) -> list[float]:
    """Cumulative Poisson(1) probabilities P(X <= k) for k = 0..max_k-1."""
    out, acc, term = [], 0.0, math.exp(-1.0)
    for k in range(max_k):
        if k > 0:
            term = term / k
        acc += term
        out.append(acc)
    return out


def hash_poisson1(seed: int, key: Column | str, salt: str, max_k: int = 16) -> Column:
    """Poisson(1) count by inverse CDF of a hashed uniform (tail beyond max_k folded in)."""
    u = hash_uniform(seed, key, salt)
    expr = F.lit(max_k)
    for k, c in reversed(list(enumerate(poisson1_thresholds(max_k)))):
        expr = F.when(u < F.lit(c), F.lit(k)).otherwise(expr)
    return expr
