import math
import random

import numpy as np
import pytest
from helpers import DIR, duck, same
from pyspark.sql import functions as F

from tidewell.llm import queries
from tidewell.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, scale=1.0, asked=lambda i: i is not None and i % 50 == 0):
    held = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(held):
        if asked(i):
            scored = [(-min(max(sum(x * y for x, y in zip(q, v)), -2 ** 63), 2 ** 63 - 1), j is None, j or 0)
                      for b, (j, v) in enumerate(held) if a != b]
            for rank, (s, none, j) in enumerate(sorted(scored)[:k]):
                out.append((i, rank + 1, None if none else j, -s))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def search(spark, rows, k=5, parts=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return got(T.top_k(df, F.col("vec_id") % 50 == 0, k, **kw))


def test_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) * (3 if d == i % 5 else 1) for d in range(8)]) for i in range(400)]
    for parts in (1, 40):
        assert search(spark, rows, parts=parts, scale=256.0) == brute(rows, 5, 256.0)


def test_odd_vectors(spark):
    rnd = random.Random(2)
    rows = [(0, None), (50, []), (100, [1.0, None]), (150, [float("nan")]), (200, [float("inf")]), (250, [1.5, -2.5]),
            (300, [1.0]), (300, [1.0]), (300, [2.0, 0.0, 9.0]), (None, [1.0, 1.0]), (None, None), (7, [-1.0, 1.0]), (8, [3e5, 1.0])]
    rows += [(rnd.randrange(400), [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for _ in range(60)]
    assert search(spark, rows) == brute(rows, 5)
    assert search(spark, rows[:3], k=2) == brute(rows[:3], 2) == []
    assert search(spark, rows, query_bytes=60) == brute(rows, 5)          # many passes


def test_huge_components(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e12, 1.0]), (2, [1e12, 2.0]), (3, [-1e18, 1.0]), (50, [1e9, 2.0 ** 40])]
    assert search(spark, rows, k=3) == brute(rows, 3)


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300 + i, [float(i % 7), 2.0, 3.0]) for i in range(100)]
    assert search(spark, rows) == brute(rows, 5)


def test_empty_and_other_names(spark):
    assert T.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    df = spark.createDataFrame([(50, [1.0], "x", 1), (51, [2.0], "y", 2)], "id long, v array<float>, score string, block int")
    out = T.top_k(df, F.col("id") == 50, id_col="id", vector_col="v")
    assert [tuple(r) for r in out.collect()] == [(50, 1, 51, 2)]


@pytest.mark.parametrize("n", [1, 3, 60, 500])
def test_bounds_hold_and_stop_early(n):
    rnd = np.random.default_rng(n)
    x = np.floor(rnd.normal(size=(n, 6)) * 50)
    q = np.floor(rnd.normal(size=(9, 6)) * 50)
    lists = T.Lists(x)
    score = q @ x.T
    for depth in {1, max(1, n // 3), n}:
        lower, upper = lists.bounds(depth, np.maximum(q, 0), np.minimum(q, 0))
        assert (lower <= score).all() and (score <= upper).all()
    found = {}
    for row, at, s in T.search_block(lists, q, np.full(9, -1), np.full(9, -np.inf), 5):
        found[row] = set(at[np.argsort(-s, kind="stable")[:5]])
    for row in range(9):
        best = np.sort(score[row])[::-1][:5]
        assert np.array_equal(np.sort(score[row, list(found[row])])[::-1], best)


def test_query_matches_sql(spark):
    same(queries.QUERIES["op11_top_k_search"](spark, DIR), duck(queries.ORACLE["op11_top_k_search"]))
