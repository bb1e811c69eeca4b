"""Hill response and budget allocation."""
import pytest
from pyspark.sql import functions as F

from tidewell.functions.hill import hill
from tidewell.operators import budget as bud
from tidewell.params import BudgetParams

PARAMS = [("email", 400.0, 100.0, 1.3), ("paid_social", 400.0, 280.0, 1.3),
          ("paid_search", 700.0, 330.0, 1.3), ("display", 200.0, 500.0, 1.3)]
# Published optimum (reference summary): parameters and total conversions.
PUBLISHED = [("email", 376.86241046095756, 95.23, 1.3), ("paid_social", 389.9012766867451, 267.53, 1.3),
             ("paid_search", 671.161080640392, 331.61, 1.3), ("display", 202.3399039706234, 507.07, 1.3)]
PUBLISHED_ALLOC = {"email": 6760.912182347932, "paid_social": 12357.78060418575,
                   "paid_search": 17559.691322306164, "display": 13321.615891160158}


def hp(spark, rows=PARAMS):
    return spark.createDataFrame(rows, "channel string, vmax double, k double, s double")


def test_hill_shape(spark):
    df = spark.range(0, 10001, 250).select(F.col("id").cast("double").alias("x"))
    ys = [r.y for r in df.select(hill("x", 500.0, 100.0, 1.3).alias("y")).orderBy("x").collect()]
    assert ys[0] == 0.0 and all(b >= a for a, b in zip(ys, ys[1:]))
    big = spark.range(1).select(hill(F.lit(1e6), 500.0, 100.0, 1.3).alias("y")).first().y
    assert big == pytest.approx(500.0, rel=1e-3)


@pytest.mark.parametrize("budget", [20000.0, 50000.0, 100000.0])
def test_allocation_sums_to_budget_and_respects_bounds(spark, budget):
    p = BudgetParams(total_budget=budget)
    rows = bud.budget_allocation(hp(spark), p).collect()
    assert sum(r.allocation for r in rows) == pytest.approx(budget, rel=1e-4)
    assert all(0.05 * budget - 1e-6 <= r.allocation <= 0.70 * budget + 1e-6 for r in rows)
    assert all(r.concave_ok for r in rows)


def test_more_budget_never_worse(spark):
    lo = bud.budget_allocation(hp(spark), BudgetParams(total_budget=30000.0)).first().total_conversions
    hi = bud.budget_allocation(hp(spark), BudgetParams(total_budget=60000.0)).first().total_conversions
    assert hi >= lo


def test_published_optimum_is_reached(spark):
    rows = bud.budget_allocation(hp(spark, PUBLISHED), BudgetParams(step=1.0)).collect()
    assert rows[0].total_conversions >= 1629.4587
    for r in rows:
        assert abs(r.allocation - PUBLISHED_ALLOC[r.channel]) <= 150.0


def test_response_curves_grid(spark):
    rc = bud.response_curves(hp(spark)).filter("channel = 'email'").orderBy("point").collect()
    assert len(rc) == 60 and rc[0].spend == 0.0 and rc[-1].spend == 35000.0


def test_evaluate_allocations_flags_off_budget(spark):
    cand = spark.createDataFrame([("even", c, 12500.0) for c, *_ in PARAMS] + [("low", c, 1000.0) for c, *_ in PARAMS],
                                 "scenario string, channel string, spend double")
    rows = {r.scenario: r for r in bud.evaluate_allocations(cand, hp(spark)).collect()}
    assert not rows["even"].off_budget and rows["low"].off_budget
    assert rows["low"].allocated_total == 4 * 2500.0  # clipped up to the floor


def test_bootstrap_is_partition_invariant_and_centred(spark):
    import random
    rnd = random.Random(7)
    rows = [(str(i), PARAMS[i % 4][0], rnd.random()) for i in range(400)]
    sa = spark.createDataFrame(rows, "customer_id string, channel string, score double")
    ch = spark.createDataFrame([(c, 50.0) for c, *_ in PARAMS], "channel string, cpa double")
    p = BudgetParams(resamples=40)
    a = {r.resample: r.total_conversions for r in bud.bootstrap_allocation(sa, ch, p).collect()}
    b = {r.resample: r.total_conversions for r in bud.bootstrap_allocation(sa.repartition(7), ch, p).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
    q = bud.allocation_quantiles(bud.bootstrap_allocation(sa, ch, p)).first()
    assert q.p10 <= q.p50 <= q.p90


def test_non_concave_floor_raises(spark):
    steep = [("a", 100.0, 50000.0, 3.0), ("b", 100.0, 100.0, 1.3)]
    with pytest.raises(ValueError):
        bud.budget_allocation(hp(spark, steep), BudgetParams(total_budget=10000.0, min_share=0.05, max_share=0.95))
