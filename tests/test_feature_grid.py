"""Dense cutoff grids give the rows of the cutoff-by-cutoff plan."""
import datetime as dt
import random

import pytest

from fixtures import BRONZE_SCHEMA, FACT_SCHEMA, SAMPLE_TRANSACTIONS, SMOKE_CODES, d
from tidewell.operators import cleaning, feature_grid, features
from tidewell.params import FeatureParams

UK = FeatureParams(home_country="United Kingdom")


def rows(df):
    out = {}
    for r in df.collect():
        assert (r.customer_id, r.as_of) not in out
        out[r.customer_id, r.as_of] = tuple(
            None if v is None else pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for v in r)
    return out


def same(fact, dim, as_ofs, window, include_target=True):
    want = features.feature_snapshots(fact, dim, as_ofs, window, UK, include_target)
    got = feature_grid.snapshot_grid(fact, dim, as_ofs, window, UK, include_target)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows(got) == rows(want)


def random_fact(spark, seed, n=500):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        c = rnd.choice(["hot", "hot", "a", "b", "c", "d"])
        day = dt.datetime(2022, 1, 1) + dt.timedelta(days=rnd.randrange(420))
        t = day + rnd.choice([dt.timedelta(), dt.timedelta(microseconds=1), dt.timedelta(hours=23, minutes=59),
                              dt.timedelta(minutes=rnd.randrange(1440)), dt.timedelta(microseconds=86_399_999_999)])
        # invoices that go on over days, and null ones
        out.append((c, rnd.choice([None, f"{c}{rnd.randrange(60)}", f"{c}x{day:%j}"]), rnd.choice([None, "p", "q", f"s{rnd.randrange(40)}"]),
                    t, round(rnd.random() * 90, 2), rnd.choice(["United Kingdom", "X"])))
    return spark.createDataFrame(out, FACT_SCHEMA)


def test_fixture_and_single_cutoffs(spark):
    silver = cleaning.clean_silver(spark.createDataFrame(SAMPLE_TRANSACTIONS, BRONZE_SCHEMA), SMOKE_CODES)
    dim = features.dim_customers(silver)
    same(silver, dim, [d("2023-01-31")], 90)
    same(silver, dim, [d("2023-01-15"), d("2023-01-31")], 10)
    same(silver, dim, [d("2023-01-20")], None, include_target=False)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weekly_and_odd_cutoffs(spark, seed):
    fact = random_fact(spark, seed)
    dim = features.dim_customers(fact)
    weekly = [d("2022-02-01") + dt.timedelta(days=7 * k) for k in range(40)]
    # several on one day, on a month's first moment, and before all rows
    odd = [d("2021-05-05"), d("2022-03-01"), d("2022-03-01 00:00:01"), d("2022-03-01 23:59:59"),
           d("2022-02-28 23:59:59") + dt.timedelta(microseconds=999_999), d("2022-07-09 11:30:00"), d("2025-01-01")]
    same(fact, dim, weekly, 30)
    same(fact, dim, odd, 7)
    same(fact, dim, odd + weekly[:5], None, include_target=False)


def test_empty_fact_and_missing_window(spark):
    fact = spark.createDataFrame([], FACT_SCHEMA)
    assert feature_grid.snapshot_grid(fact, features.dim_customers(fact), [d("2023-01-31")], 90, UK).count() == 0
    with pytest.raises(ValueError):
        feature_grid.snapshot_grid(fact, fact, [d("2023-01-31")], None, UK)


def test_rows_are_not_multiplied_by_cutoffs(spark):
    fact = random_fact(spark, 5, 100)
    cutoffs = [d("2022-02-01") + dt.timedelta(days=7 * k) for k in range(52)]
    plan = feature_grid.snapshot_grid(fact, features.dim_customers(fact), cutoffs, 90, UK)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    scan = [k for k, x in enumerate(text.splitlines()) if "LogicalRDD" in x or "LocalRelation" in x]
    explode = [k for k, x in enumerate(text.splitlines()) if "Generate explode" in x]
    window = [k for k, x in enumerate(text.splitlines()) if "Window [" in x]
    # the explodes are above the running sums
    assert len(explode) == 2 and max(explode) < min(window) < min(scan)
