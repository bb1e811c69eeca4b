"""Reports on fitted estimates: SQL recomputes each from the stored layer it reads."""
import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewell.plans.layers import Layers

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

# query on a fitted layer → the registered query whose SQL says the same over other estimates
SAME_AS = {"channel_metrics_fitted": "channel_metrics", "channel_segment_metrics_fitted": "channel_segment_metrics",
           "response_curves_fitted": "response_curves", "bootstrap_allocation_fitted": "bootstrap_allocation",
           "allocation_quantiles_fitted": "allocation_quantiles", "t_learner_qini": "qini_coefficient",
           "t_learner_qini_curve": "qini_curve", "t_learner_deciles": "uplift_by_decile"}


@pytest.fixture(scope="module")
def stored(spark, smoke_dir, tmp_path_factory):
    p = Layers(spark, smoke_dir)
    out = {}
    for name, df, sql in (("ltv", p.fitted_ltv, "SELECT *"), ("scores", p.fitted_scores, "SELECT *"),
                          ("uplift_frame", p.fitted_uplift, "SELECT *, true AS is_test")):
        # the files that the layer is read from
        files = ", ".join(f"'{f.removeprefix('file://')}'" for f in df.inputFiles())
        out[name] = f"{sql} FROM read_parquet([{files}])"
    return out


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SAME_AS))
def test_report_follows_from_the_stored_layer(spark, smoke_dir, con, stored, name):
    from compare_oracle import digest
    got = E.queries()[name](spark, smoke_dir).toPandas()
    plain = E.oracle_sql()[SAME_AS[name]]
    want = con.sql(plain.over(stored)).df()
    assert len(got) == len(want) > 0
    assert digest(got)[0] == digest(want)[0]
    # and it is not the report on the reference estimates
    assert "read_parquet" in plain.over(stored) and "read_parquet" not in plain


def test_stored_ltv_says_how_it_was_made(spark, smoke_dir):
    p = Layers(spark, smoke_dir)
    rows = p.fitted_ltv.groupBy("ltv_method").agg(F.count("fallback_reason").alias("reasons"), F.count("*").alias("n")).collect()
    assert len(rows) == 1
    assert rows[0].reasons == (0 if rows[0].ltv_method == "bgnbd_gamma_gamma" else rows[0].n)


def test_a_failing_fit_is_reported(spark, smoke_dir, monkeypatch):
    from tidewell.operators import ltv
    p = Layers(spark, smoke_dir)

    def broken(*_):
        raise ArithmeticError("no fit")

    monkeypatch.setattr(ltv, "bgnbd_fit", broken)
    out = ltv.probabilistic_ltv_table(p.silver, p.features_current, p.cutoffs.t_test, p.mp)
    r = out.select("ltv_method", "fallback_reason").distinct().collect()
    assert [tuple(x) for x in r] == [("heuristic_fallback", "ArithmeticError: no fit")]
    assert out.filter(~F.col("ltv_probabilistic").eqNullSafe(F.col("ltv_heuristic"))).isEmpty()
