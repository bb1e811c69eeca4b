"""Reporting queries (D1–D12) on small hand-made inputs."""
import pytest

from fixtures import d
from tidewell.operators import reports as rep


def scores(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, score double, label int")


def test_top_audience_filter_applies_after_the_cut(spark):
    s = scores(spark, [(str(i), 1.0 - i / 10, 0) for i in range(10)])
    seg = spark.createDataFrame([(str(i), "A" if i % 2 else "B") for i in range(10)], "customer_id string, segment_name string")
    top3 = rep.top_audience(s, seg, n=3)
    assert sorted(r.customer_id for r in top3.collect()) == ["0", "1", "2"]
    only_a = rep.top_audience(s, seg, n=3, segment="A")
    assert [r.customer_id for r in only_a.collect()] == ["1"]  # not the top-3 of segment A


def test_score_distribution_keeps_empty_bands(spark):
    out = {r.label: r.customers for r in rep.score_distribution(scores(spark, [("1", 0.1, 0), ("2", 0.95, 1)])).collect()}
    assert out == {"0-0.3": 1, "0.3-0.5": 0, "0.5-0.7": 0, "0.7-1.0": 1}


def test_revenue_share_top_five_and_other(spark):
    fact = spark.createDataFrame([(c, float(r)) for c, r in zip("ABCDEFG", [70, 60, 50, 40, 30, 20, 10])],
                                 "country string, revenue double")
    out = {r.country: r for r in rep.revenue_share_country(fact).collect()}
    assert set(out) == {"A", "B", "C", "D", "E", "Other"}
    assert out["Other"].revenue == 30.0 and out["A"].pct == pytest.approx(100 * 70 / 280)


def test_activation_funnel_is_nested(spark):
    f = spark.createDataFrame([("1", 1), ("2", 1), ("3", 0)], "customer_id string, target_conversion int")
    s = scores(spark, [("1", 0.9, 1), ("2", 0.5, 1), ("3", 0.99, 0)])
    a = spark.createDataFrame([("1", True), ("2", True), ("3", True)], "customer_id string, exposed boolean")
    got = [r.customers for r in sorted(rep.activation_funnel(f, s, a).collect(), key=lambda r: r.stage)]
    assert got == [3, 2, 1, 1]


def test_best_channel(spark):
    ch = spark.createDataFrame([("email", 11.1, 71.4, 100.0), ("display", 1.7, 8.4, 300.0)],
                               "channel string, roas double, ltv_cac double, spend_synthetic double")
    r = rep.best_channel(ch).first()
    assert (r.best_roas_channel, r.best_roas_label, r.best_ltv_cac_channel) == ("email", "Email", "email")
    assert r.best_roas_spend_share == pytest.approx(0.25)


def test_monthly_revenue(spark):
    fact = spark.createDataFrame([(d("2023-01-05"), 1.0), (d("2023-01-31 23:00:00"), 2.0), (d("2023-02-01"), 4.0)],
                                 "invoice_date timestamp_ntz, revenue double")
    got = sorted((r.month.month, r.revenue) for r in rep.monthly_revenue(fact).collect())
    assert got == [(1, 3.0), (2, 4.0)]


def test_model_comparison_scores_each_row_once(spark):
    """The three metrics read the scores once stored; scoring may cost hundreds of trees a row."""
    from pyspark.sql import functions as F
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(s):
        seen.add(1)
        return s

    rows = [("baseline", f"{i}", i / 20, i % 2) for i in range(20)] + [("other", f"{i}", (i % 7) / 10, i % 2) for i in range(20)]
    long = spark.createDataFrame(rows, "model string, customer_id string, score double, label int")
    out = {r.model: r for r in rep.model_comparison(long.withColumn("score", scored("score"))).collect()}
    assert seen.value == len(rows)
    plain = {r.model: r for r in rep.model_comparison(long).collect()}
    assert out == plain and out["baseline"].delta_roc_auc == 0
