"""Media ratios, LTV and cohort matrices."""
import math

import pytest
from pyspark.sql import functions as F

from fixtures import d
from tidewell.functions.ratios import cpa, ltv_cac, roas
from tidewell.operators import metrics as met
from tidewell.params import MetricsParams


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cpa_zero_conversions_is_infinite(spark):
    assert one(spark, [(100.0, 0), (100.0, 20)], "c double, n long", cpa("c", "n")) == [math.inf, 5.0]


def test_roas_zero_cost(spark):
    assert one(spark, [(50.0, 0.0), (0.0, 0.0), (300.0, 100.0)], "r double, c double", roas("r", "c")) == [math.inf, 0.0, 3.0]


def test_ltv_cac_zero_cac(spark):
    assert one(spark, [(500.0, 0.0), (600.0, 200.0)], "l double, c double", ltv_cac("l", "c")) == [math.inf, 3.0]


def test_ltv_heuristic(spark):
    f = spark.createDataFrame([("A", 200.0, 4, 365.25)], "customer_id string, monetary double, frequency long, tenure_days double")
    r = met.ltv_heuristic(f, MetricsParams(gross_margin=0.5, ltv_horizon_months=12)).first()
    assert r.avg_order_value == 50 and r.ltv_heuristic == pytest.approx(100.0)


FACT = "customer_id string, invoice_date timestamp_ntz, revenue double"
DIM = "customer_id string, acquisition_cohort string"


def cohort_inputs(spark):
    fact = spark.createDataFrame([("A", d("2023-01-05"), 10.0), ("A", d("2023-02-10"), 15.0),
                                  ("B", d("2023-03-01"), 20.0)], FACT)
    dim = spark.createDataFrame([("A", "2023-01"), ("B", "2023-03")], DIM)
    return fact, dim


def test_cohort_retention_censoring(spark):
    fact, dim = cohort_inputs(spark)
    rows = {r.acquisition_cohort: r for r in met.cohort_retention(fact, dim, d("2023-03-15"), 3).collect()}
    a, b = rows["2023-01"], rows["2023-03"]
    assert (a.M0, a.M1, a.M2, a.M3) == (100.0, 100.0, 0.0, None)
    assert (b.M0, b.M1, b.M2) == (100.0, None, None)


def test_cohort_retention_empty(spark):
    fact = spark.createDataFrame([], FACT)
    dim = spark.createDataFrame([], DIM)
    assert met.cohort_retention(fact, dim, d("2023-03-15"), 3).count() == 0


def test_cohort_revenue_cumulative(spark):
    fact, dim = cohort_inputs(spark)
    a = {r.acquisition_cohort: r for r in met.cohort_revenue(fact, dim, d("2023-03-15"), 3).collect()}["2023-01"]
    assert (a.M0, a.M1, a.M3) == (10.0, 25.0, None)


def test_window_revenue_only_inside_window(spark):
    rows = [("A", d("2023-01-01"), 20.0), ("A", d("2023-01-31"), 25.0), ("A", d("2023-03-02"), 22.0),
            ("A", d("2023-04-01"), 30.0), ("B", d("2023-01-15"), 15.0), ("B", d("2023-03-01"), 18.0)]
    got = {r.customer_id: r.window_revenue for r in
           met.window_revenue(spark.createDataFrame(rows, FACT), d("2023-02-01"), 90).collect()}
    assert got == {"A": 52.0, "B": 18.0}


def test_ltv_table_fallback(spark):
    f = spark.createDataFrame([("A", 97.0, 4, 120), ("B", 33.0, 2, 60)],
                              "customer_id string, monetary double, frequency long, tenure_days long")
    rows = met.ltv_table(f, None, MetricsParams(gross_margin=0.55)).collect()
    assert all(r.ltv_probabilistic == r.ltv_heuristic and r.ltv_method == "heuristic_fallback" for r in rows)


def channel_inputs(spark):
    feats = spark.createDataFrame([("1", 1), ("2", 0), ("3", 1)], "customer_id string, target_conversion int")
    attr = spark.createDataFrame([("1", "email", 10.0), ("2", "email", 10.0), ("3", "display", 40.0)],
                                 "customer_id string, channel string, cac_synthetic double")
    ltv = spark.createDataFrame([("1", 200.0), ("2", 150.0), ("3", 80.0)], "customer_id string, ltv_probabilistic double")
    wr = spark.createDataFrame([("1", 60.0), ("3", 50.0)], "customer_id string, window_revenue double")
    return feats, attr, ltv, wr


def test_channel_metrics(spark):
    rows = {r.channel: r for r in met.channel_metrics(*channel_inputs(spark)).collect()}
    e = rows["email"]
    assert (e.customers, e.conversions, e.spend_synthetic, e.cpa, e.revenue) == (2, 1, 20.0, 20.0, 60.0)
    assert rows["display"].roas == 1.25


def test_channel_segment_metrics(spark):
    feats, attr, ltv, wr = channel_inputs(spark)
    segs = spark.createDataFrame([("1", "Champions"), ("2", "Hibernating")], "customer_id string, segment_name string")
    rows = met.channel_segment_metrics(feats, attr, segs, ltv, wr).collect()
    assert len(rows) == 2
    assert [r.cpa for r in rows if r.segment == "Champions"] == [10.0]


def test_rf_summary_day_grain(spark):
    rows = [("A", d("2023-01-01 09:00:00"), 10.0), ("A", d("2023-01-01 18:00:00"), 5.0),
            ("A", d("2023-01-11 10:00:00"), 30.0), ("B", d("2023-01-20 10:00:00"), 7.0)]
    got = {r.customer_id: r for r in met.rf_summary(spark.createDataFrame(rows, FACT), d("2023-01-31")).collect()}
    a, b = got["A"], got["B"]
    assert (a.frequency, a.recency, a.T, a.monetary_value) == (1, 10.0, 30.0, 30.0)
    assert (b.frequency, b.recency, b.T, b.monetary_value) == (0, 0.0, 11.0, 0.0)
