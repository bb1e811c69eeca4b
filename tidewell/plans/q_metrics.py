"""Registered plans: media ratios, LTV, cohorts (M*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.ratios import cpa as cpa_col
from tidewell.functions.ratios import ltv_cac as ltv_cac_col
from tidewell.functions.ratios import roas as roas_col
from tidewell.operators import metrics as met
from tidewell.plans.oracle import CUT, MP, build, cpa_sql, roas_sql, tslit
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register


@register("cpa", build(f"""
SELECT channel, round(cost, 6) AS cost, conversions, round({cpa_sql('cost', 'conversions')}, 6) AS cpa
FROM channel_agg""", "channel_agg"))
def cpa(p):
    """M1: cost per conversion by channel (∞ with no conversions)."""
    b = met._channel_base(p.features_current, p.attribution, p.ltv, p.window_rev)
    g = b.groupBy("channel").agg(F.sum("cac_synthetic").alias("cost"),
                                 F.sum("target_conversion").cast("bigint").alias("conversions"))
    return round_doubles(g.select("channel", "cost", "conversions", cpa_col("cost", "conversions").alias("cpa")))


@register("roas", build(f"""
SELECT channel, round(rev, 6) AS revenue, round(cost, 6) AS cost, round({roas_sql('rev', 'cost')}, 6) AS roas
FROM channel_agg""", "channel_agg"))
def roas(p):
    """M2: realised window revenue over acquisition spend by channel."""
    b = met._channel_base(p.features_current, p.attribution, p.ltv, p.window_rev)
    g = b.groupBy("channel").agg(F.sum("window_revenue").alias("revenue"), F.sum("cac_synthetic").alias("cost"))
    return round_doubles(g.select("channel", "revenue", "cost", roas_col("revenue", "cost").alias("roas")))


@register("ltv_cac", build(f"""
SELECT channel, round(ltv, 6) AS avg_ltv, round(cac, 6) AS avg_cac, round({roas_sql('ltv', 'cac')}, 6) AS ltv_cac
FROM channel_agg""", "channel_agg"))
def ltv_cac(p):
    """M3: mean LTV over mean CAC by channel."""
    b = met._channel_base(p.features_current, p.attribution, p.ltv, p.window_rev)
    g = b.groupBy("channel").agg(F.avg("ltv_probabilistic").alias("avg_ltv"), F.avg("cac_synthetic").alias("avg_cac"))
    return round_doubles(g.select("channel", "avg_ltv", "avg_cac", ltv_cac_col("avg_ltv", "avg_cac").alias("ltv_cac")))


@register("ltv_heuristic", build("""
SELECT customer_id, round(monetary, 6) AS monetary, frequency, tenure_days, round(avg_order_value, 6) AS avg_order_value,
       round(ltv_heuristic, 6) AS ltv_heuristic FROM ltv""", "ltv"))
def ltv_heuristic(p):
    """M4: AOV × annual frequency × margin × horizon."""
    return round_doubles(met.ltv_heuristic(p.features_current, p.mp))


@register("window_revenue", build("SELECT customer_id, round(window_revenue, 6) AS window_revenue FROM window_rev",
                                  "window_rev"))
def window_revenue(p):
    """M5: realised revenue in (as_of, as_of + 90 days]."""
    return round_doubles(p.window_rev)


@register("cohort_month_index", build("""
SELECT s.customer_id, s.invoice_date, s.revenue, d.acquisition_cohort,
       (year(s.invoice_date) * 12 + month(s.invoice_date) - 1)
         - (CAST(substr(d.acquisition_cohort, 1, 4) AS INTEGER) * 12 + CAST(substr(d.acquisition_cohort, 6, 2) AS INTEGER) - 1)
         AS months_since_acquisition
FROM silver s JOIN dim d ON s.customer_id = d.customer_id""", "silver", "dim"))
def cohort_month_index(p):
    """M6: months since acquisition for every transaction."""
    return met.cohort_month_index(p.silver, p.dim)


def _cohort_sql(cell_fn) -> str:
    obs = CUT.t_test.year * 12 + CUT.t_test.month - 1
    cidx = "(CAST(substr(s.acquisition_cohort, 1, 4) AS INTEGER) * 12 + CAST(substr(s.acquisition_cohort, 6, 2) AS INTEGER) - 1)"
    cells = ",\n".join(
        f"CASE WHEN {i} > {obs} - {cidx} THEN CAST(NULL AS DOUBLE) ELSE {cell_fn(i)} END AS M{i}"
        for i in range(MP.max_months + 1))
    return f"""
WITH monthly AS (
  SELECT customer_id, year(invoice_date) * 12 + month(invoice_date) - 1 AS m_idx, round(sum(revenue), 6) AS rev
  FROM silver GROUP BY 1, 2),
cells AS (
  SELECT d.acquisition_cohort, m.customer_id, m.rev,
         m.m_idx - (CAST(substr(d.acquisition_cohort, 1, 4) AS INTEGER) * 12 + CAST(substr(d.acquisition_cohort, 6, 2) AS INTEGER) - 1) AS m
  FROM monthly m JOIN dim d ON m.customer_id = d.customer_id),
sizes AS (SELECT acquisition_cohort, count(DISTINCT customer_id) AS cohort_size FROM dim GROUP BY 1),
per AS (
  SELECT acquisition_cohort,
         {", ".join(f"count(DISTINCT CASE WHEN m = {i} THEN customer_id END) AS a{i}" for i in range(MP.max_months + 1))},
         {", ".join(f"round(sum(CASE WHEN m >= 0 AND m <= {i} THEN rev END), 6) AS r{i}" for i in range(MP.max_months + 1))}
  FROM cells GROUP BY 1)
SELECT s.acquisition_cohort, s.cohort_size,
{cells}
FROM sizes s LEFT JOIN per p ON s.acquisition_cohort = p.acquisition_cohort"""


@register("cohort_retention", build(_cohort_sql(
    lambda i: f"CAST((coalesce(a{i}, 0) * 2000 + cohort_size) // (2 * cohort_size) AS DOUBLE) / 10.0"), "silver", "dim"))
def cohort_retention(p):
    """M7: % of cohort active in month m since acquisition; censored cells null."""
    return met.cohort_retention(p.silver, p.dim, p.cutoffs.t_test, p.mp.max_months)


@register("cohort_revenue", build(_cohort_sql(
    lambda i: f"round(coalesce(r{i}, 0.0) / cohort_size, 2)"), "silver", "dim"))
def cohort_revenue(p):
    """M8: cumulative revenue per acquired customer by month since acquisition."""
    return met.cohort_revenue(p.silver, p.dim, p.cutoffs.t_test, p.mp.max_months)


_T = tslit(CUT.t_test)


@register("rf_summary", build(f"""
SELECT customer_id, n_days - 1 AS frequency, CAST(date_diff('day', first_day, last_day) AS DOUBLE) AS recency,
       CAST(date_diff('day', first_day, DATE '{CUT.t_test:%Y-%m-%d}') AS DOUBLE) AS "T",
       round(CASE WHEN n_days > 1 THEN (total - first_spend) / (n_days - 1) ELSE 0.0 END, 6) AS monetary_value
FROM (
  SELECT customer_id, count(*) AS n_days, min(day) AS first_day, max(day) AS last_day, sum(spend) AS total,
         arg_min(spend, day) AS first_spend
  FROM (SELECT customer_id, CAST(invoice_date AS DATE) AS day, sum(revenue) AS spend FROM silver
        WHERE invoice_date <= {_T} GROUP BY 1, 2) GROUP BY 1)""", "silver"))
def rf_summary(p):
    """M9: day-grain repeat-purchase summary (frequency, recency, T, monetary)."""
    return round_doubles(met.rf_summary(p.silver, p.cutoffs.t_test))


@register("ltv_table", build("""
SELECT customer_id, round(monetary, 6) AS monetary, frequency, tenure_days, round(avg_order_value, 6) AS avg_order_value,
       round(ltv_heuristic, 6) AS ltv_heuristic, round(ltv_historical, 6) AS ltv_historical,
       round(ltv_probabilistic, 6) AS ltv_probabilistic, ltv_method FROM ltv""", "ltv"))
def ltv_table(p):
    """LTV table on the heuristic fallback path."""
    return round_doubles(p.ltv)


@register("channel_metrics", build("SELECT * FROM channel_table", "channel_table"))
def channel_metrics(p):
    """Per-channel spend, conversions, revenue, CPA, ROAS, CAC, LTV, LTV:CAC (ROAS desc)."""
    return p.channel_table.orderBy(F.col("roas").desc(), F.col("channel"))


@register("channel_segment_metrics", build(f"""
SELECT channel, segment_name AS segment, count(*) AS customers,
       round({cpa_sql('sum(cac_synthetic)', 'sum(target_conversion)')}, 2) AS cpa,
       round({roas_sql('sum(window_revenue)', 'sum(cac_synthetic)')}, 2) AS roas,
       round(avg(ltv_probabilistic), 2) AS avg_ltv
FROM channel_base b JOIN segments s ON b.customer_id = s.customer_id GROUP BY channel, segment_name""",
                                           "channel_base", "segments"))
def channel_segment_metrics(p):
    """CPA, ROAS, LTV by channel × segment."""
    return met.channel_segment_metrics(p.features_current, p.attribution, p.segments, p.ltv, p.window_rev)
