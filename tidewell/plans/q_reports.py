"""Registered plans: dashboard reporting queries (D*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import reports as rep
from tidewell.plans.oracle import build, cte, q
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register


@register("kpi_overview", build("""
SELECT round((SELECT sum(revenue) FROM silver), 2) AS total_revenue,
       (SELECT count(*) FROM dim) AS active_customers,
       round((SELECT avg(target_conversion) FROM features_test), 6) AS conversion_rate,
       round((SELECT sum(spend_synthetic) / sum(conversions) FROM channel_table), 6) AS blended_cpa,
       round((SELECT sum(revenue) / sum(spend_synthetic) FROM channel_table), 6) AS blended_roas,
       round((SELECT avg(ltv_probabilistic) FROM ltv), 6) AS avg_ltv""",
                                "silver", "dim", "features_test", "channel_table", "ltv"))
def kpi_overview(p):
    """Revenue, customers, conversion rate, blended CPA / ROAS, mean LTV."""
    k = rep.kpi_overview(p.silver, p.dim, p.features_test, p.channel_table, p.ltv)
    from tidewell.functions.ratios import round_half
    return round_doubles(k.withColumn("total_revenue", round_half("total_revenue", 2)))


@register("layer_row_counts", build("""
SELECT 'bronze' AS layer, (SELECT count(*) FROM bronze) AS rows
UNION ALL SELECT 'silver', (SELECT count(*) FROM silver)
UNION ALL SELECT 'fact_transactions', (SELECT count(*) FROM silver)
UNION ALL SELECT 'dim_customers', (SELECT count(*) FROM dim)""", "bronze", "silver", "dim"))
def layer_row_counts(p):
    """Rows per medallion layer."""
    return rep.layer_row_counts(p.silver_dq, p.silver, p.dim)


@register("monthly_revenue", build("""
SELECT date_trunc('month', invoice_date) AS month, round(sum(revenue), 2) AS revenue FROM silver GROUP BY 1""",
                                   "silver"))
def monthly_revenue(p):
    """D3: revenue by calendar month."""
    from tidewell.functions.ratios import round_half
    m = rep.monthly_revenue(p.silver)
    return m.select(F.col("month").cast("timestamp_ntz").alias("month"), round_half("revenue", 2).alias("revenue"))


@register("revenue_share_country", build("""
SELECT country, round(sum(revenue), 2) AS revenue, round(100.0 * sum(revenue) / (SELECT sum(revenue) FROM silver), 6) AS pct
FROM (SELECT CASE WHEN rn <= 5 THEN country ELSE 'Other' END AS country, revenue
      FROM (SELECT country, revenue, row_number() OVER (ORDER BY revenue DESC, country) AS rn
            FROM (SELECT country, sum(revenue) AS revenue FROM silver GROUP BY 1)))
GROUP BY 1""", "silver"))
def revenue_share_country(p):
    """Top five countries by revenue plus Other, % of total."""
    from tidewell.functions.ratios import round_half
    r = rep.revenue_share_country(p.silver)
    return r.select("country", round_half("revenue", 2).alias("revenue"), round_half("pct", 6).alias("pct"))


cte("funnel_base", ("features_test", "scores", "attribution"), """
SELECT f.customer_id, f.target_conversion, s.score, a.exposed FROM features_test f
JOIN scores s ON f.customer_id = s.customer_id JOIN attribution a ON f.customer_id = a.customer_id""")
_funnel_sql = build("""
SELECT v.stage, v.name, c.customers FROM (VALUES (1, 'all_customers'), (2, 'converted'), (3, 'high_score'), (4, 'exposed')) v(stage, name)
JOIN (
  SELECT 1 AS stage, count(*) AS customers FROM funnel_base
  UNION ALL SELECT 2, count(*) FILTER (WHERE target_conversion = 1) FROM funnel_base
  UNION ALL SELECT 3, count(*) FILTER (WHERE target_conversion = 1 AND score > 0.6) FROM funnel_base
  UNION ALL SELECT 4, count(*) FILTER (WHERE target_conversion = 1 AND score > 0.6 AND exposed) FROM funnel_base) c
ON v.stage = c.stage""", "funnel_base")


@register("activation_funnel", _funnel_sql)
def activation_funnel(p):
    """Nested activation stages."""
    return rep.activation_funnel(p.features_test, p.scores, p.attribution)


_bands = " ".join(f"WHEN score >= {lo} AND score < {hi} THEN {i}" for i, (lo, hi, _) in enumerate(rep.SCORE_BANDS))
_labels = " UNION ALL ".join(f"SELECT {i} AS band, {q(lab)} AS label" for i, (_, _, lab) in enumerate(rep.SCORE_BANDS))


@register("score_distribution", build(f"""
SELECT b.band, b.label, coalesce(c.customers, 0) AS customers FROM ({_labels}) b
LEFT JOIN (SELECT CASE {_bands} END AS band, count(*) AS customers FROM scores GROUP BY 1) c ON b.band = c.band""",
                                      "scores"))
def score_distribution(p):
    """Customers per score band, empty bands included."""
    return rep.score_distribution(p.scores)


@register("score_histogram", build("""
SELECT CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS customers FROM scores GROUP BY 1""", "scores"))
def score_histogram(p):
    """20-bin score histogram."""
    return rep.score_histogram(p.scores)


@register("top_audience", build("""
SELECT t.customer_id, t.score, s.segment_name FROM (
  SELECT customer_id, score FROM scores ORDER BY score DESC, customer_id LIMIT 500) t
LEFT JOIN segments s ON t.customer_id = s.customer_id""", "scores", "segments"))
def top_audience(p):
    """Top-500 audience by score with its segment."""
    return rep.top_audience(p.scores, p.segments)


@register("segment_scatter", build("""
SELECT j.customer_id, j.segment_name, j.recency_days, j.frequency, round(j.monetary, 6) AS monetary,
       round(sqrt(least(j.monetary, c.cap)) / 3 + 5, 6) AS marker_size
FROM (SELECT f.*, s.segment_name FROM features_current f JOIN segments s ON f.customer_id = s.customer_id) j
JOIN (SELECT s.segment_name, quantile_cont(f.monetary, 0.98) AS cap FROM features_current f
      JOIN segments s ON f.customer_id = s.customer_id GROUP BY 1) c ON j.segment_name = c.segment_name""",
                                   "features_current", "segments"))
def segment_scatter(p):
    """Per-segment p98-clipped, √-scaled monetary marker."""
    return round_doubles(rep.segment_scatter(p.features_current, p.segments))


@register("segment_mix", build("""
SELECT segment_name, size, round(pct_of_base, 6) AS pct_of_base,
       row_number() OVER (ORDER BY size DESC, segment_name) = 1 AS is_top FROM profile""", "profile"))
def segment_mix(p):
    """Segment sizes and shares, top segment flagged."""
    return round_doubles(rep.segment_mix(p.profile))


@register("segment_profile_display", build("""
SELECT segment_name, size, round(pct_of_base * 100, 1) AS pct_of_base, round(recency_days, 0) AS recency_days,
       round(frequency, 0) AS frequency, round(monetary, 0) AS monetary, round(avg_order_value, 0) AS avg_order_value,
       round(conversion_rate * 100, 1) AS conversion_rate, recommended_action FROM profile""", "profile"))
def segment_profile_display(p):
    """Rounded display projection of the segment profiles."""
    return rep.segment_profile_display(p.profile)


_lab = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in rep.CHANNEL_LABELS.items())


@register("best_channel", build(f"""
SELECT (SELECT channel FROM channel_table ORDER BY roas DESC, channel DESC LIMIT 1) AS best_roas_channel,
       (SELECT CASE channel {_lab} END FROM channel_table ORDER BY roas DESC, channel DESC LIMIT 1) AS best_roas_label,
       (SELECT channel FROM channel_table ORDER BY ltv_cac DESC, channel DESC LIMIT 1) AS best_ltv_cac_channel,
       round((SELECT spend_synthetic FROM channel_table ORDER BY roas DESC, channel DESC LIMIT 1)
             / (SELECT sum(spend_synthetic) FROM channel_table), 6) AS best_roas_spend_share""", "channel_table"))
def best_channel(p):
    """Best channel by ROAS and by LTV:CAC, with label and spend share."""
    return round_doubles(rep.best_channel(p.channel_table))


cte("long_scores", ("features_test",), """
SELECT 'baseline' AS model, customer_id, target_conversion AS label,
       CAST(least(greatest(50 + 60 * frequency - 2 * recency_days, 10), 990) AS DOUBLE) / 1000.0 AS score FROM features_test
UNION ALL SELECT 'recency_only', customer_id, target_conversion,
       CAST(least(greatest(990 - 3 * recency_days, 10), 990) AS DOUBLE) / 1000.0 FROM features_test
UNION ALL SELECT 'frequency_only', customer_id, target_conversion,
       CAST(least(greatest(40 * frequency, 10), 990) AS DOUBLE) / 1000.0 FROM features_test""")


def long_scores(p):
    f = p.features_test

    def clamp(e):
        return (F.least(F.greatest(e, F.lit(10)), F.lit(990)).cast("double") / F.lit(1000.0)).alias("score")
    r, fr = F.col("recency_days"), F.col("frequency")
    base = [F.col("customer_id"), F.col("target_conversion").alias("label")]
    return (f.select(F.lit("baseline").alias("model"), *base, clamp(F.lit(50) + F.lit(60) * fr - F.lit(2) * r))
            .unionByName(f.select(F.lit("recency_only").alias("model"), *base, clamp(F.lit(990) - F.lit(3) * r)))
            .unionByName(f.select(F.lit("frequency_only").alias("model"), *base, clamp(F.lit(40) * fr))))


@register("model_comparison", build("""
SELECT model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision, round(brier, 6) AS brier,
       round(roc_auc - max(CASE WHEN model = 'baseline' THEN roc_auc END) OVER (), 6) AS delta_roc_auc,
       round(average_precision - max(CASE WHEN model = 'baseline' THEN average_precision END) OVER (), 6)
         AS delta_average_precision,
       round(brier - max(CASE WHEN model = 'baseline' THEN brier END) OVER (), 6) AS delta_brier
FROM (
  SELECT a.model, a.roc_auc, b.average_precision, c.brier FROM
    (SELECT model, sum(n_pos * (cum_neg - n_neg + 0.5 * n_neg)) / (sum(n_pos) * sum(n_neg)) AS roc_auc FROM (
       SELECT *, sum(n_neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg
       FROM (SELECT model, score, sum(label) AS n_pos, sum(1 - label) AS n_neg FROM long_scores GROUP BY 1, 2))
     GROUP BY model) a
  JOIN (SELECT model, sum(n_pos * cum_tp / (cum_tp + cum_fp)) / sum(n_pos) AS average_precision FROM (
       SELECT *, sum(n_pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_tp,
                 sum(n_neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_fp
       FROM (SELECT model, score, sum(label) AS n_pos, sum(1 - label) AS n_neg FROM long_scores GROUP BY 1, 2))
     GROUP BY model) b ON a.model = b.model
  JOIN (SELECT model, avg(pow(score - label, 2)) AS brier FROM long_scores GROUP BY model) c ON a.model = c.model)""",
                                    "long_scores"))
def model_comparison(p):
    """AUC / AP / Brier of several models from one long frame, deltas to baseline."""
    return round_doubles(rep.model_comparison(long_scores(p)))
