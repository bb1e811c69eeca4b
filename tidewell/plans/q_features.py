"""Registered plans: dimension, point-in-time features, label, attribution (F*, A*)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.operators import attribution as attr
from tidewell.operators import features as feat
from tidewell.plans.oracle import AP, CUT, FP, build, features_sql, hash_u, tslit
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register

FEAT_COLS = ("customer_id, recency_days, frequency, round(monetary, 6) AS monetary, product_diversity, "
             "round(avg_days_between_orders, 6) AS avg_days_between_orders, single_buyer, "
             "round(spend_trend_slope, 6) AS spend_trend_slope, tenure_days, is_uk, as_of, target_conversion")
T = tslit(CUT.t_test)


@register("dim_customers", build("SELECT * FROM dim", "dim"))
def dim_customers(p):
    """first purchase, modal country (ties → smallest), cohort."""
    return p.dim


@register("rfm", build(f"""
SELECT customer_id, date_sub('day', max(invoice_date), {T}) AS recency_days, count(DISTINCT invoice) AS frequency,
       round(sum(revenue), 6) AS monetary
FROM silver WHERE invoice_date <= {T} GROUP BY customer_id""", "silver"))
def rfm(p):
    """recency / frequency / monetary at t_test."""
    return round_doubles(feat.rfm(p.silver, p.cutoffs.t_test))


@register("product_diversity", build(f"""
SELECT customer_id, count(DISTINCT stock_code) AS product_diversity FROM silver
WHERE invoice_date <= {T} GROUP BY customer_id""", "silver"))
def product_diversity(p):
    """distinct stock codes in history."""
    return feat.product_diversity(p.silver, p.cutoffs.t_test)


@register("order_gaps", build(
    "SELECT customer_id, round(avg_days_between_orders, 6) AS avg_days_between_orders FROM features_test",
    "features_test"))
def order_gaps(p):
    """mean floored gap between consecutive invoices (month-split windows)."""
    h = feat.history(p.silver.select("customer_id", "invoice", "invoice_date"), [p.cutoffs.t_test])
    return round_doubles(feat.order_gaps(h).select("customer_id", "avg_days_between_orders"))


@register("single_buyer", build(f"""
SELECT customer_id, count(DISTINCT invoice) = 1 AS single_buyer FROM silver
WHERE invoice_date <= {T} GROUP BY customer_id""", "silver"))
def single_buyer(p):
    """exactly one invoice in history."""
    return feat.single_buyer(p.silver, p.cutoffs.t_test)


@register("spend_trend_slope", build(
    "SELECT customer_id, round(spend_trend_slope, 6) AS spend_trend_slope FROM features_test", "features_test"))
def spend_trend_slope(p):
    """OLS slope of zero-filled monthly revenue (7 points)."""
    return round_doubles(feat.spend_trend_slope(p.silver, p.dim, p.cutoffs.t_test, p.fp))


@register("tenure_days", build(f"""
SELECT a.customer_id, date_sub('day', d.first_purchase_date, {T}) AS tenure_days
FROM (SELECT DISTINCT customer_id FROM silver WHERE invoice_date <= {T}) a JOIN dim d ON a.customer_id = d.customer_id""",
                               "silver", "dim"))
def tenure_days(p):
    """whole days since the (unclipped) first purchase."""
    return feat.tenure_days(p.dim, p.silver, p.cutoffs.t_test)


@register("is_home_country", build(
    f"SELECT customer_id, country = '{FP.home_country}' AS is_uk FROM dim", "dim"))
def is_home_country(p):
    """F8: modal country equals the home-country parameter."""
    return feat.is_home_country(p.dim, p.fp.home_country)


@register("behavioral", build("""
SELECT customer_id, product_diversity, round(avg_days_between_orders, 6) AS avg_days_between_orders, single_buyer,
       round(spend_trend_slope, 6) AS spend_trend_slope, tenure_days, is_uk FROM features_test""", "features_test"))
def behavioral(p):
    """F3–F8 for customers with history."""
    return round_doubles(feat.behavioral(p.silver, p.dim, p.cutoffs.t_test, p.fp))


@register("target_conversion", build(f"""
SELECT customer_id, CAST(max(CASE WHEN invoice_date > {T} THEN 1 ELSE 0 END) AS INTEGER) AS target_conversion
FROM silver WHERE invoice_date <= {tslit(CUT.t_test + dt.timedelta(days=CUT.window_days))}
GROUP BY customer_id HAVING max(CASE WHEN invoice_date <= {T} THEN 1 ELSE 0 END) = 1""", "silver"))
def target_conversion(p):
    """purchase in (as_of, as_of + 90 days], eligible = has history."""
    return feat.target_conversion(p.silver, p.cutoffs.t_test, p.cutoffs.window_days)


@register("customer_features", build(f"SELECT {FEAT_COLS} FROM features_test", "features_test"))
def customer_features(p):
    """the full feature row at t_test (computed, not read from the mart)."""
    return round_doubles(p.features_at(p.cutoffs.t_test))


@register("feature_snapshots", build(f"SELECT {FEAT_COLS} FROM snapshots", "snapshots"))
def feature_snapshots(p):
    """all cutoffs in one job (computed from the fact mart)."""
    return round_doubles(p.snapshots_plan)


WEEKLY = [CUT.t_test - dt.timedelta(days=7 * k) for k in range(52)]


@register("feature_snapshots_weekly", build(f"SELECT {FEAT_COLS} FROM ({features_sql('silver', WEEKLY, CUT.window_days)})",
                                            "silver", "dim"))
def feature_snapshots_weekly(p):
    """F12 over a year of weekly cutoffs, by as-of look-ups in running sums."""
    from tidewell.operators.feature_grid import snapshot_grid
    return round_doubles(snapshot_grid(p.silver, p.dim, WEEKLY, p.cutoffs.window_days, p.fp))


@register("snapshot_conversion_rate", build("""
SELECT as_of, count(*) AS customers, round(avg(target_conversion), 6) AS conversion_rate
FROM snapshots GROUP BY as_of""", "snapshots"))
def snapshot_conversion_rate(p):
    """mean label per snapshot."""
    return round_doubles(feat.snapshot_conversion_rate(p.snapshots))


_leak_parts = []
for _a in CUT.distinct():
    _full = features_sql("silver", [_a], None, include_target=False)
    _tr = features_sql(f"(SELECT * FROM silver WHERE invoice_date <= {tslit(_a)})", [_a], None, include_target=False)
    _leak_parts.append(f"""
SELECT {tslit(_a)} AS as_of, count(f.customer_id) AS rows_full, count(t.customer_id) AS rows_truncated,
       count(*) FILTER (WHERE f.customer_id IS NULL OR t.customer_id IS NULL
         OR f.recency_days IS DISTINCT FROM t.recency_days OR f.frequency IS DISTINCT FROM t.frequency
         OR round(f.monetary, 6) IS DISTINCT FROM round(t.monetary, 6)
         OR f.product_diversity IS DISTINCT FROM t.product_diversity
         OR round(f.avg_days_between_orders, 6) IS DISTINCT FROM round(t.avg_days_between_orders, 6)
         OR f.single_buyer IS DISTINCT FROM t.single_buyer
         OR round(f.spend_trend_slope, 6) IS DISTINCT FROM round(t.spend_trend_slope, 6)
         OR f.tenure_days IS DISTINCT FROM t.tenure_days OR f.is_uk IS DISTINCT FROM t.is_uk) AS mismatched_rows
FROM ({_full}) f FULL OUTER JOIN ({_tr}) t ON f.customer_id = t.customer_id""")


@register("leakage_audit", build(" UNION ALL ".join(_leak_parts), "silver", "dim"))
def leakage_audit(p):
    """features from full vs truncated fact must agree at every cutoff."""
    return feat.leakage_audit(p.silver, p.dim, p.cutoffs.distinct(), p.fp)


# ---------------------------------------------------------------- attribution
@register("high_value_flag", build(f"""
SELECT customer_id, round(monetary, 6) AS monetary,
       monetary >= (SELECT quantile_cont(monetary, {AP.high_value_percentile / 100.0!r}) FROM features_current) AS is_high_value
FROM features_current""", "features_current"))
def high_value_flag(p):
    """A1: monetary at or above the exact 75th percentile."""
    return round_doubles(attr.high_value_flag(p.features_current.select("customer_id", "monetary"), p.ap))


@register("channel_assignment", build("SELECT customer_id, channel FROM attribution", "attribution"))
def channel_assignment(p):
    """A2: inverse-CDF channel draw from a hashed uniform."""
    return p.attribution.select("customer_id", "channel")


@register("acquisition_cost", build(
    "SELECT customer_id, channel, round(cac_synthetic, 6) AS cac_synthetic FROM attribution", "attribution"))
def acquisition_cost(p):
    """A3: lognormal acquisition cost by channel."""
    return round_doubles(p.attribution.select("customer_id", "channel", "cac_synthetic"))


@register("campaign_exposed", build("SELECT customer_id, exposed FROM attribution", "attribution"))
def campaign_exposed(p):
    """A4: exposure flag, independent of everything else."""
    return p.attribution.select("customer_id", "exposed")


@register("attribution_mix", build("""
SELECT channel, count(*) AS customers, round(count(*) / (SELECT count(*) FROM attribution), 3) AS share,
       round(avg(CAST(exposed AS DOUBLE)), 6) AS exposed_rate,
       round((SELECT avg(CAST(exposed AS DOUBLE)) FROM attribution), 6) AS overall_exposed_rate
FROM attribution GROUP BY channel""", "attribution"))
def attribution_mix(p):
    """A5: channel shares and exposure rate."""
    return round_doubles(attr.attribution_mix(p.attribution))
