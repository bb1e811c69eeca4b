"""Media metrics, lifetime value and cohort matrices.

Ratios use explicit zero-denominator rules (ANSI division raises).  Cohort
matrices never build a cohort × month spine: the fact is first reduced to one
row per (customer, month) — partial aggregation map-side, so a heavy
customer costs nothing extra — then joined to the customer dimension, and
each M0..Mn cell is a conditional aggregate per cohort.  Censoring (cells
past the observation month) is an expression on the cohort's month index.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.ratios import round_half

from tidewell.functions.ratios import cpa, ltv_cac, money_sum, roas
from tidewell.functions.timecols import as_ts, month_index
from tidewell.params import MetricsParams


def ltv_heuristic(features: DataFrame, params: MetricsParams = MetricsParams()) -> DataFrame:
    """AOV × annual frequency × margin × horizon years (M4);
    annual frequency = frequency / (max(tenure_days, 1) / 365.25)."""
    aov = F.col("monetary") / F.col("frequency")
    annual = F.col("frequency") / (F.greatest(F.col("tenure_days"), F.lit(1)) / F.lit(365.25))
    years = params.ltv_horizon_months / 12.0
    return features.select("customer_id", "monetary", "frequency", "tenure_days",
                           aov.alias("avg_order_value"),
                           (aov * annual * F.lit(params.gross_margin) * F.lit(years)).alias("ltv_heuristic"))


def window_revenue(fact: DataFrame, as_of: dt.datetime, window_days: int) -> DataFrame:
    """Realised revenue per customer in (as_of, as_of + window] — reporting only (M5)."""
    horizon = as_of + dt.timedelta(days=window_days)
    if "month" in fact.columns:  # month-partitioned fact: prune to the window's months
        fact = fact.filter(F.col("month").between(as_of.year * 100 + as_of.month, horizon.year * 100 + horizon.month))
    return (fact.filter((F.col("invoice_date") > as_ts(as_of)) & (F.col("invoice_date") <= as_ts(horizon)))
            .groupBy("customer_id").agg(F.sum("revenue").alias("window_revenue")))


def _cohort_index(cohort: Column) -> Column:
    return F.substring(cohort, 1, 4).cast("int") * 12 + F.substring(cohort, 6, 2).cast("int") - 1


def cohort_month_index(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Transactions with months since the customer's acquisition cohort (M6)."""
    d = dim.select("customer_id", "acquisition_cohort")
    return (fact.select("customer_id", "invoice_date", "revenue").join(d, "customer_id")
            .withColumn("months_since_acquisition",
                        (month_index("invoice_date") - _cohort_index(F.col("acquisition_cohort"))).cast("bigint")))


def _cohort_cells(fact: DataFrame, dim: DataFrame) -> DataFrame:
    monthly = (fact.groupBy("customer_id", month_index("invoice_date").alias("m_idx"))
               .agg(money_sum("revenue").alias("rev")))
    return (monthly.join(dim.select("customer_id", "acquisition_cohort"), "customer_id")
            .withColumn("m", F.col("m_idx") - _cohort_index(F.col("acquisition_cohort"))))


def _cohort_frame(fact: DataFrame, dim: DataFrame, observed_through: dt.datetime, max_months: int,
                  cell) -> DataFrame:
    # dim is one row per customer (contract K3), so a plain count is the distinct count
    sizes = dim.groupBy("acquisition_cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    cells = _cohort_cells(fact, dim).filter((F.col("m") >= 0) & (F.col("m") <= max_months))
    per = cells.groupBy("acquisition_cohort").agg(
        *[F.count(F.when(F.col("m") == i, F.lit(1))).alias(f"_a{i}") for i in range(max_months + 1)],
        *[money_sum(F.when(F.col("m") <= i, F.col("rev"))).alias(f"_r{i}") for i in range(max_months + 1)])
    obs = observed_through.year * 12 + observed_through.month - 1
    j = sizes.join(per, "acquisition_cohort", "left").orderBy("acquisition_cohort")
    max_obs = F.lit(obs) - _cohort_index(F.col("acquisition_cohort"))
    return j.select("acquisition_cohort", "cohort_size", *[
        F.when(F.lit(i) > max_obs, F.lit(None).cast("double")).otherwise(cell(i)).alias(f"M{i}")
        for i in range(max_months + 1)])


def cohort_retention(fact: DataFrame, dim: DataFrame, observed_through: dt.datetime,
                     max_months: int = 6) -> DataFrame:
    """% of each cohort with an order in month m since acquisition, 1 dp (M7).
    Rounding is half-up on the exact ratio (integer arithmetic)."""
    def cell(i):
        a = F.coalesce(F.col(f"_a{i}"), F.lit(0)).cast("bigint")
        n = F.col("cohort_size")
        return (((a * 2000 + n) / (n * 2)).cast("bigint") / F.lit(10.0))
    return _cohort_frame(fact, dim, observed_through, max_months, cell)


def cohort_revenue(fact: DataFrame, dim: DataFrame, observed_through: dt.datetime,
                   max_months: int = 6) -> DataFrame:
    """Cumulative revenue per acquired customer by month, 2 dp (M8)."""
    def cell(i):
        return round_half(F.coalesce(F.col(f"_r{i}"), F.lit(0.0)) / F.col("cohort_size"), 2)
    return _cohort_frame(fact, dim, observed_through, max_months, cell)


def rf_summary(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Day-grain repeat-purchase summary (M9): frequency = purchase days − 1,
    recency = first→last purchase day, T = first purchase day→as_of day,
    monetary = mean daily spend excluding the first day (0 if none)."""
    from tidewell.operators.features import until
    daily = (until(fact, as_of)
             .groupBy("customer_id", F.to_date("invoice_date").alias("day"))
             .agg(F.sum("revenue").alias("spend")))
    per = daily.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.sum("spend").alias("total"), F.min_by("spend", "day").alias("first_spend"))
    freq = F.col("n_days") - 1
    return per.select(
        "customer_id", freq.alias("frequency"),
        F.datediff("last_day", "first_day").cast("double").alias("recency"),
        F.datediff(F.lit(as_of.date()), "first_day").cast("double").alias("T"),
        F.when(freq > 0, (F.col("total") - F.col("first_spend")) / freq).otherwise(F.lit(0.0)).alias("monetary_value"))


def ltv_table(features: DataFrame, probabilistic: DataFrame | None = None,
              params: MetricsParams = MetricsParams()) -> DataFrame:
    """customer LTV: heuristic for all, historical = monetary, probabilistic from
    the fitted model where available else the heuristic (M13)."""
    h = ltv_heuristic(features, params)
    if probabilistic is None:
        return h.select("customer_id", "monetary", "frequency", "tenure_days", "avg_order_value",
                        "ltv_heuristic", F.col("monetary").alias("ltv_historical"),
                        F.col("ltv_heuristic").alias("ltv_probabilistic"),
                        F.lit("heuristic_fallback").alias("ltv_method"))
    j = h.join(probabilistic.select("customer_id", F.col("ltv_probabilistic").alias("_p")), "customer_id", "left")
    return j.select("customer_id", "monetary", "frequency", "tenure_days", "avg_order_value", "ltv_heuristic",
                    F.col("monetary").alias("ltv_historical"),
                    F.coalesce(F.col("_p"), F.col("ltv_heuristic")).alias("ltv_probabilistic"),
                    F.lit("bgnbd_gamma_gamma").alias("ltv_method"))


def _channel_base(features: DataFrame, attribution: DataFrame, ltv: DataFrame, window_rev: DataFrame,
                  segments: DataFrame | None = None) -> DataFrame:
    df = (features.select("customer_id", "target_conversion")
          .join(attribution.select("customer_id", "channel", "cac_synthetic"), "customer_id")
          .join(ltv.select("customer_id", "ltv_probabilistic"), "customer_id"))
    if segments is not None:
        df = df.join(segments.select("customer_id", "segment_name"), "customer_id")
    return (df.join(window_rev, "customer_id", "left")
            .withColumn("window_revenue", F.coalesce(F.col("window_revenue"), F.lit(0.0))))


def channel_metrics(features: DataFrame, attribution: DataFrame, ltv: DataFrame,
                    window_rev: DataFrame) -> DataFrame:
    """Per channel: customers, spend, conversions, revenue, CPA, ROAS, avg CAC,
    avg LTV, LTV:CAC — ratios from unrounded inputs, then 2 dp (M14)."""
    g = _channel_base(features, attribution, ltv, window_rev).groupBy("channel").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("cac_synthetic").alias("cost"),
        F.sum("target_conversion").cast("bigint").alias("conversions"),
        F.sum("window_revenue").alias("rev"), F.avg("ltv_probabilistic").alias("ltv"),
        F.avg("cac_synthetic").alias("cac"))
    return g.select(
        "channel", "customers", round_half("cost", 2).alias("spend_synthetic"), "conversions",
        round_half("rev", 2).alias("revenue"), round_half(cpa("cost", "conversions"), 2).alias("cpa"),
        round_half(roas("rev", "cost"), 2).alias("roas"), round_half("cac", 2).alias("avg_cac"),
        round_half("ltv", 2).alias("avg_ltv"), round_half(ltv_cac("ltv", "cac"), 2).alias("ltv_cac"))


def channel_segment_metrics(features: DataFrame, attribution: DataFrame, segments: DataFrame,
                            ltv: DataFrame, window_rev: DataFrame) -> DataFrame:
    """Per (channel, segment): customers, CPA, ROAS, avg LTV."""
    g = _channel_base(features, attribution, ltv, window_rev, segments).groupBy("channel", "segment_name").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("cac_synthetic").alias("cost"),
        F.sum("target_conversion").alias("conversions"), F.sum("window_revenue").alias("rev"),
        F.avg("ltv_probabilistic").alias("ltv"))
    return g.select("channel", F.col("segment_name").alias("segment"), "customers",
                    round_half(cpa("cost", "conversions"), 2).alias("cpa"),
                    round_half(roas("rev", "cost"), 2).alias("roas"), round_half("ltv", 2).alias("avg_ltv"))
