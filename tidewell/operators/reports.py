"""Reporting queries behind the dashboards."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.ratios import round_half

from tidewell.operators import evaluation as ev

# Display labels for channels (fixed values).
CHANNEL_LABELS = {"paid_search": "Paid Search", "paid_social": "Paid Social", "email": "Email", "display": "Display"}
SCORE_BANDS = ((0.0, 0.3, "0-0.3"), (0.3, 0.5, "0.3-0.5"), (0.5, 0.7, "0.5-0.7"), (0.7, 1.01, "0.7-1.0"))


def kpi_overview(fact: DataFrame, dim: DataFrame, features_test: DataFrame, channel_table: DataFrame,
                 ltv: DataFrame) -> DataFrame:
    """Headline KPIs as one row of scalar subqueries."""
    spend = channel_table.agg(F.sum("spend_synthetic")).scalar()
    conv = channel_table.agg(F.sum("conversions")).scalar()
    rev = channel_table.agg(F.sum("revenue")).scalar()
    return fact.agg(F.sum("revenue").alias("total_revenue")).select(
        "total_revenue",
        dim.agg(F.count(F.lit(1))).scalar().alias("active_customers"),
        features_test.agg(F.avg("target_conversion")).scalar().alias("conversion_rate"),
        F.when(conv == 0, F.lit(float("inf"))).otherwise(spend / conv).alias("blended_cpa"),
        F.when(spend == 0, F.lit(float("inf"))).otherwise(rev / spend).alias("blended_roas"),
        ltv.agg(F.avg("ltv_probabilistic")).scalar().alias("avg_ltv"))


def layer_row_counts(report: DataFrame, fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows per medallion layer."""
    r = report.filter(F.col("rule_order") == 0)
    bronze = r.select(F.lit("bronze").alias("layer"), F.col("rows_raw").alias("rows"))
    silver = r.select(F.lit("silver").alias("layer"), F.col("rows_silver").alias("rows"))
    f = fact.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("fact_transactions").alias("layer"), "rows")
    d = dim.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("dim_customers").alias("layer"), "rows")
    return bronze.unionByName(silver).unionByName(f).unionByName(d)


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by calendar month (D3)."""
    return fact.groupBy(F.date_trunc("month", "invoice_date").alias("month")).agg(F.sum("revenue").alias("revenue"))


def revenue_share_country(fact: DataFrame, top: int = 5) -> DataFrame:
    """Top countries by revenue plus "Other", as % of total.
    The ranking window runs over one row per country (bounded by geography)."""
    by = fact.groupBy("country").agg(F.sum("revenue").alias("revenue"))
    ranked = by.withColumn("_rn", F.row_number().over(Window.orderBy(F.col("revenue").desc(), F.col("country"))))
    total = by.agg(F.sum("revenue")).scalar()
    lab = F.when(F.col("_rn") <= top, F.col("country")).otherwise(F.lit("Other"))
    return ranked.groupBy(lab.alias("country")).agg(F.sum("revenue").alias("revenue")) \
        .withColumn("pct", F.lit(100.0) * F.col("revenue") / total)


def activation_funnel(features_test: DataFrame, scores: DataFrame, attribution: DataFrame,
                      threshold: float = 0.6, score_col: str = "score") -> DataFrame:
    """Nested stages counted in one aggregate, then unpivoted."""
    s = features_test.select("customer_id", "target_conversion") \
        .join(scores.select("customer_id", score_col), "customer_id") \
        .join(attribution.select("customer_id", "exposed"), "customer_id")
    conv = F.col("target_conversion") == 1
    hi = conv & (F.col(score_col) > threshold)
    agg = s.agg(F.count(F.lit(1)).alias("s1"), F.count_if(conv).alias("s2"), F.count_if(hi).alias("s3"),
                F.count_if(hi & F.col("exposed")).alias("s4"))
    return agg.selectExpr("stack(4, 1, 'all_customers', s1, 2, 'converted', s2, 3, 'high_score', s3, "
                          "4, 'exposed', s4) AS (stage, name, customers)")


def score_distribution(scores: DataFrame, score_col: str = "score") -> DataFrame:
    """Counts in four left-closed score bands, empty bands included."""
    spark = scores.sparkSession
    bands = spark.createDataFrame([(i, lab) for i, (_, _, lab) in enumerate(SCORE_BANDS)], "band int, label string")
    p = F.col(score_col)
    b = F.lit(None).cast("int")
    for i, (lo, hi, _) in reversed(list(enumerate(SCORE_BANDS))):
        b = F.when((p >= lo) & (p < hi), F.lit(i)).otherwise(b)
    cnt = scores.groupBy(b.alias("band")).agg(F.count(F.lit(1)).alias("customers"))
    return F.broadcast(bands).join(cnt, "band", "left").select(
        "band", "label", F.coalesce(F.col("customers"), F.lit(0)).alias("customers"))


def score_histogram(scores: DataFrame, bins: int = 20, score_col: str = "score") -> DataFrame:
    """Equal-width histogram of scores on [0, 1]."""
    b = F.least(F.floor(F.col(score_col) * bins), F.lit(bins - 1)).cast("int")
    return scores.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))


def top_audience(scores: DataFrame, segments: DataFrame, n: int = 500, segment: str | None = None,
                 score_col: str = "score") -> DataFrame:
    """Top-n customers by score (ties by id), with segment; the optional segment
    filter applies after the cut (D7).  The limit is the feature: Spark runs
    it as a distributed top-k (TakeOrderedAndProject)."""
    top = scores.select("customer_id", score_col).orderBy(F.col(score_col).desc(), F.col("customer_id")).limit(n)
    out = top.join(segments.select("customer_id", "segment_name"), "customer_id", "left")
    if segment is not None:
        out = out.filter(F.col("segment_name") == segment)
    return out


def segment_scatter(features: DataFrame, segments: DataFrame, pct: float = 0.98) -> DataFrame:
    """Monetary clipped at its per-segment exact percentile, √-scaled marker size."""
    j = features.select("customer_id", "recency_days", "frequency", "monetary") \
        .join(segments.select("customer_id", "segment_name"), "customer_id")
    from tidewell.operators.quantiles import grouped_percentiles
    caps = grouped_percentiles(j, "monetary", [pct], ["segment_name"]).withColumnRenamed("q0", "_cap")
    j = j.join(caps, "segment_name")
    return j.select("customer_id", "segment_name", "recency_days", "frequency", "monetary",
                    (F.sqrt(F.least(F.col("monetary"), F.col("_cap"))) / 3 + 5).alias("marker_size"))


def segment_mix(profile: DataFrame) -> DataFrame:
    """Size and share of base by segment, largest first, and the top segment."""
    w = Window.orderBy(F.col("size").desc(), F.col("segment_name"))
    return profile.select("segment_name", "size", "pct_of_base").withColumn(
        "is_top", F.row_number().over(w) == 1).orderBy(F.col("size").desc(), F.col("segment_name"))


def segment_profile_display(profile: DataFrame) -> DataFrame:
    """Rounded display projection: shares in % (1 dp), money and days 0 dp."""
    return profile.select(
        "segment_name", "size", round_half(F.col("pct_of_base") * 100, 1).alias("pct_of_base"),
        round_half("recency_days", 0).alias("recency_days"), round_half("frequency", 0).alias("frequency"),
        round_half("monetary", 0).alias("monetary"), round_half("avg_order_value", 0).alias("avg_order_value"),
        round_half(F.col("conversion_rate") * 100, 1).alias("conversion_rate"), "recommended_action")


def best_channel(channel_table: DataFrame) -> DataFrame:
    """Best channel by ROAS and by LTV:CAC, display label, share of spend."""
    lab = F.lit(None).cast("string")
    for k, v in reversed(list(CHANNEL_LABELS.items())):
        lab = F.when(F.col("channel") == k, F.lit(v)).otherwise(lab)
    total = channel_table.agg(F.sum("spend_synthetic")).scalar()
    t = channel_table.select("channel", lab.alias("channel_label"), "roas", "ltv_cac",
                             (F.col("spend_synthetic") / total).alias("spend_share"))
    by_roas = F.struct("roas", "channel")
    return t.agg(F.max_by("channel", by_roas).alias("best_roas_channel"),
                 F.max_by("channel_label", by_roas).alias("best_roas_label"),
                 F.max_by("channel", F.struct("ltv_cac", "channel")).alias("best_ltv_cac_channel"),
                 F.max_by("spend_share", by_roas).alias("best_roas_spend_share"))


def model_comparison(long_scores: DataFrame, baseline: str = "baseline") -> DataFrame:
    """AUC, AP and Brier of every model from one long (model, customer, score,
    label) frame, plus deltas to the baseline model (D12).  The three read the
    scores once stored: rows are scored by hundreds of trees."""
    g = ("model",)
    scored = long_scores.select("model", "score", "label").cache()
    m = ev.roc_auc(scored, "score", "label", g).join(
        ev.average_precision(scored, "score", "label", g), "model").join(
        ev.brier_score(scored, "score", "label", g), "model")
    base = m.filter(F.col("model") == baseline)
    return m.select("model", "roc_auc", "average_precision", "brier",
                    (F.col("roc_auc") - base.select("roc_auc").scalar()).alias("delta_roc_auc"),
                    (F.col("average_precision") - base.select("average_precision").scalar()).alias("delta_average_precision"),
                    (F.col("brier") - base.select("brier").scalar()).alias("delta_brier"))
