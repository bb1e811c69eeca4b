"""Registered plans: evaluation, segmentation and propensity preparation
(P*, U*, G*).  SQL-checked plans run on deterministic reference scores and
labels derived from the tables; model-fitting plans are registered in
q_fits (rows-only checks)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import evaluation as ev
from tidewell.operators import propensity as prop
from tidewell.operators import segmentation as seg
from tidewell.params import FEATURE_COLUMNS
from tidewell.plans.oracle import INF_SQL, build, cte
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register

# ---------------------------------------------------------------- evaluation (given scores)
cte("score_table", ("scores",), "SELECT score, sum(label) AS n_pos, sum(1 - label) AS n_neg FROM scores GROUP BY score")


@register("roc_auc", build("""
SELECT round(sum(n_pos * (cum_neg - n_neg + 0.5 * n_neg)) / (sum(n_pos) * sum(n_neg)), 6) AS roc_auc
FROM (SELECT *, sum(n_neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM score_table)""",
                           "score_table"))
def roc_auc(p):
    """Rank AUC with ties counted ½."""
    return round_doubles(ev.roc_auc(p.scores))


@register("average_precision", build("""
SELECT round(sum(n_pos * cum_tp / (cum_tp + cum_fp)) / sum(n_pos), 6) AS average_precision
FROM (SELECT *, sum(n_pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_tp,
             sum(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_fp FROM score_table)""",
                                     "score_table"))
def average_precision(p):
    """Step-sum average precision."""
    return round_doubles(ev.average_precision(p.scores))


@register("brier_score", build("SELECT round(avg(pow(score - label, 2)), 6) AS brier FROM scores", "scores"))
def brier_score(p):
    """P10: mean squared probability error."""
    return round_doubles(ev.brier_score(p.scores))


@register("roc_curve", build(f"""
SELECT {INF_SQL} AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT score, cum_fp / N, cum_tp / P FROM (
  SELECT *, lead(n_pos) OVER (ORDER BY score DESC) AS next_pos, lead(n_neg) OVER (ORDER BY score DESC) AS next_neg,
         sum(n_pos) OVER () AS P, sum(n_neg) OVER () AS N, count(*) OVER () AS K
  FROM (SELECT *, row_number() OVER (ORDER BY score DESC) AS pos,
               sum(n_pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_tp,
               sum(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_fp FROM score_table))
WHERE pos = 1 OR pos = K OR n_pos <> next_pos OR n_neg <> next_neg""", "score_table"))
def roc_curve(p):
    """ROC points per distinct score, collinear points dropped."""
    return ev.roc_curve(p.scores)


_edges = " + ".join(f"CASE WHEN score > {e!r} THEN 1 ELSE 0 END" for e in ev.CALIBRATION_EDGES)


@register("calibration_curve", build(f"""
SELECT ({_edges}) AS bin, count(*) AS n, round(avg(score), 6) AS mean_predicted, round(avg(label), 6) AS observed_rate
FROM scores GROUP BY 1""", "scores"))
def calibration_curve(p):
    """Ten uniform right-closed bins, empty bins absent."""
    return round_doubles(ev.calibration_curve(p.scores))


# ---------------------------------------------------------------- uplift (given uplift scores)
cte("qini", ("uplift_frame",), """
SELECT point, n AS n_customers, pct_targeted, incremental_conversions,
       pct_targeted / 100.0 * max(CASE WHEN point = 20 THEN incremental_conversions END) OVER () AS random_reference
FROM (
  SELECT c.point, c.n,
         CASE WHEN c.point = 0 THEN 0.0 ELSE CAST((2000 * c.pos + c.n) // (2 * c.n) AS DOUBLE) / 10.0 END AS pct_targeted,
         CASE WHEN c.point = 0 THEN 0.0
              ELSE coalesce(r.cum_yt - r.cum_yc * (r.cum_nt / greatest(r.cum_nc, 1)), 0.0) END AS incremental_conversions
  FROM (SELECT point, n, (n * point) // 20 AS pos
        FROM (SELECT count(*) AS n FROM uplift_frame WHERE is_test), range(0, 21) t(point)) c
  LEFT JOIN (
    SELECT row_number() OVER w AS pos,
           sum(label * CAST(treated AS INTEGER)) OVER w AS cum_yt,
           sum(label * (1 - CAST(treated AS INTEGER))) OVER w AS cum_yc,
           sum(CAST(treated AS INTEGER)) OVER w AS cum_nt,
           sum(1 - CAST(treated AS INTEGER)) OVER w AS cum_nc
    FROM uplift_frame WHERE is_test
    WINDOW w AS (ORDER BY uplift DESC, customer_id ROWS UNBOUNDED PRECEDING)) r ON c.pos = r.pos)""")


@register("stratified_split", build("SELECT customer_id, label, treated, is_test FROM uplift_frame", "uplift_frame"))
def stratified_split(p):
    """70/30 split, exact per-stratum sizes from hashed order."""
    return p.uplift_frame.select("customer_id", "label", "treated", "is_test")


@register("qini_curve", build("""
SELECT point, n_customers, pct_targeted, round(incremental_conversions, 6) AS incremental_conversions,
       round(random_reference, 6) AS random_reference FROM qini""", "qini"))
def qini_curve(p):
    """Qini curve over 20 cuts of the uplift ranking."""
    t = p.uplift_frame.filter("is_test")
    return round_doubles(ev.qini_curve(t))


@register("qini_coefficient", build("""
SELECT round((coalesce(sum(am), 0) - coalesce(sum(ar), 0)) / max(n_customers), 6) AS qini_coefficient FROM (
  SELECT n_customers,
         (incremental_conversions + lag(incremental_conversions) OVER (ORDER BY point)) * 0.5
           * (pct_targeted - lag(pct_targeted) OVER (ORDER BY point)) AS am,
         (random_reference + lag(random_reference) OVER (ORDER BY point)) * 0.5
           * (pct_targeted - lag(pct_targeted) OVER (ORDER BY point)) AS ar
  FROM qini)""", "qini"))
def qini_coefficient(p):
    """U4: area between model and random Qini curves per customer."""
    t = p.uplift_frame.filter("is_test")
    return round_doubles(ev.qini_coefficient(ev.qini_curve(t)))


@register("uplift_by_decile", build("""
SELECT decile, round(avg(CASE WHEN treated THEN label END), 6) AS treated_conv_rate,
       round(avg(CASE WHEN NOT treated THEN label END), 6) AS control_conv_rate,
       round(avg(CASE WHEN treated THEN label END) - avg(CASE WHEN NOT treated THEN label END), 6) AS uplift
FROM (
  SELECT t.*, 1 + len(list_filter(list_slice(e.edges, 2, len(e.edges) - 1), lambda x: -t.uplift > x)) AS decile
  FROM (SELECT * FROM uplift_frame WHERE is_test) t,
       (SELECT list_sort(list_distinct(quantile_cont(-uplift, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
               AS edges FROM uplift_frame WHERE is_test) e)
GROUP BY decile""", "uplift_frame"))
def uplift_by_decile(p):
    """Treated vs control conversion by uplift decile (duplicate edges dropped)."""
    t = p.uplift_frame.filter("is_test")
    return round_doubles(ev.uplift_by_decile(t))


# ---------------------------------------------------------------- segmentation (given labels)
cte("rfm_matrix", ("features_current",), """
SELECT customer_id, recency_days, frequency, monetary,
       (r - avg(r) OVER ()) / CASE WHEN stddev_pop(r) OVER () = 0 THEN 1.0 ELSE stddev_pop(r) OVER () END AS x_recency,
       (f - avg(f) OVER ()) / CASE WHEN stddev_pop(f) OVER () = 0 THEN 1.0 ELSE stddev_pop(f) OVER () END AS x_frequency,
       (m - avg(m) OVER ()) / CASE WHEN stddev_pop(m) OVER () = 0 THEN 1.0 ELSE stddev_pop(m) OVER () END AS x_monetary
FROM (SELECT *, least(CAST(recency_days AS DOUBLE), (SELECT quantile_cont(recency_days, 0.99) FROM features_current)) AS r,
             ln(1 + frequency) AS f, ln(1 + monetary) AS m FROM features_current)""")


@register("rfm_matrix", build("""
SELECT customer_id, recency_days, frequency, round(monetary, 6) AS monetary, round(x_recency, 6) AS x_recency,
       round(x_frequency, 6) AS x_frequency, round(x_monetary, 6) AS x_monetary FROM rfm_matrix""", "rfm_matrix"))
def rfm_matrix(p):
    """G1: winsorised, log-transformed, population-standardised RFM matrix."""
    return round_doubles(seg.rfm_matrix(p.features_current, p.sp))


cte("lab", ("rfm_matrix", "rule_labels"),
    "SELECT m.*, l.cluster FROM rfm_matrix m JOIN rule_labels l ON m.customer_id = l.customer_id")
_sil_sql = build("""
SELECT round(avg(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (
  SELECT i, max(own_n) AS own_n, max(CASE WHEN same THEN d / (own_n - 1) END) AS a,
         min(CASE WHEN NOT same THEN d / n END) AS b
  FROM (
    SELECT x.customer_id AS i, y.cluster AS c, x.cluster = y.cluster AS same,
           sum(pow(x.x_recency - y.x_recency, 2) + pow(x.x_frequency - y.x_frequency, 2)
               + pow(x.x_monetary - y.x_monetary, 2)) AS d,
           count(*) AS n, max(sz.own) AS own_n
    FROM lab x CROSS JOIN lab y JOIN (SELECT cluster, count(*) AS own FROM lab GROUP BY 1) sz ON sz.cluster = x.cluster
    GROUP BY 1, 2, 3) GROUP BY i)""", "lab")

@register("silhouette", _sil_sql)  # oracle: brute-force all pairs (small scale)
def silhouette(p):
    """Mean silhouette (squared Euclidean, exact O(n·k) decomposition)."""
    lab = seg.rfm_matrix(p.features_current, p.sp).join(p.rule_labels, "customer_id")
    return round_doubles(ev.silhouette(lab, seg.RFM_FEATURES))



cte("label_b", ("features_current",), """
SELECT customer_id, CASE WHEN monetary >= 1000000 THEN 2 WHEN monetary >= 300000 THEN 1 ELSE 0 END AS tier
FROM features_current""")


def _tiers(p):
    m = F.col("monetary")
    return p.features_current.select("customer_id", F.when(m >= 1000000, 2).when(m >= 300000, 1).otherwise(0).alias("tier"))


@register("adjusted_rand_index", build("""
SELECT round(CASE WHEN (sa + sb) / 2.0 = sa * sb / (n * (n - 1) / 2.0) THEN 1.0
            ELSE (sij - sa * sb / (n * (n - 1) / 2.0)) / ((sa + sb) / 2.0 - sa * sb / (n * (n - 1) / 2.0)) END, 6) AS ari
FROM (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM cells),
     (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT cluster, sum(nij) AS ai FROM cells GROUP BY 1)),
     (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT tier, sum(nij) AS bj FROM cells GROUP BY 1))""",
                                       "rule_labels", "label_b").replace(
    "\nSELECT round(CASE", ",\ncells AS (SELECT l.cluster, b.tier, count(*) AS nij FROM rule_labels l JOIN label_b b "
    "ON l.customer_id = b.customer_id GROUP BY 1, 2)\nSELECT round(CASE", 1))
def adjusted_rand_index(p):
    """ARI between the recency×frequency labelling and monetary tiers."""
    j = p.rule_labels.join(_tiers(p), "customer_id")
    return round_doubles(ev.adjusted_rand_index(j, "cluster", "tier"))


_PROFILE = ("cluster, size, round(recency_days, 6) AS recency_days, round(frequency, 6) AS frequency, "
            "round(monetary, 6) AS monetary, round(avg_order_value, 6) AS avg_order_value, "
            "round(ltv_historical, 6) AS ltv_historical, round(conversion_rate, 6) AS conversion_rate, "
            "round(pct_of_base, 6) AS pct_of_base, segment_name, recommended_action")


@register("segment_profiles", build(f"SELECT {_PROFILE} FROM profile", "profile"))
def segment_profiles(p):
    """Per-cluster profile, named, with actions."""
    return round_doubles(p.profile)


@register("segment_naming", build("SELECT cluster, segment_name FROM profile", "profile"))
def segment_naming(p):
    """Quadrant names with richest-first suffixes."""
    return p.profile.select("cluster", "segment_name")


@register("segment_actions", build("SELECT segment_name, recommended_action FROM profile", "profile"))
def segment_actions(p):
    """Recommended action per segment."""
    return p.profile.select("segment_name", "recommended_action")


@register("segment_assignments", build("SELECT * FROM segments", "segments"))
def segment_assignments(p):
    """Customer → cluster → segment."""
    return p.segments


# ---------------------------------------------------------------- propensity preparation
_feat_sql = ", ".join(
    "CAST(CAST({0} AS INTEGER) AS DOUBLE) AS {0}".format(c) if c in ("single_buyer", "is_uk")
    else "monetary / frequency AS avg_order_value" if c == "avg_order_value"
    else f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)
cte("prep_test", ("features_test",), f"SELECT customer_id, as_of, target_conversion, {_feat_sql} FROM features_test")
cte("prep_train", ("features_train",), f"SELECT customer_id, as_of, target_conversion, {_feat_sql} FROM features_train")
_med = ", ".join(f"coalesce(t.{c}, (SELECT median({c}) FROM prep_train)) AS {c}" for c in FEATURE_COLUMNS)
cte("imp_test", ("prep_test", "prep_train"), f"SELECT customer_id, as_of, target_conversion, {_med} FROM prep_test t")
cte("imp_train", ("prep_train",), f"SELECT customer_id, as_of, target_conversion, {_med} FROM prep_train t")
_scale = ", ".join(
    f"({c} - (SELECT avg({c}) FROM imp_train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}) END FROM imp_train) AS {c}" for c in FEATURE_COLUMNS)
_R = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_COLUMNS)


@register("prepare_features", build(f"SELECT customer_id, as_of, target_conversion, {_R} FROM prep_test", "prep_test"))
def prepare_features(p):
    """Model feature frame (AOV, booleans as 0/1)."""
    return round_doubles(prop.prepare_features(p.features_test))


@register("median_impute", build(f"SELECT customer_id, as_of, target_conversion, {_R} FROM imp_test", "imp_test"))
def median_impute(p):
    """Test features imputed with exact training medians."""
    train = prop.prepare_features(p.features_train)
    return round_doubles(prop.median_impute(prop.prepare_features(p.features_test), prop.training_medians(train)))


@register("standard_scale", build(
    f"SELECT customer_id, as_of, target_conversion, {_R} FROM (SELECT customer_id, as_of, target_conversion, {_scale} "
    f"FROM imp_test)", "imp_test", "imp_train"))
def standard_scale(p):
    """Test features scaled by imputed-training mean and population std."""
    train = prop.prepare_features(p.features_train)
    med = prop.training_medians(train)
    imp_train = prop.median_impute(train, med)
    imp_test = prop.median_impute(prop.prepare_features(p.features_test), med)
    return round_doubles(prop.standard_scale(imp_test, imp_train))


@register("temporal_split", build("""
SELECT as_of, CASE WHEN as_of = (SELECT min(as_of) FROM snapshots) THEN 'train' ELSE 'test' END AS split,
       count(*) AS customers, CAST(sum(target_conversion) AS BIGINT) AS positives
FROM snapshots GROUP BY as_of""", "snapshots"))
def temporal_split(p):
    """Train rows at t_train, scored rows at t_test (customers may be in both)."""
    tr, te = prop.temporal_split(p.snapshots, p.cutoffs.t_train, p.cutoffs.t_test)
    agg = [F.count(F.lit(1)).alias("customers"), F.sum("target_conversion").cast("bigint").alias("positives")]
    return (tr.groupBy("as_of").agg(*agg).select("as_of", F.lit("train").alias("split"), "customers", "positives")
            .unionByName(te.groupBy("as_of").agg(*agg).select("as_of", F.lit("test").alias("split"),
                                                               "customers", "positives")))


# ---------------------------------------------------------------- G5 on a deterministic sweep
cte("tier_sweep", ("rfm_matrix",), """
SELECT k, customer_id, x_recency, x_frequency, x_monetary, least(frequency - 1, k - 1) AS cluster
FROM rfm_matrix, range(2, 11) t(k)""")


@register("choose_k", build("""
SELECT k, round(silhouette, 6) AS silhouette FROM (
  SELECT k, avg(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
    SELECT k, i, max(own_n) AS own_n, max(CASE WHEN same THEN d / (own_n - 1) END) AS a,
           min(CASE WHEN NOT same THEN d / n END) AS b
    FROM (
      SELECT x.k, x.customer_id AS i, y.cluster AS c, x.cluster = y.cluster AS same,
             sum(pow(x.x_recency - y.x_recency, 2) + pow(x.x_frequency - y.x_frequency, 2)
                 + pow(x.x_monetary - y.x_monetary, 2)) AS d,
             count(*) AS n, max(sz.own) AS own_n
      FROM tier_sweep x JOIN tier_sweep y ON x.k = y.k
      JOIN (SELECT k, cluster, count(*) AS own FROM tier_sweep GROUP BY 1, 2) sz ON sz.k = x.k AND sz.cluster = x.cluster
      GROUP BY 1, 2, 3, 4) GROUP BY k, i) GROUP BY k)
ORDER BY silhouette DESC, k LIMIT 1""", "tier_sweep"))
def choose_k(p):
    """First k with the highest silhouette over a sweep (here: frequency
    tiers for k = 2..10, silhouettes for all k in one grouped job)."""
    m = seg.rfm_matrix(p.features_current, p.sp)
    sweep = m.withColumn("k", F.explode(F.sequence(F.lit(2).cast("bigint"), F.lit(10).cast("bigint")))).withColumn(
        "cluster", F.least(F.col("frequency") - 1, F.col("k") - 1))
    sil = ev.silhouette(sweep, seg.RFM_FEATURES, "cluster", ("k",))
    best = seg.choose_k(sil.select("k", "silhouette"), None)
    return round_doubles(best.join(sil, "k").select("k", "silhouette"))
