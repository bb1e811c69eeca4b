"""Model evaluation as aggregations.

Scores are first collapsed to one row per distinct score (ties merge and the
table shrinks), then ordered statistics come from range-partitioned running
totals.  Every function takes ``groups`` so many models / runs / resamples
are evaluated by one job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import running_totals

CALIBRATION_EDGES = [j * 0.1 for j in range(1, 10)]  # interior edges of 10 uniform bins
INF = float("inf")


def _with_group(df: DataFrame, groups) -> tuple[DataFrame, list[str]]:
    """Guarantee at least one grouping column so per-group constants can be
    attached with an equi-join (a one-row broadcast) instead of a cross join."""
    if groups:
        return df, list(groups)
    return df.withColumn("_g", F.lit(0)), ["_g"]


def _score_table(df: DataFrame, score: str, label: str, groups) -> DataFrame:
    y = F.col(label).cast("long")
    return df.groupBy(*groups, score).agg(F.sum(y).alias("n_pos"), F.sum(F.lit(1) - y).alias("n_neg"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label", groups: tuple = ()) -> DataFrame:
    """Rank AUC (Mann–Whitney, ties count ½) per group."""
    st = _score_table(df, score, label, groups)
    rt = running_totals(st, [F.col(score).asc()], {"neg": F.col("n_neg")}, tuple(groups))
    below = F.col("cum_neg") - F.col("n_neg")
    return rt.groupBy(*groups).agg(
        (F.sum(F.col("n_pos") * (below + F.col("n_neg") * 0.5)) / (F.sum("n_pos") * F.sum("n_neg")))
        .alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label", groups: tuple = ()) -> DataFrame:
    """Step-sum AP = Σ (R_k − R_{k−1}) P_k over distinct thresholds, highest first."""
    st = _score_table(df, score, label, groups)
    rt = running_totals(st, [F.col(score).desc()], {"tp": F.col("n_pos"), "fp": F.col("n_neg")}, tuple(groups))
    prec = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    return rt.groupBy(*groups).agg((F.sum(F.col("n_pos") * prec) / F.sum("n_pos")).alias("average_precision"))


def brier_score(df: DataFrame, score: str = "score", label: str = "label", groups: tuple = ()) -> DataFrame:
    """Mean squared error of the probability (P10)."""
    return df.groupBy(*groups).agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label", groups: tuple = (),
              drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr) per distinct score, highest first, after a (0, 0) origin.

    With ``drop_intermediate`` an interior point is kept only when the step
    into it differs from the step out of it (collinear runs collapse).  The
    next point's step is fetched by an equi-join on position, not a window.
    """
    src, gs = _with_group(df, groups)
    st = _score_table(src, score, label, gs)
    rt = running_totals(st, [F.col(score).desc()], {"tp": F.col("n_pos"), "fp": F.col("n_neg")}, tuple(gs))
    tot = rt.groupBy(*gs).agg(F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"), F.max("pos").alias("K"))
    pts = rt.join(tot, gs)
    if drop_intermediate:
        nxt = rt.select(*gs, (F.col("pos") - 1).alias("pos"), F.col("n_pos").alias("next_pos"),
                        F.col("n_neg").alias("next_neg"))
        pts = pts.join(nxt, [*gs, "pos"], "left").filter(
            (F.col("pos") == 1) | (F.col("pos") == F.col("K")) |
            (F.col("n_pos") != F.col("next_pos")) | (F.col("n_neg") != F.col("next_neg")))
    curve = pts.select(*gs, F.col(score).cast("double").alias("threshold"),
                       (F.col("cum_fp") / F.col("N")).alias("fpr"), (F.col("cum_tp") / F.col("P")).alias("tpr"))
    origin = tot.select(*gs, F.lit(INF).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    out = origin.unionByName(curve)
    return out if groups else out.drop("_g")


def calibration_bin(score: str = "score"):
    """Bin index 0..9 of ten uniform bins, right-closed, 0 in the first bin."""
    p = F.col(score)
    expr = F.lit(0)
    for e in CALIBRATION_EDGES:
        expr = expr + (p > F.lit(e)).cast("int")
    return expr


def calibration_curve(df: DataFrame, score: str = "score", label: str = "label", groups: tuple = ()) -> DataFrame:
    """Mean predicted vs observed rate per non-empty bin."""
    return df.groupBy(*groups, calibration_bin(score).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"))


def _half_up_ratio(num, den, scale: int):
    """round(100*num/den, 1) in exact integer arithmetic (engine-independent)."""
    return F.expr(f"(2 * {scale} * 100 * {num} + {den}) div (2 * {den})") / F.lit(float(scale))


def qini_curve(df: DataFrame, uplift: str = "uplift", label: str = "label", treated: str = "treated",
               key: str = "customer_id", groups: tuple = (), n_bins: int = 20) -> DataFrame:
    """Cumulative incremental conversions by predicted uplift.

    Order: uplift desc, key asc (a total order).  Cut k is the first
    floor(n·k/n_bins) rows; incremental = treated conversions − control
    conversions × treated/max(control, 1).  Point 0 is the origin.
    """
    src, gs = _with_group(df, groups)
    y = F.col(label).cast("long")
    t = F.col(treated).cast("long")
    rt = running_totals(src, [F.col(uplift).desc(), F.col(key).asc()],
                        {"yt": y * t, "yc": y * (F.lit(1) - t), "nt": t, "nc": F.lit(1) - t}, tuple(gs))
    tot = src.groupBy(*gs).agg(F.count(F.lit(1)).alias("n_customers"))
    cuts = (tot.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_bins).cast("bigint"))))
            .withColumn("pos", F.expr(f"(n_customers * point) div {n_bins}")))
    j = cuts.join(rt.select(*gs, "pos", "cum_yt", "cum_yc", "cum_nt", "cum_nc"), [*gs, "pos"], "left")
    inc = F.coalesce(F.col("cum_yt") - F.col("cum_yc") * (F.col("cum_nt") / F.greatest(F.col("cum_nc"), F.lit(1))),
                     F.lit(0.0))
    curve = j.select(*gs, "point", "n_customers",
                     F.when(F.col("point") == 0, F.lit(0.0))
                      .otherwise(_half_up_ratio("pos", "n_customers", 10)).alias("pct_targeted"),
                     F.when(F.col("point") == 0, F.lit(0.0)).otherwise(inc.cast("double")).alias("incremental_conversions"))
    overall = curve.filter(F.col("point") == n_bins).select(*gs, F.col("incremental_conversions").alias("_overall"))
    out = curve.join(overall, gs).withColumn(
        "random_reference", F.col("pct_targeted") / 100.0 * F.col("_overall")).drop("_overall")
    return out if groups else out.drop("_g")


def qini_coefficient(curve: DataFrame, groups: tuple = ()) -> DataFrame:
    """(trapezoid area of model − of random line) / n over pct 0..100 (U4).
    The lag runs over the n_bins+1 points of each curve (bounded)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*groups).orderBy("point") if groups else Window.orderBy("point")
    dx = F.col("pct_targeted") - F.lag("pct_targeted").over(w)
    am = (F.col("incremental_conversions") + F.lag("incremental_conversions").over(w)) * 0.5 * dx
    ar = (F.col("random_reference") + F.lag("random_reference").over(w)) * 0.5 * dx
    pts = curve.select(*groups, "n_customers", am.alias("am"), ar.alias("ar"))
    return pts.groupBy(*groups).agg(
        ((F.coalesce(F.sum("am"), F.lit(0.0)) - F.coalesce(F.sum("ar"), F.lit(0.0))) / F.max("n_customers"))
        .alias("qini_coefficient"))


def uplift_by_decile(df: DataFrame, uplift: str = "uplift", label: str = "label", treated: str = "treated",
                     groups: tuple = ()) -> DataFrame:
    """Equal-frequency bins of −uplift from exact linear quantile edges,
    right-closed, duplicate edges dropped; decile 1 = highest uplift (U5)."""
    from tidewell.operators.quantiles import grouped_percentiles
    src, gs = _with_group(df, groups)
    q = grouped_percentiles(src.withColumn("_neg", -F.col(uplift)), "_neg", [i / 10.0 for i in range(11)], gs)
    edges = q.select(*gs, F.sort_array(F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(11)]))).alias("_edges"))
    j = src.join(edges, gs)
    interior = F.slice(F.col("_edges"), 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    j = j.withColumn("decile", (F.lit(1) + F.size(F.filter(interior, lambda e: -F.col(uplift) > e))).cast("bigint"))
    tr = F.col(treated).cast("boolean")
    y = F.col(label).cast("double")
    out = j.groupBy(*gs, "decile").agg(
        F.avg(F.when(tr, y)).alias("treated_conv_rate"),
        F.avg(F.when(~tr, y)).alias("control_conv_rate"))
    out = out.withColumn("uplift", F.col("treated_conv_rate") - F.col("control_conv_rate")).orderBy(*gs, "decile")
    return out if groups else out.drop("_g")


def adjusted_rand_index(df: DataFrame, a: str, b: str, groups: tuple = ()) -> DataFrame:
    """ARI from the contingency table (G6); 1.0 in the degenerate limit cases."""
    src, gs = _with_group(df, groups)
    cells = src.groupBy(*gs, a, b).agg(F.count(F.lit(1)).alias("nij"))

    def c2(x):
        return x * (x - 1) / 2.0

    rows = cells.groupBy(*gs, a).agg(F.sum("nij").alias("ai")).groupBy(*gs).agg(F.sum(c2(F.col("ai"))).alias("sa"))
    cols = cells.groupBy(*gs, b).agg(F.sum("nij").alias("bj")).groupBy(*gs).agg(F.sum(c2(F.col("bj"))).alias("sb"))
    idx = cells.groupBy(*gs).agg(F.sum(c2(F.col("nij"))).alias("sij"), F.sum("nij").alias("n"))
    t = idx.join(rows, gs).join(cols, gs)
    expected = F.col("sa") * F.col("sb") / c2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2.0
    out = t.select(*gs, F.when(mx == expected, F.lit(1.0))
                   .otherwise((F.col("sij") - expected) / (mx - expected)).alias("ari"))
    return out if groups else out.drop("_g")


def silhouette(df: DataFrame, features: list[str], cluster: str = "cluster", groups: tuple = ()) -> DataFrame:
    """Mean silhouette with squared Euclidean distances (G4), exact and O(n·k).

    Σ_y∈c ||x−y||² = n_c·||x||² − 2·x·S_c + Q_c with S_c, Q_c the cluster's
    vector sum and sum of squared norms, so each point only meets the k
    cluster summaries (an array of k structs, broadcast by group) — never
    another point.  Singleton clusters score 0.
    """
    src, gs = _with_group(df, groups)
    sq = sum((F.col(f) * F.col(f) for f in features[1:]), F.col(features[0]) * F.col(features[0]))
    pts = src.withColumn("_q", sq)
    stats = pts.groupBy(*gs, cluster).agg(F.count(F.lit(1)).alias("n"),
                                          *[F.sum(f).alias(f"s{i}") for i, f in enumerate(features)],
                                          F.sum("_q").alias("q"))
    arr = stats.groupBy(*gs).agg(F.collect_list(F.struct(
        F.col(cluster).alias("c"), "n", "q", *[F.col(f"s{i}") for i in range(len(features))])).alias("_cl"))
    j = pts.join(F.broadcast(arr), gs)

    def total_sq(s):
        dot = sum((F.col(f) * s[f"s{i}"] for i, f in enumerate(features[1:], start=1)),
                  F.col(features[0]) * s["s0"])
        return s["n"] * F.col("_q") - 2 * dot + s["q"]

    own = F.filter("_cl", lambda s: s["c"] == F.col(cluster))[0]
    others = F.filter("_cl", lambda s: s["c"] != F.col(cluster))
    a = F.when(own["n"] > 1, total_sq(own) / (own["n"] - 1))
    b = F.array_min(F.transform(others, lambda s: total_sq(s) / s["n"]))
    s_val = F.when(own["n"] <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    out = j.groupBy(*gs).agg(F.avg(s_val).alias("silhouette"))
    return out if groups else out.drop("_g")
