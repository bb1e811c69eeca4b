"""Hill response curves and budget allocation.

Allocation is re-aimed from a per-scenario numerical solver to a relational
plan: spend above each channel's floor is cut into steps of ``step``; each
(channel, step) has a marginal gain hill(x+δ) − hill(x); the best
(budget − Σ floors)/δ steps win.  Where every curve is concave above its
floor (checked: the Hill inflection k·((s−1)/(s+1))^(1/s) lies below the
floor) this is the exact optimum on the δ grid.  Many scenarios — e.g. 200
bootstrap resamples — are one window partitioned by scenario.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_poisson1
from tidewell.functions.hill import hill
from tidewell.params import BudgetParams


def hill_params(attribution: DataFrame, scores: DataFrame, channel_table: DataFrame,
                params: BudgetParams = BudgetParams(), score_col: str = "score") -> DataFrame:
    """Per channel: vmax = audience × mean score (0 for an empty audience),
    k = max(cpa, 1), s = shape (B2)."""
    scored = attribution.select("customer_id", "channel").join(scores.select("customer_id", score_col), "customer_id")
    aud = scored.groupBy("channel").agg(F.sum(score_col).alias("_vmax"))
    return (channel_table.select("channel", "cpa").join(aud, "channel", "left")
            .select("channel", F.coalesce(F.col("_vmax"), F.lit(0.0)).alias("vmax"),
                    F.greatest(F.col("cpa"), F.lit(1.0)).alias("k"), F.lit(params.hill_shape).alias("s")))


def inflection(k, s):
    return k * F.pow((s - F.lit(1.0)) / (s + F.lit(1.0)), F.lit(1.0) / s)


def response_curves(hp: DataFrame, params: BudgetParams = BudgetParams(), groups: tuple = ()) -> DataFrame:
    """Evenly spaced spends 0..max_share·budget per channel and the Hill response."""
    stop = params.max_share * params.total_budget
    n = params.curve_points
    step = stop / (n - 1)
    grid = [i * step for i in range(n - 1)] + [stop]
    pts = hp.withColumn("_p", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(n - 1)).alias("point"),
                                                      F.array(*[F.lit(float(g)) for g in grid]).alias("spend"))))
    return pts.select(*groups, "channel", F.col("_p.point").alias("point"), F.col("_p.spend").alias("spend"),
                      hill(F.col("_p.spend"), F.col("vmax"), F.col("k"), F.col("s")).alias("conversions"))


def check_concave_above_floor(hp: DataFrame, floor: float) -> None:
    """Marginal-gain ranking is exact only where each curve is concave above
    its floor: raise if a Hill inflection k·((s−1)/(s+1))^(1/s) exceeds it.
    Reads the distinct (k, s) pairs — at most one per channel."""
    import math
    for r in hp.select("k", "s").distinct().collect():
        k, s = r["k"], r["s"]
        if k is None or not math.isfinite(k) or s is None or s <= 1:
            continue  # s ≤ 1 is concave everywhere; k = ∞ is a flat zero curve
        if k * ((s - 1) / (s + 1)) ** (1 / s) > floor:
            raise ValueError(f"Hill curve (k={k}, s={s}) is not concave above the floor {floor}")


def budget_allocation(hp: DataFrame, params: BudgetParams = BudgetParams(), groups: tuple = ()) -> DataFrame:
    """Marginal-gain allocation per scenario (B4): (groups, channel, allocation,
    conversions, total_conversions, concave_ok).

    The parameter table is consumed once: every (channel, step) gain is
    ranked in one window per scenario, and one grouped aggregate carries the
    Hill parameters together with the number of chosen steps."""
    b = params.total_budget
    floor, cap, d = params.min_share * b, params.max_share * b, params.step
    if not groups:
        n_channels = hp.select("channel").distinct().count()
        if not (n_channels * params.min_share <= 1 <= n_channels * params.max_share):
            raise ValueError("budget bounds are infeasible for this many channels")
    check_concave_above_floor(hp, floor)
    j_max = int(round((cap - floor) / d))
    scen = Window.partitionBy(*groups) if groups else Window.partitionBy()
    base = hp.withColumn("_n_steps", F.round((F.lit(b) - F.count(F.lit(1)).over(scen) * F.lit(floor)) / F.lit(d))
                         .cast("int"))
    js = F.sequence(F.lit(1), F.lit(j_max)) if j_max >= 1 else F.array().cast("array<int>")
    steps = base.withColumn("j", F.explode_outer(js))
    x = F.lit(floor) + F.col("j") * F.lit(d)
    steps = steps.withColumn("gain", hill(x, "vmax", "k", "s") - hill(x - F.lit(d), "vmax", "k", "s"))
    w = Window.partitionBy(*groups).orderBy(F.col("gain").desc_nulls_last(), F.col("channel").asc(), F.col("j").asc())
    ranked = steps.withColumn("_rank", F.row_number().over(w))
    chosen = F.when(F.col("j").isNotNull() & (F.col("_rank") <= F.col("_n_steps")), 1).otherwise(0)
    per = ranked.groupBy(*groups, "channel").agg(
        F.first("vmax").alias("vmax"), F.first("k").alias("k"), F.first("s").alias("s"),
        F.sum(chosen).alias("_steps"))
    alloc = per.withColumn("allocation", F.lit(floor) + F.col("_steps") * F.lit(d))
    alloc = alloc.withColumn("conversions", hill("allocation", "vmax", "k", "s"))
    return alloc.select(*groups, "channel", "allocation", "conversions",
                        F.sum("conversions").over(scen).alias("total_conversions"),
                        (inflection(F.col("k"), F.col("s")) <= F.lit(floor)).alias("concave_ok"))


def bootstrap_hill_params(scored_attribution: DataFrame, channel_table: DataFrame,
                          params: BudgetParams = BudgetParams(), score_col: str = "score") -> DataFrame:
    """Hill parameters per (resample, channel) from resampled customers.

    Each customer gets a Poisson(1) weight per resample from a hashed uniform
    (no row ordering, no driver sampling).  vmax is rescaled by n / Σ weights
    so every resample represents exactly n customers, as an n-draw bootstrap
    does.  The customer × resample stream is reduced map-side before any
    shuffle: the exchange carries resamples × channels rows per task."""
    n = scored_attribution.count()
    r = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(params.resamples).cast("bigint")))
    exp = scored_attribution.select("customer_id", "channel", score_col).withColumn("resample", r)
    w = hash_poisson1(params.seed, F.concat_ws(":", F.col("resample"), F.col("customer_id")), "bootstrap")
    agg = exp.withColumn("_w", w).groupBy("resample", "channel").agg(
        F.sum(F.col("_w") * F.col(score_col)).alias("_ws"), F.sum("_w").alias("_wn"))
    tot = Window.partitionBy("resample")
    agg = agg.withColumn("_W", F.sum("_wn").over(tot))
    grid = channel_table.select("channel", "cpa").withColumn("resample", r)
    j = grid.join(agg, ["resample", "channel"], "left")
    return j.select("resample", "channel",
                    F.when(F.col("_W") > 0, F.lit(float(n)) * F.coalesce(F.col("_ws"), F.lit(0.0)) / F.col("_W"))
                    .otherwise(F.lit(0.0)).alias("vmax"),
                    F.greatest(F.col("cpa"), F.lit(1.0)).alias("k"), F.lit(params.hill_shape).alias("s"))


def bootstrap_allocation(scored_attribution: DataFrame, channel_table: DataFrame,
                         params: BudgetParams = BudgetParams(), score_col: str = "score") -> DataFrame:
    """Total optimal conversions per resample."""
    hp = bootstrap_hill_params(scored_attribution, channel_table, params, score_col)
    alloc = budget_allocation(hp, params, groups=("resample",))
    return alloc.groupBy("resample").agg(F.first("total_conversions").alias("total_conversions"))


def allocation_quantiles(boot: DataFrame) -> DataFrame:
    """p10 / p50 / p90 (exact, linear) of bootstrap totals."""
    q = boot.agg(F.percentile("total_conversions", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"),
                 F.count(F.lit(1)).alias("resamples"))
    return q.select("resamples", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"))


def allocation_histogram(boot: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of bootstrap totals between min and max."""
    mn = boot.agg(F.min("total_conversions")).scalar()
    mx = boot.agg(F.max("total_conversions")).scalar()
    width = (mx - mn) / F.lit(float(bins))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("total_conversions") - mn) / width), F.lit(bins - 1))).cast("int")
    return boot.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("resamples"),
                                           F.min("total_conversions").alias("lo"),
                                           F.max("total_conversions").alias("hi"))


def evaluate_allocations(candidates: DataFrame, hp: DataFrame, params: BudgetParams = BudgetParams()) -> DataFrame:
    """For a table (scenario, channel, spend): clip to bounds, conversions per
    channel, per-scenario total, blended CPA (inf if none) and a flag when
    the allocated total is off budget by more than 2% (B7)."""
    b = params.total_budget
    lo, hi = params.min_share * b, params.max_share * b
    j = candidates.join(hp, "channel").withColumn(
        "allocated", F.least(F.greatest(F.col("spend"), F.lit(lo)), F.lit(hi)))
    j = j.withColumn("conversions", hill("allocated", "vmax", "k", "s"))
    per = j.groupBy("scenario").agg(F.sum("allocated").alias("allocated_total"),
                                    F.sum("conversions").alias("total_conversions"))
    return per.select("scenario", "allocated_total", "total_conversions",
                      F.when(F.col("total_conversions") == 0, F.lit(float("inf")))
                      .otherwise(F.col("allocated_total") / F.col("total_conversions")).alias("blended_cpa"),
                      (F.abs(F.col("allocated_total") - F.lit(b)) > F.lit(0.02 * b)).alias("off_budget"))


def response_bands(scored_attribution: DataFrame, channel_table: DataFrame,
                   params: BudgetParams = BudgetParams(), score_col: str = "score") -> DataFrame:
    """Response-curve uncertainty band (B3 re-aimed): the curve of every
    bootstrap resample, then exact p10 / p50 / p90 per (channel, spend point)."""
    hp = bootstrap_hill_params(scored_attribution, channel_table, params, score_col)
    curves = response_curves(hp, params, groups=("resample",))
    q = F.percentile("conversions", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return curves.groupBy("channel", "point", "spend").agg(q.alias("_q")).select(
        "channel", "point", "spend", F.col("_q")[0].alias("p10"), F.col("_q")[1].alias("p50"),
        F.col("_q")[2].alias("p90"))
