"""Registered plans: Hill response and budget allocation (B*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.hashing import poisson1_thresholds
from tidewell.functions.hill import hill
from tidewell.functions.ratios import round_half
from tidewell.operators import budget as bud
from tidewell.plans.oracle import BP, build, cte, dl, hash_u, hill_sql
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register

B = BP.total_budget
FLOOR, CAP, D = BP.min_share * B, BP.max_share * B, BP.step
JMAX = int(round((CAP - FLOOR) / D))


@register("hill_params", build("SELECT channel, round(vmax, 6) AS vmax, round(k, 6) AS k, s FROM hill", "hill"))
def hill_params(p):
    """B2: vmax = audience × mean score, k = max(CPA, 1), s = shape."""
    return round_doubles(p.hill)


@register("hill_response", build(f"""
SELECT h.channel, c.spend_synthetic AS spend, round({hill_sql('c.spend_synthetic', 'h.vmax', 'h.k', 'h.s')}, 6) AS conversions
FROM hill h JOIN channel_table c ON h.channel = c.channel""", "hill", "channel_table"))
def hill_response(p):
    """B1: Hill response at each channel's current synthetic spend."""
    j = p.hill.join(p.channel_table.select("channel", F.col("spend_synthetic").alias("spend")), "channel")
    return round_doubles(j.select("channel", "spend", hill("spend", "vmax", "k", "s").alias("conversions")))


_stop = BP.max_share * B
_step = _stop / (BP.curve_points - 1)
_grid = [i * _step for i in range(BP.curve_points - 1)] + [_stop]
_grid_sql = " UNION ALL ".join(f"SELECT {i} AS point, {dl(g)} AS spend" for i, g in enumerate(_grid))


@register("response_curves", build(f"""
SELECT h.channel, g.point, g.spend, round({hill_sql('g.spend')}, 6) AS conversions
FROM hill h, ({_grid_sql}) g""", "hill"))
def response_curves(p):
    """60-point response curve per channel."""
    rc = bud.response_curves(p.hill, p.bp)
    return rc.withColumn("conversions", round_half(F.col("conversions"), 6))


def _alloc_sql(hp: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    on = " AND ".join([f"a.{x} = c.{x}" for x in groups.split(", ")] + ["a.channel = c.channel"]) if groups else \
        "a.channel = c.channel"
    return f"""
SELECT {g}channel, allocation, conversions, sum(conversions) OVER ({part}) AS total_conversions, concave_ok FROM (
  SELECT a.*, {dl(FLOOR)} + coalesce(c.n, 0) * {dl(D)} AS allocation,
         {hill_sql(f"{dl(FLOOR)} + coalesce(c.n, 0) * {dl(D)}", 'a.vmax', 'a.k', 'a.s')} AS conversions,
         a.k * pow((a.s - 1.0) / (a.s + 1.0), 1.0 / a.s) <= {dl(FLOOR)} AS concave_ok
  FROM {hp} a LEFT JOIN (
    SELECT {g}channel, count(*) AS n FROM (
      SELECT *, row_number() OVER ({part}ORDER BY gain DESC, channel, j) AS rn,
             CAST(round(({dl(B)} - count(*) OVER ({part}) / {JMAX} * {dl(FLOOR)}) / {dl(D)}) AS INTEGER) AS n_steps
      FROM (SELECT {g}channel, j,
                   {hill_sql(f"{dl(FLOOR)} + j * {dl(D)}")} - {hill_sql(f"{dl(FLOOR)} + j * {dl(D)} - {dl(D)}")} AS gain
            FROM {hp}, range(1, {JMAX + 1}) t(j)))
    WHERE rn <= n_steps GROUP BY {g}channel) c ON {on})"""


@register("budget_allocation", build(
    "SELECT channel, round(allocation, 6) AS allocation, round(conversions, 6) AS conversions, "
    f"round(total_conversions, 6) AS total_conversions, concave_ok FROM ({_alloc_sql('hill')})", "hill"))
def budget_allocation(p):
    """Marginal-gain allocation of the budget within 5–70% bounds."""
    return round_doubles(bud.budget_allocation(p.hill, p.bp))


_th = poisson1_thresholds()
_pois = "CASE " + " ".join(f"WHEN u < {dl(c)} THEN {k}" for k, c in enumerate(_th)) + f" ELSE {len(_th)} END"
cte("boot_hill", ("scored_attribution", "channel_table"), f"""
SELECT r.resample, c.channel,
       CASE WHEN a.W > 0 THEN CAST((SELECT count(*) FROM scored_attribution) AS DOUBLE) * coalesce(a.ws, 0.0) / a.W
            ELSE 0.0 END AS vmax,
       greatest(c.cpa, 1.0) AS k, {dl(BP.hill_shape)} AS s
FROM channel_table c CROSS JOIN range(1, {BP.resamples + 1}) r(resample)
LEFT JOIN (
  SELECT resample, channel, ws, sum(wn) OVER (PARTITION BY resample) AS W FROM (
    SELECT resample, channel, sum(w * score) AS ws, sum(w) AS wn FROM (
      SELECT resample, channel, score, {_pois} AS w FROM (
        SELECT r.resample, s.channel, s.score,
               {hash_u("CAST(r.resample AS VARCHAR) || ':' || s.customer_id", 'bootstrap', BP.seed)} AS u
        FROM scored_attribution s CROSS JOIN range(1, {BP.resamples + 1}) r(resample)))
    GROUP BY 1, 2)) a ON a.resample = r.resample AND a.channel = c.channel""")
cte("boot", ("boot_hill",), f"""
SELECT resample, max(total_conversions) AS total_conversions FROM ({_alloc_sql('boot_hill', 'resample')})
GROUP BY resample""")


@register("response_bands", build(f"""
SELECT channel, point, spend, round(quantile_cont(conv, 0.1), 6) AS p10, round(quantile_cont(conv, 0.5), 6) AS p50,
       round(quantile_cont(conv, 0.9), 6) AS p90
FROM (SELECT h.resample, h.channel, g.point, g.spend, {hill_sql('g.spend', 'h.vmax', 'h.k', 'h.s')} AS conv
      FROM boot_hill h, ({_grid_sql}) g)
GROUP BY channel, point, spend""", "boot_hill"))
def response_bands(p):
    """p10 / p50 / p90 response per channel and spend over bootstrap resamples."""
    b = bud.response_bands(p.scored_attribution, p.channel_table, p.bp)
    return b.select("channel", "point", "spend", *[round_half(F.col(c), 6).alias(c) for c in ("p10", "p50", "p90")])


@register("bootstrap_allocation", build(
    "SELECT resample, round(total_conversions, 6) AS total_conversions FROM boot", "boot"))
def bootstrap_allocation(p):
    """Optimal conversions on 200 Poisson-weight resamples of customers."""
    return round_doubles(bud.bootstrap_allocation(p.scored_attribution, p.channel_table, p.bp))


@register("allocation_quantiles", build("""
SELECT count(*) AS resamples, round(quantile_cont(total_conversions, 0.1), 6) AS p10,
       round(quantile_cont(total_conversions, 0.5), 6) AS p50, round(quantile_cont(total_conversions, 0.9), 6) AS p90
FROM boot""", "boot"))
def allocation_quantiles(p):
    """p10 / p50 / p90 of bootstrap totals."""
    return round_doubles(bud.allocation_quantiles(bud.bootstrap_allocation(p.scored_attribution, p.channel_table, p.bp)))


@register("allocation_histogram", build("""
SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((total_conversions - mn) / w), 29) END AS INTEGER) AS bin,
       count(*) AS resamples, round(min(total_conversions), 6) AS lo, round(max(total_conversions), 6) AS hi
FROM boot, (SELECT min(total_conversions) AS mn, (max(total_conversions) - min(total_conversions)) / 30.0 AS w FROM boot)
GROUP BY 1""", "boot"))
def allocation_histogram(p):
    """30-bin histogram of bootstrap totals."""
    boot = bud.bootstrap_allocation(p.scored_attribution, p.channel_table, p.bp)
    return round_doubles(bud.allocation_histogram(boot))


def candidates(p):
    """Candidate allocation table: equal split, the optimum, and a split
    proportional to current synthetic spend."""
    ch = p.channel_table.select("channel", "spend_synthetic")
    n = len(p.ap.channels)
    eq = ch.select(F.lit("equal_split").alias("scenario"), "channel", F.lit(B / n).alias("spend"))
    opt = bud.budget_allocation(p.hill, p.bp).select(F.lit("optimal").alias("scenario"), "channel",
                                                     F.col("allocation").alias("spend"))
    tot = ch.agg(F.sum("spend_synthetic")).scalar()
    prop = ch.select(F.lit("spend_proportional").alias("scenario"), "channel",
                     (F.lit(B) * F.col("spend_synthetic") / tot).alias("spend"))
    return eq.unionByName(opt).unionByName(prop)


@register("evaluate_allocations", build(f"""
SELECT scenario, round(sum(allocated), 6) AS allocated_total, round(sum(conv), 6) AS total_conversions,
       round(CASE WHEN sum(conv) = 0 THEN CAST('inf' AS DOUBLE) ELSE sum(allocated) / sum(conv) END, 6) AS blended_cpa,
       abs(sum(allocated) - {dl(B)}) > {dl(0.02 * B)} AS off_budget
FROM (
  SELECT x.scenario, least(greatest(x.spend, {dl(FLOOR)}), {dl(CAP)}) AS allocated,
         {hill_sql(f"least(greatest(x.spend, {dl(FLOOR)}), {dl(CAP)})", 'h.vmax', 'h.k', 'h.s')} AS conv
  FROM (
    SELECT 'equal_split' AS scenario, channel, {dl(B / 4)} AS spend FROM channel_table
    UNION ALL SELECT 'optimal', channel, allocation FROM ({_alloc_sql('hill')})
    UNION ALL SELECT 'spend_proportional', channel, {dl(B)} * spend_synthetic / (SELECT sum(spend_synthetic) FROM channel_table)
    FROM channel_table) x JOIN hill h ON x.channel = h.channel)
GROUP BY scenario""", "hill", "channel_table"))
def evaluate_allocations(p):
    """Conversions, blended CPA and budget check for a table of candidate allocations."""
    return round_doubles(bud.evaluate_allocations(candidates(p), p.hill, p.bp))
