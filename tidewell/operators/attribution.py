"""Synthetic media attribution (A1–A5).

Channel, acquisition cost and campaign exposure are drawn per customer from
hashed uniforms keyed by customer_id, so the table is identical whatever the
partitioning and survives task re-execution.  The high-value threshold is an
exact linear-interpolated percentile evaluated as a scalar subquery.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_normal, hash_uniform
from tidewell.functions.ratios import round_half
from tidewell.params import AttributionParams


def high_value_threshold(features: DataFrame, pct: float) -> Column:
    """Exact percentile (linear interpolation) of monetary, as a literal."""
    from tidewell.operators.quantiles import exact_percentiles
    return F.lit(exact_percentiles(features, ["monetary"], pct / 100.0)["monetary"])


def high_value_flag(features: DataFrame, params: AttributionParams = AttributionParams()) -> DataFrame:
    thr = high_value_threshold(features, params.high_value_percentile)
    return features.withColumn("is_high_value", F.col("monetary") >= thr)


def _pick_channel(u: Column, cums: list[float], names: list[str]) -> Column:
    expr = F.lit(names[0])
    for name, c in reversed(list(zip(names, cums))):
        expr = F.when(u < F.lit(c), F.lit(name)).otherwise(expr)
    return expr


def channel_column(params: AttributionParams, high_value: Column, key: str = "customer_id") -> Column:
    names = params.names()
    u = hash_uniform(params.seed, key, "channel")
    return F.when(high_value, _pick_channel(u, params.cumulative(True), names)).otherwise(
        _pick_channel(u, params.cumulative(False), names))


def cac_column(params: AttributionParams, channel: Column, key: str = "customer_id") -> Column:
    z = hash_normal(params.seed, key, "cac")
    mu = F.lit(None).cast("double")
    sigma = F.lit(None).cast("double")
    for name, _, m, s in reversed(params.channels):
        mu = F.when(channel == name, F.lit(m)).otherwise(mu)
        sigma = F.when(channel == name, F.lit(s)).otherwise(sigma)
    return F.exp(mu + sigma * z)


def exposed_column(params: AttributionParams, key: str = "customer_id") -> Column:
    return hash_uniform(params.seed, key, "exposure") < F.lit(params.exposure_rate)


def synthetic_attribution(features: DataFrame, params: AttributionParams = AttributionParams()) -> DataFrame:
    """customer_id, channel, cac_synthetic, exposed (A2–A4) for one snapshot."""
    flagged = high_value_flag(features.select("customer_id", "monetary"), params)
    ch = flagged.withColumn("channel", channel_column(params, F.col("is_high_value")))
    return ch.select("customer_id", "channel",
                     cac_column(params, F.col("channel")).alias("cac_synthetic"),
                     exposed_column(params).alias("exposed"))


def attribution_mix(attribution: DataFrame) -> DataFrame:
    """Share of customers by channel (3 dp) and exposure rates (A5)."""
    per = attribution.groupBy("channel").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(F.col("exposed").cast("double")).alias("exposed_rate"))
    tot = attribution.agg(F.count(F.lit(1)).alias("n"),
                          F.avg(F.col("exposed").cast("double")).alias("overall_exposed_rate"))
    return per.select(
        "channel", "customers",
        round_half(F.col("customers") / tot.select("n").scalar(), 3).alias("share"),
        "exposed_rate",
        tot.select("overall_exposed_rate").scalar().alias("overall_exposed_rate"))
