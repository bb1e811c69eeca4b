"""Propensity and uplift modelling.

Feature preparation, median imputation and scaling are aggregates attached
as scalar subqueries.  Model fits are Spark ML estimators (distributed
tree-aggregate jobs); everything they produce is scored and evaluated as
DataFrames by ``tidewell.operators.evaluation``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_uniform
from tidewell.operators.ordered import running_totals
from tidewell.params import FEATURE_COLUMNS


def prepare_features(features: DataFrame) -> DataFrame:
    """AOV = monetary / frequency; booleans as 0/1."""
    return features.select(
        "customer_id", "as_of", "target_conversion",
        *[(F.col(c).cast("int") if c in ("single_buyer", "is_uk")
           else (F.col("monetary") / F.col("frequency")) if c == "avg_order_value"
           else F.col(c)).cast("double").alias(c) for c in FEATURE_COLUMNS])


def training_medians(train: DataFrame, cols=FEATURE_COLUMNS) -> dict[str, float]:
    """Exact medians of the training set, one aggregate job (P2).  A fitted
    imputer is a fixed-size parameter vector, so it comes back to the driver."""
    from tidewell.operators.quantiles import exact_percentiles
    return exact_percentiles(train, list(cols), 0.5)


def median_impute(df: DataFrame, medians: dict[str, float], cols=FEATURE_COLUMNS) -> DataFrame:
    """Fill nulls with the training medians."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in cols})


def scaler_params(train: DataFrame, cols=FEATURE_COLUMNS) -> dict[str, tuple[float, float]]:
    """Training mean and population std per column (zero std → 1), one job."""
    row = train.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols]).first()
    return {c: (row[f"mu_{c}"], row[f"sd_{c}"] if row[f"sd_{c}"] else 1.0) for c in cols}


def standard_scale(df: DataFrame, train: DataFrame, cols=FEATURE_COLUMNS) -> DataFrame:
    """z-score with the training mean and population std; zero std → 1."""
    par = scaler_params(train, cols)
    return df.withColumns({c: (F.col(c) - F.lit(par[c][0])) / F.lit(par[c][1]) for c in cols})


def temporal_split(snapshots: DataFrame, t_train, t_test) -> tuple[DataFrame, DataFrame]:
    """Train on the t_train snapshot, score the t_test snapshot."""
    from tidewell.functions.timecols import as_ts
    return (snapshots.filter(F.col("as_of") == as_ts(t_train)),
            snapshots.filter(F.col("as_of") == as_ts(t_test)))


def stratified_split(df: DataFrame, strata: list[str], test_frac: float, seed: int,
                     key: str = "customer_id") -> DataFrame:
    """Adds ``is_test``: in every stratum the ceil(test_frac·n) rows with the
    smallest hashed uniform (U1).  Positions per stratum come from
    range-partitioned running counts (no stratum is ranked in one task)."""
    u = hash_uniform(seed, key, "split")
    s = df.withColumn("_stratum", F.concat_ws("-", *[F.col(c).cast("string") for c in strata])).withColumn("_u", u)
    n = s.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"))
    rt = running_totals(s, [F.col("_u").asc(), F.col(key).asc()], {}, ("_stratum",))
    num = int(round(test_frac * 1000))
    j = rt.join(n, "_stratum").withColumn(
        "is_test", F.col("pos") <= F.expr(f"(_n * {num} + 999) div 1000"))
    return j.drop("_stratum", "_u", "_n", "pos")
