"""Probabilistic lifetime value (M10–M12): BG/NBD, Gamma-Gamma, 12-month CLV.

The day-grain summary (M9) is compressed to its distinct sufficient
statistics with counts — an exact ``groupBy`` — and cached.  The
log-likelihood of a *batch* of candidate parameter vectors is evaluated by
one ``mapInPandas`` job that emits per-partition partial sums; the driver
only runs the optimiser over those few numbers (quasi-Newton with
central-difference gradients and a batched line search, so each iteration
is two jobs).  CLV is an Arrow-batched pandas UDF over the customer rows.
Time is rescaled to max(T) = 10 for the BG/NBD fit, as is customary.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Lanczos approximation (g = 7, n = 9): standard published coefficients.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
            -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
            1.5056327351493116e-7)


def lgamma(x):
    """log Γ(x) for x > 0, vectorised (numpy has no gammaln without scipy)."""
    x = np.asarray(x, dtype=float)
    small = x < 0.5
    z = np.where(small, 1.0 - x, x) - 1.0
    acc = np.full_like(z, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        acc = acc + c / (z + i)
    t = z + 7.5
    val = 0.5 * math.log(2 * math.pi) + (z + 0.5) * np.log(t) - t + np.log(acc)
    refl = math.log(math.pi) - np.log(np.abs(np.sin(math.pi * x))) - val
    return np.where(small, refl, val)


def hyp2f1(a, b, c, z, tol: float = 1e-14, limit: int = 5_000_000):
    """Gauss series F(a, b; c; z) for 0 <= z < 1, vectorised: every element is
    summed until its own terms vanish.  An element that does not get there
    within ``limit`` terms is an error, not a result."""
    a, b, c, z = (np.array(v, dtype=float).ravel() for v in np.broadcast_arrays(a, b, c, z))
    total = np.ones_like(z)
    term = np.ones_like(z)
    live = np.flatnonzero(np.isfinite(a + b + c + z))
    total[~np.isfinite(a + b + c + z)] = np.nan
    n = 0
    while len(live):
        if n >= limit or not np.all(z[live] < 1):
            raise ArithmeticError("the hypergeometric series does not converge")
        ratio = (a[live] + n) * (b[live] + n) / ((c[live] + n) * (n + 1)) * z[live]
        term[live] *= ratio
        total[live] += term[live]
        n += 1
        # terms fall once their ratio is below 1; the rest is then at most term / (1 - ratio)
        small = (np.abs(ratio) < 1) & (np.abs(term[live]) <= tol * np.abs(total[live]) * (1 - np.abs(ratio)))
        live = live[~(small | (term[live] == 0))]
    return total


# ---------------------------------------------------------------- likelihoods
def bgnbd_ll(params: np.ndarray, x, tx, T):
    """Per-row log-likelihood of the BG/NBD model (Fader, Hardie and Lee 2005,
    equation 6) for (r, alpha, a, b), written as that of a customer certainly
    alive times one plus the odds of having left after the last purchase."""
    r, alpha, a, b = params
    purchases = lgamma(r + x) - lgamma(r) + r * np.log(alpha) - (r + x) * np.log(alpha + T)
    stayed = lgamma(b + x) + lgamma(a + b) - lgamma(b) - lgamma(a + b + x)
    left_odds = np.where(x > 0, np.log(a) - np.log(b + np.maximum(x, 1) - 1)
                         + (r + x) * np.log((alpha + T) / (alpha + tx)), -np.inf)
    return purchases + stayed + np.logaddexp(0.0, left_odds)


def gamma_gamma_ll(params: np.ndarray, x, m):
    """Per-row Gamma-Gamma log-likelihood for params (p, q, v)."""
    p, q, v = params
    return (lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * np.log(v) + (p * x - 1) * np.log(m)
            + (p * x) * np.log(x) - (p * x + q) * np.log(x * m + v))


def _batch_objective(stats: DataFrame, cols: list[str], ll_fn, penalizer: float):
    """Returns f(batch of log-param vectors) -> array of penalised mean
    negative log-likelihoods, one distributed job per batch."""
    from tidewell.session import ship_package
    ship_package(stats.sparkSession)

    def evaluate(log_batch: np.ndarray) -> np.ndarray:
        cand = np.exp(np.asarray(log_batch, dtype=float))

        def part(it):
            ll = np.zeros(len(cand))
            invalid = np.zeros(len(cand), dtype=np.int64)
            wsum = 0.0
            for pdf in it:
                w = pdf["w"].to_numpy(dtype=float)
                args = [pdf[c].to_numpy(dtype=float) for c in cols]
                wsum += w.sum()
                for i, pr in enumerate(cand):
                    with np.errstate(all="ignore"):
                        rows = ll_fn(pr, *args)
                    fine = np.isfinite(rows)
                    invalid[i] += int((~fine).sum())
                    ll[i] += float(np.sum(w[fine] * rows[fine]))
            yield pd.DataFrame({"cand": np.arange(len(cand)), "ll": ll, "w": np.full(len(cand), wsum),
                                "invalid": invalid})

        res = (stats.mapInPandas(part, "cand long, ll double, w double, invalid long")
               .groupBy("cand").agg(F.sum("ll").alias("ll"), F.sum("w").alias("w"), F.sum("invalid").alias("invalid"))
               .collect())
        out = np.full(len(cand), np.inf)
        for r in res:
            # a candidate outside its domain on any row is no candidate
            if r["invalid"] or not r["w"]:
                continue
            val = -r["ll"] / r["w"] + penalizer * float(np.sum(cand[r["cand"]] ** 2))
            out[r["cand"]] = val if np.isfinite(val) else np.inf
        return out
    return evaluate


def minimise(f_batch, x0: np.ndarray, max_iter: int = 500, gtol: float = 1e-6, h: float = 1e-5):
    """Quasi-Newton (BFGS) on a batched objective: per iteration one job for
    the value and central-difference gradient, one job for a line search
    over a ladder of step lengths.  Returns (x, f(x), iterations, converged):
    converged when the gradient or the gain has vanished."""
    x = np.asarray(x0, dtype=float)
    n = len(x)
    H = np.eye(n)

    def val_grad(xv):
        pts = [xv] + [xv + h * e for e in np.eye(n)] + [xv - h * e for e in np.eye(n)]
        v = f_batch(np.array(pts))
        return v[0], (v[1:n + 1] - v[n + 1:]) / (2 * h)

    fx, g = val_grad(x)
    steps = np.array([2.0 ** -k for k in range(-2, 12)])
    for it in range(max_iter):
        if not (np.isfinite(fx) and np.all(np.isfinite(g))):
            return x, fx, it, False
        if np.max(np.abs(g)) < gtol:
            return x, fx, it, True
        d = -H @ g
        if g @ d >= 0:  # not a descent direction: reset to steepest descent
            H = np.eye(n)
            d = -g
        vals = f_batch(np.array([x + s * d for s in steps]))
        ok = vals <= fx + 1e-4 * steps * (g @ d)
        if not ok.any():
            # no step gains: at the noise of the differences, unless the slope is still steep
            return x, fx, it, bool(np.max(np.abs(g)) < 1e-3)
        s = steps[np.argmin(np.where(ok, vals, np.inf))]
        x_new = x + s * d
        f_new, g_new = val_grad(x_new)
        sk, yk = x_new - x, g_new - g
        if yk @ sk > 1e-12:
            rho = 1.0 / (yk @ sk)
            I = np.eye(n)
            H = (I - rho * np.outer(sk, yk)) @ H @ (I - rho * np.outer(yk, sk)) + rho * np.outer(sk, sk)
        gain = abs(fx - f_new)
        x, fx, g = x_new, f_new, g_new
        if gain < 1e-12 * max(1.0, abs(fx)):
            return x, fx, it + 1, True
    return x, fx, max_iter, False


# rows of sufficient statistics that one task takes
STATS_ROWS = 50_000


def _sized(stats: DataFrame) -> DataFrame:
    """Compressed statistics, cached in as many partitions as their rows need
    (each evaluation is one task per partition)."""
    cached = stats.cache()
    n = -(-cached.count() // STATS_ROWS)
    return cached.coalesce(max(1, n))


# ---------------------------------------------------------------- fits
def bgnbd_fit(rf: DataFrame, penalizer: float = 0.01) -> DataFrame:
    """BG/NBD maximum likelihood on the compressed (x, t_x, T) table.
    Returns one row: r, alpha, a, b, neg_log_likelihood, rows."""
    spark = rf.sparkSession
    max_t = rf.agg(F.max("T")).first()[0]
    scale = 10.0 / max_t if max_t else 1.0
    stats = (rf.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("w"))
             .select(F.col("frequency").cast("double").alias("x"), (F.col("recency") * scale).alias("tx"),
                     (F.col("T") * scale).alias("T"), F.col("w").cast("double").alias("w")))
    from tidewell.session import static_plans
    sized = _sized(stats)
    f = _batch_objective(sized, ["x", "tx", "T"], bgnbd_ll, penalizer)
    with static_plans(spark):
        x, fx, steps, converged = minimise(f, np.full(4, 0.1))
    r, alpha, a, b = np.exp(x)
    rows = sized.agg(F.sum("w")).first()[0] or 0
    stats.unpersist()
    # with a or b next to 0 nobody (or everybody) leaves, and only their limit is known
    identified = bool(min(a, b) > 1e-6)
    return spark.createDataFrame(
        [(float(r), float(alpha / scale), float(a), float(b), float(fx), int(rows), int(steps), converged, identified)],
        "r double, alpha double, a double, b double, neg_log_likelihood double, rows long, iterations int, "
        "converged boolean, identified boolean")


def gamma_gamma_fit(rf: DataFrame, penalizer: float = 0.01) -> DataFrame:
    """Gamma-Gamma spend model on repeat customers (frequency > 0)."""
    spark = rf.sparkSession
    stats = (rf.filter((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
             .groupBy("frequency", "monetary_value").agg(F.count(F.lit(1)).alias("w"))
             .select(F.col("frequency").cast("double").alias("x"), F.col("monetary_value").alias("m"),
                     F.col("w").cast("double").alias("w")))
    from tidewell.session import static_plans
    sized = _sized(stats)
    f = _batch_objective(sized, ["x", "m"], gamma_gamma_ll, penalizer)
    with static_plans(spark):
        x, fx, steps, converged = minimise(f, np.full(3, 0.1))
    p, q, v = np.exp(x)
    rows = sized.agg(F.sum("w")).first()[0] or 0
    stats.unpersist()
    return spark.createDataFrame([(float(p), float(q), float(v), float(fx), int(rows), int(steps), converged)],
                                 "p double, q double, v double, neg_log_likelihood double, rows long, "
                                 "iterations int, converged boolean")


def expected_purchases(t, x, tx, T, r, alpha, a, b):
    """BG/NBD conditional expected purchases in (T, T + t] (Fader, Hardie and
    Lee 2005, equation 10).  With z = t / (alpha + T + t), Euler's
    transformation turns the paper's (1 - z)^(r + x) F(r + x, b + x; c; z)
    into (1 - z)^(a - 1) F(a - 1, a + b - 1 - r; c; z), c = a + b + x - 1,
    whose series has small parameters and falls fast."""
    if np.isscalar(t) and t == 0:
        return np.zeros_like(np.asarray(x, dtype=float))
    z = t / (alpha + T + t)
    c = a + b + x - 1
    stays = (1 - z) ** (a - 1) * hyp2f1(a - 1, a + b - 1 - r, c, z)
    left_odds = np.where(x > 0, a / (b + np.maximum(x, 1) - 1) * ((alpha + T) / (alpha + tx)) ** (r + x), 0.0)
    return c / (a - 1) * (1 - stays) / (1 + left_odds)


def clv(rf: DataFrame, bg: DataFrame, gg: DataFrame, months: int = 12, discount: float = 0.0) -> DataFrame:
    """Expected spend over ``months`` steps of 30 days (M12): Σ steps of
    expected purchases in the step × conditional expected order value,
    clipped at 0.  The fitted parameters (7 numbers) travel in the closure."""
    from tidewell.session import ship_package
    ship_package(rf.sparkSession)
    b = bg.first()
    g = gg.first()
    r, alpha, a, bb = b["r"], b["alpha"], b["a"], b["b"]
    p, q, v = g["p"], g["q"], g["v"]

    @F.pandas_udf(DoubleType())
    def _clv(x: pd.Series, tx: pd.Series, T: pd.Series, m: pd.Series) -> pd.Series:
        x, tx, T, m = (s.to_numpy(dtype=float) for s in (x, tx, T, m))
        w = p * x / (p * x + q - 1)
        value = (1 - w) * (v * p / (q - 1)) + w * m
        total = np.zeros_like(x)
        for i in range(1, months + 1):
            t = 30.0 * i
            n = expected_purchases(t, x, tx, T, r, alpha, a, bb) - expected_purchases(t - 30.0, x, tx, T, r, alpha, a, bb)
            total += value * n / (1 + discount) ** i
        return pd.Series(np.clip(total, 0, None))

    return rf.select("customer_id", _clv("frequency", "recency", "T", "monetary_value").alias("ltv_probabilistic"))


def fits_usable(bg: DataFrame, gg: DataFrame) -> bool:
    """The expectations divide by a - 1 (BG/NBD) and q - 1 (Gamma-Gamma): a
    fit with non-finite estimates, or at one of these poles, has none."""
    b, g = bg.first(), gg.first()
    vals = [b["r"], b["alpha"], b["a"], b["b"], g["p"], g["q"], g["v"]]
    return bool(np.all(np.isfinite(vals))) and b["a"] != 1 and g["q"] != 1


def probabilistic_ltv_table(fact: DataFrame, features: DataFrame, as_of, params=None, penalizer: float = 0.01):
    """M13 with the probabilistic path: fit M10/M11 on the day-grain summary,
    score M12, and fall back to the heuristic when a fit or the scoring fails
    for whatever reason (the reference's rule), which ``fallback_reason`` says."""
    from tidewell.operators.metrics import ltv_table, rf_summary
    from tidewell.params import MetricsParams
    from tidewell.session import ensure_checkpoint_dir
    params = params or MetricsParams()

    def heuristic(reason: str) -> DataFrame:
        return ltv_table(features, None, params).withColumn("fallback_reason", F.lit(reason))

    try:
        ensure_checkpoint_dir(fact.sparkSession)
        rf = rf_summary(fact, as_of).checkpoint()
        bg, gg = bgnbd_fit(rf, penalizer), gamma_gamma_fit(rf, penalizer)
        if not fits_usable(bg, gg):
            return heuristic("estimates not finite or at a pole")
        # scored here, so that a failing row falls back as a failing fit does
        scored = clv(rf, bg, gg, params.ltv_horizon_months).checkpoint()
    except Exception as exc:  # noqa: BLE001
        return heuristic(f"{type(exc).__name__}: {str(exc)[:200]}")
    return ltv_table(features, scored, params).withColumn("fallback_reason", F.lit(None).cast("string"))
