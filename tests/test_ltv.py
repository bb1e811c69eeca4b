"""Probabilistic LTV (M10–M12): special functions and parameter recovery."""
import math

import numpy as np
import pytest

from tidewell.operators import ltv


def test_lgamma_and_hyp2f1():
    xs = np.array([0.05, 0.5, 1.0, 3.3, 42.0, 500.0])
    assert np.allclose(ltv.lgamma(xs), [math.lgamma(v) for v in xs], atol=1e-10)
    z = np.array([0.1, 0.5, 0.9])
    assert np.allclose(ltv.hyp2f1(1.0, 1.0, 2.0, z), -np.log(1 - z) / z, rtol=1e-10)


def simulate_bgnbd(n, r, alpha, a, b, T, seed=0):
    rnd = np.random.default_rng(seed)
    lam = rnd.gamma(r, 1.0 / alpha, n)
    p = rnd.beta(a, b, n)
    rows = []
    for i in range(n):
        t, x, tx, alive = 0.0, 0, 0.0, True
        while alive:
            t += rnd.exponential(1.0 / lam[i])
            if t > T:
                break
            x, tx = x + 1, t
            alive = rnd.random() > p[i]
        rows.append((str(i), x, float(tx), float(T), 10.0 if x else 0.0))
    return rows


def test_bgnbd_recovers_parameters(spark):
    rows = simulate_bgnbd(3000, r=0.8, alpha=4.0, a=2.0, b=4.0, T=40.0)
    rf = spark.createDataFrame(rows, "customer_id string, frequency long, recency double, T double, monetary_value double")
    fit = ltv.bgnbd_fit(rf, penalizer=0.0).first()
    assert fit.r == pytest.approx(0.8, rel=0.3)
    assert fit.alpha == pytest.approx(4.0, rel=0.35)
    # expected purchases are finite and non-negative for every customer
    x = np.array([r[1] for r in rows], float)
    tx = np.array([r[2] for r in rows])
    e = ltv.expected_purchases(30.0, x, tx, np.full_like(x, 40.0), fit.r, fit.alpha, fit.a, fit.b)
    assert np.all(np.isfinite(e)) and np.all(e >= -1e-9)


def test_hypergeometric_series():
    z = np.array([0.0, 0.3, 0.9, 0.999])
    assert ltv.hyp2f1(1, 1, 2, z)[1:] == pytest.approx(-np.log1p(-z[1:]) / z[1:], rel=1e-10)
    assert ltv.hyp2f1(2.5, 1, 1, z) == pytest.approx((1 - z) ** -2.5, rel=1e-9)
    with pytest.raises(ArithmeticError):
        ltv.hyp2f1(1, 1, 2, np.array([1.0]))


def test_expected_purchases_is_the_papers_formula():
    x, tx, T = np.array([0.0, 2, 9]), np.array([0.0, 30, 200]), np.array([90.0, 80, 210])
    r, al, a, b, t = .3, 5.0, 1.7, 2.4, 40.0
    z = t / (al + T + t)
    want = (a + b + x - 1) / (a - 1) * (1 - ((al + T) / (al + T + t)) ** (r + x) * ltv.hyp2f1(r + x, b + x, a + b + x - 1, z))
    want = want / (1 + (x > 0) * a / (b + np.maximum(x, 1) - 1) * ((al + T) / (al + tx)) ** (r + x))
    assert ltv.expected_purchases(t, x, tx, T, r, al, a, b) == pytest.approx(want, rel=1e-10)


def test_invalid_rows_disqualify_a_candidate(spark):
    """One partition is outside the candidate's domain: the candidate is worth nothing, not more."""
    df = spark.createDataFrame([(1.0, 1.0), (-5.0, 1.0)], "x double, w double").repartition(2, "x")
    f = ltv._batch_objective(df, ["x"], lambda p, x: np.log(x) * p[0] - 5, 0.0)
    assert np.isinf(f(np.array([[0.0]]))).all()
    g = ltv._batch_objective(df, ["x"], lambda p, x: -x * p[0], 0.0)
    assert np.isfinite(g(np.array([[0.0]]))).all()


def test_same_objective_at_1_and_32_partitions(spark):
    from tidewell.operators.metrics import rf_summary
    from tidewell.plans.layers import Layers
    p = Layers(spark, "/root/testdata/sf0.001")
    rf = rf_summary(p.silver, p.cutoffs.t_test).checkpoint()
    a, b = (ltv.bgnbd_fit(rf.repartition(n)).first() for n in (1, 32))
    assert a.neg_log_likelihood == pytest.approx(b.neg_log_likelihood, rel=1e-9) and a.converged and b.converged


def test_any_failure_falls_back(spark, monkeypatch):
    from tidewell.plans.layers import Layers
    p = Layers(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(ltv, "bgnbd_fit", lambda *a, **k: (_ for _ in ()).throw(TypeError("anything")))
    out = ltv.probabilistic_ltv_table(p.silver, p.features_test, p.cutoffs.t_test)
    assert out.count() == p.features_test.count()
