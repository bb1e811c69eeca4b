"""The iterative fits, held against their own definitions on the stored rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import ltv, models, propensity, segmentation
from tidewell.operators.metrics import rf_summary
from tidewell.params import FEATURE_COLUMNS
from tidewell.plans.layers import Layers


@pytest.fixture(scope="module")
def layers(spark, smoke_dir):
    return Layers(spark, smoke_dir)


def test_kmeans_labels_are_nearest_centres_and_inertia_is_their_sum(layers):
    labels, summary = models.kmeans_fit(layers.features_current, layers.sp)
    rows = labels.collect()
    x = np.array([[r[c] for c in segmentation.RFM_FEATURES] for r in rows])
    mine = np.array([r.cluster for r in rows])
    ks = sorted(set(mine))
    assert len(ks) == layers.sp.chosen_k and len(rows) == layers.features_current.count()
    centres = np.array([x[mine == k].mean(axis=0) for k in ks])
    far = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    s = summary.first()
    assert s.converged
    own = far[np.arange(len(x)), np.searchsorted(ks, mine)]
    # converged to the tolerance on the centres' shift: a point on a border may be as near to another
    assert (own <= far.min(axis=1) + 1e-2).all()
    assert s.inertia == pytest.approx(own.sum(), rel=1e-4)
    # and no worse than plain Lloyd from many random starts
    rnd, best = np.random.default_rng(0), np.inf
    for _ in range(20):
        c = x[rnd.choice(len(x), len(ks), replace=False)]
        for _ in range(60):
            near = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(ks))])
        best = min(best, ((x - c[near]) ** 2).sum())
    assert s.inertia <= best * 1.05


def test_reseeded_and_subsampled_scores_follow_from_labels(layers):
    again = models.stability_reseed(layers.features_current, layers.kmeans_labels, layers.sp).collect()
    assert len(again) == layers.sp.reseed_runs and all(-1 <= r.ari <= 1 + 1e-9 for r in again)
    part = models.stability_summary(models.stability_subsample(layers.features_current, layers.kmeans_labels, layers.sp),
                                    layers.sp.ari_threshold).first()
    assert part.runs == layers.sp.subsample_runs and part.ari_min <= part.ari_mean
    assert part.stable == (part.ari_mean >= layers.sp.ari_threshold)


def bgnbd_loss(p, rows, penalty):
    """The penalised mean negative log-likelihood by the paper's terms, row by row."""
    r, alpha, a, b = p
    total = 0.0
    for x, tx, big_t in rows:
        first = (math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b) + math.lgamma(b + x)
                 - math.lgamma(b) - math.lgamma(a + b + x))
        alive = -(r + x) * math.log(alpha + big_t)
        left = math.log(a) - math.log(b + x - 1) - (r + x) * math.log(alpha + tx) if x > 0 else -math.inf
        top = max(alive, left)
        total += first + top + math.log(math.exp(alive - top) + math.exp(left - top))
    return -total / len(rows) + penalty * sum(v * v for v in p)


def test_bgnbd_objective_at_the_returned_parameters(layers):
    rf = rf_summary(layers.silver, layers.cutoffs.t_test)
    fit = ltv.bgnbd_fit(rf).first()
    raw = [(r.frequency, r.recency, r["T"]) for r in rf.collect()]
    scale = 10.0 / max(t for _, _, t in raw)
    rows = [(x, tx * scale, t * scale) for x, tx, t in raw]
    at = np.array([fit.r, fit.alpha * scale, fit.a, fit.b])
    assert fit.converged and fit.rows == len(rows)
    assert bgnbd_loss(at, rows, 0.01) == pytest.approx(fit.neg_log_likelihood, rel=1e-9)
    for k in range(4):
        for step in (0.9, 1.1):
            other = at.copy()
            other[k] *= step
            assert bgnbd_loss(other, rows, 0.01) >= fit.neg_log_likelihood - 1e-9


def test_gamma_gamma_objective_at_the_returned_parameters(layers):
    rf = rf_summary(layers.silver, layers.cutoffs.t_test)
    fit = ltv.gamma_gamma_fit(rf).first()
    rows = [(r.frequency, r.monetary_value) for r in rf.collect() if r.frequency > 0 and r.monetary_value > 0]

    def loss(p):
        p_, q, v = p
        total = sum(math.lgamma(p_ * x + q) - math.lgamma(p_ * x) - math.lgamma(q) + q * math.log(v) + (p_ * x - 1) * math.log(m)
                    + p_ * x * math.log(x) - (p_ * x + q) * math.log(x * m + v) for x, m in rows)
        return -total / len(rows) + 0.01 * sum(t * t for t in p)

    at = np.array([fit.p, fit.q, fit.v])
    assert fit.converged and fit.rows == len(rows)
    assert loss(at) == pytest.approx(fit.neg_log_likelihood, rel=1e-9)
    for k in range(3):
        for step in (0.9, 1.1):
            other = at.copy()
            other[k] *= step
            assert loss(other) >= fit.neg_log_likelihood - 1e-9


def test_logistic_scores_minimise_the_weighted_penalised_loss(layers):
    """The scores of P4 are those of the optimum that a plain Newton search finds."""
    def matrix(df, med):
        rows = propensity.median_impute(propensity.prepare_features(df), med).orderBy("customer_id").collect()
        return ([r.customer_id for r in rows], np.array([[float(r[c]) for c in FEATURE_COLUMNS] for r in rows]),
                np.array([float(r.target_conversion) for r in rows]))

    med = propensity.training_medians(propensity.prepare_features(layers.features_train))
    _, x, y = matrix(layers.features_train, med)
    ids, xt, _ = matrix(layers.features_test, med)
    mean, std = x.mean(axis=0), x.std(axis=0)
    std[std == 0] = 1.0
    a, b = np.c_[(x - mean) / std, np.ones(len(x))], np.c_[(xt - mean) / std, np.ones(len(xt))]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    ridge = np.r_[np.ones(len(FEATURE_COLUMNS)), 0.0]
    beta = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ beta))
        gradient = a.T @ (w * (p - y)) + ridge * beta
        beta -= np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + np.diag(ridge), gradient)
    want = dict(zip(ids, 1 / (1 + np.exp(-b @ beta))))
    got = {r.customer_id: r.score for r in models.logistic_baseline(layers.features_train, layers.features_test, layers.pp).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in got) < 2e-3


def test_calibrated_scores_rise_with_no_score_out_of_range(layers):
    rows = layers.fitted_scores.select(F.min("score"), F.max("score"), F.count("*"), F.count_distinct("customer_id")).first()
    assert 0 <= rows[0] <= rows[1] <= 1 and rows[2] == rows[3] == layers.features_test.count()
