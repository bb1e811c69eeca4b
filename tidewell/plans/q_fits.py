"""Registered plans with iterative fits (Spark ML estimators, batched Lloyd):
no SQL oracle — checked for rows and by invariants in tests/."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.ratios import round_half
from tidewell.operators import budget as bud
from tidewell.operators import evaluation as ev
from tidewell.operators import models as M
from tidewell.operators import segmentation as seg
from tidewell.plans.layers import round_doubles
from tidewell.plans.registry import register


@register("logistic_baseline")
def logistic_baseline(p):
    """Imputed, scaled, class-balanced L2 logistic regression scores."""
    return M.logistic_baseline(p.features_train, p.features_test, p.pp)


@register("gbm_raw")
def gbm_raw(p):
    """P5: boosted trees with early stopping, raw probabilities."""
    return M.gbm_raw(p.features_train, p.features_test, p.pp)


@register("gbm_rounds")
def gbm_rounds(p):
    """P5: held-out loss after each boosting round and the rounds kept."""
    return M.boosting_rounds(p.features_train, p.pp)


@register("isotonic_calibration")
def isotonic_calibration(p):
    """Five-fold isotonic-calibrated boosted-tree ensemble."""
    return M.gbm_calibrated(p.features_train, p.features_test, p.pp, p.calibrated_ensemble)


@register("permutation_importance")
def permutation_importance(p):
    """AUC drop per permuted feature (mean, population std over repeats)."""
    return M.permutation_importance(p.features_train, p.features_test, p.pp, fitted=p.calibrated_ensemble)


@register("propensity_scores")
def propensity_scores(p):
    """Customer, baseline score, calibrated score, label."""
    return M.propensity_scores(p.features_train, p.features_test, p.pp, p.calibrated_ensemble)


@register("model_metrics")
def model_metrics(p):
    """P8–P10 on the fitted models' test scores, one grouped job."""
    b = M.logistic_baseline(p.features_train, p.features_test, p.pp).withColumn("model", F.lit("baseline"))
    g = M.gbm_raw(p.features_train, p.features_test, p.pp).withColumn("model", F.lit("gbm_raw"))
    c = M.gbm_calibrated(p.features_train, p.features_test, p.pp, p.calibrated_ensemble).withColumn(
        "model", F.lit("gbm_calibrated"))
    long = b.unionByName(g).unionByName(c)
    from tidewell.operators.reports import model_comparison
    return model_comparison(long)


@register("t_learner")
def t_learner(p):
    """treated/control boosted trees, uplift on the stratified test split (stored)."""
    return p.fitted_uplift


@register("t_learner_qini")
def t_learner_qini(p):
    """U3/U4 on the fitted T-learner's uplift."""
    return round_doubles(ev.qini_coefficient(ev.qini_curve(p.fitted_uplift)))


@register("t_learner_qini_curve")
def t_learner_qini_curve(p):
    """U3 on the fitted T-learner's uplift."""
    return round_doubles(ev.qini_curve(p.fitted_uplift))


@register("t_learner_deciles")
def t_learner_deciles(p):
    """U5 on the fitted T-learner's uplift."""
    return round_doubles(ev.uplift_by_decile(p.fitted_uplift))


@register("kmeans_fit")
def kmeans_fit(p):
    """Best-of-restarts k-means labels (batched Lloyd)."""
    labels, _ = M.kmeans_fit(p.features_current, p.sp)
    return labels.select("customer_id", "cluster")


@register("k_sweep")
def k_sweep(p):
    """Inertia and silhouette for k = 2..10."""
    return M.k_sweep(p.features_current, p.sp)


@register("stability_reseed")
def stability_reseed(p):
    """ARI of reseeded refits vs the reference labelling (mean, min)."""
    return M.stability_summary(M.stability_reseed(p.features_current, p.kmeans_labels, p.sp))


@register("stability_subsample")
def stability_subsample(p):
    """ARI on 80% subsamples without replacement; stable iff mean ≥ 0.85."""
    return M.stability_summary(M.stability_subsample(p.features_current, p.kmeans_labels, p.sp),
                               p.sp.ari_threshold)


@register("kmeans_segments")
def kmeans_segments(p):
    """G9–G12 on the fitted k-means labels: named profile per cluster."""
    return seg.segment_profiles(p.features_current, p.kmeans_labels)


# ---------------------------------------------------------------- probabilistic LTV
def _rf(p):
    from tidewell.operators.metrics import rf_summary
    return rf_summary(p.silver, p.cutoffs.t_test).cache()


@register("bgnbd_fit")
def bgnbd_fit(p):
    """BG/NBD parameters by distributed maximum likelihood (ridge 0.01)."""
    from tidewell.operators import ltv
    return ltv.bgnbd_fit(_rf(p))


@register("gamma_gamma_fit")
def gamma_gamma_fit(p):
    """Gamma-Gamma spend parameters on repeat customers (ridge 0.01)."""
    from tidewell.operators import ltv
    return ltv.gamma_gamma_fit(_rf(p))


@register("clv")
def clv(p):
    """12 × 30-day expected spend per customer from M10 × M11, clipped at 0."""
    from tidewell.operators import ltv
    rf = _rf(p)
    return ltv.clv(rf, ltv.bgnbd_fit(rf), ltv.gamma_gamma_fit(rf), p.mp.ltv_horizon_months)


@register("ltv_table_probabilistic")
def ltv_table_probabilistic(p):
    """LTV table on the probabilistic path (heuristic when the fit is unusable)."""
    return p.fitted_ltv


@register("channel_metrics_fitted")
def channel_metrics_fitted(p):
    """M14 on the stored probabilistic LTV."""
    return p.fitted_channel_table


@register("channel_segment_metrics_fitted")
def channel_segment_metrics_fitted(p):
    """M15 on the stored probabilistic LTV."""
    from tidewell.operators import metrics as met
    return met.channel_segment_metrics(p.features_current, p.attribution, p.segments, p.fitted_ltv, p.window_rev)


@register("response_curves_fitted")
def response_curves_fitted(p):
    """B3 on the stored calibrated scores and probabilistic LTV."""
    return bud.response_curves(p.fitted_hill, p.bp).withColumn("conversions", round_half(F.col("conversions"), 6))


@register("model_budget_allocation")
def model_budget_allocation(p):
    """B2 + B4 on the stored calibrated scores (the fitted-model path of the simulator)."""
    return bud.budget_allocation(p.fitted_hill, p.bp)


@register("bootstrap_allocation_fitted")
def bootstrap_allocation_fitted(p):
    """B5 on the stored calibrated scores."""
    return round_doubles(bud.bootstrap_allocation(p.fitted_scored_attribution, p.fitted_channel_table, p.bp))


@register("allocation_quantiles_fitted")
def allocation_quantiles_fitted(p):
    """B6 on the stored calibrated scores."""
    return round_doubles(bud.allocation_quantiles(
        bud.bootstrap_allocation(p.fitted_scored_attribution, p.fitted_channel_table, p.bp)))
