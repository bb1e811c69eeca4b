"""Invariants for the fit-based plans (no SQL oracle): run on sf0.001."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E


def run(spark, smoke_dir, name):
    return E.queries()[name](spark, smoke_dir)


@pytest.mark.parametrize("name", ["logistic_baseline", "gbm_raw", "isotonic_calibration"])
def test_scores_are_probabilities(spark, smoke_dir, name):
    df = run(spark, smoke_dir, name)
    st = df.agg(F.min("score"), F.max("score"), F.count("*"), F.count_distinct("customer_id")).first()
    assert 0.0 <= st[0] <= st[1] <= 1.0 and st[2] == st[3] > 0


def test_k_sweep_inertia_non_increasing(spark, smoke_dir):
    rows = sorted(run(spark, smoke_dir, "k_sweep").collect(), key=lambda r: r.k)
    assert [r.k for r in rows] == list(range(2, 11))
    inert = [r.inertia for r in rows]
    assert all(b <= a * 1.02 for a, b in zip(inert, inert[1:]))  # best-of-restarts, small tolerance
    assert all(-1.0 <= r.silhouette <= 1.0 for r in rows)


def test_stability_reseed_range(spark, smoke_dir):
    r = run(spark, smoke_dir, "stability_reseed").first()
    assert r.runs == 20 and -1.0 <= r.ari_min <= r.ari_mean <= 1.0


def test_t_learner_uplift_is_difference(spark, smoke_dir):
    df = run(spark, smoke_dir, "t_learner")
    bad = df.filter(F.abs(F.col("uplift") - (F.col("p_treated") - F.col("p_control"))) > 1e-12).count()
    assert bad == 0 and df.count() > 0


def test_probabilistic_ltv_non_negative(spark, smoke_dir):
    df = run(spark, smoke_dir, "ltv_table_probabilistic")
    assert df.filter(F.col("ltv_probabilistic") < 0).count() == 0
    assert {r.ltv_method for r in df.select("ltv_method").distinct().collect()} <= {"bgnbd_gamma_gamma",
                                                                                    "heuristic_fallback"}


def test_permutation_importance_covers_features(spark, smoke_dir):
    rows = run(spark, smoke_dir, "permutation_importance").collect()
    assert len(rows) == 10 and all(r.importance_std >= 0 for r in rows)


def test_stored_ensemble_scores_like_a_fresh_fit(spark, smoke_dir):
    from tidewell.operators import models as M
    from tidewell.plans.layers import Layers
    p = Layers(spark, smoke_dir)
    fresh = M.gbm_calibrated(p.features_train, p.features_test, p.pp).withColumnRenamed("score", "a")
    stored = M.gbm_calibrated(p.features_train, p.features_test, p.pp, p.calibrated_ensemble)
    j = fresh.join(stored.withColumnRenamed("score", "b"), ["customer_id", "label"])
    assert j.count() == fresh.count() and j.filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_patience_outlasts_a_noisy_curve():
    from tidewell.operators.models import patient_stop
    noisy = [1.0, 0.9, 0.95, 0.93, 0.8, 0.85, 0.84, 0.83]
    assert patient_stop(noisy, 3, 1e-7) == (5, True)
    assert patient_stop(noisy, 2, 1e-7) == (2, True)
    assert patient_stop(noisy[:5], 3, 1e-7) == (5, False)
    assert patient_stop([1.0, 1.0 - 1e-9, 1.0 - 2e-9], 2, 1e-7) == (1, True)
    assert patient_stop([], 3, 0.0) == (0, False)


def test_boosting_keeps_the_best_round(spark):
    """A label with a signal: many rounds, and the kept trees are the first of a longer fit."""
    from tidewell.operators import models as M
    from tidewell.params import FEATURE_COLUMNS, PropensityParams
    cols = [F.lit(1.0).alias(c) if c not in ("recency_days", "frequency") else
            F.expr(f"pmod(hash(id, '{c}'), 1000) / 1000.0").alias(c) for c in FEATURE_COLUMNS]
    df = spark.range(1500).select(F.col("id").cast("string").alias("customer_id"), *cols, F.lit(0.0).alias("gap_missing"))
    df = df.withColumn("target_conversion", (F.sin(F.col("recency_days") * 9) + F.col("frequency") * 2
                                             + F.expr("pmod(hash(customer_id, 'n'), 100) / 90.0") > 1.6).cast("int"))
    params = PropensityParams(gbm_max_iter=60, gbm_max_depth=3, gbm_patience=4)
    curve = []
    va, model = M.fit_gbm(df, params, curve=curve)
    kept, _ = M.patient_stop(curve, params.gbm_patience, params.gbm_tol)
    assert model.getNumTrees == kept > params.gbm_patience + 2
    assert len(curve) == 60 or len(curve) >= kept + params.gbm_patience
    rows = va.transform(M._holdout(df, params.gbm_validation_fraction, params.seed, "val").filter("not is_val").withColumn(
        "label", F.col("target_conversion").cast("double"))).select("features", "label")
    longer = M._gbt(params, 0, kept + 3).fit(rows)
    # the first line of a tree's text names its object
    assert all(a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]
               for a, b in zip(longer.trees, model.trees))


def test_permutations_swap_one_feature_at_a_time(spark):
    from tidewell.operators import models as M
    feats = ["a", "b", "c"]
    df = spark.range(40).select(F.format_string("c%03d", "id").alias("customer_id"), *[
        (F.col("id") * (k + 1)).cast("double").alias(c) for k, c in enumerate(feats)])
    out = M.permuted_features(df, feats, 2, 7)
    rows = out.collect()
    assert len(rows) == 40 * 3 * 2
    own = {r.customer_id: r for r in df.collect()}
    donor = {}
    for r in rows:
        for k, c in enumerate(feats):
            if c == r.feature:
                # the same donor for all features of a repeat
                assert donor.setdefault((r.repeat, r.customer_id), r[c] / (k + 1)) == r[c] / (k + 1)
            else:
                assert r[c] == own[r.customer_id][c]
    for rep in (0, 1):
        assert sorted(d for (q, _), d in donor.items() if q == rep) == [float(i) for i in range(40)]
    assert [donor[0, f"c{i:03d}"] for i in range(40)] != [donor[1, f"c{i:03d}"] for i in range(40)]


def test_boosted_fits_take_tasks_by_their_rows(spark, monkeypatch):
    """However many partitions the frame comes in, a task takes FIT_ROWS of its rows and no row is lost."""
    from tidewell.operators import models as M
    from tidewell.params import FEATURE_COLUMNS, PropensityParams
    df = spark.range(900).select(F.col("id").cast("string").alias("customer_id"), *[
        F.expr(f"pmod(hash(id, '{c}'), 50) / 50.0").alias(c) for c in FEATURE_COLUMNS], F.lit(0.0).alias("gap_missing"))
    df = df.withColumn("target_conversion", (F.col("frequency") > 0.5).cast("int"))
    params, seen, plain = PropensityParams(gbm_max_iter=2, gbm_max_depth=2, gbm_patience=1), [], M._gbt

    class Watched:
        def __init__(self, gbt):
            self.gbt = gbt

        def fit(self, rows):
            seen.append((rows.count(), rows.rdd.getNumPartitions()))
            return self.gbt.fit(rows)

    monkeypatch.setattr(M, "FIT_ROWS", 300)
    monkeypatch.setattr(M, "_gbt", lambda *a: Watched(plain(*a)))
    for frame in (df.repartition(23), df.coalesce(1)):
        M.fit_gbm(frame, params)
    held = M._holdout(df, params.gbm_validation_fraction, params.seed, "val").filter("is_val").count()
    assert set(seen) == {(900 - held, -(-(900 - held) // 300))}


def test_boosting_does_not_fit_its_rounds_over_and_over(spark, monkeypatch):
    """A loss that falls to the last round: all batches together take less than one and a half times the rounds."""
    from tidewell.operators import models as M
    from tidewell.params import FEATURE_COLUMNS, PropensityParams
    df = spark.range(40).select(F.col("id").cast("string").alias("customer_id"), *[
        F.col("id").cast("double").alias(c) for c in FEATURE_COLUMNS], F.lit(0.0).alias("gap_missing"),
        (F.col("id") % 2).cast("int").alias("target_conversion"))
    fitted = []

    class Model:
        def __init__(self, rounds):
            self.getNumTrees = rounds

        def evaluateEachIteration(self, held):
            return [1.0 / k for k in range(1, self.getNumTrees + 1)]

    class Fit:
        def __init__(self, params, seed_salt, rounds):
            self.rounds = rounds

        def fit(self, rows):
            fitted.append(self.rounds)
            return Model(self.rounds)

    monkeypatch.setattr(M, "_gbt", Fit)
    params = PropensityParams()
    _, model = M.fit_gbm(df, params)
    assert model.getNumTrees == fitted[-1] == params.gbm_max_iter
    assert fitted[0] == params.gbm_patience + 2 and sum(fitted) < 1.5 * params.gbm_max_iter


def test_unchanged_copies_are_not_scored_again(spark, smoke_dir, monkeypatch):
    """A permuted copy that equals its row keeps the row's score; importances are those of scoring every copy."""
    from tidewell.operators import models as M
    from tidewell.plans.layers import Layers
    p = Layers(spark, smoke_dir)
    fitted, plain, asked = p.calibrated_ensemble, M.apply_calibrated, []
    monkeypatch.setattr(M, "apply_calibrated", lambda df, *a: asked.append(df) or plain(df, *a))
    got = M.permutation_importance(p.features_train, p.features_test, p.pp, repeats=2, fitted=fitted).collect()
    n, copies = asked[0].count(), asked[1]
    assert copies.count() < 2 * len(M.FEATURE_COLUMNS) * n * 0.95
    assert copies.filter("feature = 'single_buyer'").count() < 2 * n
    med, va, models = fitted
    te = M.gbm_frame(p.features_test, med)
    every = plain(M.permuted_features(te, list(M.FEATURE_COLUMNS), 2, p.pp.seed), va, models, ["feature", "repeat", "target_conversion"])
    base = M.ev.roc_auc(plain(te, va, models, ["target_conversion"]), "score", "target_conversion").first().roc_auc
    auc = M.ev.roc_auc(every, "score", "target_conversion", ("feature", "repeat")).collect()
    for r in got:
        drops = [base - a.roc_auc for a in auc if a.feature == r.feature]
        assert abs(r.importance_mean - sum(drops) / 2) < 1e-12
