"""Model fitting with Spark ML (P4–P6, P13, P14, U2) and batched k-means runs
(G2, G3, G5, G7, G8).

Each estimator fit is a sequence of distributed jobs (tree aggregates over
the cached training frame); predictions stay DataFrames and are evaluated by
``tidewell.operators.evaluation``.  Only fitted parameters — coefficient
vectors, trees, centres — live on the driver.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_uniform
from tidewell.operators import evaluation as ev
from tidewell.operators import propensity as prop
from tidewell.operators import segmentation as seg
from tidewell.operators.ordered import running_totals
from tidewell.params import FEATURE_COLUMNS, PropensityParams, SegmentationParams

GBM_INPUTS = list(FEATURE_COLUMNS) + ["gap_missing"]

# rows of a boosted fit that one task takes: a fit is thousands of short jobs (one a
# tree level), so their tasks follow the rows and not the partitions of the frame's plan.
# Up to FIT_TASKS partitions are left as they come.
FIT_ROWS, FIT_TASKS = 200_000, 8
# a longer fit begins anew, so the rounds of a batch grow by this: fitting 12, 60 and all 300
# rounds costs 372 of them, doubling 672
BATCH_GROWTH = 5


def _p1(df: DataFrame, col: str = "probability") -> DataFrame:
    return df.withColumn("_p1", vector_to_array(F.col(col))[1])


# ---------------------------------------------------------------- P4
def logistic_baseline(train: DataFrame, test: DataFrame, params: PropensityParams = PropensityParams()) -> DataFrame:
    """Median impute → standard scale → L2 logistic regression with balanced
    class weights (C = 1 ⇔ regParam = 1/Σweights).  Returns (customer_id, score, label)."""
    tr, te = prop.prepare_features(train), prop.prepare_features(test)
    med = prop.training_medians(tr)
    tr, te = prop.median_impute(tr, med), prop.median_impute(te, med)
    par = prop.scaler_params(tr)
    scale = {c: (F.col(c) - F.lit(par[c][0])) / F.lit(par[c][1]) for c in FEATURE_COLUMNS}
    tr, te = tr.withColumns(scale), te.withColumns(scale)
    counts = {r["target_conversion"]: r["n"] for r in
              tr.groupBy("target_conversion").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    wexpr = F.lit(0.0)
    for cls, cnt in counts.items():
        wexpr = F.when(F.col("target_conversion") == cls, F.lit(n / (len(counts) * cnt))).otherwise(wexpr)
    va = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")
    trv = va.transform(tr.withColumn("w", wexpr).withColumn("label", F.col("target_conversion").cast("double")))
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", regParam=1.0 / n,
                            elasticNetParam=0.0, standardization=False, maxIter=params.logistic_max_iter, tol=1e-6)
    model = lr.fit(trv)
    out = _p1(model.transform(va.transform(te)))
    return out.select("customer_id", F.col("_p1").alias("score"), F.col("target_conversion").alias("label"))


# ---------------------------------------------------------------- P5
def gbm_frame(features: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Prepared features, imputed, plus a missing-gap indicator (GBT rejects NaN)."""
    p = prop.prepare_features(features)
    p = p.withColumn("gap_missing", F.col("avg_days_between_orders").isNull().cast("double"))
    return prop.median_impute(p, medians)


def _gbt(params: PropensityParams, seed_salt: int, rounds: int) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=params.gbm_learning_rate,
                         maxDepth=params.gbm_max_depth, minInstancesPerNode=params.gbm_min_instances,
                         seed=params.seed + seed_salt, maxBins=64)


def _holdout(df: DataFrame, frac: float, seed: int, salt: str) -> DataFrame:
    return df.withColumn("is_val", hash_uniform(seed, "customer_id", salt) < F.lit(frac))


def patient_stop(losses: list[float], patience: int, tol: float) -> tuple[int, bool]:
    """(rounds to keep, whether boosting may end there) from the held-out loss
    after each round: the best round, once ``patience`` further ones did not get
    below it by ``tol``.  A noisy curve may rise in between."""
    best, at = float("inf"), 0
    for k, loss in enumerate(losses, 1):
        if loss < best - tol:
            best, at = loss, k
        elif k - at >= patience:
            return at, True
    return at, False


def _by_rows(stored: DataFrame) -> DataFrame:
    """A cached frame in as many partitions as its rows need."""
    need, have = max(1, -(-stored.count() // FIT_ROWS)), stored.rdd.getNumPartitions()
    if have < need:
        return stored.repartition(need).cache()
    return stored if have <= max(need, FIT_TASKS) else stored.coalesce(need)


def fit_gbm(train_gbm: DataFrame, params: PropensityParams, salt: str = "val", seed_salt: int = 0,
            curve: list | None = None):
    """Boosted trees on all but a hashed share of the rows, cut at the round with the
    lowest loss on that share (P5).  Rounds are fitted in growing batches: a fit is
    a function of its rows and seed, so a longer one begins with the same trees,
    and the last, shorter one is the ensemble cut at the best round.  Without a held-out
    row nothing can be told and the first batch is kept.  ``curve`` receives
    the held-out losses."""
    va = VectorAssembler(inputCols=GBM_INPUTS, outputCol="features")
    rows = va.transform(_holdout(train_gbm, params.gbm_validation_fraction, params.seed, salt)
                        .withColumn("label", F.col("target_conversion").cast("double")))
    stored = [rows.filter(c).select("features", "label").cache() for c in (~F.col("is_val"), F.col("is_val"))]
    fit, held = map(_by_rows, stored)
    watched = not held.isEmpty()
    rounds = min(params.gbm_patience + 2, params.gbm_max_iter)
    while True:
        model = _gbt(params, seed_salt, rounds).fit(fit)
        losses = model.evaluateEachIteration(held) if watched else []
        keep, done = patient_stop(losses, params.gbm_patience, params.gbm_tol)
        if done or not watched or rounds == params.gbm_max_iter:
            break
        rounds = min(BATCH_GROWTH * rounds, params.gbm_max_iter)
    if watched and keep < rounds:
        model = _gbt(params, seed_salt, keep).fit(fit)
    if curve is not None:
        curve.extend(losses)
    for frame in (*stored, fit, held):
        frame.unpersist()
    return va, model


def _together(spark, fits: list):
    """The results of independent fits, run at once: the jobs of one are too short to fill a cluster."""
    with ThreadPoolExecutor(len(fits)) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]]


def boosting_rounds(train: DataFrame, params: PropensityParams = PropensityParams()) -> DataFrame:
    """(round, holdout_loss, kept): the held-out loss after each fitted round of
    P5 and whether the model kept it."""
    med = prop.training_medians(prop.prepare_features(train))
    curve: list[float] = []
    _, model = fit_gbm(gbm_frame(train, med), params, curve=curve)
    kept = model.getNumTrees
    rows = [(k, float(x), k <= kept) for k, x in enumerate(curve, 1)] or [(k, None, True) for k in range(1, kept + 1)]
    return train.sparkSession.createDataFrame(rows, "round int, holdout_loss double, kept boolean")


def gbm_raw(train: DataFrame, test: DataFrame, params: PropensityParams = PropensityParams()) -> DataFrame:
    """Boosted trees cut at the best round of a hashed 15% holdout (P5)."""
    med = prop.training_medians(prop.prepare_features(train))
    tr, te = gbm_frame(train, med), gbm_frame(test, med)
    va, model = fit_gbm(tr, params)
    out = _p1(model.transform(va.transform(te)))
    return out.select("customer_id", F.col("_p1").alias("score"), F.col("target_conversion").alias("label"))


# ---------------------------------------------------------------- P6
def stratified_folds(df: DataFrame, k: int, seed: int, label: str = "target_conversion") -> DataFrame:
    """fold = position within its label stratum (hashed order) mod k."""
    u = hash_uniform(seed, "customer_id", "fold")
    rt = running_totals(df.withColumn("_u", u), [F.col("_u").asc(), F.col("customer_id").asc()], {}, (label,))
    return rt.withColumn("fold", (F.col("pos") - 1) % k).drop("_u", "pos")


def calibrated_models(train: DataFrame, params: PropensityParams = PropensityParams()):
    """k stratified folds: boosted trees on k−1 folds, isotonic map fitted on
    the held-out fold's probabilities.  Returns (medians, assembler, [(gbt, iso)])."""
    med = prop.training_medians(prop.prepare_features(train))
    tr = stratified_folds(gbm_frame(train, med), params.calibration_folds, params.seed).cache()

    def fold(f: int):
        va, gbt = fit_gbm(tr.filter(F.col("fold") != f), params, salt=f"val{f}", seed_salt=f)
        held = _p1(gbt.transform(va.transform(tr.filter(F.col("fold") == f)))).drop(
            "rawPrediction", "probability", "prediction")
        iso = IsotonicRegression(featuresCol="_p1", labelCol="label", predictionCol="_iso", isotonic=True).fit(
            held.withColumn("label", F.col("target_conversion").cast("double")))
        return gbt, iso

    models = _together(tr.sparkSession, [partial(fold, f) for f in range(params.calibration_folds)])
    tr.unpersist()
    return med, VectorAssembler(inputCols=GBM_INPUTS, outputCol="features"), models


def apply_calibrated(df_gbm: DataFrame, va, models, keep: list[str]) -> DataFrame:
    """Mean of the k calibrated probabilities (isotonic prediction clipped to [0, 1])."""
    base = va.transform(df_gbm)
    cols = []
    for i, (gbt, iso) in enumerate(models):
        base = _p1(gbt.transform(base)).drop("rawPrediction", "probability", "prediction")
        base = iso.setPredictionCol(f"_c{i}").transform(base).drop("_p1", "rawPrediction", "probability", "prediction")
        cols.append(F.col(f"_c{i}"))
    mean = reduce(lambda a, b: a + b, cols) / F.lit(float(len(cols)))
    return base.select(*keep, F.least(F.greatest(mean, F.lit(0.0)), F.lit(1.0)).alias("score"))


def save_calibrated(spark, fitted, path: str) -> None:
    """Persist a calibrated ensemble with Spark ML's own writers (shared folder)."""
    med, _, models = fitted
    spark.createDataFrame([tuple(float(med[c]) if med[c] is not None else None for c in FEATURE_COLUMNS)],
                          ", ".join(f"{c} double" for c in FEATURE_COLUMNS)).write.mode("overwrite").json(
        f"{path}/medians")
    for i, (gbt, iso) in enumerate(models):
        gbt.write().overwrite().save(f"{path}/gbt_{i}")
        iso.write().overwrite().save(f"{path}/iso_{i}")


def load_calibrated(spark, path: str, folds: int):
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel
    row = spark.read.json(f"{path}/medians").first()
    med = {c: row[c] for c in FEATURE_COLUMNS}
    models = [(GBTClassificationModel.load(f"{path}/gbt_{i}"), IsotonicRegressionModel.load(f"{path}/iso_{i}"))
              for i in range(folds)]
    return med, VectorAssembler(inputCols=GBM_INPUTS, outputCol="features"), models


def gbm_calibrated(train: DataFrame, test: DataFrame, params: PropensityParams = PropensityParams(),
                   fitted=None) -> DataFrame:
    """Isotonic-calibrated boosted-tree ensemble scores on the test snapshot."""
    med, va, models = fitted or calibrated_models(train, params)
    te = gbm_frame(test, med)
    return apply_calibrated(te, va, models, ["customer_id", "target_conversion"]).withColumnRenamed(
        "target_conversion", "label").select("customer_id", "score", "label")


# ---------------------------------------------------------------- P13
def permutation_importance(train: DataFrame, test: DataFrame, params: PropensityParams = PropensityParams(),
                           repeats: int | None = None, fitted=None) -> DataFrame:
    """Drop in AUC when one feature column is permuted.

    A repeat is one permutation of the rows: the donor of the row with id rank i is
    the row whose hashed rank is i, and it brings its whole feature row.  So there is one
    ordering by id, one by hash within each repeat (repeats x rows in a single exchange),
    and one equi-join on rank; the copies of the features, each with its own column
    swapped, are made after it.  Every copy is scored by the same model ensemble and
    AUC is computed grouped by (feature, repeat)."""
    repeats = repeats or params.permutation_repeats
    med, va, models = fitted or calibrated_models(train, params)
    feats = list(FEATURE_COLUMNS)
    te = apply_calibrated(gbm_frame(test, med), va, models,
                          ["customer_id", "target_conversion", *GBM_INPUTS]).withColumnRenamed("score", "own_score").cache()
    base_auc = ev.roc_auc(te, "own_score", "target_conversion").first()["roc_auc"]
    g = ("feature", "repeat")
    perm = permuted_features(te, feats, repeats, params.seed, changed="changed")
    keep = [*g, "customer_id", "target_conversion"]
    # a copy whose donor brings the same value is the row itself, which has its score
    scored = apply_calibrated(perm.filter("changed"), va, models, keep).unionByName(
        perm.filter("not changed").select(*keep, F.col("own_score").alias("score")))
    auc = ev.roc_auc(scored, "score", "target_conversion", g)
    te.unpersist()
    return auc.groupBy("feature").agg(
        (F.lit(base_auc) - F.avg("roc_auc")).alias("importance_mean"),
        F.stddev_pop(F.lit(base_auc) - F.col("roc_auc")).alias("importance_std")).orderBy(
        F.col("importance_mean").desc(), F.col("feature"))


def permuted_features(rows: DataFrame, feats: list[str], repeats: int, seed: int, changed: str | None = None) -> DataFrame:
    """``rows`` once per feature and repeat, that feature taken from the row's donor in that repeat.
    ``changed`` names a column that tells whether the donor's value is another one."""
    ranked = running_totals(rows, [F.col("customer_id").asc()], {}).withColumnRenamed("pos", "_rid")
    donors = rows.select("customer_id", F.struct(*feats).alias("_donor")).withColumn(
        "repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))
    u = hash_uniform(seed, F.concat_ws(":", "repeat", "customer_id"), "perm")
    donors = running_totals(donors.withColumn("_u", u), [F.col("_u").asc(), F.col("customer_id").asc()], {}, ("repeat",)) \
        .select("repeat", F.col("pos").alias("_rid"), "_donor")
    copies = ranked.join(donors, "_rid").withColumn("feature", F.explode(F.array(*[F.lit(f) for f in feats])))
    swaps = {f: F.when(F.col("feature") == f, F.col(f"_donor.{f}")).otherwise(F.col(f)) for f in feats}
    if changed:
        swaps[changed] = ~reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(swaps[f]) for f in feats])
    return copies.withColumns(swaps).drop("_donor", "_rid")


def propensity_scores(train: DataFrame, test: DataFrame, params: PropensityParams = PropensityParams(),
                      fitted=None) -> DataFrame:
    """customer_id, baseline score, calibrated score, label."""
    b = logistic_baseline(train, test, params).select("customer_id", F.col("score").alias("score_baseline"))
    c = gbm_calibrated(train, test, params, fitted).select("customer_id", F.col("score").alias("score_gbm_calibrated"),
                                                  F.col("label").alias("target_conversion"))
    return b.join(c, "customer_id")


# ---------------------------------------------------------------- U2
def t_learner(features: DataFrame, attribution: DataFrame, params: PropensityParams = PropensityParams()) -> DataFrame:
    """Separate boosted trees on treated and control training rows of a
    stratified 70/30 split; uplift = p_treated − p_control on the test rows (U2)."""
    df = features.join(attribution.select("customer_id", F.col("exposed").alias("treated")), "customer_id")
    split = prop.stratified_split(df, ["treated", "target_conversion"], 0.3, params.seed)
    med = prop.training_medians(prop.prepare_features(split.filter(~F.col("is_test"))))
    g = gbm_frame(split, med).join(split.select("customer_id", "treated", "is_test"), "customer_id").cache()
    train, test = g.filter(~F.col("is_test")), g.filter(F.col("is_test"))
    (va_t, m_t), (va_c, m_c) = _together(g.sparkSession, [
        partial(fit_gbm, train.filter(F.col("treated")), params, salt="val_t", seed_salt=11),
        partial(fit_gbm, train.filter(~F.col("treated")), params, salt="val_c", seed_salt=13)])
    pt = _p1(m_t.transform(va_t.transform(test))).select("customer_id", "treated", "target_conversion",
                                                         F.col("_p1").alias("p_treated"))
    pc = _p1(m_c.transform(va_c.transform(test))).select("customer_id", F.col("_p1").alias("p_control"))
    return pt.join(pc, "customer_id").select(
        "customer_id", "treated", F.col("target_conversion").alias("label"), "p_treated", "p_control",
        (F.col("p_treated") - F.col("p_control")).alias("uplift"))


# ---------------------------------------------------------------- k-means runs
def _k(features: DataFrame, params: SegmentationParams) -> int:
    """The configured k, else the sweep's choice."""
    return params.chosen_k or seg.choose_k(k_sweep(features, params)).first()["k"]


def kmeans_fit(features: DataFrame, params: SegmentationParams = SegmentationParams()):
    """Final k-means labels: best of ``restarts`` fits by inertia."""
    m = seg.rfm_matrix(features, params)
    k = _k(features, params)
    labels, summary = seg.kmeans_fits(m, seg.fit_table([k], params.restarts), None, params)
    return labels.select("customer_id", "cluster", *seg.RFM_FEATURES), summary


def k_sweep(features: DataFrame, params: SegmentationParams = SegmentationParams()) -> DataFrame:
    """Inertia and silhouette for k = k_min..k_max, all fits batched."""
    m = seg.rfm_matrix(features, params)
    ks = list(range(params.k_min, params.k_max + 1))
    labels, summary = seg.kmeans_fits(m, seg.fit_table(ks, params.restarts), None, params)
    sil = ev.silhouette(labels, seg.RFM_FEATURES, "cluster", ("run",))
    return summary.join(sil, "run").select("k", "inertia", "silhouette")


def _with_reference(matrix: DataFrame, reference: DataFrame) -> DataFrame:
    """Each customer's reference cluster as ``ref``: joined to the points once, not to the labels of every run."""
    return matrix.join(reference.select("customer_id", F.col("cluster").alias("ref")), "customer_id", "left")


def stability_reseed(features: DataFrame, reference: DataFrame, params: SegmentationParams = SegmentationParams()):
    """ARI of ``reseed_runs`` refits (new seeds) against the reference labels."""
    m = _with_reference(seg.rfm_matrix(features, params), reference)
    k = _k(features, params)
    # fit ids offset from the reference fit's, so every run gets new seeds
    fits = [(f + 1000, kk, run, r) for f, kk, run, r in seg.fit_table([k] * params.reseed_runs, params.restarts)]
    labels, _ = seg.kmeans_fits(m, fits, None, params, ("ref",))
    return ev.adjusted_rand_index(labels.filter(F.col("ref").isNotNull()), "ref", "cluster", ("run",))


def stability_subsample(features: DataFrame, reference: DataFrame,
                        params: SegmentationParams = SegmentationParams()):
    """ARI on ``subsample_runs`` exact-size 80% subsamples without replacement."""
    m = _with_reference(seg.rfm_matrix(features, params), reference)
    k = _k(features, params)
    runs = list(range(params.subsample_runs))
    members = seg.subsample_runs(m, runs, params.subsample_frac, params.seed)
    fits = [(f + 5000, kk, run, r) for f, kk, run, r in seg.fit_table([k] * params.subsample_runs, params.restarts)]
    labels, _ = seg.kmeans_fits(m, fits, members, params, ("ref",))
    return ev.adjusted_rand_index(labels.filter(F.col("ref").isNotNull()), "ref", "cluster", ("run",))


def stability_summary(ari: DataFrame, threshold: float | None = None) -> DataFrame:
    out = ari.agg(F.count(F.lit(1)).alias("runs"), F.avg("ari").alias("ari_mean"), F.min("ari").alias("ari_min"))
    if threshold is not None:
        out = out.withColumn("stable", F.col("ari_mean") >= F.lit(threshold))
    return out
