"""The pipeline layers over the TESTDATA tables.

Stored layers (``silver``, ``dim``, ``snapshots``, ``attribution``,
``kmeans_labels``) are Parquet marts in the shared checkpoint folder, keyed by
an input + code + parameter signature and built on first use; ``*_plan`` attributes are
the same layers as plans over their inputs, for the queries that measure the
operator itself.  Derived customer-grain frames (scores, profiles, LTV,
channel table, Hill parameters) are lazily built DataFrames, one object per
Layers instance so repeated use inside one query shares plan nodes.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidewell.functions.ratios import round_half
from tidewell.operators import attribution as attr
from tidewell.operators import cleaning, contracts, features
from tidewell.operators.audited import counters, observe, undisturbed
from tidewell.params import (AttributionParams, BudgetParams, Cutoffs, FeatureParams,
                             MetricsParams, PropensityParams, SegmentationParams)
from tidewell.sources.testdata import bronze_from_testdata, table


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (float sums are order-dependent in the last bits)."""
    return df.select(*[
        round_half(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


class Layers:
    """Entry point to every layer for one set of source tables and parameters."""

    def __init__(self, spark: SparkSession, sf_dir: str,
                 cutoffs: Cutoffs = Cutoffs(),
                 feature_params: FeatureParams = FeatureParams(),
                 attribution_params: AttributionParams = AttributionParams(),
                 segmentation_params: SegmentationParams = SegmentationParams(),
                 propensity_params: PropensityParams = PropensityParams(),
                 metrics_params: MetricsParams = MetricsParams(),
                 budget_params: BudgetParams = BudgetParams()):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cutoffs = cutoffs
        self.fp = feature_params
        self.ap = attribution_params
        self.sp = segmentation_params
        self.pp = propensity_params
        self.mp = metrics_params
        self.bp = budget_params

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_from_testdata(self.spark, self.sf_dir)

    @property
    def _observed_bronze(self) -> DataFrame:
        """Bronze in the session for observed jobs."""
        from tidewell.session import observer_session
        return bronze_from_testdata(observer_session(self.spark), self.sf_dir)

    @property
    def _inputs(self) -> list[str]:
        from tidewell.sources.testdata import TABLES
        return [f"{self.sf_dir.rstrip('/')}/{t}.parquet"
                for t in ("lineitem", "orders", "part", "supplier", "nation") if t in TABLES]

    @cached_property
    def signature(self) -> str:
        from tidewell.sources.marts import input_signature
        return input_signature(self.spark, self._inputs)

    def sized(self, spark: SparkSession):
        """Tasks of ``spark`` sized by the bytes of the inputs."""
        from tidewell.session import sized_tasks
        from tidewell.sources.marts import input_bytes
        return sized_tasks(spark, input_bytes(self.spark, self._inputs))

    def keyed(self, *params) -> str:
        """The signature of a layer that depends on ``params`` besides the inputs."""
        from tidewell.sources.marts import parameter_key
        return f"{self.signature}-{parameter_key(*params)}"

    def mart(self, name: str, build, partition_by=None, params: tuple = (), sized: bool = False) -> DataFrame:
        """``sized``: a mart made from every fact row, written by tasks sized by bytes."""
        from tidewell.sources.marts import materialize
        around = {"around": lambda: self.sized(self.spark)} if sized else {}
        return materialize(self.spark, self.keyed(*params), name, build, partition_by, **around)

    @cached_property
    def silver_plan(self) -> DataFrame:
        """C1–C6 as a plan over bronze (what the cleaning queries measure)."""
        return cleaning.clean_silver(self.bronze)

    @cached_property
    def _silver_version(self) -> str:
        """fact_transactions mart: silver stored once, partitioned by month
        (yyyymm), so time-window scans prune whole months.  The counters of the
        cleaning (C8) and of silver's checks (K2) are observed by the same jobs
        and stored beside the version."""
        from tidewell.session import shared_path
        from tidewell.sources.marts import publish, published, write_mart
        folder = shared_path(self.spark, "marts", self.keyed(), "fact_transactions")

        def write(path: str) -> None:
            bronze = self._observed_bronze
            month = (F.year("invoice_date") * 100 + F.month("invoice_date")).cast("int")
            # contiguous (month, customer) ranges per task: few files per month
            # partition, and tight customer_id statistics inside each file.
            # Invoice and stock code let a hot customer-month be split; without
            # an explicit count AQE sizes the ranges by their bytes.
            customer = F.col("customer_id").cast("bigint").cast("string")
            silver, rules = cleaning.clean_silver_observed(bronze, arrange=lambda lines: lines.repartitionByRange(
                month, customer, "invoice", "stock_code"))
            with_month = silver.withColumn("month", month)
            checks = contracts.check_metrics(silver.columns, contracts.SILVER)
            out, written = observe(with_month, {"rows_silver": F.count(F.lit(1))} | {
                f"{c}:{k}": e for (c, k), e in checks.items()})
            with self.sized(bronze.sparkSession):
                once = undisturbed(self.spark, lambda: write_mart(out, path, ["month"]))
            counts = counters(rules, written) if once else None
            if counts is None:
                again = contracts.contract_checks(self.spark.read.parquet(path), contracts.SILVER).collect()
                counts = cleaning.counted_rules(self.bronze) | {f"{r.column}:{r.check}": r.violations for r in again}
            self.spark.createDataFrame(list(counts.items()), "counter string, n bigint").coalesce(1) \
                .write.parquet(f"{path}-audit")

        return published(self.spark, folder) or publish(self.spark, folder, write)

    @cached_property
    def silver(self) -> DataFrame:
        """The stored fact_transactions."""
        return self.spark.read.parquet(self._silver_version)

    @cached_property
    def _stored_counts(self) -> dict[str, int]:
        return {r.counter: r.n for r in self.spark.read.parquet(f"{self._silver_version}-audit").collect()}

    @cached_property
    def dq(self) -> DataFrame:
        """C8 from the counters of silver's write or, while it is not stored, of a counting pass."""
        from tidewell.session import shared_path
        from tidewell.sources.marts import published
        stored = published(self.spark, shared_path(self.spark, "marts", self.keyed(), "fact_transactions"))
        return cleaning.dq_report_from(self.spark, self._stored_counts if stored else cleaning.rule_counts(self._observed_bronze))

    @cached_property
    def silver_dq(self) -> DataFrame:
        """C8 from silver's counters, for plans that read silver or what is made of it as
        well: bronze is then passed once, by silver's write."""
        return cleaning.dq_report_from(self.spark, self._stored_counts)

    @cached_property
    def silver_checks(self) -> DataFrame:
        """K2 of silver, counted while it was written."""
        counts = {tuple(k.split(":")): n for k, n in self._stored_counts.items() if ":" in k}
        return contracts.contract_checks_from(self.spark, counts, contracts.SILVER)

    @cached_property
    def dim(self) -> DataFrame:
        return self.mart("dim_customers", lambda: features.dim_customers(self.silver), sized=True)

    def features_at(self, as_of, include_target: bool = True) -> DataFrame:
        return features.customer_features(self.silver, self.dim, as_of, self.cutoffs.window_days,
                                          self.fp, include_target)

    @cached_property
    def snapshots_plan(self) -> DataFrame:
        """F12 as a plan over the fact mart (what the snapshot queries measure)."""
        return features.feature_snapshots(self.silver, self.dim, self.cutoffs.distinct(),
                                          self.cutoffs.window_days, self.fp)

    @cached_property
    def _features_mart(self) -> DataFrame:
        """customer_features mart: every cutoff, written once, partitioned by
        snapshot date so a single snapshot is read by partition pruning."""
        return self.mart("customer_features", lambda: self.snapshots_plan.withColumn(
            "snapshot", F.date_format("as_of", "yyyy-MM-dd")), ["snapshot"], (self.cutoffs, self.fp), sized=True)

    @cached_property
    def snapshots(self) -> DataFrame:
        return self._features_mart.select(*features.FEATURE_TABLE_COLUMNS)

    def _snapshot(self, as_of) -> DataFrame:
        from tidewell.functions.timecols import as_ts
        return self._features_mart.filter(
            (F.col("snapshot") == F.lit(as_of.strftime("%Y-%m-%d"))) & (F.col("as_of") == as_ts(as_of))
        ).select(*features.FEATURE_TABLE_COLUMNS)

    @cached_property
    def features_test(self) -> DataFrame:
        return self._snapshot(self.cutoffs.t_test)

    @cached_property
    def features_train(self) -> DataFrame:
        return self._snapshot(self.cutoffs.t_train)

    @cached_property
    def features_current(self) -> DataFrame:
        return self._snapshot(self.cutoffs.t_full)

    @cached_property
    def attribution(self) -> DataFrame:
        return self.mart("synthetic_attribution", lambda: attr.synthetic_attribution(self.features_current, self.ap),
                         params=(self.cutoffs, self.fp, self.ap))

    # ---------------------------------------------------------------- derived marts
    @cached_property
    def scores(self) -> DataFrame:
        """Deterministic reference score on the test snapshot (integer arithmetic,
        so every engine computes the identical double): customer_id, score, label."""
        raw = F.least(F.greatest(F.lit(50) + F.lit(60) * F.col("frequency") - F.lit(2) * F.col("recency_days"),
                                 F.lit(10)), F.lit(990))
        return self.features_test.select("customer_id", (raw.cast("double") / F.lit(1000.0)).alias("score"),
                                         F.col("target_conversion").alias("label"))

    @cached_property
    def rule_labels(self) -> DataFrame:
        from tidewell.operators.segmentation import rule_clusters
        return rule_clusters(self.features_current)

    @cached_property
    def profile(self) -> DataFrame:
        from tidewell.operators.segmentation import segment_profiles
        return segment_profiles(self.features_current, self.rule_labels)

    @cached_property
    def segments(self) -> DataFrame:
        from tidewell.operators.segmentation import segment_assignments
        return segment_assignments(self.rule_labels, self.profile)

    @cached_property
    def ltv(self) -> DataFrame:
        from tidewell.operators.metrics import ltv_table
        return ltv_table(self.features_current, None, self.mp)

    @cached_property
    def window_rev(self) -> DataFrame:
        from tidewell.operators.metrics import window_revenue
        return window_revenue(self.silver, self.cutoffs.t_test, self.cutoffs.window_days)

    @cached_property
    def channel_table(self) -> DataFrame:
        from tidewell.operators.metrics import channel_metrics
        return channel_metrics(self.features_current, self.attribution, self.ltv, self.window_rev)

    @cached_property
    def hill(self) -> DataFrame:
        from tidewell.operators.budget import hill_params
        return hill_params(self.attribution, self.scores, self.channel_table, self.bp)

    @cached_property
    def scored_attribution(self) -> DataFrame:
        return self.attribution.select("customer_id", "channel").join(
            self.scores.select("customer_id", "score"), "customer_id")

    @cached_property
    def uplift_frame(self) -> DataFrame:
        """Test snapshot ⋈ exposure with a stratified 70/30 split (U1) and a
        deterministic reference uplift score for the test rows."""
        from tidewell.operators.propensity import stratified_split
        from tidewell.functions.hashing import hash_uniform
        df = self.features_test.select("customer_id", F.col("target_conversion").alias("label")).join(
            self.attribution.select("customer_id", F.col("exposed").alias("treated")), "customer_id")
        split = stratified_split(df, ["treated", "label"], 0.3, self.pp.seed)
        u = hash_uniform(self.pp.seed, "customer_id", "uplift")
        return split.withColumn("uplift", F.floor(u * 200).cast("double") / F.lit(1000.0) - F.lit(0.1))

    @cached_property
    def kmeans_labels(self) -> DataFrame:
        """segment_assignments mart from the fitted k-means (reference labelling
        for the stability studies and the k-means segment report)."""
        from tidewell.operators.models import kmeans_fit
        return self.mart("segment_assignments_kmeans",
                         lambda: kmeans_fit(self.features_current, self.sp)[0].select("customer_id", "cluster"),
                         params=(self.cutoffs, self.fp, self.sp))

    @cached_property
    def calibrated_ensemble(self):
        """The five-fold calibrated boosted-tree ensemble fitted on the training
        snapshot, stored with Spark ML writers next to the marts and reused."""
        from tidewell.operators import models
        from tidewell.session import shared_path
        from tidewell.sources.marts import publish, published
        folder = shared_path(self.spark, "marts", self.keyed(self.cutoffs, self.fp, self.pp), "models", "gbm_calibrated")
        path = published(self.spark, folder) or publish(self.spark, folder, lambda to: models.save_calibrated(
            self.spark, models.calibrated_models(self.features_train, self.pp), to))
        return models.load_calibrated(self.spark, path, self.pp.calibration_folds)

    # ---------------------------------------------------------------- fitted layers, stored
    # What a model said of each customer is kept as a table, keyed by inputs, code and
    # parameters: reports read the stored estimates, so two of them never see two
    # fits, and SQL can recompute every report from the same rows.
    @cached_property
    def fitted_ltv(self) -> DataFrame:
        """ltv_table mart (M13) on the probabilistic path, the method and any
        reason for falling back in every row."""
        from tidewell.operators.ltv import probabilistic_ltv_table
        return self.mart("ltv_table", lambda: probabilistic_ltv_table(
            self.silver, self.features_current, self.cutoffs.t_test, self.mp), params=(self.cutoffs, self.fp, self.mp))

    @cached_property
    def fitted_scores(self) -> DataFrame:
        """propensity_scores mart: the calibrated ensemble on the test snapshot."""
        from tidewell.operators.models import gbm_calibrated
        return self.mart("propensity_scores", lambda: gbm_calibrated(
            self.features_train, self.features_test, self.pp, self.calibrated_ensemble), params=(self.cutoffs, self.fp, self.pp))

    @cached_property
    def fitted_uplift(self) -> DataFrame:
        """uplift_scores mart: the T-learner's test rows."""
        from tidewell.operators.models import t_learner
        return self.mart("uplift_scores", lambda: t_learner(self.features_test, self.attribution, self.pp),
                         params=(self.cutoffs, self.fp, self.ap, self.pp))

    @cached_property
    def fitted_channel_table(self) -> DataFrame:
        from tidewell.operators.metrics import channel_metrics
        return channel_metrics(self.features_current, self.attribution, self.fitted_ltv, self.window_rev)

    @cached_property
    def fitted_hill(self) -> DataFrame:
        from tidewell.operators.budget import hill_params
        return hill_params(self.attribution, self.fitted_scores, self.fitted_channel_table, self.bp)

    @cached_property
    def fitted_scored_attribution(self) -> DataFrame:
        return self.attribution.select("customer_id", "channel").join(
            self.fitted_scores.select("customer_id", "score"), "customer_id")
