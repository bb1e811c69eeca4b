"""Stored layers follow their parameters; publishing is safe between jobs."""
import datetime as dt
from dataclasses import replace

from tidewell.params import AttributionParams, Cutoffs, SegmentationParams
from tidewell.plans.layers import Layers
from tidewell.sources import marts


def rows(df):
    return sorted(map(repr, df.collect()))


def test_other_parameters_build_other_marts(spark, smoke_dir):
    base = Layers(spark, smoke_dir)
    assert base.features_test.count() > 0 and base.attribution.count() > 0       # stored under the defaults
    seeded = Layers(spark, smoke_dir, attribution_params=AttributionParams(seed=7))
    from tidewell.operators.attribution import synthetic_attribution
    assert rows(seeded.attribution) == rows(synthetic_attribution(seeded.features_current, seeded.ap))
    assert rows(seeded.attribution) != rows(base.attribution)
    cut = Cutoffs(t_train=dt.datetime(1997, 3, 31), t_test=dt.datetime(1998, 1, 31), t_full=dt.datetime(1998, 1, 31))
    moved = Layers(spark, smoke_dir, cutoffs=cut)
    assert moved.features_test.count() > 0
    assert sorted(r.customer_id for r in moved.features_test.collect()) == sorted(
        r.customer_id for r in moved.features_at(cut.t_test).collect())
    assert moved.features_test.select("as_of").distinct().collect()[0].as_of == cut.t_test


def test_keys_of_stored_models_follow_their_parameters(spark, smoke_dir):
    p = Layers(spark, smoke_dir)
    other = Layers(spark, smoke_dir, segmentation_params=SegmentationParams(chosen_k=3),
                   propensity_params=replace(p.pp, gbm_max_depth=2))
    for a in ("sp", "pp"):
        assert p.keyed(p.cutoffs, p.fp, getattr(p, a)) != other.keyed(other.cutoffs, other.fp, getattr(other, a))
    assert other.kmeans_labels.select("cluster").distinct().count() == 3
    assert p.kmeans_labels.select("cluster").distinct().count() == 5


def test_concurrent_writers_and_failed_jobs(spark, tmp_path):
    folder = str(tmp_path / "mart")
    (tmp_path / "mart" / "v-0-unfinished").mkdir(parents=True)                   # a job that died
    assert marts.published(spark, folder) is None
    write = lambda path: spark.range(5).write.parquet(path)
    first = marts.publish(spark, folder, write)
    second = marts.publish(spark, folder, write)
    assert second == marts.published(spark, folder) and spark.read.parquet(second).count() == 5
    assert spark.read.parquet(first).count() == 5


def test_hot_customer_month_is_split_on_write(spark, smoke_dir):
    """A customer with a third of all rows in one month is written by several tasks."""
    from pyspark.sql import functions as F
    from tidewell.session import sql_conf
    p = Layers(spark, smoke_dir)
    silver = p.silver_plan.checkpoint()
    hot = silver.limit(1).select("customer_id", "invoice_date").first()
    many = silver.withColumn("customer_id", F.when(F.pmod(F.hash("invoice"), F.lit(3)) == 0, hot.customer_id)
                             .otherwise(F.col("customer_id")))
    many = many.withColumn("invoice_date", F.when(F.col("customer_id") == hot.customer_id, F.lit(hot.invoice_date))
                           .otherwise(F.col("invoice_date")))
    p.__dict__["silver_plan"] = many
    p.__dict__["signature"] = "hot-customer-test"
    with sql_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}):
        fact = p.silver
    files = fact.filter(F.col("customer_id") == hot.customer_id).select(F.col("_metadata.file_path")).distinct().count()
    assert files >= 2


def test_fact_layers_are_written_by_tasks_sized_by_bytes(spark, smoke_dir, tmp_path, monkeypatch):
    """What a task sorts must not grow with the input: more bytes, more shuffle partitions."""
    from tidewell import session
    from tidewell.plans.layers import Layers
    from tidewell.sources import marts
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    seen, plans, real = {}, [], marts.write_mart

    def write_mart(df, path, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        seen[path.split("/")[-2]] = [int(df.sparkSession.conf.get(k)) for k in keys]
        real(df, path, *args)

    monkeypatch.setattr(marts, "write_mart", write_mart)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 4096)
    with session.sql_conf(spark, {"spark.tidewell.mart.namespace": str(tmp_path)}):
        p = Layers(spark, smoke_dir)
        before = [s.conf.get(k, None) for s in (spark, session.observer_session(spark)) for k in keys]
        rows = p.features_test.count()
        assert before == [s.conf.get(k, None) for s in (spark, session.observer_session(spark)) for k in keys]
        n = -(-marts.input_bytes(spark, p._inputs) // 4096)
        assert rows and n > 8
        assert seen == {k: [16 << 20, 16 << 20, n] for k in ("fact_transactions", "dim_customers", "customer_features")}
        # the layout of silver carries no derived column through its shuffle
        assert "RepartitionByExpression" in plans[0] and plans[0].index(" AS revenue") < plans[0].index("RepartitionByExpression")
        monkeypatch.undo()
        with session.sql_conf(spark, {keys[1]: "8m"}), session.sized_tasks(spark, 0):
            assert int(spark.conf.get(keys[1])) == 8 << 20
