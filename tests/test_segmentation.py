"""Segment naming, actions and batched k-means."""
from pyspark.sql import functions as F

from tidewell.operators import segmentation as seg


def profile(spark, rows):
    return spark.createDataFrame(rows, "cluster int, recency_days double, frequency double, monetary double")


def test_naming_with_duplicate_quadrants(spark):
    # two engaged clusters (low recency, high frequency) and two hibernating ones
    p = profile(spark, [(0, 10.0, 20.0, 900.0), (1, 12.0, 18.0, 500.0), (2, 200.0, 1.0, 50.0), (3, 220.0, 2.0, 80.0)])
    names = {r.cluster: r.segment_name for r in seg.segment_naming(p).collect()}
    assert names[0] == "Champions" and names[1] == "Loyal Customers"
    assert names[3] == "Hibernating 1" and names[2] == "Hibernating 2"


def test_actions_strip_numeric_suffix(spark):
    p = spark.createDataFrame([("Hibernating 2",), ("At Risk",), ("Something",)], "segment_name string")
    acts = {r.segment_name: r.recommended_action for r in seg.segment_actions(p).collect()}
    assert acts["Hibernating 2"].startswith("Low-cost reactivation")
    assert acts["Something"] == "Monitor and re-evaluate next cycle."


def test_batched_kmeans_separates_blobs_and_inertia_falls_with_k(spark):
    import numpy as np
    rnd = np.random.default_rng(1)
    pts = np.vstack([rnd.normal(c, 0.1, (30, 3)) for c in ([0, 0, 0], [3, 3, 3], [0, 3, 0])])
    m = spark.createDataFrame([(str(i), *map(float, x)) for i, x in enumerate(pts)],
                              "customer_id string, x_recency double, x_frequency double, x_monetary double")
    labels, summary = seg.kmeans_fits(m, seg.fit_table([2, 3, 4], 3))
    inert = {r.k: r.inertia for r in summary.collect()}
    assert inert[2] > inert[3] >= inert[4]
    lab3 = labels.filter(F.col("run") == 1).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in lab3) == [30, 30, 30]


def test_kmeans_follows_from_the_data_and_takes_odd_tables(spark):
    rows = [(str(i), float(i % 7), float(i % 5), float(i % 3)) for i in range(200)]
    schema = "customer_id string, x_recency double, x_frequency double, x_monetary double"
    m = spark.createDataFrame(rows, schema)
    got = [sorted((r.customer_id, r.cluster) for r in seg.kmeans_fits(d, seg.fit_table([4], 2))[0].collect())
           for d in (m.repartition(1), m.orderBy(F.rand(3)).repartition(9))]
    assert got[0] == got[1]
    # no rows: no labels and no fit
    labels, summary = seg.kmeans_fits(m.limit(0), seg.fit_table([3], 2))
    assert labels.count() == 0 and summary.count() == 0
    # fewer distinct points than centres
    labels, summary = seg.kmeans_fits(m.filter("customer_id in ('0', '1', '105')"), seg.fit_table([5], 2))
    assert summary.first().inertia == 0 and len({r.cluster for r in labels.filter("customer_id in ('0', '105')").collect()}) == 1
    # runs see their own rows only; one without rows is left out
    members = spark.createDataFrame([(0, str(i)) for i in range(50)] + [(2, str(i)) for i in range(20, 200)], "run int, customer_id string")
    labels, summary = seg.kmeans_fits(m, seg.fit_table([3, 3, 3], 2), members)
    assert {r.run: r["count"] for r in labels.groupBy("run").count().collect()} == {0: 50, 2: 180}
    assert {r.run for r in summary.collect()} == {0, 2} and all(r.converged and r.inertia > 0 for r in summary.collect())


def test_subsample_members_exact_size(spark):
    m = spark.range(500).select(F.col("id").cast("string").alias("customer_id"))
    mem = seg.subsample_members(m, list(range(5)), 0.8, 42)
    counts = [r["count"] for r in mem.groupBy("run").count().collect()]
    assert counts == [400] * 5


def test_choose_k_first_best(spark):
    sw = spark.createDataFrame([(2, 1.0, 0.4), (3, 0.8, 0.5), (4, 0.7, 0.5)], "k int, inertia double, silhouette double")
    assert seg.choose_k(sw).first().k == 3
    assert seg.choose_k(sw, 4).first().k == 4


def test_points_are_spread_by_their_number(spark, monkeypatch):
    """A frame in one partition is fitted by as many tasks as its points need, every point labelled once."""
    monkeypatch.setattr(seg, "POINT_ROWS", 100)
    m = spark.range(350).coalesce(1).select(F.col("id").cast("string").alias("customer_id"), *[
        F.expr(f"pmod(hash(id, '{c}'), 1000) / 100.0").alias(c) for c in seg.RFM_FEATURES])
    labels, _ = seg.kmeans_fits(m, seg.fit_table([3], 2))
    assert labels.rdd.getNumPartitions() == 4
    assert labels.count() == labels.select("customer_id").distinct().count() == 350


def test_nearest_centre_is_the_first_of_equal_ones():
    import numpy as np
    x = np.random.default_rng(2).integers(0, 4, (3, 500)).astype(float)
    centres = np.array([[1, 1, 1], [0, 2, 1], [1, 1, 1], [3, 0, 2.5]], float)
    far = ((x.T[:, None] - centres[None]) ** 2).sum(2)
    best, d = seg._nearest(x, centres)
    assert (best == far.argmin(1)).all() and (d == far.min(1)).all()


def test_subsample_is_the_smallest_draws_of_each_run(spark, monkeypatch):
    """Members by the last one of each run are those of a full ranking, at any size and with draws in one slice."""
    from tidewell.functions.hashing import hash_uniform
    for n, frac, slices in ((500, 0.8, 4096), (37, 0.5, 2), (3, 0.2, 4096), (0, 0.8, 4096), (5, 1.0, 1)):
        monkeypatch.setattr(seg, "SLICES", slices)
        m = spark.range(n).select(F.col("id").cast("string").alias("customer_id"))
        rows = m.crossJoin(spark.range(4).select(F.col("id").cast("int").alias("run"))).withColumn(
            "u", hash_uniform(7, F.concat_ws(":", "run", "customer_id"), "subsample")).collect()
        want = {(run, c) for run in range(4) for _, c in
                sorted((r.u, r.customer_id) for r in rows if r.run == run)[:int(n * frac)]}
        got = seg.subsample_members(m, list(range(4)), frac, 7).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_stability_shuffles_customers_not_customers_by_runs(spark, smoke_dir, monkeypatch):
    """The reference meets the points once; the labels of all runs are counted where they are made."""
    from tidewell.operators import evaluation as ev
    from tidewell.operators import models
    from tidewell.plans.layers import Layers
    p = Layers(spark, smoke_dir)
    seen, plain = [], ev.adjusted_rand_index
    monkeypatch.setattr(ev, "adjusted_rand_index", lambda df, *a: seen.append(df) or plain(df, *a))
    for study in (models.stability_reseed, models.stability_subsample):
        ari = study(p.features_current, p.kmeans_labels, p.sp)
        plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert all(-1 <= r.ari <= 1 + 1e-9 for r in ari.collect())
