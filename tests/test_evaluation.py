"""Evaluation operators against hand-computed tables."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_uniform
from tidewell.operators import evaluation as ev
from tidewell.operators.ordered import running_totals


def scores(spark, ps, ys):
    return spark.createDataFrame([(str(i), float(p), int(y)) for i, (p, y) in enumerate(zip(ps, ys))],
                                 "customer_id string, score double, label int")


def test_auc_and_ap_hand_table(spark):
    df = scores(spark, [.9, .8, .7, .1], [1, 0, 1, 0])
    assert ev.roc_auc(df).first().roc_auc == pytest.approx(0.75)
    assert ev.average_precision(df).first().average_precision == pytest.approx(0.8333333, abs=1e-6)


def test_auc_ties_count_half(spark):
    df = scores(spark, [.5, .5, .5, .5], [1, 0, 1, 0])
    assert ev.roc_auc(df).first().roc_auc == pytest.approx(0.5)


def test_auc_matches_brute_force_and_partition_count(spark):
    rnd = random.Random(3)
    ps = [round(rnd.random(), 2) for _ in range(300)]
    ys = [int(rnd.random() < p) for p in ps]
    pos = [p for p, y in zip(ps, ys) if y]
    neg = [p for p, y in zip(ps, ys) if not y]
    brute = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    df = scores(spark, ps, ys)
    assert ev.roc_auc(df).first().roc_auc == pytest.approx(brute)
    assert ev.roc_auc(df.repartition(13)).first().roc_auc == pytest.approx(brute)
    brier = np.mean([(p - y) ** 2 for p, y in zip(ps, ys)])
    assert ev.brier_score(df).first().brier == pytest.approx(brier)


def test_calibration_bin_edges(spark):
    df = scores(spark, [0.0, 0.1, 0.3, 1.0], [0, 0, 1, 1])
    bins = sorted(r.bin for r in ev.calibration_curve(df).collect())
    assert bins == [0, 2, 9]
    assert sorted(r[0] for r in df.select(ev.calibration_bin()).collect()) == [0, 0, 2, 9]


def test_roc_curve_starts_at_origin_and_ends_at_one(spark):
    df = scores(spark, [.9, .8, .7, .6, .1], [1, 0, 0, 0, 1])
    pts = ev.roc_curve(df).orderBy("fpr", "tpr").collect()
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0) and (pts[-1].fpr, pts[-1].tpr) == (1.0, 1.0)
    # .8 and .7 are interior points of one horizontal run: dropped; first threshold always kept
    assert sorted(r.threshold for r in pts if r.threshold != float("inf")) == [0.1, 0.6, 0.9]


def test_running_totals_positions_are_exact_for_any_partitioning(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g"))
    df = df.withColumn("u", hash_uniform(1, "k", "t"))
    for parts in (1, 16):
        rt = running_totals(df, [F.col("u").asc(), F.col("k").asc()], {"one": F.lit(1)}, ("g",), parts)
        got = rt.groupBy("g").agg(F.min("pos"), F.max("pos"), F.count("*"), F.countDistinct("pos")).collect()
        for r in got:
            assert r[1] == 1 and r[2] == r[3] == r[4]
        bad = rt.filter(F.col("pos") != F.col("cum_one")).count()
        assert bad == 0


def test_qini_control_divisor_is_at_least_one(spark):
    rows = [(str(i), 1.0 - i / 100, 1, True) for i in range(10)] + [(str(10 + i), -i / 100, 0, False) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id string, uplift double, label int, treated boolean")
    curve = {r.point: r for r in ev.qini_curve(df).collect()}
    assert curve[0].incremental_conversions == 0.0
    assert curve[10].incremental_conversions == 10.0  # all-treated head: control count 0 → divisor 1
    assert curve[20].pct_targeted == 100.0
    coef = ev.qini_coefficient(ev.qini_curve(df)).first().qini_coefficient
    assert coef > 0


def test_uplift_deciles_collapse_on_ties(spark):
    rows = [(str(i), 0.0 if i < 80 else 0.5, i % 2, i % 3 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "customer_id string, uplift double, label int, treated boolean")
    deciles = sorted(r.decile for r in ev.uplift_by_decile(df).collect())
    assert len(deciles) < 10 and deciles[0] == 1


def test_adjusted_rand_index_cases(spark):
    def ari(a, b):
        df = spark.createDataFrame(list(zip(range(len(a)), a, b)), "i int, a int, b int")
        return ev.adjusted_rand_index(df, "a", "b").first().ari

    lab = [0, 0, 1, 1, 2, 2, 2]
    assert ari(lab, lab) == pytest.approx(1.0)
    assert ari(lab, [5 - x for x in lab]) == pytest.approx(1.0)
    assert ari([0] * 6, [0, 1, 0, 1, 0, 1]) == pytest.approx(0.0)


def test_silhouette_matches_brute_force_squared_euclidean(spark):
    rnd = np.random.default_rng(0)
    pts = np.vstack([rnd.normal(0, 1, (20, 3)), rnd.normal(4, 1, (15, 3)), rnd.normal([0, 5, 0], 1, (10, 3))])
    lab = [0] * 20 + [1] * 15 + [2] * 10
    sil = []
    for i, x in enumerate(pts):
        d = ((pts - x) ** 2).sum(axis=1)
        same = [j for j in range(len(pts)) if lab[j] == lab[i] and j != i]
        a = d[same].mean()
        b = min(d[[j for j in range(len(pts)) if lab[j] == c]].mean() for c in set(lab) if c != lab[i])
        sil.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(l), *map(float, x)) for i, (x, l) in enumerate(zip(pts, lab))],
                               "id int, cluster int, a double, b double, c double")
    got = ev.silhouette(df, ["a", "b", "c"]).first().silhouette
    assert got == pytest.approx(float(np.mean(sil)), rel=1e-9)


def test_hash_uniform_is_partition_invariant_and_uniform(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    a = df.select("k", hash_uniform(42, "k", "x").alias("u"))
    b = df.repartition(16).select("k", hash_uniform(42, "k", "x").alias("u2"))
    assert a.join(b, "k").filter("u != u2").count() == 0
    st = a.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < st[0] and st[1] < 1 and abs(st[2] - 0.5) < 0.01
    assert not math.isnan(st[2])


def test_exact_percentiles(spark):
    from tidewell.operators.quantiles import exact_percentiles
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 300)),) for _ in range(2001)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    xs = sorted(r[0] for r in rows if r[0] is not None)
    for p in (0.0, 0.1, 0.5, 0.75, 0.99, 1.0):
        exp = float(np.percentile(xs, p * 100))
        assert exact_percentiles(df, ["x"], p)["x"] == pytest.approx(exp)
    assert exact_percentiles(df.withColumn("y", -F.col("x")), ["x", "y"], 0.5) == {
        "x": pytest.approx(np.median(xs)), "y": pytest.approx(-np.median(xs))}
    assert exact_percentiles(df.filter("x is null"), ["x"], 0.5) == {"x": None}


def test_grouped_percentiles(spark):
    from tidewell.operators.quantiles import grouped_percentiles
    rnd = random.Random(9)
    rows = [(g, float(rnd.randint(0, 50))) for g in ("a", "b", "c") for _ in range(rnd.randint(5, 200))]
    df = spark.createDataFrame(rows, "g string, x double")
    ps = [0.0, 0.1, 0.5, 0.98, 1.0]
    small = {r.g: r for r in grouped_percentiles(df, "x", ps, ["g"]).collect()}
    for g in ("a", "b", "c"):
        xs = sorted(x for gg, x in rows if gg == g)
        for i, p in enumerate(ps):
            exp = float(np.percentile(xs, p * 100))
            assert small[g][f"q{i}"] == pytest.approx(exp)
