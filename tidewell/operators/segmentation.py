"""RFM segmentation.

The matrix, profiles, naming and actions are plain aggregates and windows
over the k-row profile.  K-means is Lloyd's algorithm over *all* fits at
once: every (run, restart) keeps its k centres on the driver (bounded by
parameters), the points are stored once, and each iteration is one job that
assigns every point to its nearest centre of every fit in memory and sends
one partial sum per fit and cluster.  A k-sweep, reseeded stability runs and
subsample runs are just more fits in the same job.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_uniform
from tidewell.params import DEFAULT_SEGMENT_ACTION, SEGMENT_ACTIONS, SegmentationParams

RFM_FEATURES = ["x_recency", "x_frequency", "x_monetary"]


def rfm_matrix(features: DataFrame, params: SegmentationParams = SegmentationParams()) -> DataFrame:
    """Recency capped at its exact p99, log1p frequency / monetary, each
    z-scored with the population std (zero std → divide by 1) (G1)."""
    base = features.select("customer_id", "recency_days", "frequency", "monetary")
    from tidewell.operators.quantiles import exact_percentiles
    cap = F.lit(exact_percentiles(base, ["recency_days"], params.recency_winsor_pct / 100.0)["recency_days"])
    t = base.select("*", F.least(F.col("recency_days").cast("double"), cap).alias("_r"),
                    F.log1p("frequency").alias("_f"), F.log1p("monetary").alias("_m"))
    # fitted scaler = six numbers: one aggregate job, applied as literals
    st = t.agg(*[F.avg(c).alias(f"mu{c}") for c in ("_r", "_f", "_m")],
               *[F.stddev_pop(c).alias(f"sd{c}") for c in ("_r", "_f", "_m")]).first()
    out = t
    for c, name in zip(("_r", "_f", "_m"), RFM_FEATURES):
        sd = st[f"sd{c}"] or 1.0
        out = out.withColumn(name, (F.col(c) - F.lit(st[f"mu{c}"])) / F.lit(sd))
    return out.select("customer_id", "recency_days", "frequency", "monetary", *RFM_FEATURES)


def rule_clusters(features: DataFrame) -> DataFrame:
    """Deterministic reference labelling (recency × frequency tiers) used to
    check profile / naming / reporting plans against the oracle."""
    r, f = F.col("recency_days"), F.col("frequency")
    c = (F.when((r <= 30) & (f >= 10), 0).when(r <= 30, 1).when(f >= 10, 2).when(r <= 120, 3).otherwise(4))
    return features.select("customer_id", c.alias("cluster"))


def segment_profiles(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Per cluster: size, mean R/F/M, mean AOV (mean of ratios), mean historical
    LTV, conversion rate (nulls skipped), share of base; named; monetary desc (G9)."""
    df = features.select("customer_id", "recency_days", "frequency", "monetary", "target_conversion") \
        .join(labels.select("customer_id", "cluster"), "customer_id")
    prof = df.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("recency_days").alias("recency_days"), F.avg("frequency").alias("frequency"),
        F.avg("monetary").alias("monetary"), F.avg(F.col("monetary") / F.col("frequency")).alias("avg_order_value"),
        F.avg("monetary").alias("ltv_historical"), F.avg("target_conversion").alias("conversion_rate"))
    prof = prof.withColumn("pct_of_base", F.col("size") / F.sum("size").over(Window.partitionBy()))
    return segment_actions(segment_naming(prof)).orderBy(F.col("monetary").desc(), F.col("cluster"))


def segment_naming(profile: DataFrame) -> DataFrame:
    """Quadrants against the median of cluster means (recency ≤, frequency ≥);
    engaged clusters by monetary: first Champions, rest Loyal Customers;
    repeated names get " 1", " 2", … richest first (G10).
    The windows run over the k-row profile table (bounded by k)."""
    allw = Window.partitionBy()
    p = profile.withColumn("_mr", F.median("recency_days").over(allw)) \
               .withColumn("_mf", F.median("frequency").over(allw))
    low_r = F.col("recency_days") <= F.col("_mr")
    high_f = F.col("frequency") >= F.col("_mf")
    p = p.withColumn("_quad", F.when(low_r & high_f, "engaged").when(low_r, "Potential Loyalists")
                     .when(high_f, "At Risk").otherwise("Hibernating"))
    rich = [F.col("monetary").desc(), F.col("cluster").asc()]
    p = p.withColumn("_qr", F.row_number().over(Window.partitionBy("_quad").orderBy(*rich)))
    p = p.withColumn("_base", F.when(F.col("_quad") != "engaged", F.col("_quad"))
                     .when(F.col("_qr") == 1, "Champions").otherwise("Loyal Customers"))
    p = p.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_base"))) \
         .withColumn("_k", F.row_number().over(Window.partitionBy("_base").orderBy(*rich)))
    name = F.when(F.col("_n") > 1, F.concat_ws(" ", F.col("_base"), F.col("_k").cast("string"))).otherwise(F.col("_base"))
    return p.withColumn("segment_name", name).drop("_mr", "_mf", "_quad", "_qr", "_base", "_n", "_k")


def action_for(name: Column) -> Column:
    base = F.regexp_replace(name, " [0-9]+$", "")
    expr = F.lit(DEFAULT_SEGMENT_ACTION)
    for seg, act in reversed(list(SEGMENT_ACTIONS.items())):
        expr = F.when(base == seg, F.lit(act)).otherwise(expr)
    return expr


def segment_actions(profile: DataFrame) -> DataFrame:
    """Recommended action by segment name, numeric suffix stripped."""
    return profile.withColumn("recommended_action", action_for(F.col("segment_name")))


def segment_assignments(labels: DataFrame, profile: DataFrame) -> DataFrame:
    """customer → cluster → segment name (G12); profile has k rows."""
    return labels.join(F.broadcast(profile.select("cluster", "segment_name")), "cluster", "left") \
        .select("customer_id", "cluster", "segment_name")


def choose_k(sweep: DataFrame, chosen_k: int | None = None) -> DataFrame:
    """Configured k, else the first k with the highest silhouette."""
    if chosen_k:
        return sweep.filter(F.col("k") == chosen_k).select("k")
    return sweep.orderBy(F.col("silhouette").desc(), F.col("k").asc()).limit(1).select("k")


# ---------------------------------------------------------------- batched Lloyd
#
# Points are stored once, whatever the number of fits.  Every job reads them,
# works on all live fits in memory and emits one row per fit and cluster; the
# centres (fits x k rows) travel in the closure.

_DIM = len(RFM_FEATURES)
_SUMS = ", ".join(f"s{i} double" for i in range(_DIM))
# points that one task takes: their bytes are few, but each meets the centres of every fit
POINT_ROWS = 10_000


def _uniform(ids: np.ndarray, *salt: int) -> np.ndarray:
    """Hashed uniforms in (0, 1) from 64-bit ids: partition-independent."""
    x = ids.view(np.uint64).copy()
    for v in salt:
        x = (x ^ np.uint64(v * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(hashed ids, points as one row per feature, run membership by point and run or None for all)."""
    x = np.stack([batch.column(f).to_numpy() for f in RFM_FEATURES])
    member = None
    if "runs" in batch.schema.names:
        runs = batch.column("runs")
        flat = runs.flatten().to_numpy()
        member = np.zeros((x.shape[1], int(flat.max()) + 1 if len(flat) else 1), bool)
        member[np.repeat(np.arange(x.shape[1]), np.diff(runs.offsets.to_numpy())), flat] = True
    return batch.column("hid").to_numpy(), x, member


def _in_run(member: np.ndarray | None, run: int, n: int) -> np.ndarray:
    if member is None:
        return np.ones(n, bool)
    return member[:, run] if run < member.shape[1] else np.zeros(n, bool)


def _by_run(x: np.ndarray, member: np.ndarray | None, fits: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """(fit, its run's points) for each (fit, run): a run's points are taken out once."""
    mine, at = x, None
    for f, run in fits:
        if member is not None and run != at:
            mine, at = x[:, _in_run(member, run, x.shape[1])], run
        yield f, mine


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre (the first of equal ones) and squared distance of points
    given as one row per feature: one centre at a time, in whole columns."""
    best, least = np.zeros(x.shape[1], np.intp), np.full(x.shape[1], np.inf)
    for c, centre in enumerate(centres):
        d = (x[0] - centre[0]) ** 2
        for i in range(1, _DIM):
            d += (x[i] - centre[i]) ** 2
        best[d < least] = c
        least = np.minimum(d, least)
    return best, least


def _seed_centres(points: DataFrame, fits: list[tuple[int, int, int]], seed: int) -> dict[int, np.ndarray]:
    """k-means++ seeding for all fits at once: each next centre is drawn with
    probability proportional to the squared distance, as the winner of an
    exponential race (least -ln(u) / d2).  One job per centre."""
    centres: dict[int, np.ndarray] = {f: np.empty((0, _DIM)) for f, _, _ in fits}
    for c in range(max(k for _, k, _ in fits)):
        # a run without rows, or with fewer distinct points than centres, gets no more
        live = [(f, run) for f, k, run in fits if k > c and len(centres[f]) == c]
        if not live:
            break

        def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple] = {}
            for batch in batches:
                ids, x, runs = _batch(batch)
                for f, run in live:
                    with np.errstate(divide="ignore"):
                        t = -np.log(_uniform(ids, seed, f, c))
                        if c:
                            t = t / _nearest(x, centres[f])[1]
                    t[~_in_run(runs, run, len(t))] = np.inf
                    if len(t):
                        i = int(np.lexsort((ids, t))[0])
                        if np.isfinite(t[i]) and (f not in best or (t[i], ids[i]) < best[f][:2]):
                            best[f] = (t[i], ids[i], *x[:, i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), *(pa.array([b[j] for b in best.values()], pa.float64() if j != 1 else pa.int64())
                                                     for j in range(2 + _DIM))],
                ["fit", "t", "hid", *[f"s{i}" for i in range(_DIM)]])

        won = points.mapInArrow(race, f"fit int, t double, hid long, {_SUMS}").groupBy("fit").agg(
            F.min(F.struct("t", "hid", *[f"s{i}" for i in range(_DIM)])).alias("w")).collect()
        for r in won:
            centres[r.fit] = np.vstack([centres[r.fit], [r.w[f"s{i}"] for i in range(_DIM)]])
    return centres


def lloyd(points: DataFrame, fits: list[tuple[int, int, int]], seed: int, max_iter: int, tol: float):
    """Lloyd's algorithm for every (fit, k, run) at once, one job per
    iteration over the points stored once.

    A fit has converged when the sum of its squared centre shifts is at most
    ``tol`` x the mean feature variance; converged fits are left out of later
    iterations.  Returns (centres by fit, {fit: (iterations, converged)})."""
    from tidewell.session import static_plans
    var = points.agg(*[F.var_pop(f) for f in RFM_FEATURES]).first()
    threshold = tol * (sum(v or 0.0 for v in var) / _DIM)
    # the shuffle carries at most fits x k rows per task: size it to that
    with static_plans(points.sparkSession, max(1, -(-sum(k for _, k, _ in fits) // 20000))):
        centres = _seed_centres(points, fits, seed)
        status = {f: (0, False) for f, _, _ in fits}
        for it in range(1, max_iter + 1):
            live = [(f, run) for f, _, run in fits if not status[f][1] and len(centres[f])]
            if not live:
                break

            def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = {f: np.zeros((len(centres[f]), 1 + _DIM)) for f, _ in live}
                for batch in batches:
                    _, x, runs = _batch(batch)
                    for f, mine in _by_run(x, runs, live):
                        best, _ = _nearest(mine, centres[f])
                        for i, w in enumerate([None, *mine]):
                            total[f][:, i] += np.bincount(best, w, len(centres[f]))
                rows = [(f, c, *t) for f, ts in total.items() for c, t in enumerate(ts) if t[0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate(
                        [pa.int32(), pa.int32()] + [pa.float64()] * (1 + _DIM))],
                    ["fit", "cluster", "n", *[f"s{i}" for i in range(_DIM)]])

            new = points.mapInArrow(sums, f"fit int, cluster int, n double, {_SUMS}").groupBy("fit", "cluster").agg(
                F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(_DIM)]).collect()
            moved = {f: centres[f].copy() for f, _ in live}      # an emptied cluster keeps its centre
            for r in new:
                moved[r.fit][r.cluster] = [r[f"s{i}"] / r.n for i in range(_DIM)]
            for f, _ in live:
                status[f] = (it, bool(((moved[f] - centres[f]) ** 2).sum() <= threshold))
                centres[f] = moved[f]
    return centres, status


# slices of (0, 1) in which a run's draws are counted: the last member is looked for in one of them
SLICES = 4096


def _draw(seed: int, run: Column) -> Column:
    return hash_uniform(seed, F.concat_ws(":", run.cast("string"), F.col("customer_id")), "subsample")


def subsample_runs(matrix: DataFrame, runs: list[int], frac: float, seed: int) -> Column:
    """Exactly floor(frac·n) customers per run, without replacement: the customers with
    the smallest hashed uniform for that run, as an array of runs for each row of
    ``matrix``.  Only the last member of each run is looked for: draws are counted by
    slice, the slice in which the count is reached is ranked, and whoever does not come
    after the last member belongs to the run, so customers x runs are never shuffled."""
    from tidewell.operators.ordered import running_totals
    m = int(matrix.count() * frac)
    drawn = matrix.select("customer_id", F.explode(F.array(*[F.lit(r) for r in runs])).alias("run"))
    drawn = drawn.withColumn("_u", _draw(seed, F.col("run"))).withColumn("_slice", F.floor(F.col("_u") * SLICES))
    upto = F.sum("n").over(Window.partitionBy("run").orderBy("_slice"))
    edges = (drawn.groupBy("run", "_slice").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
             .filter((F.col("upto") >= m) & (F.col("upto") - F.col("n") < m)).collect())
    if not edges:                                  # no customers, or none to be drawn
        return F.array().cast("array<int>")
    by_run = lambda values: F.create_map(*[F.lit(x) for r in edges for x in (r.run, values[r.run])])[F.col("run")]
    inside = drawn.filter(F.col("_slice") == by_run({r.run: r._slice for r in edges})).drop("_slice")
    last = running_totals(inside, [F.col("_u").asc(), F.col("customer_id").asc()], {}, ("run",)) \
        .filter(F.col("pos") == by_run({r.run: m - (r.upto - r.n) for r in edges})).collect()
    cuts = F.array(*[F.struct(F.lit(r.run).alias("run"), F.lit(r._u).alias("u"), F.lit(r.customer_id).alias("id")) for r in last])
    return F.transform(F.filter(cuts, lambda c: F.struct(_draw(seed, c["run"]), F.col("customer_id")) <= F.struct(c["u"], c["id"])),
                       lambda c: c["run"])


def subsample_members(matrix: DataFrame, runs: list[int], frac: float, seed: int) -> DataFrame:
    """The customers of each run (``subsample_runs``), one row each."""
    return matrix.select(F.explode(subsample_runs(matrix, runs, frac, seed)).alias("run"), "customer_id")


def _inertia(points: DataFrame, fits: list[tuple[int, int, int]], centres: dict[int, np.ndarray]) -> dict[int, float]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeded = [(f, run) for f, _, run in fits if len(centres[f])]
        total = dict.fromkeys((f for f, _ in seeded), 0.0)
        for batch in batches:
            _, x, runs = _batch(batch)
            for f, mine in _by_run(x, runs, seeded):
                total[f] += float(_nearest(mine, centres[f])[1].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64())],
                                         ["fit", "d"])

    return {r.fit: r.d for r in points.mapInArrow(work, "fit int, d double").groupBy("fit").agg(F.sum("d").alias("d")).collect()}


def kmeans_fits(matrix: DataFrame, fits: list[tuple[int, int, int, int]], subsample: DataFrame | Column | None = None,
                params: SegmentationParams = SegmentationParams(), carry: tuple[str, ...] = tuple(RFM_FEATURES)):
    """Fit every (fit, k, run, restart) on the matrix (or, per run, on the
    subsample: (run, customer_id) rows, or an array of runs for each row of the
    matrix) and keep per run the restart with the lowest inertia.

    Returns (labels, summary): labels (run, customer_id, cluster, and the columns of the
    matrix named in ``carry``) of the best restart per run, summary (run, k, inertia,
    iterations, converged)."""
    from pyspark import StorageLevel
    from tidewell.session import ensure_checkpoint_dir, ship_package
    spark = matrix.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    points = matrix.select("customer_id", F.xxhash64("customer_id").alias("hid"),
                           *[F.col(f).cast("double").alias(f) for f in RFM_FEATURES],
                           *[F.col(c) for c in carry if c not in RFM_FEATURES],
                           *([subsample.alias("runs")] if isinstance(subsample, Column) else []))
    if isinstance(subsample, DataFrame):
        # the runs of a customer as one array (at most the number of runs)
        points = points.join(subsample.groupBy("customer_id").agg(F.collect_set("run").alias("runs")), "customer_id")
    need = -(-matrix.count() // POINT_ROWS)
    if need > 1:
        points = points.repartition(need, "customer_id")
    # A reliable copy cuts the lineage; iterations read it from executor memory
    # (a lost block is re-read from the copy).
    points = points.checkpoint(eager=True)
    if isinstance(subsample, Column):
        # not before: a filter would draw all runs again
        points = points.filter(F.size("runs") > 0)
    held = points.persist(StorageLevel.MEMORY_AND_DISK)
    shapes = [(f, k, run) for f, k, run, _ in fits]
    centres, status = lloyd(held, shapes, params.seed, params.max_iter, params.tol)
    inertia = _inertia(held, shapes, centres)
    held.unpersist()
    best: dict[int, tuple] = {}
    for f, k, run, restart in fits:
        if f in inertia and (run not in best or (inertia[f], restart) < best[run][:2]):
            best[run] = (inertia[f], restart, f, k)
    chosen = [(run, centres[f]) for run, (_, _, f, _) in best.items()]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, runs = _batch(batch)
            for run, c in chosen:
                mine = _in_run(runs, run, x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(mine.sum()), run), pa.int32()), batch.column("customer_id").filter(pa.array(mine)),
                     pa.array(_nearest(x, c)[0][mine], pa.int32()), *(batch.column(v).filter(pa.array(mine)) for v in carry)],
                    ["run", "customer_id", "cluster", *carry])

    labels = points.mapInArrow(label, ", ".join(["run int, customer_id string, cluster int", *(
        f"{c} {points.schema[c].dataType.simpleString()}" for c in carry)]))
    summary = spark.createDataFrame([(run, k, i, *status[f]) for run, (i, _, f, k) in best.items()],
                                    "run int, k int, inertia double, iterations int, converged boolean")
    return labels, summary


def fit_table(ks: list[int], restarts: int, first_run: int = 0) -> list[tuple[int, int, int, int]]:
    """(fit, k, run, restart) rows: one run per k, ``restarts`` fits per run."""
    out, fit = [], 0
    for run, k in enumerate(ks, start=first_run):
        for r in range(restarts):
            out.append((fit, k, run, r))
            fit += 1
    return out
