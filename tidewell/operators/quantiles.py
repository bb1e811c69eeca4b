"""Exact percentiles with linear interpolation.

One way for every size: the distinct values of each group are counted, their
order statistics are located from range-partitioned running counts, and the
target ranks are columns of the per-group count table.  Nothing but one row
per group is brought together, so there is no value map in one task and no
switch between algorithms.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import running_totals


def exact_percentiles(df: DataFrame, cols: list[str], p: float) -> dict[str, float]:
    """Exact linear-interpolated p-quantile of each column, all columns in one
    pass (the result has one row per column)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("x")).select("x.col", "x.v")
    rows = {r["col"]: r["q0"] for r in grouped_percentiles(long, "v", [p], ["col"]).collect()}
    return {c: rows.get(c) for c in cols}


def grouped_percentiles(df: DataFrame, col: str, ps: list[float], groups: list[str]) -> DataFrame:
    """Exact linear-interpolated quantiles of ``col`` per group, as columns
    q0..q{k-1} (one per requested p).  Groups without values are absent."""
    v = F.col(col).cast("double")
    base = df.select(*groups, v.alias("_v")).filter(F.col("_v").isNotNull())
    counts = base.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("c"))
    rt = running_totals(counts, [F.col("_v").asc()], {"c": F.col("c")}, tuple(groups))
    n = rt.groupBy(*groups).agg(F.max("cum_c").alias("_n"))
    for i, p in enumerate(ps):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        n = n.withColumns({f"_lo{i}": F.floor(pos), f"_hi{i}": F.ceil(pos), f"_fr{i}": pos - F.floor(pos)})
    j = rt.join(n, list(groups))

    def at(rank):
        return F.max(F.when((F.col("cum_c") - F.col("c") <= rank) & (rank < F.col("cum_c")), F.col("_v")))

    aggs = []
    for i in range(len(ps)):
        aggs += [at(F.col(f"_lo{i}")).alias(f"_a{i}"), at(F.col(f"_hi{i}")).alias(f"_b{i}"),
                 F.first(f"_fr{i}").alias(f"_f{i}")]
    g = j.groupBy(*groups).agg(*aggs)
    return g.select(*groups, *[(F.col(f"_a{i}") + F.col(f"_f{i}") * (F.col(f"_b{i}") - F.col(f"_a{i}"))).alias(f"q{i}")
                               for i in range(len(ps))])
