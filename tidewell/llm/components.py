"""Connected components of a table of edges, by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    links = e.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return links.unionByName(least.select("u", F.col("m").alias("v")))


def _is_star(e: DataFrame) -> bool:
    """Every node has one root, and no root has another."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v long), root being the
    least node reachable.  Each round halves the distance to the roots at
    least; a round's edges are never more than the last's, and hubs are
    aggregated before they are shuffled.  Self-loops and repeats are fine."""
    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .filter("u <> v").distinct(), "edges")
    while not _is_star(e):
        e = stage(_small_star(_large_star(e)).distinct(), "edges")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
