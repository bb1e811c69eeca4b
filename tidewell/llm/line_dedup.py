"""Exact line de-duplication over levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space and A-Z lower-cased;
keys shorter than ``min_chars`` code points are never dropped.  Documents
arrive in batches of ascending doc_id.  ``LineRuns`` holds the keys seen so
far as immutable runs, bucketed and sorted by hash: each batch aggregates
its own keys (map-side), merge-joins them against the runs without
re-shuffling those, and adds what the runs don't hold as a new level-0 run.
``fan_out`` runs of a level are merged into one run of the next.

Keys are held as 96 bits (xxhash64 + murmur3); at 10^12 distinct lines the
chance of any collision is about 1e-5.

Defined cases: null or empty text is one empty line.  Rows with one doc_id
are one document as far as ownership goes (each row is returned, all keep
their lines if that doc_id is the smallest).  A null doc_id comes after all
others.  Further input columns pass through; ``n_lines`` and ``n_dropped``
replace input columns of that name.  An empty table gives an empty result.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import (P, SPACES, ascii_lower, shuffle_partitions, stage, stage_path,
                                 text_hash, text_or_empty)

MIN_CHARS = 10
BATCHES = 4
FAN_OUT = 3
LAST = (1 << 63) - 1


class LineRuns:
    """Levelled sorted runs of (h, g, owner), one bucketed table per run."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT, buckets: int | None = None):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"tidewell_line_run_{uuid.uuid4().hex}"
        self.paths[name] = stage_path(self.spark, "line-run")
        (df.repartition(self.buckets, "h", "g").write
           .bucketBy(self.buckets, "h", "g").sortBy("h", "g")
           .option("path", self.paths[name]).format("parquet").saveAsTable(name))
        return name

    def _keys(self, name: str) -> DataFrame:
        return self.spark.table(name).filter(~F.col("seen")).select("h", "g", "owner")

    def probe(self, keys: DataFrame) -> DataFrame:
        """``keys`` (unique h, g) with ``seen``: held by a run already."""
        runs = [self._keys(n) for level in self.levels for n in level]
        out = keys.withColumn("seen", F.lit(False))
        for run in runs:
            hit = run.select("h", "g", F.lit(True).alias("hit"))
            out = out.join(hit, ["h", "g"], "left").withColumn(
                "seen", F.col("seen") | F.coalesce("hit", F.lit(False))).drop("hit")
        return out

    def add(self, keys: DataFrame) -> DataFrame:
        """Merge-anti-join a batch's keys, store them as a run, compact, and
        return the batch's keys with ``seen``."""
        name = self._write(self.probe(keys))
        self._place(name, 0)
        # read by path: without the buckets a join may split a hot line's rows
        return self.spark.read.schema(self.spark.table(name).schema).parquet(self.paths[name])

    def _place(self, name: str, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            merged = reduce(DataFrame.unionByName, [self._keys(n) for n in self.levels[level]])
            self.levels[level] = []
            self._place(self._write(merged.withColumn("seen", F.lit(False))), level + 1)

    def forget(self) -> None:
        """Drop the catalog entries (files stay with the checkpoint folder)."""
        for name in self.paths:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, th, line, h, g) for every line whose key is long enough."""
    text = text_or_empty(docs)
    lines = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("doc"),
                        text_hash(text).alias("th"),
                        F.posexplode(F.split(text, "\n", -1)).alias("line", "raw"))
    keyed = lines.select("doc", "th", "line", ascii_lower(F.btrim("raw", F.lit(SPACES))).alias("key"))
    return (keyed.filter(F.char_length("key") >= min_chars)
                 .select("doc", "th", "line", F.xxhash64("key").alias("h"), F.hash("key").alias("g")))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                  fan_out: int = FAN_OUT) -> DataFrame:
    """(doc, th, lines): positions of the lines each document loses."""
    spark = docs.sparkSession
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile(
        "d", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    rows = line_rows(docs, min_chars)
    batch = reduce(lambda a, c: a + (F.col("doc") > F.lit(int(c))).cast("int"), cuts, F.lit(0))
    rows = stage(rows.withColumn("batch", batch), "lines", ["batch"])
    runs = LineRuns(spark, fan_out)
    found = []
    for i in range(len(cuts) + 1):
        pairs = rows.filter(F.col("batch") == i)
        keys = pairs.groupBy("h", "g").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
        held = runs.add(keys).filter(F.col("seen") | (F.col("owner") < F.col("last")))
        lost = pairs.join(held.select("h", "g", "owner", "seen"), ["h", "g"])
        found.append(stage(lost.filter(F.col("seen") | (F.col("doc") != F.col("owner")))
                               .select("doc", "th", "line"), "lost"))
    lost = reduce(DataFrame.unionByName, found)
    # a repeated row has each position once per copy
    out = lost.groupBy("doc", "th").agg(F.collect_set("line").alias("lines"))
    runs.forget()
    return out


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                fan_out: int = FAN_OUT) -> DataFrame:
    """``docs`` with ``text`` reduced to the kept lines, plus ``n_lines``
    (before) and ``n_dropped``.  A text that was null is empty."""
    text = text_or_empty(docs)
    keyed = docs.withColumns({"text": text, P + "th": text_hash(text),
                              P + "doc": F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST))})
    lost = dropped_lines(docs, min_chars, batches, fan_out).select(
        F.col("doc").alias(P + "doc"), F.col("th").alias(P + "th"), F.col("lines").alias(P + "lost"))
    both = keyed.join(lost, [P + "doc", P + "th"], "left")
    lines = F.split(F.col("text"), "\n", -1)
    n = F.size(lines)
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col(P + "lost"))
    kept = F.when(F.col(P + "lost").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(P + "all"), i)), "\n"))
    both = both.withColumn(P + "all", lines).withColumns({
        P + "kept": kept, "n_lines": n.cast("long"),
        "n_dropped": F.coalesce(F.size(P + "lost"), F.lit(0)).cast("long")})
    both = both.withColumn("n_dropped", F.when(F.col(P + "lost").isNull(), F.lit(0).cast("long"))
                           .otherwise(F.col("n_dropped")))
    out = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return both.withColumn("text", F.col(P + "kept")).select(*out)
