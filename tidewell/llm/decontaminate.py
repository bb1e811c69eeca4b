"""Benchmark decontamination with a broadcast set of n-gram hashes.

Words are maximal runs of digits, lower-cased A-Z and non-ASCII characters.
A benchmark item is cut into windows of ``window`` words (one window if it
has fewer).  Training documents are scanned in two steps, both plain
DataFrame operations:

1. Probe.  Any occurrence of a window of m words holds a whole k-gram that
   starts at a multiple of m - k + 1; with k = (m + 1) / 2 every sixth word
   of a document is probed for windows of ten.  Probes meet the set of all
   k-grams of the windows.
2. Verify.  Documents with a met probe are cut into all their windows, which
   are joined to the benchmark's by their words (not by a hash).

The benchmark's sets are broadcast while their counted rows stay below
BROADCAST_ROWS; a larger benchmark is joined by shuffling, with the same
result.

Defined cases: null or empty texts have no words and are clean; items
without words have no windows.  Rows sharing a doc_id are judged each by its
own text; every input row gives one row.  Items sharing an item_id count
once.  Extra columns pass through ``decontaminate``.  Empty tables give
empty or clean results.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, ascii_lower, stage, text_hash, text_or_empty

WINDOW = 10
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"       # every character that no word holds
# the same before lower-casing
RAW_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_WORD = RAW_OTHER.replace("[", "[^")
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), OTHER + "+", -1), "")


def _bounded(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, m, gram): the distinct windows, words joined by blanks."""
    text = F.coalesce(benchmark["text"].cast("string"), F.lit(""))
    base = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(text).alias("w"))
    base = base.withColumn("m", F.least(F.size("w"), F.lit(window))).filter("m > 0")
    return base.select("item_id", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("i"), "w") \
        .select("item_id", "m", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("gram")).distinct()


def _gram_length(m: int) -> int:
    return (m + 1) // 2


def _probes(w: Column, m: int) -> Column:
    """Hashes of the k-grams at every (m - k + 1)-th word."""
    k = _gram_length(m)
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - k, F.lit(m - k + 1)), lambda i: F.xxhash64(
        *[F.get(w, i + j) for j in range(k)]))
    return F.when(F.size(w) >= m, grams).otherwise(F.array().cast("array<bigint>"))


def _probe_set(grams: DataFrame, m: int) -> DataFrame:
    k = _gram_length(m)
    w = F.split("gram", " ")
    return grams.filter(F.col("m") == m).select(F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(m - k)), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).alias("h"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, hits).  rows: (doc_id, th, n_words), one per row of ``docs``.
    hits: (doc_id, th, spans, items), spans being the sorted (first word, word
    after the last) of every occurrence."""
    grams = stage(windows(benchmark, window), "benchmark-windows")
    sizes = {r.m: r.n for r in grams.groupBy("m").agg(F.count("*").alias("n")).collect()}   # at most ``window`` rows
    text = text_or_empty(docs)
    key = [docs["doc_id"], text_hash(text).alias("th")]
    base = docs.select(*key, F.monotonically_increasing_id().alias("row"), words(text).alias("w"))
    if not sizes:
        rows = base.select("doc_id", "th", F.size("w").cast("long").alias("n_words"))
        return rows, base.limit(0).select("doc_id", "th", F.array().cast(
            "array<struct<a:int,b:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    sets = reduce(DataFrame.unionByName, [_probe_set(grams, m) for m in sizes]).distinct()
    n_probes = sum(n * (m - _gram_length(m) + 1) for m, n in sizes.items())
    probed = base.select("doc_id", "th", "row",
                         F.size("w").cast("long").alias("n_words"),
                         F.explode_outer(F.concat(*[_probes(F.col("w"), m) for m in sizes])).alias("h"))
    met = probed.join(_bounded(sets.withColumn("met", F.lit(True)), n_probes), "h", "left")
    rows = stage(met.groupBy("row", "doc_id", "th", "n_words").agg(F.max("met").alias("met")).drop("row"), "probed")
    found = rows.filter("met").select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct()

    near = docs.select(*key, text.alias("text"))
    near = near.join(found, near["doc_id"].eqNullSafe(found["d"]) & (near["th"] == found["t"]), "left_semi")
    near = near.dropDuplicates(["doc_id", "th"]).select("doc_id", "th", words(F.col("text")).alias("w"))
    starts = lambda m: F.when(F.size("w") >= m, F.transform(
        F.sequence(F.lit(0), F.size("w") - m), lambda i: F.struct(
            i.alias("a"), (i + m).alias("b"), F.array_join(F.slice("w", i + 1, m), " ").alias("gram"))))
    cut = near.select("doc_id", "th", F.inline(F.concat(*[F.coalesce(starts(m), F.array().cast(
        "array<struct<a:int,b:int,gram:string>>")) for m in sizes])))
    hits = cut.join(_bounded(grams.select("item_id", "gram"), sum(sizes.values())), "gram")
    hits = hits.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"),
                                            F.sort_array(F.collect_set("item_id")).alias("items"))
    return rows.drop("met"), hits


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(acc["upto"], x["a"]))).alias("n"),
        F.greatest(acc["upto"], x["b"]).alias("upto"))
    return F.aggregate(spans, start, step)["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) per row of ``docs``."""
    rows, hits = scan(docs, benchmark, window)
    hits = hits.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), covered(F.col("spans")).alias("n_hit"), "items")
    both = rows.join(hits, rows["doc_id"].eqNullSafe(hits["d"]) & (rows["th"] == hits["t"]), "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return both.select("doc_id", "n_words", n.alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                       (n > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                  window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with
    the hit words, and what separates them from the next word, cut out."""
    _, hits = scan(docs, benchmark, window)
    hits = hits.select(F.col("doc_id").alias(P + "doc"), F.col("th").alias(P + "th2"), F.col("spans").alias(P + "spans"))
    keyed = docs.withColumn(P + "th", text_hash(text_or_empty(docs)))
    on = keyed["doc_id"].eqNullSafe(hits[P + "doc"]) & (keyed[P + "th"] == hits[P + "th2"])
    if remove == "documents":
        return keyed.join(hits, on, "left_anti").select(*docs.columns)
    both = keyed.join(hits, on, "left")
    chunks = F.regexp_extract_all("text", F.lit(f"{RAW_WORD}+{RAW_OTHER}*"), F.lit(0))
    hit = F.flatten(F.transform(P + "spans", lambda s: F.sequence(s["a"], s["b"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), hit)
    cut = F.concat(F.regexp_extract("text", f"^{RAW_OTHER}*", 0),
                   F.array_join(F.transform(stay, lambda i: F.get(chunks, i)), ""))
    return both.withColumn("text", F.when(F.col(P + "spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
