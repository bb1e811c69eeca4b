"""The registered query of each operator and, where SQL can say it, its DuckDB SQL."""
from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import oracle, reshard
from tidewell.llm.common import stage_path, table
from tidewell.llm.decontaminate import contamination
from tidewell.llm.filter_audit import audit
from tidewell.llm.html_text import extract
from tidewell.llm.line_dedup import dedup_lines
from tidewell.llm.near_dedup import near_components
from tidewell.llm.packing import pack_documents
from tidewell.llm.periodic_runs import periodic_runs
from tidewell.llm.quality_classifier import classify
from tidewell.llm.quality_rules import judge
from tidewell.llm.substring_dedup import repeat_report
from tidewell.llm.topk_search import top_k
from tidewell.llm.warc import pages_of, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_line_dedup", oracle.LINE_DEDUP)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the smallest doc_id only."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op7_quality_rules", oracle.quality_rules())
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and certified cutoffs for every document."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


OLD_SHARDS = 16


@query("op9_resharding")
def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards by text hash become 24 even ones; the digest is of the files
    then written (every shard gives or takes, so all are)."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(OLD_SHARDS))
    plan = reshard.plan(docs, old, OLD_SHARDS)
    out = reshard.rewrite(docs, old, plan, stage_path(spark, "reshard"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", reshard.document_size(text).alias("size"), F.crc32(text).alias("text_crc32"),
                      F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"),
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as tokens in as few 4096-token sequences as best fit finds."""
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_warc", oracle.WARC)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records (equal large payloads as revisits) and read back."""
    path = stage_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return pages_of(spark, path)


@query("op6_decontamination", oracle.DECONTAMINATION)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op8_near_dedup", oracle.NEAR_DEDUP)
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles."""
    return near_components(table(spark, sf_dir, "documents")).drop("th")


@query("op10_substring_dedup", oracle.SUBSTRING_DEDUP)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated 400-byte strings cover in every document."""
    return repeat_report(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document from weak labels and the scorer they train."""
    out = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[F.round(c, 6).alias(c) for c in (
        "quality_posterior", "quality_score", "toxic_posterior", "toxic_score")], "good", "toxic", "kept")


@query("op11_top_k_search", oracle.TOP_K)
def op11_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest inner products of every 50th vector with all others."""
    out = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, scale=256.0)
    return out.select("query_id", "rank", "vec_id", "score")


@query("op12_filter_audit", oracle.FILTER_AUDIT)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source, in each of their orders."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repeat_tail(doc_id: int, words: list[bytes]) -> list[bytes]:
    """In one document of ten the words from some place on repeat their first few."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic word runs of every document, and the document without their repeats."""
    out = periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=repeat_tail)
    runs = F.col("runs")
    best = F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * -F.col("best.l") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))
