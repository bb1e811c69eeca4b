"""Corpus pipeline: five stages applied in order to ``documents``.

Each stage takes the table its predecessor wrote and works on all of it.  All
but the last return the columns of ``documents``; the last returns the packed
pieces.  Documents that a stage empties stay, as empty documents, until
packing, where they are one end token.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import stage, table
from tidewell.llm.decontaminate import decontaminate
from tidewell.llm.line_dedup import dedup_lines
from tidewell.llm.near_dedup import drop_near_copies
from tidewell.llm.packing import pack_documents
from tidewell.llm.quality_rules import keep_quality

NEAR_WORDS = 5            # words in a shingle; similarity is 0.8 or more
CAPACITY = 4096


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the smallest doc_id only."""
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return drop_near_copies(docs, NEAR_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# certified cutoffs and token ids are beyond SQL: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
