"""How filters interact: what each removes, in every order of applying them.

1. Scan.  One pass of a table-driven finite-state transducer over the UTF-8
   bytes of a batch of texts.  Its two states are "between words" and "in a
   word"; a transition emits actions: a word starts or ends, a capital, a
   symbol, a code point.  The next state depends on the byte alone, so all
   transitions of a batch are looked up at once.  The word spans it emits are
   inserted in a hash table of byte strings (equal hashes are settled by the
   bytes), whose size is the number of distinct words.  No text is shuffled.
2. Copies.  Equal texts have equal digests (128 bits of SHA-256); rows are counted per
   (digest, part, labels) before the least id of a digest is joined back, so a
   text with a third of all rows is a few rows there.
3. Lattice.  What remains are counts per part and set of failed filters, 32 at
   most; every order, step and share follows from them.

Defined cases: null text is empty: no words, no code points, and it fails the
length filter only (and the copy filter, after the first).  A document fails the copy
filter if a smaller id has its text; rows sharing an id do not make each other
fail, and a null id is smaller than none and has none smaller.  Null parts, and a
missing part column, are the empty string.  Labels of one document are merged
(a 1 in any row counts); null labels count as 0, labels of unknown
documents are ignored, and a null id has no labels.  Only the id, text and part
columns of ``docs`` are read, so further columns of any name are harmless.  Empty tables
give empty results.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SPACES, UPPER, stage, text_or_empty
from tidewell.session import ship_package, sql_conf

FILTERS = "ABCDE"        # words, distinct words, capitals, symbols, copies
BATCH_ROWS = 1000


@dataclass(frozen=True)
class AuditParams:
    min_words: int = 200
    min_distinct_pct: int = 50
    max_capital_pct: int = 2
    symbols: str = "#$%&*|"


BETWEEN, WORD = 0, 1
START, END, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16


def transducer(symbols: str) -> tuple[np.ndarray, np.ndarray]:
    """(next state of each byte, actions of each state and byte)."""
    byte = np.arange(256)
    space = np.isin(byte, list(SPACES.encode()))
    after = np.where(space, BETWEEN, WORD).astype(np.uint8)
    common = (CAPITAL * np.isin(byte, list(UPPER.encode())) + SYMBOL * np.isin(byte, list(symbols.encode()))
              + POINT * (byte & 0xC0 != 0x80))          # all but continuation bytes
    emit = np.stack([common + START * ~space, common + END * space]).astype(np.uint8)
    return after, emit


class Scan:
    """Counts of a batch of texts that lie one after the other in ``data``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, tables: tuple[np.ndarray, np.ndarray]):
        """ends: where each text ends; the first starts at 0."""
        after, emit = tables
        begins = np.r_[0, ends[:-1]].astype(np.int64)
        state = np.full(len(data), BETWEEN, np.uint8)
        state[1:] = after[data[:-1]]
        state[begins[begins < ends]] = BETWEEN          # each text starts anew
        act = emit[state, data]
        full = ends[begins < ends]
        # a word open at the end of its text ends there
        open_ends = full[after[data[full - 1]] == WORD]
        self.starts = np.flatnonzero(act & START)
        self.stops = np.sort(np.r_[np.flatnonzero(act & END), open_ends])
        self.data = data

        def count(action: int) -> np.ndarray:
            at = np.flatnonzero(act & action)
            return np.searchsorted(at, ends) - np.searchsorted(at, begins)

        self.edges = np.r_[0, np.searchsorted(self.starts, ends)]
        self.n_words = np.diff(self.edges)
        self.n_capitals, self.n_symbols = count(CAPITAL), count(SYMBOL)
        sums = np.r_[0, np.cumsum(act & POINT != 0)]
        self.n_points = sums[ends] - sums[begins]

    def distinct_words(self) -> np.ndarray:
        """Size of each text's table of words."""
        raw = self.data.tobytes()
        out = np.empty(len(self.n_words), np.int64)
        for k, (a, b) in enumerate(zip(self.edges, self.edges[1:])):
            spans = map(slice, self.starts[a:b].tolist(), self.stops[a:b].tolist())
            out[k] = len(set(map(raw.__getitem__, spans)))
        return out


COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]


def _scan_batches(tables: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2)
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
            held = text.buffers()[2]
            data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.empty(0, np.uint8)
            ends = offsets[1:] - offsets[0]
            scan = Scan(data, ends, tables)
            digests = [hashlib.sha256(data[a:b]).digest()[:16] for a, b in zip(np.r_[0, ends[:-1]], ends)]
            counts = [scan.n_words, scan.distinct_words(), scan.n_capitals, scan.n_points, scan.n_symbols]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(digests, pa.binary())], ["doc_id", "part", *COUNTS, "digest"])
    return run


def _bits(flags: list[Column]) -> Column:
    out = F.lit(0)
    for k, c in enumerate(flags):
        out = out + F.when(c, 1 << k).otherwise(0)
    return out


def text_outcomes(docs: DataFrame, params: AuditParams = AuditParams(), part: str = "source") -> DataFrame:
    """(doc_id, part, the counts, digest, failed): one row per row of ``docs``,
    stored; bit k of ``failed`` is the k-th filter, copies not yet among them."""
    ship_package(docs.sparkSession)
    where = F.coalesce(docs[part].cast("string"), F.lit("")) if part in docs.columns else F.lit("")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), where.alias("part"), text_or_empty(docs).alias("text"))
    schema = "doc_id long, part string, " + ", ".join(f"{c} long" for c in COUNTS) + ", digest binary"
    with sql_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
                                      "spark.sql.execution.arrow.useLargeVarTypes": "false"}):
        out = rows.mapInArrow(_scan_batches(transducer(params.symbols)), schema)
        n = F.col("n_words")
        return stage(out.withColumn("failed", _bits([
            n < params.min_words, 100 * F.col("n_distinct") < params.min_distinct_pct * n,
            100 * F.col("n_capitals") > params.max_capital_pct * F.col("n_points"), F.col("n_symbols") > 0])), "filter-scan")


def _labels(labels: DataFrame) -> DataFrame:
    def one(c: str) -> Column:
        return F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias("good" if c == "quality" else c)
    return labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        one("quality"), one("toxic"))


def failure_counts(outcomes: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, n_good, n_toxic): documents per set of failed filters, copies included."""
    copy_bit = 1 << FILTERS.index("E")
    docs = outcomes.groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    marked = docs.join(_labels(labels), docs["doc_id"] == F.col("l_id"), "left").select(
        "doc_id", "part", "digest", "failed", "n", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # of a group only the rows of its least id can be the first of their text
    groups = stage(marked.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null")), "filter-groups")
    first = groups.groupBy("digest").agg(F.min("least").alias("first")).withColumnRenamed("digest", "d")
    both = groups.join(first, F.col("digest") == F.col("d"))
    stays = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = both.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("failed").alias("failed"), stays.alias("n")),
        F.struct((F.col("failed") + copy_bit).alias("failed"), (F.col("n") - stays).alias("n")))).alias("x"))
    return split.filter("x.n > 0").groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("n_toxic"))


def lattice(counts: DataFrame) -> DataFrame:
    """Every order and step of the filters per part, from ``failure_counts``."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "n_good", "n_toxic")).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = cells.select("part", "cells", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bit(place: Column) -> Column:
        letter = F.substring("filter_order", place, F.lit(1))
        return F.pow(F.lit(2), F.instr(F.lit(FILTERS), letter) - 1).cast("int")

    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    rows = rows.withColumns({
        "own": bit(F.col("step")),
        "earlier": F.aggregate(F.filter(steps, lambda i: i < F.col("step")), F.lit(0), lambda a, i: a + bit(i))})

    def total(value, keep) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(keep(c["failed"]), value(c)).otherwise(0))

    own, earlier = F.col("own"), F.col("earlier")
    fails = lambda m: m.bitwiseAND(own) != 0                              # noqa: E731
    present = lambda m: m.bitwiseAND(earlier) == 0                        # noqa: E731
    removed = lambda m: fails(m) & present(m)                             # noqa: E731
    count = lambda c: c["n"]                                              # noqa: E731
    orders_n = factorial(len(FILTERS))
    return rows.select(
        "part", "filter_order", "step",
        total(count, lambda m: m.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"),
        total(count, removed).alias("removed"), total(count, lambda m: fails(m) & ~present(m)).alias("redundant"),
        total(count, lambda m: m == own).alias("unique_fails"),
        total(lambda c: c["n_good"], removed).alias("good_lost"), total(lambda c: c["n_toxic"], removed).alias("toxic_lost"),
        # of the filters that a document fails, each comes first in an equal share of the orders
        total(lambda c: (c["n"] * orders_n / F.bit_count(c["failed"])).cast("long"), fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, params: AuditParams = AuditParams(), part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) per part, order and step."""
    return lattice(failure_counts(text_outcomes(docs, params, part), labels))
