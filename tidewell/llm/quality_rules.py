"""Quality rules with risk-controlled cutoffs.

Base rules are fixed.  On top, each stratum (language) gets one cutoff per
metric, chosen on a labelled holdout so that the share of good documents that all
its cutoffs together reject is provably at most ``risk``: a document goes if any
metric rejects it, so each metric may use risk / metrics.  A cutoff is certified when
the exact binomial tail P(Bin(n, risk / metrics) <= k) is at most the test's level, n being the good
holdout documents of the stratum and k those rejected.  The cutoffs of a
metric are tested from lenient to strict and testing stops at the first
failure (fixed sequence, no further correction needed); across strata and
metrics the level is divided by their number (Bonferroni).  Of the certified
cutoffs, the one that rejects most bad documents net of ``cost`` times the
good ones is used, the most lenient of equals; none if no cutoff gains.

Strata are the listed languages plus "other", so the table of counts and the
fitted cutoffs are of fixed size.

Defined cases: null or empty text has no words and fails the base rules.
Labels of one document are merged to the best of them; null labels and
labels of unknown documents are ignored.  Without labels nothing is certified
and only the base rules reject.  Rows sharing a doc_id are judged each by its
own text.  Further columns pass through; result columns replace input columns
of the same name.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, stage, text_hash, text_or_empty
from tidewell.session import ship_package, sql_conf

SPACE_BYTES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines"]
SCHEMA = ", ".join(f"{c} long" for c in FEATURES)


@dataclass(frozen=True)
class RuleParams:
    strata: tuple[str, ...] = ("en", "de", "fr", "es")
    risk: float = 0.02          # most good documents of a stratum that its cutoffs may reject, as a share
    level: float = 0.05         # chance that any stratum breaks that
    cost: float = 10.0          # bad documents that one good document is worth
    min_words: int = 10
    max_repeat_pct: int = 20
    # thousandths, lenient to strict; a document above the cutoff is rejected
    grid: dict[str, tuple[int, ...]] = field(default_factory=lambda: {
        "symbols": (2000, 1500, 1000, 800, 600, 500, 400, 300, 250, 200, 150, 100, 50),
        "dup_lines": (900, 800, 700, 600, 500, 400, 300, 200, 100),
        "word_length": (20000, 15000, 12000, 10000, 9000, 8500, 8000, 7500, 7000)})

    @property
    def metric_risk(self) -> float:
        return self.risk / len(self.grid)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside a window of five that occurs twice or more."""
    m = len(words) - WINDOW + 1
    if m < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    win = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        win = win * np.uint64(0x9E3779B97F4A7C15) + (h[k:k + m] ^ (h[k:k + m] >> np.uint64(31)))
    order = np.argsort(win, kind="stable")
    s = win[order]
    eq = s[1:] == s[:-1]
    if not eq.any():
        return 0
    twice = np.zeros(m, bool)
    twice[order[1:][eq]] = True
    twice[order[:-1][eq]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:m] += twice
    edge[WINDOW:WINDOW + m] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_features(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()          # exactly the six ASCII white-space bytes
    spaces = len(raw) - len(raw.translate(None, SPACE_BYTES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE_BYTES)]
    dup = len(lines) - len(set(lines))
    return len(words), len(text) - spaces, symbols, dup, _repeat_words(words), len(lines)


def features_column(text: Column) -> Column:
    @F.pandas_udf(SCHEMA)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_features(t) for t in s], columns=FEATURES, dtype="int64")
    return run(text)


def quality_features(docs: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """(doc_id, th, stratum, the features, base_failed): one row per row of
    ``docs``, stored in the shared folder."""
    ship_package(docs.sparkSession)
    text = text_or_empty(docs)
    lang = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    base = docs.select(docs["doc_id"], text_hash(text).alias("th"),
                       F.when(lang.isin(*params.strata), lang).otherwise("other").alias("stratum"),
                       features_column(text).alias("f"))
    flat = base.select("doc_id", "th", "stratum", "f.*").withColumn(
        "base_failed", (F.col("n_words") < params.min_words)
        | (100 * F.col("n_repeat_words") > params.max_repeat_pct * F.col("n_words")))
    with sql_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        return stage(flat, "quality-features")


def metric(name: str) -> Column:
    """A metric in thousandths; 0 without words."""
    over = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_word_lines"),
            "word_length": ("word_chars", "n_words")}[name]
    return F.when(F.col(over[1]) > 0, F.floor(1000 * F.col(over[0]) / F.col(over[1]))).otherwise(0)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def certified(counts: list[tuple[int, int, int]], n_good: int, risk: float, level: float,
              cost: float) -> int | None:
    """The cutoff to use.  counts: (cutoff, good rejected, bad rejected) from
    lenient to strict."""
    best, gain = None, 0.0
    for cut, good, bad in counts:
        # beyond risk * n the tail is over one half: no need to sum it
        if n_good == 0 or good > risk * n_good or binomial_tail(good, n_good, risk) > level:
            break
        if bad - cost * good > gain:
            best, gain = cut, bad - cost * good
    return best


def fit_cutoffs(features: DataFrame, labels: DataFrame, params: RuleParams = RuleParams()
                ) -> dict[tuple[str, str], int]:
    """(stratum, metric) -> cutoff.  Reads every labelled document; what comes
    to the driver is one row per stratum."""
    good = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.max("quality") > 0).alias("good"))
    held = features.filter(~F.col("base_failed")).join(good, "doc_id")
    cells = [F.count_if("good").alias("n")]
    for name, grid in params.grid.items():
        for c in grid:
            cells += [F.count_if(F.col("good") & (metric(name) > c)).alias(f"g_{name}_{c}"),
                      F.count_if(~F.col("good") & (metric(name) > c)).alias(f"b_{name}_{c}")]
    level = params.level / ((len(params.strata) + 1) * len(params.grid))
    out = {}
    for r in held.groupBy("stratum").agg(*cells).collect():
        for name, grid in params.grid.items():
            cut = certified([(c, r[f"g_{name}_{c}"], r[f"b_{name}_{c}"]) for c in grid],
                            r["n"], params.metric_risk, level, params.cost)
            if cut is not None:
                out[r["stratum"], name] = cut
    return out


def verdict(cutoffs: dict[tuple[str, str], int]) -> Column:
    """kept: passes the base rules and every certified cutoff of its stratum."""
    rejected = F.col("base_failed")
    for (stratum, name), cut in sorted(cutoffs.items()):
        rejected = rejected | ((F.col("stratum") == stratum) & (metric(name) > cut))
    return ~rejected


def judge(docs: DataFrame, labels: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """Features, base_failed and kept per row of ``docs`` (with ``th``)."""
    features = quality_features(docs, params)
    return features.withColumn("kept", verdict(fit_cutoffs(features, labels, params)))


def keep_quality(docs: DataFrame, labels: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """``docs`` without the rejected documents."""
    bad = judge(docs, labels, params).filter(~F.col("kept")).select(
        F.col("doc_id").alias(P + "doc"), F.col("th").alias(P + "th")).distinct()
    keyed = docs.withColumn(P + "th", text_hash(text_or_empty(docs)))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad[P + "doc"]) & (keyed[P + "th"] == bad[P + "th"]),
                      "left_anti").select(*docs.columns)
