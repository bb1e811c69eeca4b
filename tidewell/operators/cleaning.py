"""Silver layer: the ordered cleaning waterfall and its audit report.

Each rule is a null-safe predicate.  A missing value never makes a rule fire
(``coalesce(pred, false)``), so a row is only dropped on positive evidence.
The composed plan tags every bronze row with the first rule it fails — one
pass, one CASE — instead of materialising five filtered copies.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ratios import round_half
from tidewell.operators.audited import counters, observe, undisturbed
from tidewell.params import (CLEANING_RATIONALE, CLEANING_STEPS, DEDUP_KEY,
                             NON_PRODUCT_STOCK_CODES)

BRONZE_COLUMNS = ("invoice", "stock_code", "description", "quantity", "invoice_date",
                  "unit_price", "customer_id", "country")
SILVER_COLUMNS = BRONZE_COLUMNS + ("revenue",)


# -- rule predicates (True = the rule removes the row) -----------------------

def is_cancellation() -> Column:
    return F.coalesce(F.col("invoice").startswith("C"), F.lit(False))


def is_non_product(codes=NON_PRODUCT_STOCK_CODES) -> Column:
    return F.coalesce(F.col("stock_code").isin(list(codes)), F.lit(False))


def is_invalid_qty_price() -> Column:
    return F.coalesce((F.col("quantity") <= 0) | (F.col("unit_price") <= 0), F.lit(False))


def is_missing_customer() -> Column:
    c = F.col("customer_id")
    return c.isNull() | F.isnan(c)


def _rule_predicates(codes) -> list[tuple[str, Column]]:
    return [
        (CLEANING_STEPS[0], is_cancellation()),
        (CLEANING_STEPS[1], is_non_product(codes)),
        (CLEANING_STEPS[2], is_invalid_qty_price()),
        (CLEANING_STEPS[3], is_missing_customer()),
    ]


# -- single rules -------------------------------------------------------------

def drop_cancellations(df: DataFrame) -> DataFrame:
    return df.filter(~is_cancellation())


def drop_non_product(df: DataFrame, codes=NON_PRODUCT_STOCK_CODES) -> DataFrame:
    return df.filter(~is_non_product(codes))


def drop_invalid_qty_price(df: DataFrame) -> DataFrame:
    return df.filter(~is_invalid_qty_price())


def drop_missing_customer(df: DataFrame) -> DataFrame:
    return df.filter(~is_missing_customer())


def dedupe_line_items(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per line key (DEDUP_KEY); description and country are not in the key.

    Implemented as an aggregation, not a window, so it pre-aggregates
    map-side and a hot key never lands whole in one task.  With ``order_col``
    (a source ordinal) the survivor is the first row in source order; without
    one the survivor's non-key values are the smallest (deterministic).
    """
    key = list(DEDUP_KEY)
    rest = [c for c in df.columns if c not in key and c != order_col]
    if order_col:
        pick = F.min_by(F.struct(*rest), F.col(order_col)).alias("_keep")
    else:
        pick = F.min(F.struct(*rest)).alias("_keep")
    out = df.groupBy(*key).agg(pick)
    return out.select(*key, *[F.col(f"_keep.{c}").alias(c) for c in rest]).select(
        *[c for c in df.columns if c != order_col])


def standardize(df: DataFrame) -> DataFrame:
    """customer_id double→bigint→string; timestamps kept as UTC wall clock;
    revenue = quantity × unit_price; country trimmed."""
    return df.select(
        "invoice", "stock_code", "description", "quantity", "invoice_date", "unit_price",
        F.col("customer_id").cast("bigint").cast("string").alias("customer_id"),
        F.trim(F.col("country")).alias("country"),
        (F.col("quantity") * F.col("unit_price")).alias("revenue"),
    ).select(*SILVER_COLUMNS)


# -- composed plan ------------------------------------------------------------

def tag_failed_rule(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES) -> DataFrame:
    """Adds ``failed_rule``: the first of C1–C4 that removes the row, else null."""
    expr = F.lit(None).cast("string")
    for name, pred in reversed(_rule_predicates(codes)):
        expr = F.when(pred, F.lit(name)).otherwise(expr)
    return bronze.withColumn("failed_rule", expr)


def clean_silver(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES,
                 order_col: str | None = None) -> DataFrame:
    """C1–C6 as one plan: tag, keep untagged rows, dedupe, standardize."""
    kept = tag_failed_rule(bronze, codes).filter(F.col("failed_rule").isNull()).drop("failed_rule")
    return standardize(dedupe_line_items(kept, order_col))


def rule_metrics() -> dict[str, Column]:
    """What a pass over tagged bronze rows counts: all rows and those of C1–C4."""
    failed = F.col("failed_rule")
    return {"rows_raw": F.count(F.lit(1))} | {name: F.count_if(failed == name) for name in CLEANING_STEPS[:4]}


def clean_silver_observed(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES, arrange=lambda lines: lines):
    """``clean_silver`` with the rule counters observed on its way: (silver,
    observation).  ``bronze`` belongs to an observer session.  ``arrange`` lays out
    the deduplicated lines, before the derived columns are there to be carried."""
    tagged, seen = observe(tag_failed_rule(bronze, codes), rule_metrics())
    kept = tagged.filter(F.col("failed_rule").isNull()).drop("failed_rule")
    return standardize(arrange(dedupe_line_items(kept))), seen


def counted_rules(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES) -> dict[str, int]:
    """The counters by a plain aggregation (for when an observed pass was disturbed)."""
    tagged = tag_failed_rule(bronze, codes)
    surv = F.col("failed_rule").isNull()
    keyed = tagged.groupBy(
        "failed_rule", *[F.when(surv, F.col(k)).alias(k) for k in DEDUP_KEY]).agg(F.count(F.lit(1)).alias("n"))
    got = keyed.groupBy("failed_rule").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys")).collect()
    by = {r.failed_rule: r.n for r in got}
    return ({"rows_raw": sum(by.values()), "rows_silver": sum(r["keys"] for r in got if r.failed_rule is None)}
            | {name: by.get(name, 0) for name in CLEANING_STEPS[:4]})


def rule_counts(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES) -> dict[str, int]:
    """The counters of the cleaning, observed on one pass that goes as far as
    the line keys of silver and keeps nothing.  ``bronze`` belongs to an
    observer session (``session.observer_session``)."""
    tagged, rules = observe(tag_failed_rule(bronze, codes), rule_metrics())
    keys, written = observe(tagged.filter(F.col("failed_rule").isNull()).select(*DEDUP_KEY).distinct(),
                            {"rows_silver": F.count(F.lit(1))})
    once = undisturbed(bronze.sparkSession, lambda: keys.write.format("noop").mode("overwrite").save())
    return (counters(rules, written) if once else None) or counted_rules(bronze, codes)


def dq_report(bronze: DataFrame, codes=NON_PRODUCT_STOCK_CODES) -> DataFrame:
    """C8 from bronze alone; where silver is stored, ``dq_report_from`` its counters."""
    return dq_report_from(bronze.sparkSession, counted_rules(bronze, codes))


def dq_report_from(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Per-rule audit from the counters of a cleaning run: one row per rule
    (five dropping rules and the conformance record), in order."""
    left, rows = counts["rows_raw"], []
    duplicates = counts["rows_raw"] - sum(counts[name] for name in CLEANING_STEPS[:4]) - counts["rows_silver"]
    removed = [counts[name] for name in CLEANING_STEPS[:4]] + [duplicates, 0]
    for k, (name, n) in enumerate(zip(CLEANING_STEPS, removed)):
        rows.append((k, name, CLEANING_RATIONALE[name], left, n, counts["rows_raw"], counts["rows_silver"]))
        left -= n
    rep = spark.createDataFrame(rows, "rule_order int, rule string, rationale string, rows_before bigint, "
                                      "rows_removed bigint, rows_raw bigint, rows_silver bigint")
    share = lambda part, whole: round_half(F.lit(100.0) * F.col(part) / F.greatest(F.col(whole), F.lit(1)), 2)
    # an empty bronze has no retention
    return rep.select("rule_order", "rule", "rationale", "rows_before", "rows_removed",
                      share("rows_removed", "rows_before").alias("pct_of_input"),
                      share("rows_removed", "rows_raw").alias("pct_of_raw"), "rows_raw", "rows_silver",
                      F.when(F.col("rows_raw") > 0, share("rows_silver", "rows_raw")).alias("retention_pct"))


def dq_active_rules(report: DataFrame) -> DataFrame:
    """Rules that removed rows, with a display name and share of raw rows."""
    return (report.filter(F.col("rows_removed") > 0)
            .select("rule_order",
                    F.initcap(F.regexp_replace("rule", "_", " ")).alias("rule_label"),
                    "rows_removed",
                    round_half(F.lit(100.0) * F.col("rows_removed") / F.col("rows_raw"), 2).alias("pct_of_raw")))
