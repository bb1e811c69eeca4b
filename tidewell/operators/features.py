"""Gold layer: customer dimension, point-in-time features and the label.

All snapshots are computed by one job: every fact row is expanded to the
cutoffs it can influence (a literal array, so no join), and one aggregation
keyed by (as_of, customer_id) produces every feature with conditional
aggregates.  History is ``invoice_date <= as_of``; the label window is
``(as_of, as_of + window_days]``.  A row dated after a cutoff never touches
that cutoff's features — only its label.
"""
from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.ratios import money_sum, round_half
from tidewell.functions.timecols import as_ts, floor_days, month_index
from tidewell.params import FeatureParams

FEATURE_TABLE_COLUMNS = (
    "customer_id", "recency_days", "frequency", "monetary", "product_diversity",
    "avg_days_between_orders", "single_buyer", "spend_trend_slope", "tenure_days",
    "is_uk", "as_of", "target_conversion",
)


def _month_idx(d: dt.datetime) -> int:
    return d.year * 12 + d.month - 1


# -- F1 -------------------------------------------------------------------------

def dim_customers(fact: DataFrame) -> DataFrame:
    """customer → first purchase (all history), modal country, cohort "YYYY-MM".

    Mode ties go to the smallest country name.  Both steps are plain
    aggregations (partial aggregation map-side), so a customer with a third
    of all rows still reduces to one small record per map task.
    """
    per_country = (fact.groupBy("customer_id", "country")
                   .agg(F.count(F.lit(1)).alias("n"), F.min("invoice_date").alias("first_ts")))
    dim = per_country.groupBy("customer_id").agg(
        F.min("first_ts").alias("first_purchase_date"),
        F.min(F.when(F.col("country").isNotNull(),
                     F.struct((-F.col("n")).alias("neg_n"), F.col("country")))).alias("_mode"))
    return dim.select(
        "customer_id", "first_purchase_date",
        F.date_format("first_purchase_date", "yyyy-MM").alias("acquisition_cohort"),
        F.col("_mode.country").alias("country"))


# -- cutoff expansion -----------------------------------------------------------

def _cutoff_rows(as_ofs, window_days: int | None, trend_months: int) -> Column:
    rows = []
    for a in sorted(set(as_ofs)):
        horizon = a + dt.timedelta(days=window_days) if window_days is not None else a
        rows.append(F.struct(as_ts(a).alias("as_of"), as_ts(horizon).alias("horizon"),
                             F.lit(_month_idx(a) - trend_months).alias("trend_start"),
                             F.lit(_month_idx(a)).alias("trend_end")))
    return F.array(*rows)


def until(fact: DataFrame, last: dt.datetime) -> DataFrame:
    """Rows up to ``last``; on the stored fact (partitioned by yyyymm) later
    months are pruned before they are read."""
    base = fact.filter(F.col("invoice_date") <= as_ts(last))
    if "month" in fact.columns:
        base = base.filter(F.col("month") <= F.lit(last.year * 100 + last.month))
    return base


def expand_to_cutoffs(fact: DataFrame, as_ofs, window_days: int | None,
                      trend_months: int = 6) -> DataFrame:
    """Each fact row once per cutoff whose history or label window contains it.

    The upper bound of the latest window is a literal filter, so it reaches
    the Parquet scan as a pushed filter; the explode is a narrow Generate.
    """
    as_ofs = sorted(set(as_ofs))
    last = as_ofs[-1] + (dt.timedelta(days=window_days) if window_days is not None else dt.timedelta(0))
    return (until(fact, last).withColumn("_c", F.explode(_cutoff_rows(as_ofs, window_days, trend_months)))
            .filter(F.col("invoice_date") <= F.col("_c.horizon"))
            .select("*", "_c.as_of", "_c.horizon", "_c.trend_start", "_c.trend_end").drop("_c"))


def history(fact: DataFrame, as_ofs, trend_months: int = 6) -> DataFrame:
    """Fact rows with invoice_date <= as_of, tagged with as_of (one copy per cutoff)."""
    return expand_to_cutoffs(fact, as_ofs, None, trend_months)


# -- F2/F3/F5/F6/F10 core aggregation ---------------------------------------------

# cutoffs that share a row of the invoice and day grains: what does not depend on a
# cutoff (keys, first times) is then shuffled once for all of them
BLOCK = 4


def _blocks(as_ofs) -> list[list[dt.datetime]]:
    cuts = sorted(set(as_ofs))
    return [cuts[i:i + BLOCK] for i in range(0, len(cuts), BLOCK)]


def _slot(blocks: list[list[dt.datetime]], j: int, value) -> Column:
    """``value`` of the j-th cutoff of the row's block (``as_of``, its last cutoff); null if it has none."""
    return F.coalesce(*[F.when(F.col("as_of") == as_ts(b[-1]), value(b[j])) for b in blocks if j < len(b)])


def _invoice_grain(fact: DataFrame, blocks: list[list[dt.datetime]], window_days: int, trend_months: int) -> DataFrame:
    """One row per (block of cutoffs, customer, invoice): its first time and, for each
    cutoff of the block, the last history time, history revenue, the invoice's share of the
    trend numerator and the label flag.  An invoice has history at a cutoff when its first
    time is not after it.  Every customer-level feature except product diversity, and
    the order gaps, are derived from this one (partially aggregated) shuffle."""
    window = dt.timedelta(days=window_days)
    when, m, center = F.col("invoice_date"), month_index("invoice_date"), trend_months / 2.0
    rows = (until(fact, blocks[-1][-1] + window)
            .withColumn("as_of", F.explode(F.array(*[as_ts(b[-1]) for b in blocks])))
            .filter(when <= F.col("as_of") + F.lit(window)))
    aggs = [F.min("invoice_date").alias("first_t")]
    for j in range(len(blocks[0])):
        at, start = _slot(blocks, j, as_ts), _slot(blocks, j, lambda a: F.lit(_month_idx(a) - trend_months))
        hist = when <= at
        in_trend = hist & (m >= start) & (m <= start + trend_months)
        fut = (when > at) & (when <= _slot(blocks, j, lambda a: as_ts(a + window)))
        aggs += [F.max(F.when(hist, when)).alias(f"last_t{j}"), F.sum(F.when(hist, F.col("revenue"))).alias(f"rev{j}"),
                 F.sum(F.when(in_trend, (m - start - F.lit(center)) * F.col("revenue"))).alias(f"slope_part{j}"),
                 F.max(F.when(fut, F.lit(1)).otherwise(F.lit(0))).alias(f"fut{j}")]
    return rows.groupBy("as_of", "customer_id", "invoice").agg(*aggs)


def _customer_grain(inv: DataFrame, blocks: list[list[dt.datetime]], trend_months: int) -> DataFrame:
    """Every invoice-derived feature from one pass over the invoice grain.

    Invoices are reduced to (block, customer, day) first: two invoices on the same
    calendar day are less than 24 h apart, so only the gap from one active day to
    the next counts (see ``order_gaps``), and the window runs over a customer's
    active days.  Days after a cutoff count for its label only."""
    n_pts = trend_months + 1
    denom = n_pts * (n_pts * n_pts - 1) / 12.0
    slots = range(len(blocks[0]))
    at = [_slot(blocks, j, as_ts) for j in slots]
    day_aggs = [F.min("first_t").alias("d_first")]
    for j in slots:
        hist = F.col("first_t") <= at[j]
        day_aggs += [F.max(F.when(hist, F.col("first_t"))).alias(f"d_last{j}"), F.max(f"last_t{j}").alias(f"last_ts{j}"),
                     F.count_if(hist).alias(f"n{j}"), F.count_if(hist & F.col("invoice").isNotNull()).alias(f"named{j}"),
                     *[F.sum(f"{c}{j}").alias(f"{c}{j}") for c in ("rev", "slope_part")], F.max(f"fut{j}").alias(f"fut{j}")]
    days = inv.groupBy("as_of", "customer_id", F.to_date("first_t").alias("day")).agg(*day_aggs)
    w = Window.partitionBy("as_of", "customer_id").orderBy("day")
    days = days.withColumns({f"edge_gap{j}": floor_days(F.when(F.col("d_first") <= at[j], F.col("d_first")),
                                                        F.lag(f"d_last{j}").over(w)) for j in slots})
    per = days.groupBy("as_of", "customer_id").agg(*[x for j in slots for x in (
        F.max(f"last_ts{j}").alias(f"last_ts{j}"), F.sum(f"named{j}").alias(f"frequency{j}"), F.sum(f"n{j}").alias(f"n{j}"),
        round_half(F.sum(f"rev{j}"), 6).alias(f"monetary{j}"), F.sum(f"slope_part{j}").alias(f"slope_num{j}"),
        F.max(f"fut{j}").alias(f"fut{j}"), F.coalesce(F.sum(f"edge_gap{j}"), F.lit(0)).alias(f"gaps{j}"))])
    fields = ("last_ts", "frequency", "n", "monetary", "slope_num", "fut", "gaps")
    agg = per.withColumn("_s", F.explode(F.array(*[F.struct(
        at[j].alias("as_of"), *[F.col(f"{c}{j}").alias(c) for c in fields]) for j in slots]))) \
        .select("customer_id", "_s.*").filter(F.col("last_ts").isNotNull())
    return agg.select(
        "as_of", "customer_id",
        floor_days(F.col("as_of"), F.col("last_ts")).alias("recency_days"),
        "frequency", "monetary",
        (F.col("frequency") == 1).alias("single_buyer"),
        (F.coalesce(F.col("slope_num"), F.lit(0.0)) / F.lit(denom)).alias("spend_trend_slope"),
        F.col("fut").cast("int").alias("target_conversion"),
        F.when(F.col("n") >= 2, F.col("gaps") / (F.col("n") - 1)).cast("double").alias("avg_days_between_orders"))


def _diversity(fact: DataFrame, as_ofs) -> DataFrame:
    """Distinct products up to each cutoff: a product counts from the customer's first
    purchase of it on, so (customer, product) pairs are shuffled once for all cutoffs."""
    as_ofs = sorted(set(as_ofs))
    first = until(fact, as_ofs[-1]).groupBy("customer_id", "stock_code").agg(F.min("invoice_date").alias("first_t"))
    per = first.groupBy("customer_id").agg(*[
        F.count_if(F.col("stock_code").isNotNull() & (F.col("first_t") <= as_ts(a))).alias(f"_n{i}")
        for i, a in enumerate(as_ofs)])
    return per.select("customer_id", F.explode(F.array(*[
        F.struct(as_ts(a).alias("as_of"), F.col(f"_n{i}").alias("product_diversity")) for i, a in enumerate(as_ofs)
    ])).alias("_d")).select("_d.as_of", "customer_id", "_d.product_diversity")


# -- F4 -------------------------------------------------------------------------

def _gaps_from_invoices(inv: DataFrame) -> DataFrame:
    days = (inv.filter(F.col("first_t").isNotNull())
            .groupBy("as_of", "customer_id", F.to_date("first_t").alias("day"))
            .agg(F.min("first_t").alias("d_first"), F.max("first_t").alias("d_last"),
                 F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("as_of", "customer_id").orderBy("day")
    days = days.withColumn("edge_gap", floor_days(F.col("d_first"), F.lag("d_last").over(w)))
    tot = days.groupBy("as_of", "customer_id").agg(
        F.coalesce(F.sum("edge_gap"), F.lit(0)).alias("gaps"), F.sum("n").alias("n_invoices"))
    return tot.select(
        "as_of", "customer_id",
        F.when(F.col("n_invoices") >= 2, F.col("gaps") / (F.col("n_invoices") - 1))
         .cast("double").alias("avg_days_between_orders"))


def order_gaps(hist: DataFrame) -> DataFrame:
    """Mean floored day gap between a customer's consecutive invoices.

    Invoice time = earliest row of the invoice.  Two invoices on the same
    calendar day are less than 24 h apart, so their floored gap is 0: only
    the gap from the last invoice of one active day to the first invoice of
    the next active day contributes.  Invoices are therefore reduced to one
    row per (as_of, customer, day) — plain aggregations, pre-aggregated
    map-side — and a single window runs over a customer's *active days*,
    which is bounded by the calendar however many rows the customer has.
    Sum of gaps / (invoices − 1); null below two invoices.
    """
    inv = hist.groupBy("as_of", "customer_id", "invoice").agg(F.min("invoice_date").alias("first_t"))
    return _gaps_from_invoices(inv)


# -- F11 / F12 --------------------------------------------------------------------

def feature_snapshots(fact: DataFrame, dim: DataFrame, as_ofs, window_days: int | None = 90,
                      params: FeatureParams = FeatureParams(), include_target: bool = True) -> DataFrame:
    """customer_features for every cutoff in one job (F12; F11 is one cutoff)."""
    if include_target and window_days is None:
        raise ValueError("window_days is required when include_target=True")
    tm = params.trend_months
    # "month" stays: it prunes the stored fact's partitions
    cols = fact.select("customer_id", "invoice", "stock_code", "invoice_date", "revenue",
                       *[c for c in ("month",) if c in fact.columns])
    blocks = _blocks(as_ofs)
    inv = _invoice_grain(cols, blocks, window_days if include_target else 0, tm)
    keys = ["as_of", "customer_id"]
    d = dim.select("customer_id", "first_purchase_date", "country")
    out = (_customer_grain(inv, blocks, tm).join(_diversity(cols, as_ofs), keys, "left")
           .join(d, "customer_id", "left"))
    label = F.col("target_conversion") if include_target else F.lit(None).cast("int")
    return out.select(
        "customer_id", "recency_days", "frequency", "monetary", "product_diversity",
        "avg_days_between_orders", "single_buyer", "spend_trend_slope",
        floor_days(F.col("as_of"), F.col("first_purchase_date")).alias("tenure_days"),
        F.coalesce(F.col("country") == F.lit(params.home_country), F.lit(False)).alias("is_uk"),
        "as_of", label.alias("target_conversion"))


def customer_features(fact: DataFrame, dim: DataFrame, as_of: dt.datetime, window_days: int | None = 90,
                      params: FeatureParams = FeatureParams(), include_target: bool = True) -> DataFrame:
    return feature_snapshots(fact, dim, [as_of], window_days, params, include_target)


# -- single-feature views (F2, F3, F5–F10) --------------------------------------

def rfm(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """recency (whole days since last purchase), distinct invoices, revenue sum (F2)."""
    hist = until(fact, as_of)
    return hist.groupBy("customer_id").agg(
        floor_days(as_ts(as_of), F.max("invoice_date")).alias("recency_days"),
        F.count_distinct("invoice").alias("frequency"),
        money_sum("revenue").alias("monetary"))


def product_diversity(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    return (until(fact, as_of)
            .groupBy("customer_id").agg(F.count_distinct("stock_code").alias("product_diversity")))


def single_buyer(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    return (until(fact, as_of)
            .groupBy("customer_id")
            .agg((F.count_distinct("invoice") == 1).alias("single_buyer")))


def spend_trend_slope(fact: DataFrame, dim: DataFrame, as_of: dt.datetime,
                      params: FeatureParams = FeatureParams()) -> DataFrame:
    """OLS slope of zero-filled monthly revenue over trend_months+1 calendar months
    ending with the as_of month (F6).  With x = 0..N-1 the slope is
    Σ (x − x̄)·y / Σ (x − x̄)², and months without revenue add 0 to the
    numerator, so no dense month spine is materialised."""
    return feature_snapshots(fact, dim, [as_of], None, params, include_target=False).select(
        "customer_id", "spend_trend_slope")


def tenure_days(dim: DataFrame, fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    active = until(fact, as_of).select("customer_id").distinct()
    return active.join(dim, "customer_id").select(
        "customer_id", floor_days(as_ts(as_of), F.col("first_purchase_date")).alias("tenure_days"))


def is_home_country(dim: DataFrame, home_country: str) -> DataFrame:
    return dim.select("customer_id", (F.col("country") == F.lit(home_country)).alias("is_uk"))


def behavioral(fact: DataFrame, dim: DataFrame, as_of: dt.datetime,
               params: FeatureParams = FeatureParams()) -> DataFrame:
    """F3–F8 for customers with history at as_of."""
    return feature_snapshots(fact, dim, [as_of], None, params, include_target=False).select(
        "customer_id", "product_diversity", "avg_days_between_orders", "single_buyer",
        "spend_trend_slope", "tenure_days", "is_uk")


def target_conversion(fact: DataFrame, as_of: dt.datetime, window_days: int) -> DataFrame:
    """1 iff a purchase falls in (as_of, as_of + window]; eligible = has history.
    One conditional aggregation, no join."""
    horizon = as_of + dt.timedelta(days=window_days)
    f = until(fact, horizon)
    return (f.groupBy("customer_id").agg(
        F.max((F.col("invoice_date") <= as_ts(as_of)).cast("int")).alias("_h"),
        F.max(F.when(F.col("invoice_date") > as_ts(as_of), F.lit(1)).otherwise(F.lit(0))).alias("target_conversion"))
        .filter(F.col("_h") == 1).select("customer_id", F.col("target_conversion").cast("int")))


def snapshot_conversion_rate(snapshots: DataFrame) -> DataFrame:
    """Mean label per snapshot."""
    return snapshots.groupBy("as_of").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("target_conversion").alias("conversion_rate"))


def leakage_audit(fact: DataFrame, dim: DataFrame, as_ofs, params: FeatureParams = FeatureParams(),
                  digits: int = 6, window_days: int = 90, snapshots=feature_snapshots) -> DataFrame:
    """the features of the production plan (all cutoffs and the label in
    one job, over the whole fact) must equal those computed for each cutoff
    alone from a fact that ends there.  One row per cutoff with the count of
    differing rows; doubles compared after rounding (summation order is not
    fixed).  ``snapshots`` is the plan under audit."""
    cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ("customer_id", "as_of", "target_conversion")]

    def rounded(df, side):
        return df.select("as_of", "customer_id", *[
            (round_half(F.col(c), digits) if c in ("monetary", "avg_days_between_orders", "spend_trend_slope")
             else F.col(c)).alias(f"{side}_{c}") for c in cols])

    as_ofs = sorted(set(as_ofs))
    alone = [feature_snapshots(until(fact, a), dim, [a], None, params, include_target=False) for a in as_ofs]
    full = rounded(snapshots(fact, dim, as_ofs, window_days, params), "f")
    j = full.join(rounded(reduce(DataFrame.unionByName, alone), "t"), ["as_of", "customer_id"], "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"f_{c}").eqNullSafe(F.col(f"t_{c}"))
    return j.groupBy("as_of").agg(F.count(F.col("f_recency_days")).alias("rows_full"),
                                  F.count(F.col("t_recency_days")).alias("rows_truncated"),
                                  F.count_if(~same).alias("mismatched_rows"))
