"""F12 over dense cutoff grids: as-of lookups in per-customer running sums.

``features.feature_snapshots`` copies a row to every cutoff it can influence,
which suits a few cutoffs.  Here every row is read once whatever their number.
All times a snapshot asks about (cutoffs, ends of label windows, starts of
trends) are cut points; a row belongs to the first cut point not before it.  Sums per
customer and cut point are far fewer than rows, their running sums say what held at
each cut point, and a cutoff's features are differences of such states.  A customer with a
third of all rows is reduced map-side to as many rows as there are cut points.
"""
from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.ratios import round_half
from tidewell.functions.timecols import as_ts, floor_days, month_index
from tidewell.params import FeatureParams

TICK = dt.timedelta(microseconds=1)
MIDNIGHT = dt.time()
SUMS = ("rows", "rev", "month_rev", "invoices", "named", "gaps", "products")


def _month_start(months: int) -> dt.datetime:
    return dt.datetime(months // 12, months % 12 + 1, 1)


def _literal(values: list, dtype: str) -> Column:
    """An array constant as one string, folded when the plan is optimised."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{dtype}>")


class CutPoints:
    """The sorted times a grid of cutoffs asks about."""

    def __init__(self, as_ofs, window_days: int | None, trend_months: int):
        self.as_ofs = sorted(set(as_ofs))
        ask: dict[dt.datetime, list[tuple[dt.datetime, str]]] = {}
        for a in self.as_ofs:
            start = _month_start(a.year * 12 + a.month - 1 - trend_months) - TICK      # the last moment before the trend
            asked = [("state", a), ("before", start)]
            if window_days is not None:
                asked.append(("horizon", a + dt.timedelta(days=window_days)))
            for kind, t in asked:
                ask.setdefault(t, []).append((a, kind))
        self.times = sorted(ask)
        self.asked = [ask[t] for t in self.times]
        self.first_month = min(self.times).year * 12 + min(self.times).month - 1

    def place(self, t: Column) -> Column:
        """Index of the first cut point not before ``t`` (at most the last one).
        A look-up by day, then the day's own cut points."""
        day0, last = self.times[0].date(), self.times[-1].date()
        days = [day0 + dt.timedelta(days=k) for k in range((last - day0).days + 1)]
        before, inside = [], []
        for d in days:
            midnight = dt.datetime.combine(d, MIDNIGHT)
            before.append(sum(x < midnight for x in self.times))
            inside.append([x for x in self.times if midnight <= x < midnight + dt.timedelta(days=1)])
        k = F.datediff(F.to_date(t), F.lit(day0))
        out = F.get(_literal(before, "int"), k)
        for nth in range(max(map(len, inside))):
            # a day without an nth cut point has one that no time of it exceeds
            own = F.get(_literal([x[nth] if nth < len(x) else dt.datetime.combine(d, dt.time.max)
                                  for d, x in zip(days, inside)], "timestamp_ntz"), k)
            out = out + F.when(own < t, 1).otherwise(0)
        return F.when(k < 0, F.lit(0)).otherwise(out)

    def asked_at(self, place: Column) -> Column:
        """(as_of, kind) of the look-ups at a cut point."""
        lists = json.dumps([[{"as_of": a.isoformat(timespec="microseconds"), "kind": kind} for a, kind in x] for x in self.asked])
        return F.get(F.from_json(F.lit(lists), "array<array<struct<as_of:timestamp_ntz,kind:string>>>"), place)


def _per_place(df: DataFrame, **aggs: Column) -> DataFrame:
    """Sums per (customer, place); what a branch does not count is 0."""
    zero = {c: F.lit(0.0 if c in ("rev", "month_rev") else 0).cast("double" if c in ("rev", "month_rev") else "long") for c in SUMS}
    out = df.groupBy("customer_id", "place").agg(*[a.alias(c) for c, a in aggs.items()])
    return out.select("customer_id", "place", *[F.col(c) if c in aggs else zero[c].alias(c) for c in SUMS],
                      *([F.col("last_ts")] if "last_ts" in aggs else [F.lit(None).cast("timestamp_ntz").alias("last_ts")]))


def timeline(fact: DataFrame, cuts: CutPoints) -> DataFrame:
    """State of each customer at the cut points where it changes: running sums,
    last purchase, and ``until``, the place of the next change."""
    rows = fact.filter(F.col("invoice_date") <= as_ts(cuts.times[-1]))
    if "month" in fact.columns:
        last = cuts.times[-1]
        rows = rows.filter(F.col("month") <= F.lit(last.year * 100 + last.month))
    t, rev = F.col("invoice_date"), F.col("revenue")
    at = rows.withColumn("place", cuts.place(t))
    sales = _per_place(at, rows=F.count(F.lit(1)), rev=F.sum(rev),
                       month_rev=F.sum((month_index(t) - cuts.first_month) * rev), last_ts=F.max(t))
    # an invoice counts from its first row on; the gap to the active day before it from its own day's first invoice on
    first = rows.groupBy("customer_id", "invoice").agg(F.min(t).alias("t"))
    days = first.groupBy("customer_id", F.to_date("t").alias("day"), cuts.place(F.col("t")).alias("place")).agg(
        F.min("t").alias("d_first"), F.max("t").alias("d_last"), F.count(F.lit(1)).alias("invoices"),
        F.count("invoice").alias("named"))
    order = Window.partitionBy("customer_id").orderBy("d_first")
    days = days.withColumn("gap", floor_days(F.col("d_first"), F.lag("d_last").over(order)))
    orders = _per_place(days, invoices=F.sum("invoices"), named=F.sum("named"), gaps=F.coalesce(F.sum("gap"), F.lit(0)))
    bought = rows.filter(F.col("stock_code").isNotNull()).groupBy("customer_id", "stock_code").agg(F.min(t).alias("t"))
    products = _per_place(bought.withColumn("place", cuts.place(F.col("t"))), products=F.count(F.lit(1)))
    changes = sales.unionByName(orders).unionByName(products).groupBy("customer_id", "place").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("last_ts").alias("last_ts"))
    step = Window.partitionBy("customer_id").orderBy("place")
    so_far = step.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.select(
        "customer_id", "place", F.lead("place", 1, len(cuts.times)).over(step).alias("until"),
        *[F.sum(c).over(so_far).alias(c) for c in SUMS], F.max("last_ts").over(so_far).alias("last_ts"))


def snapshot_grid(fact: DataFrame, dim: DataFrame, as_ofs, window_days: int | None = 90,
                  params: FeatureParams = FeatureParams(), include_target: bool = True) -> DataFrame:
    """``feature_snapshots`` for many cutoffs: the same rows and values."""
    if include_target and window_days is None:
        raise ValueError("window_days is required when include_target=True")
    tm = params.trend_months
    cuts = CutPoints(as_ofs, window_days if include_target else None, tm)
    cols = fact.select("customer_id", "invoice", "stock_code", "invoice_date", "revenue",
                       *[c for c in ("month",) if c in fact.columns])
    states = timeline(cols, cuts)
    # a state holds from its place to the next change: answer what is asked there
    answers = states.withColumn("p", F.explode(F.sequence(F.col("place"), F.col("until") - 1))).withColumn(
        "ask", F.explode(cuts.asked_at(F.col("p")))).select("customer_id", "ask.*", *SUMS, "last_ts")

    def at(kind: str, c: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(c)))

    wide = answers.groupBy("customer_id", "as_of").agg(
        *[at("state", c).alias(c) for c in (*SUMS, "last_ts")], at("horizon", "rows").alias("later_rows"),
        F.coalesce(at("before", "rev"), F.lit(0.0)).alias("old_rev"),
        F.coalesce(at("before", "month_rev"), F.lit(0.0)).alias("old_month_rev")).filter("last_ts is not null")
    points = tm + 1
    denom = points * (points * points - 1) / 12.0
    # x = months since the trend's start, less its middle
    middle = F.year("as_of") * 12 + F.month("as_of") - 1 - tm + F.lit(tm / 2.0) - F.lit(cuts.first_month)
    slope = (F.col("month_rev") - F.col("old_month_rev") - middle * (F.col("rev") - F.col("old_rev"))) / F.lit(denom)
    out = wide.join(dim.select("customer_id", "first_purchase_date", "country"), "customer_id", "left")
    label = (F.col("later_rows") > F.col("rows")).cast("int") if include_target else F.lit(None).cast("int")
    return out.select(
        "customer_id", floor_days(F.col("as_of"), F.col("last_ts")).alias("recency_days"),
        F.col("named").alias("frequency"), round_half(F.col("rev"), 6).alias("monetary"),
        F.when(F.col("products") > 0, F.col("products")).otherwise(0).alias("product_diversity"),
        F.when(F.col("invoices") >= 2, F.col("gaps") / (F.col("invoices") - 1)).cast("double").alias("avg_days_between_orders"),
        (F.col("named") == 1).alias("single_buyer"), slope.alias("spend_trend_slope"),
        floor_days(F.col("as_of"), F.col("first_purchase_date")).alias("tenure_days"),
        F.coalesce(F.col("country") == F.lit(params.home_country), F.lit(False)).alias("is_uk"),
        "as_of", label.alias("target_conversion"))
