"""Registered plans: sources, cleaning waterfall, DQ report, contracts (S*, C*, K*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import cleaning, contracts
from tidewell.params import CLEANING_STEPS
from tidewell.plans.oracle import build
from tidewell.plans.registry import register

# row-level values are exact IEEE results in both engines: compared unrounded
BR = "invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
SV = "invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, revenue"


@register("bronze_union", build(f"SELECT {BR} FROM bronze", "bronze"))
def bronze_union(p):
    """Two source files with raw padded headers → read, trimmed, unioned, renamed, conformed."""
    import uuid

    from tidewell.session import shared_path
    from tidewell.sources.files import bronze_union as union, read_parts
    from tidewell.sources.testdata import write_source_parts
    paths = write_source_parts(p.spark, p.sf_dir, shared_path(p.spark, "parts", uuid.uuid4().hex))
    return union(read_parts(p.spark, paths))


_conform_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM bronze"
    for c in ("invoice", "stock_code", "description", "country"))


@register("bronze_conform", build(_conform_sql, "bronze"))
def bronze_conform(p):
    """Text columns conformed to string with nulls preserved (null profile)."""
    b = p.bronze.select(*[F.col(c).cast("string").alias(c) for c in ("invoice", "stock_code", "description", "country")])
    agg = b.agg(*[F.count(c).alias(f"nn_{c}") for c in b.columns], F.count(F.lit(1)).alias("n"))
    stack = ", ".join(f"'{c}', nn_{c}, n - nn_{c}" for c in b.columns)
    return agg.selectExpr(f"stack({len(b.columns)}, {stack}) AS (column, non_null, nulls)")


@register("drop_cancellations", build(f"SELECT {BR} FROM stage1", "stage1"))
def drop_cancellations(p):
    """Survivors of the cancellation rule."""
    return cleaning.drop_cancellations(p.bronze)


@register("drop_non_product", build(f"SELECT {BR} FROM stage2", "stage2"))
def drop_non_product(p):
    """Survivors after the non-product stock-code rule."""
    return cleaning.drop_non_product(cleaning.drop_cancellations(p.bronze))


def _stage3(p):
    return cleaning.drop_invalid_qty_price(cleaning.drop_non_product(cleaning.drop_cancellations(p.bronze)))


@register("drop_invalid_qty_price", build(f"SELECT {BR} FROM stage3", "stage3"))
def drop_invalid_qty_price(p):
    """Survivors after the quantity/price rule."""
    return _stage3(p)


@register("drop_missing_customer", build(f"SELECT {BR} FROM stage4", "stage4"))
def drop_missing_customer(p):
    """C4: survivors after the missing-customer rule."""
    return cleaning.drop_missing_customer(_stage3(p))


@register("dedupe_line_items", build(f"SELECT {BR} FROM stage5", "stage5"))
def dedupe_line_items(p):
    """One row per line key among C1–C4 survivors."""
    return cleaning.dedupe_line_items(cleaning.drop_missing_customer(_stage3(p)))


_first_sql = """
SELECT invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice, stock_code, invoice_date, customer_id, quantity, unit_price
                               ORDER BY source_row) AS nth
  FROM ordered_bronze
  WHERE NOT coalesce(starts_with(invoice, 'C'), false) AND quantity > 0 AND unit_price > 0
    AND customer_id IS NOT NULL AND NOT isnan(customer_id)) WHERE nth = 1"""


@register("dedupe_keep_first", build(_first_sql, "ordered_bronze"))
def dedupe_keep_first(p):
    """C5 with a source ordinal: of equal line keys the first row of the export stays."""
    from tidewell.sources.testdata import bronze_in_source_order
    rows = cleaning.drop_missing_customer(cleaning.drop_invalid_qty_price(
        cleaning.drop_cancellations(bronze_in_source_order(p.spark, p.sf_dir))))
    return cleaning.dedupe_line_items(rows, "source_row")


@register("standardize", build(f"SELECT {SV} FROM silver", "silver"))
def standardize(p):
    """Conformance of the deduplicated rows."""
    return cleaning.standardize(
        cleaning.dedupe_line_items(cleaning.drop_missing_customer(_stage3(p))))


@register("clean_silver", build(f"SELECT {SV} FROM silver", "silver"))
def clean_silver(p):
    """C1–C6 composed as one tagged plan."""
    return p.silver_plan


@register("dq_report", build("SELECT * FROM dq", "dq"))
def dq_report(p):
    """Per-rule audit from counters observed while silver is made."""
    return p.dq


_labels = " ".join(f"WHEN '{r}' THEN '{r.replace('_', ' ').title()}'" for r in CLEANING_STEPS)


@register("dq_active_rules", build(f"""
SELECT rule_order, CASE rule {_labels} END AS rule_label, rows_removed, pct_of_raw
FROM dq WHERE rows_removed > 0""", "dq"))
def dq_active_rules(p):
    """Rules that removed rows, prettified."""
    return cleaning.dq_active_rules(p.dq)


@register("contract_types")
def contract_types(p):
    """K1: silver schema vs the declared contract."""
    return contracts.contract_types(p.silver_plan, contracts.SILVER)


_checks_sql = """
SELECT 'silver' AS "table", "column", "check", violations FROM (
  SELECT 'invoice' AS "column", 'not_null' AS "check", count(*) FILTER (WHERE invoice IS NULL) AS violations FROM silver
  UNION ALL SELECT 'stock_code', 'not_null', count(*) FILTER (WHERE stock_code IS NULL) FROM silver
  UNION ALL SELECT 'quantity', 'not_null', count(*) FILTER (WHERE quantity IS NULL) FROM silver
  UNION ALL SELECT 'quantity', 'gt_0', count(*) FILTER (WHERE quantity IS NOT NULL AND NOT quantity > 0) FROM silver
  UNION ALL SELECT 'invoice_date', 'not_null', count(*) FILTER (WHERE invoice_date IS NULL) FROM silver
  UNION ALL SELECT 'unit_price', 'not_null', count(*) FILTER (WHERE unit_price IS NULL) FROM silver
  UNION ALL SELECT 'unit_price', 'gt_0', count(*) FILTER (WHERE unit_price IS NOT NULL AND NOT unit_price > 0) FROM silver
  UNION ALL SELECT 'customer_id', 'not_null', count(*) FILTER (WHERE customer_id IS NULL) FROM silver
  UNION ALL SELECT 'country', 'not_null', count(*) FILTER (WHERE country IS NULL) FROM silver
  UNION ALL SELECT 'revenue', 'not_null', count(*) FILTER (WHERE revenue IS NULL) FROM silver
  UNION ALL SELECT 'revenue', 'gt_0', count(*) FILTER (WHERE revenue IS NOT NULL AND NOT revenue > 0) FROM silver)"""


@register("contract_checks", build(_checks_sql, "silver"))
def contract_checks(p):
    """K2: every silver value check, counted while silver was written."""
    return p.silver_checks


@register("contract_unique", build("""
SELECT 'silver' AS "table", 'invoice,stock_code,invoice_date,customer_id,quantity,unit_price' AS key,
       CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT count(*) AS n FROM silver GROUP BY invoice, stock_code, invoice_date, customer_id, quantity, unit_price)""",
                                   "silver"))
def contract_unique(p):
    """K3: composite unique key of silver."""
    return contracts.contract_unique(p.silver_plan, contracts.SILVER)


# ---------------------------------------------------------------- sinks and stored layers
@register("bronze_cache", build(f"SELECT {BR} FROM bronze", "bronze"))
def bronze_cache(p):
    """S3: bronze materialised once in the shared folder and read back."""
    return p.mart("bronze", lambda: p.bronze)


@register("source_manifest")
def source_manifest(p):
    """Lineage rows for the source files (bytes, sha256, rows)."""
    from tidewell.sources.files import source_manifest as manifest
    paths = [f"{p.sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders", "part", "supplier", "nation")]
    return manifest(p.spark, paths)


@register("write_mart", build("SELECT * FROM channel_table", "channel_table"))
def write_mart(p):
    """The channel-metrics mart written to the shared folder and read back."""
    return p.mart("channel_metrics", lambda: p.channel_table)


@register("read_mart", build(f"SELECT {SV} FROM silver", "silver"))
def read_mart(p):
    """The stored fact mart read by name (partition column dropped)."""
    from tidewell.operators.cleaning import SILVER_COLUMNS
    return p.silver.select(*SILVER_COLUMNS)


def _digest_sql(source: str, cells: str, order: str = "") -> str:
    """rows and content digest of an export; cells: name, or name:d for a number with a point."""
    text = ", ".join("coalesce(CAST(" + (f"CAST(round({c[:-2]} * 1000000) AS BIGINT)" if c.endswith(":d") else c) + " AS VARCHAR), '')"
                     for c in cells.split())
    return (f"SELECT count(*) AS rows, CAST(coalesce(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT), 0) AS BIGINT) "
            f"AS digest FROM {source}")


_segment_rows = """(SELECT s.customer_id, s.cluster, s.segment_name, f.recency_days, f.frequency, f.monetary
 FROM segments s JOIN features_current f ON s.customer_id = f.customer_id)"""
_top_rows = """(SELECT t.customer_id, t.score, s.segment_name FROM (
  SELECT customer_id, score FROM scores ORDER BY score DESC, customer_id LIMIT 500) t
 LEFT JOIN segments s ON t.customer_id = s.customer_id)"""
_exports = {
    "segment_assignments": _digest_sql(_segment_rows, "customer_id cluster segment_name recency_days frequency monetary:d"),
    "top_audience": _digest_sql(_top_rows, "customer_id score:d segment_name"),
    "channel_metrics": _digest_sql("channel_table", "channel customers spend_synthetic:d conversions revenue:d cpa:d roas:d "
                                                    "avg_cac:d avg_ltv:d ltv_cac:d"),
    "dq_report": _digest_sql("dq", "rule_order rule rationale rows_before rows_removed pct_of_input:d pct_of_raw:d rows_raw "
                                   "rows_silver retention_pct:d")}


@register("export_csv", build(" UNION ALL ".join(f"SELECT '{k}' AS export, rows, digest FROM ({x})" for k, x in _exports.items()),
                              "segments", "features_current", "scores", "channel_table", "dq"))
def export_csv(p):
    """The four CSV exports, written with headers and re-read: row counts and content digests."""
    from pyspark.sql import functions as F
    from tidewell.operators import reports as rep
    from tidewell.session import shared_path
    from tidewell.sources.files import content_digest, export_csv as export, read_export
    seg_rfm = p.segments.join(p.features_current.select("customer_id", "recency_days", "frequency", "monetary"),
                              "customer_id").select("customer_id", "cluster", "segment_name", "recency_days", "frequency", "monetary")
    outs = {"segment_assignments": seg_rfm, "top_audience": rep.top_audience(p.scores, p.segments),
            "channel_metrics": p.channel_table, "dq_report": p.silver_dq}
    frames = []
    for name, df in outs.items():
        path = shared_path(p.spark, "exports", p.signature, name)
        export(df, path)
        back = read_export(p.spark, path, df)
        frames.append(back.agg(F.count(F.lit(1)).alias("rows"), content_digest(back).alias("digest"))
                      .select(F.lit(name).alias("export"), "rows", "digest"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("write_summary", build("""
SELECT metric, value FROM (
  SELECT 'rows_raw' AS metric, CAST(rows_raw AS DOUBLE) AS value FROM dq WHERE rule_order = 0
  UNION ALL SELECT 'rows_silver', CAST(rows_silver AS DOUBLE) FROM dq WHERE rule_order = 0
  UNION ALL SELECT 'retention_pct', retention_pct FROM dq WHERE rule_order = 0
  UNION ALL SELECT 'share_' || channel, round(count(*) / (SELECT count(*) FROM attribution), 3)
            FROM attribution GROUP BY channel)""", "dq", "attribution"))
def write_summary(p):
    """Run summary as tidy (metric, value) JSON, read back."""
    from pyspark.sql import functions as F
    from tidewell.functions.ratios import round_half
    from tidewell.session import shared_path
    from tidewell.sources.files import write_summary as summary
    r = p.silver_dq.filter(F.col("rule_order") == 0)
    m = (r.select(F.lit("rows_raw").alias("metric"), F.col("rows_raw").cast("double").alias("value"))
         .unionByName(r.select(F.lit("rows_silver").alias("metric"), F.col("rows_silver").cast("double").alias("value")))
         .unionByName(r.select(F.lit("retention_pct").alias("metric"), F.col("retention_pct").alias("value"))))
    n = p.attribution.count()
    mix = p.attribution.groupBy("channel").agg(F.count(F.lit(1)).alias("c")).select(
        F.concat(F.lit("share_"), F.col("channel")).alias("metric"), round_half(F.col("c") / F.lit(n), 3).alias("value"))
    return summary(p.spark, m.unionByName(mix), shared_path(p.spark, "summaries", p.signature, "run_summary"))


def _contract_sql(contract, source: str) -> str:
    parts = []
    for c in contract.columns:
        col = f'"{c.name}"'
        if not c.nullable:
            parts.append(f"SELECT '{contract.table}' AS \"table\", '{c.name}' AS \"column\", 'not_null' AS \"check\", "
                         f"count(*) FILTER (WHERE {col} IS NULL) AS violations FROM {source}")
        for kind, arg in c.checks:
            if kind == "isin":
                label, bad = "isin", f"NOT {col} IN ({', '.join(repr(a) for a in arg)})"
            else:
                label, bad = f"{kind}_{arg}", f"NOT {col} {'>' if kind == 'gt' else '>='} {arg}"
            parts.append(f"SELECT '{contract.table}', '{c.name}', '{label}', "
                         f"count(*) FILTER (WHERE {col} IS NOT NULL AND {bad}) FROM {source}")
    return " UNION ALL ".join(parts)


@register("mart_contract_checks", build(" UNION ALL ".join([
    _contract_sql(contracts.BRONZE, "bronze"),
    _contract_sql(contracts.DIM_CUSTOMERS, "dim"),
    _contract_sql(contracts.CUSTOMER_FEATURES, "features_test"),
    _contract_sql(contracts.ATTRIBUTION, "attribution")]), "bronze", "dim", "features_test", "attribution"))
def mart_contract_checks(p):
    """K2 on bronze and on every gold mart (dimension, features, attribution)."""
    out = contracts.contract_checks(p.bronze, contracts.BRONZE)
    for df, c in ((p.dim, contracts.DIM_CUSTOMERS), (p.features_test, contracts.CUSTOMER_FEATURES),
                  (p.attribution, contracts.ATTRIBUTION)):
        out = out.unionByName(contracts.contract_checks(df, c))
    return out


@register("mart_contract_unique", build("""
SELECT 'dim_customers' AS "table", 'customer_id' AS key, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM (SELECT count(*) AS n FROM dim GROUP BY customer_id)
UNION ALL
SELECT 'customer_features', 'as_of,customer_id', CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (WHERE n > 1)
FROM (SELECT count(*) AS n FROM features_test GROUP BY as_of, customer_id)
UNION ALL
SELECT 'synthetic_attribution', 'customer_id', CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (WHERE n > 1)
FROM (SELECT count(*) AS n FROM attribution GROUP BY customer_id)""", "dim", "features_test", "attribution"))
def mart_contract_unique(p):
    """K3 on the gold marts' keys."""
    return (contracts.contract_unique(p.dim, contracts.DIM_CUSTOMERS)
            .unionByName(contracts.contract_unique(p.features_test, contracts.CUSTOMER_FEATURES))
            .unionByName(contracts.contract_unique(p.attribution, contracts.ATTRIBUTION)))
