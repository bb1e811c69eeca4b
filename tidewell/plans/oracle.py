"""DuckDB oracle SQL for the registered plans.

Named CTE fragments are assembled (dependencies first) in front of each
final SELECT.  The SQL is written independently of the Spark plans — it is
the straightforward relational statement of each operator — so agreement
between the two is evidence that the Spark plan is right.
"""
from __future__ import annotations

import datetime as dt

from tidewell.params import (CLEANING_RATIONALE, CLEANING_STEPS, NON_PRODUCT_STOCK_CODES,
                             AttributionParams, Cutoffs, FeatureParams)
from tidewell.sources.testdata import (ANON_CUSTOMER_MOD, DUPLICATE_ORDER_MOD, MINUTES_MOD,
                                       POSTAGE_PART_MOD, ZERO_QTY_ORDER_MOD)

CUT = Cutoffs()
FP = FeatureParams()
AP = AttributionParams()

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (deps, sql)


class Recipe(str):
    """SQL text that can be built again over stored layers."""

    final: str
    needs: tuple[str, ...]

    def over(self, stored: dict[str, str]) -> str:
        return build(self.final, *self.needs, stored=stored)


def build(final: str, *needs: str, stored: dict[str, str] | None = None) -> str:
    """``final`` over the named tables it needs.  ``stored``: SQL that takes the
    place of a named table, such as the reading of a stored layer."""
    order: list[str] = []
    tables = _CTES | {n: ((), sql) for n, sql in (stored or {}).items()}

    def visit(n: str) -> None:
        if n in order:
            return
        for d in tables[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    out = Recipe(_text(final, order, tables))
    out.final, out.needs = final, needs
    return out


def _text(final: str, order: list[str], tables: dict[str, tuple[tuple[str, ...], str]]) -> str:
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{tables[n][1]}\n)" for n in order)
    head = final.lstrip()
    if head[:5].upper() == "WITH ":
        return f"WITH {body},\n{head[5:]}"
    return f"WITH {body}\n{final}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tslit(d: dt.datetime) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def hash_u(key: str, salt: str, seed: int = 42) -> str:
    """Same hashed uniform as tidewell.functions.hashing.hash_uniform."""
    return (f"((('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"
            f" + 0.5) / 4294967296.0)")


def hash_n(key: str, salt: str, seed: int = 42) -> str:
    return (f"(sqrt(-2.0 * ln({hash_u(key, salt + ':n1', seed)})) * "
            f"cos({2.0 * 3.141592653589793!r} * {hash_u(key, salt + ':n2', seed)}))")


def month_idx(c: str) -> str:
    return f"(year({c}) * 12 + month({c}) - 1)"


def days(later: str, earlier: str) -> str:
    return f"date_sub('day', {earlier}, {later})"


# ---------------------------------------------------------------- bronze / silver
cte("bronze", (), f"""
SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
            ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice,
       CASE WHEN l.l_partkey % {POSTAGE_PART_MOD} = 0 THEN 'POST' ELSE CAST(l.l_partkey AS VARCHAR) END AS stock_code,
       p.p_name AS description,
       CASE WHEN l.l_orderkey % {ZERO_QTY_ORDER_MOD} = 0 THEN CAST(0 AS BIGINT) ELSE CAST(l.l_quantity AS BIGINT) END AS quantity,
       o.o_orderdate + to_minutes(CAST(l.l_orderkey % {MINUTES_MOD} AS BIGINT)) AS invoice_date,
       l.l_extendedprice / l.l_quantity AS unit_price,
       CASE WHEN o.o_custkey % {ANON_CUSTOMER_MOD} = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS customer_id,
       ' ' || n.n_name || ' ' AS country
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN (SELECT unnest([0, 1]) AS copy_no) c ON c.copy_no = 0 OR l.l_orderkey % {DUPLICATE_ORDER_MOD} = 0""")

cte("ordered_bronze", (), _CTES["bronze"][1].replace("p.p_name AS description", "p.p_name || ' v' || copy_no AS description")
    .replace("AS country\n", """AS country,
       (l.l_orderkey * 10 + l.l_linenumber) * 2 + CASE WHEN l.l_orderkey % 2 = 1 THEN 1 - copy_no ELSE copy_no END AS source_row
"""))

_codes = ", ".join(q(c) for c in NON_PRODUCT_STOCK_CODES)
cte("tagged", ("bronze",), f"""
SELECT *, CASE
  WHEN coalesce(starts_with(invoice, 'C'), false) THEN '{CLEANING_STEPS[0]}'
  WHEN coalesce(stock_code IN ({_codes}), false) THEN '{CLEANING_STEPS[1]}'
  WHEN coalesce(quantity <= 0 OR unit_price <= 0, false) THEN '{CLEANING_STEPS[2]}'
  WHEN customer_id IS NULL OR isnan(customer_id) THEN '{CLEANING_STEPS[3]}'
  END AS failed_rule
FROM bronze""")
cte("stage1", ("bronze",), "SELECT * FROM bronze WHERE NOT coalesce(starts_with(invoice, 'C'), false)")
cte("stage2", ("stage1",), f"SELECT * FROM stage1 WHERE NOT coalesce(stock_code IN ({_codes}), false)")
cte("stage3", ("stage2",), "SELECT * FROM stage2 WHERE NOT coalesce(quantity <= 0 OR unit_price <= 0, false)")
cte("stage4", ("stage3",), "SELECT * FROM stage3 WHERE NOT (customer_id IS NULL OR isnan(customer_id))")
cte("stage5", ("stage4",), """
SELECT invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice, stock_code, invoice_date, customer_id, quantity, unit_price
                               ORDER BY description NULLS FIRST, country NULLS FIRST) AS rn
  FROM stage4) WHERE rn = 1""")
cte("silver", ("stage5",), """
SELECT invoice, stock_code, description, quantity, invoice_date, unit_price,
       CAST(CAST(customer_id AS BIGINT) AS VARCHAR) AS customer_id, trim(country) AS country,
       quantity * unit_price AS revenue
FROM stage5""")

_rules = " UNION ALL ".join(
    f"SELECT {i} AS rule_order, {q(r)} AS rule, {q(CLEANING_RATIONALE[r])} AS rationale"
    for i, r in enumerate(CLEANING_STEPS))
cte("dq", ("tagged", "bronze", "silver", "stage4"), f"""
SELECT r.rule_order, r.rule, r.rationale, rows_before, rows_removed,
       round(100.0 * rows_removed / greatest(rows_before, 1), 2) AS pct_of_input,
       round(100.0 * rows_removed / greatest(rows_raw, 1), 2) AS pct_of_raw,
       rows_raw, rows_silver, round(100.0 * rows_silver / rows_raw, 2) AS retention_pct
FROM (
  SELECT r.*, CAST(rows_raw - coalesce(sum(removed) OVER (ORDER BY rule_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rows_before,
         CAST(removed AS BIGINT) AS rows_removed, rows_raw, rows_silver
  FROM (
    SELECT r.*, CASE WHEN r.rule = '{CLEANING_STEPS[4]}' THEN (SELECT count(*) FROM stage4) - (SELECT count(*) FROM silver)
                     WHEN r.rule = '{CLEANING_STEPS[5]}' THEN 0
                     ELSE coalesce((SELECT count(*) FROM tagged t WHERE t.failed_rule = r.rule), 0) END AS removed,
           (SELECT count(*) FROM bronze) AS rows_raw, (SELECT count(*) FROM silver) AS rows_silver
    FROM ({_rules}) r) r) r""")

# ---------------------------------------------------------------- features
cte("dim", ("silver",), """
SELECT f.customer_id, f.first_purchase_date, strftime(f.first_purchase_date, '%Y-%m') AS acquisition_cohort, m.country
FROM (SELECT customer_id, min(invoice_date) AS first_purchase_date FROM silver GROUP BY customer_id) f
JOIN (SELECT customer_id, country FROM (
        SELECT customer_id, country, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country ASC) AS rn
        FROM (SELECT customer_id, country, count(*) AS n FROM silver WHERE country IS NOT NULL GROUP BY 1, 2))
      WHERE rn = 1) m ON f.customer_id = m.customer_id""")


def _mi(d: dt.datetime) -> int:
    return d.year * 12 + d.month - 1


def features_sql(src: str, as_ofs, window_days: int | None, include_target: bool = True,
                 home: str = FP.home_country, tm: int = FP.trend_months) -> str:
    """Feature rows for every cutoff in ``as_ofs`` from fact table ``src``."""
    rows = []
    for a in sorted(set(as_ofs)):
        h = a + dt.timedelta(days=window_days) if (include_target and window_days is not None) else a
        rows.append(f"({tslit(a)}, {tslit(h)}, {_mi(a) - tm}, {_mi(a)})")
    n = tm + 1
    denom = n * (n * n - 1) / 12.0
    label = "CAST(max(CASE WHEN invoice_date > as_of AND invoice_date <= horizon THEN 1 ELSE 0 END) AS INTEGER)" \
        if include_target else "CAST(NULL AS INTEGER)"
    return f"""
WITH cut(as_of, horizon, ts_start, ts_end) AS (VALUES {", ".join(rows)}),
x AS (SELECT s.*, c.* FROM {src} s, cut c WHERE s.invoice_date <= c.horizon),
h AS (SELECT * FROM x WHERE invoice_date <= as_of),
core AS (
  SELECT as_of, customer_id,
         {days('as_of', 'max(CASE WHEN invoice_date <= as_of THEN invoice_date END)')} AS recency_days,
         count(DISTINCT CASE WHEN invoice_date <= as_of THEN invoice END) AS frequency,
         round(sum(CASE WHEN invoice_date <= as_of THEN revenue END), 6) AS monetary,
         count(DISTINCT CASE WHEN invoice_date <= as_of THEN stock_code END) AS product_diversity,
         coalesce(sum(CASE WHEN invoice_date <= as_of AND {month_idx('invoice_date')} BETWEEN ts_start AND ts_end
                      THEN ({month_idx('invoice_date')} - ts_start - {tm / 2.0}) * revenue END), 0) / {denom} AS spend_trend_slope,
         {label} AS target_conversion
  FROM x GROUP BY as_of, customer_id
  HAVING max(CASE WHEN invoice_date <= as_of THEN 1 ELSE 0 END) = 1),
inv AS (SELECT as_of, customer_id, invoice, min(invoice_date) AS t FROM h GROUP BY 1, 2, 3),
gaps AS (
  SELECT as_of, customer_id,
         CASE WHEN count(*) >= 2 THEN CAST(sum(g) AS DOUBLE) / (count(*) - 1) END AS avg_days_between_orders
  FROM (SELECT *, {days('t', 'lag(t) OVER (PARTITION BY as_of, customer_id ORDER BY t)')} AS g FROM inv)
  GROUP BY 1, 2)
SELECT c.customer_id, c.recency_days, c.frequency, c.monetary, c.product_diversity, g.avg_days_between_orders,
       c.frequency = 1 AS single_buyer, c.spend_trend_slope,
       {days('c.as_of', 'd.first_purchase_date')} AS tenure_days,
       coalesce(d.country = {q(home)}, false) AS is_uk, c.as_of, c.target_conversion
FROM core c LEFT JOIN gaps g ON c.as_of = g.as_of AND c.customer_id = g.customer_id
LEFT JOIN dim d ON c.customer_id = d.customer_id"""


cte("features_test", ("silver", "dim"), features_sql("silver", [CUT.t_test], CUT.window_days))
cte("features_train", ("silver", "dim"), features_sql("silver", [CUT.t_train], CUT.window_days))
cte("features_current", ("features_test",), "SELECT * FROM features_test")
cte("snapshots", ("silver", "dim"), features_sql("silver", CUT.distinct(), CUT.window_days))


# ---------------------------------------------------------------- attribution
def _pick(u: str, cums, names) -> str:
    whens = " ".join(f"WHEN {u} < {c!r} THEN {q(n)}" for n, c in zip(names, cums))
    return f"CASE {whens} ELSE {q(names[0])} END"


_names = AP.names()
_u = hash_u("customer_id", "channel", AP.seed)
_mu = " ".join(f"WHEN {q(c[0])} THEN {c[2]!r}" for c in AP.channels)
_sg = " ".join(f"WHEN {q(c[0])} THEN {c[3]!r}" for c in AP.channels)
cte("attribution", ("features_current",), f"""
SELECT customer_id, channel,
       exp((CASE channel {_mu} END) + (CASE channel {_sg} END) * {hash_n('customer_id', 'cac', AP.seed)}) AS cac_synthetic,
       {hash_u('customer_id', 'exposure', AP.seed)} < {AP.exposure_rate!r} AS exposed
FROM (
  SELECT customer_id,
         CASE WHEN monetary >= (SELECT quantile_cont(monetary, {AP.high_value_percentile / 100.0!r}) FROM features_current)
              THEN {_pick(_u, AP.cumulative(True), _names)} ELSE {_pick(_u, AP.cumulative(False), _names)} END AS channel
  FROM features_current)""")


def dl(x: float) -> str:
    """Exact DOUBLE literal (string parse is correctly rounded)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


from tidewell.params import (DEFAULT_SEGMENT_ACTION, SEGMENT_ACTIONS, BudgetParams,  # noqa: E402
                             MetricsParams, PropensityParams)

MP = MetricsParams()
BP = BudgetParams()
PP = PropensityParams()

# ---------------------------------------------------------------- given scores / labels
cte("scores", ("features_test",), """
SELECT customer_id, CAST(least(greatest(50 + 60 * frequency - 2 * recency_days, 10), 990) AS DOUBLE) / 1000.0 AS score,
       target_conversion AS label
FROM features_test""")
cte("rule_labels", ("features_current",), """
SELECT customer_id, CASE WHEN recency_days <= 30 AND frequency >= 10 THEN 0 WHEN recency_days <= 30 THEN 1
                         WHEN frequency >= 10 THEN 2 WHEN recency_days <= 120 THEN 3 ELSE 4 END AS cluster
FROM features_current""")
_actions = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in SEGMENT_ACTIONS.items())
cte("profile", ("features_current", "rule_labels"), f"""
SELECT cluster, size, recency_days, frequency, monetary, avg_order_value, ltv_historical, conversion_rate, pct_of_base,
       segment_name,
       CASE regexp_replace(segment_name, ' [0-9]+$', '') {_actions} ELSE {q(DEFAULT_SEGMENT_ACTION)} END AS recommended_action
FROM (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY base) > 1
                 THEN base || ' ' || CAST(row_number() OVER (PARTITION BY base ORDER BY monetary DESC, cluster) AS VARCHAR)
                 ELSE base END AS segment_name
  FROM (
    SELECT *, CASE WHEN quad <> 'engaged' THEN quad
                   WHEN row_number() OVER (PARTITION BY quad ORDER BY monetary DESC, cluster) = 1 THEN 'Champions'
                   ELSE 'Loyal Customers' END AS base
    FROM (
      SELECT *, size / sum(size) OVER () AS pct_of_base,
             CASE WHEN recency_days <= mr AND frequency >= mf THEN 'engaged'
                  WHEN recency_days <= mr THEN 'Potential Loyalists'
                  WHEN frequency >= mf THEN 'At Risk' ELSE 'Hibernating' END AS quad
      FROM (
        SELECT *, median(recency_days) OVER () AS mr, median(frequency) OVER () AS mf
        FROM (
          SELECT l.cluster, count(*) AS size, avg(f.recency_days) AS recency_days, avg(f.frequency) AS frequency,
                 avg(f.monetary) AS monetary, avg(f.monetary / f.frequency) AS avg_order_value,
                 avg(f.monetary) AS ltv_historical, avg(f.target_conversion) AS conversion_rate
          FROM features_current f JOIN rule_labels l ON f.customer_id = l.customer_id GROUP BY l.cluster)))))""")
cte("segments", ("rule_labels", "profile"), """
SELECT l.customer_id, l.cluster, p.segment_name FROM rule_labels l LEFT JOIN profile p ON l.cluster = p.cluster""")

# ---------------------------------------------------------------- metrics marts
cte("ltv", ("features_current",), f"""
SELECT customer_id, monetary, frequency, tenure_days, monetary / frequency AS avg_order_value,
       (monetary / frequency) * (frequency / (greatest(tenure_days, 1) / {dl(365.25)})) * {dl(MP.gross_margin)}
         * {dl(MP.ltv_horizon_months / 12.0)} AS ltv_heuristic,
       monetary AS ltv_historical,
       (monetary / frequency) * (frequency / (greatest(tenure_days, 1) / {dl(365.25)})) * {dl(MP.gross_margin)}
         * {dl(MP.ltv_horizon_months / 12.0)} AS ltv_probabilistic,
       'heuristic_fallback' AS ltv_method
FROM features_current""")
_H = tslit(CUT.t_test + dt.timedelta(days=CUT.window_days))
cte("window_rev", ("silver",), f"""
SELECT customer_id, sum(revenue) AS window_revenue FROM silver
WHERE invoice_date > {tslit(CUT.t_test)} AND invoice_date <= {_H} GROUP BY customer_id""")
cte("channel_base", ("features_current", "attribution", "ltv", "window_rev"), """
SELECT f.customer_id, f.target_conversion, a.channel, a.cac_synthetic, l.ltv_probabilistic,
       coalesce(w.window_revenue, 0.0) AS window_revenue
FROM features_current f JOIN attribution a ON f.customer_id = a.customer_id
JOIN ltv l ON f.customer_id = l.customer_id LEFT JOIN window_rev w ON f.customer_id = w.customer_id""")
INF_SQL = "CAST('inf' AS DOUBLE)"


def cpa_sql(cost: str, conv: str) -> str:
    return f"CASE WHEN {conv} = 0 THEN {INF_SQL} ELSE {cost} / {conv} END"


def roas_sql(rev: str, cost: str) -> str:
    return f"CASE WHEN {cost} = 0 THEN CASE WHEN {rev} > 0 THEN {INF_SQL} ELSE 0.0 END ELSE {rev} / {cost} END"


cte("channel_agg", ("channel_base",), """
SELECT channel, count(*) AS customers, sum(cac_synthetic) AS cost, CAST(sum(target_conversion) AS BIGINT) AS conversions,
       sum(window_revenue) AS rev, avg(ltv_probabilistic) AS ltv, avg(cac_synthetic) AS cac
FROM channel_base GROUP BY channel""")
cte("channel_table", ("channel_agg",), f"""
SELECT channel, customers, round(cost, 2) AS spend_synthetic, conversions, round(rev, 2) AS revenue,
       round({cpa_sql('cost', 'conversions')}, 2) AS cpa, round({roas_sql('rev', 'cost')}, 2) AS roas,
       round(cac, 2) AS avg_cac, round(ltv, 2) AS avg_ltv, round({roas_sql('ltv', 'cac')}, 2) AS ltv_cac
FROM channel_agg""")


def hill_sql(x: str, vmax: str = "vmax", k: str = "k", s: str = "s") -> str:
    xx = f"pow(greatest({x}, 0.0), {s})"
    return f"({vmax} * {xx} / (pow({k}, {s}) + {xx}))"


cte("hill", ("channel_table", "attribution", "scores"), f"""
SELECT c.channel, coalesce(a.vmax, 0.0) AS vmax, greatest(c.cpa, 1.0) AS k, {dl(BP.hill_shape)} AS s
FROM channel_table c LEFT JOIN (
  SELECT ab.channel, sum(sc.score) AS vmax FROM attribution ab JOIN scores sc ON ab.customer_id = sc.customer_id
  GROUP BY ab.channel) a ON c.channel = a.channel""")
cte("scored_attribution", ("attribution", "scores"), """
SELECT a.customer_id, a.channel, s.score FROM attribution a JOIN scores s ON a.customer_id = s.customer_id""")

# ---------------------------------------------------------------- uplift frame
cte("uplift_frame", ("features_test", "attribution"), f"""
SELECT customer_id, label, treated, is_test,
       CAST(floor({hash_u('customer_id', 'uplift', PP.seed)} * 200) AS DOUBLE) / 1000.0 - {dl(0.1)} AS uplift
FROM (
  SELECT *, row_number() OVER (PARTITION BY treated, label ORDER BY u, customer_id)
              <= (count(*) OVER (PARTITION BY treated, label) * 300 + 999) // 1000 AS is_test
  FROM (
    SELECT f.customer_id, f.target_conversion AS label, a.exposed AS treated, {hash_u('f.customer_id', 'split', PP.seed)} AS u
    FROM features_test f JOIN attribution a ON f.customer_id = a.customer_id))""")
