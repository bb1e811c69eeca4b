"""Data contracts (K1–K3): strict column sets, types, value checks, unique keys.

K1 compares schemas (metadata, driver side).  K2 evaluates every check of a
table in a single aggregation (one pass, all violations counted, none
short-circuited) and unpivots the counters.  K3 counts duplicate keys with a
grouped count per key set.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str                      # Spark simpleString, e.g. "string", "bigint"
    nullable: bool = False
    checks: tuple = ()              # ("gt", 0) | ("ge", 1) | ("isin", (...))


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple
    unique: tuple = ()              # tuple of key tuples
    strict: bool = True

    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


SILVER = Contract("silver", (
    ColumnSpec("invoice", "string"),
    ColumnSpec("stock_code", "string"),
    ColumnSpec("description", "string", nullable=True),
    ColumnSpec("quantity", "bigint", checks=(("gt", 0),)),
    ColumnSpec("invoice_date", "timestamp_ntz"),
    ColumnSpec("unit_price", "double", checks=(("gt", 0),)),
    ColumnSpec("customer_id", "string"),
    ColumnSpec("country", "string"),
    ColumnSpec("revenue", "double", checks=(("gt", 0),)),
), unique=(("invoice", "stock_code", "invoice_date", "customer_id", "quantity", "unit_price"),))

BRONZE = Contract("bronze", (
    ColumnSpec("invoice", "string"),
    ColumnSpec("stock_code", "string"),
    ColumnSpec("description", "string", nullable=True),
    ColumnSpec("quantity", "bigint"),
    ColumnSpec("invoice_date", "timestamp_ntz"),
    ColumnSpec("unit_price", "double"),
    ColumnSpec("customer_id", "double", nullable=True),
    ColumnSpec("country", "string"),
))

DIM_CUSTOMERS = Contract("dim_customers", (
    ColumnSpec("customer_id", "string"),
    ColumnSpec("first_purchase_date", "timestamp_ntz"),
    ColumnSpec("acquisition_cohort", "string"),
    ColumnSpec("country", "string"),
), unique=(("customer_id",),))

CUSTOMER_FEATURES = Contract("customer_features", (
    ColumnSpec("customer_id", "string"),
    ColumnSpec("recency_days", "bigint", checks=(("ge", 0),)),
    ColumnSpec("frequency", "bigint", checks=(("ge", 1),)),
    ColumnSpec("monetary", "double", checks=(("gt", 0),)),
    ColumnSpec("product_diversity", "bigint", checks=(("ge", 1),)),
    ColumnSpec("avg_days_between_orders", "double", nullable=True, checks=(("ge", 0),)),
    ColumnSpec("single_buyer", "boolean"),
    ColumnSpec("spend_trend_slope", "double", nullable=True),
    ColumnSpec("tenure_days", "bigint", checks=(("ge", 0),)),
    ColumnSpec("is_uk", "boolean"),
    ColumnSpec("as_of", "timestamp_ntz"),
    ColumnSpec("target_conversion", "int", nullable=True, checks=(("isin", (0, 1)),)),
), unique=(("as_of", "customer_id"),))

ATTRIBUTION = Contract("synthetic_attribution", (
    ColumnSpec("customer_id", "string"),
    ColumnSpec("channel", "string", checks=(("isin", ("paid_search", "paid_social", "email", "display")),)),
    ColumnSpec("cac_synthetic", "double", checks=(("gt", 0),)),
    ColumnSpec("exposed", "boolean"),
), unique=(("customer_id",),))


def contract_types(df: DataFrame, contract: Contract) -> DataFrame:
    """K1: one row per declared or present column with its status."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for c in contract.columns:
        got = actual.get(c.name)
        status = "missing" if got is None else ("ok" if got == c.dtype else "type_mismatch")
        rows.append((contract.table, c.name, c.dtype, got, status))
    if contract.strict:
        for name, got in actual.items():
            if name not in contract.column_names():
                rows.append((contract.table, name, None, got, "unexpected"))
    return df.sparkSession.createDataFrame(
        rows, "table string, column string, expected_type string, actual_type string, status string")


def _violation(spec: ColumnSpec, check) -> tuple[str, Column]:
    c = F.col(spec.name)
    kind, arg = check
    if kind == "gt":
        return f"gt_{arg}", c.isNotNull() & ~(c > F.lit(arg))
    if kind == "ge":
        return f"ge_{arg}", c.isNotNull() & ~(c >= F.lit(arg))
    if kind == "isin":
        return "isin", c.isNotNull() & ~c.isin(list(arg))
    raise ValueError(kind)


def check_metrics(columns: list[str], contract: Contract) -> dict[tuple[str, str], Column]:
    """(column, check) → the count of rows that violate it."""
    out = {}
    for spec in contract.columns:
        if spec.name not in columns:
            continue
        if not spec.nullable:
            out[spec.name, "not_null"] = F.count_if(F.col(spec.name).isNull())
        for chk in spec.checks:
            label, pred = _violation(spec, chk)
            out[spec.name, label] = F.count_if(pred)
    return out


def contract_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """K2: (table, column, check, violations) for every check, from one aggregate."""
    metrics = check_metrics(df.columns, contract)
    agg = df.agg(*[e.alias(f"v{i}") for i, e in enumerate(metrics.values())])
    stack = "stack({n}, {args}) AS (column, check, violations)".format(
        n=len(metrics), args=", ".join(f"'{c}', '{k}', v{i}" for i, (c, k) in enumerate(metrics)))
    return agg.selectExpr(f"'{contract.table}' AS table", stack)


def contract_checks_from(spark: SparkSession, counts: dict[tuple[str, str], int], contract: Contract) -> DataFrame:
    """K2 from counters gathered while the table was written."""
    return spark.createDataFrame([(contract.table, c, k, int(n)) for (c, k), n in counts.items()],
                                 "table string, column string, check string, violations bigint")


def contract_unique(df: DataFrame, contract: Contract) -> DataFrame:
    """K3: per unique key set, rows, distinct keys and keys seen more than once."""
    out = None
    for key in contract.unique:
        g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        r = g.agg(F.sum("n").cast("bigint").alias("rows"),
                  F.count(F.lit(1)).alias("distinct_keys"),
                  F.count_if(F.col("n") > 1).alias("duplicate_keys")).select(
            F.lit(contract.table).alias("table"), F.lit(",".join(key)).alias("key"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def assert_contract(df: DataFrame, contract: Contract) -> None:
    """Raise with every violation listed (types, checks, keys) — lazy validation."""
    problems = [r for r in contract_types(df, contract).collect() if r.status != "ok"]
    msgs = [f"{r.column}: {r.status} ({r.expected_type} vs {r.actual_type})" for r in problems]
    msgs += [f"{r.column}: {r.check} x{r.violations}"
             for r in contract_checks(df, contract).collect() if r.violations]
    if contract.unique:
        msgs += [f"unique({r.key}): {r.duplicate_keys} duplicated"
                 for r in contract_unique(df, contract).collect() if r.duplicate_keys]
    if msgs:
        raise ValueError(f"contract {contract.table} violated: " + "; ".join(msgs))
