"""Bronze line items derived from the TPC-H-style TESTDATA tables.

The retail source the operators were designed for is not available, so the
bronze table is derived deterministically from lineitem / orders / part /
supplier / nation, with dirt injected by key arithmetic so every cleaning rule
has work to do (cancellations, postage lines, zero quantities, anonymous
customers, duplicated export rows, padded country names).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed adapter constants (shared with the DuckDB oracle).
POSTAGE_PART_MOD = 50
ZERO_QTY_ORDER_MOD = 41
MINUTES_MOD = 1440
ANON_CUSTOMER_MOD = 23
DUPLICATE_ORDER_MOD = 37
SPLIT_DATE = "1996-01-01"
# suppliers up to which their lookup (a key and a nation's name, about 40 bytes) is broadcast:
# a plan by size stops at 10 MB and shuffles every line instead
BROADCAST_SUPPLIERS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_source_parts(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """The adapter output as two files, split at a date as yearly exports are,
    under the retail export's raw headers: the parts pad different headers
    with blanks (what the file reader S1 has to trim and rename)."""
    from tidewell.sources.files import RAW_COLUMNS
    raw = {v: k for k, v in RAW_COLUMNS.items()}
    b = bronze_from_testdata(spark, sf_dir)
    early = F.coalesce(F.col("invoice_date") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(True))
    paths = []
    for part, rows in enumerate((b.filter(early), b.filter(~early))):
        named = rows.select(*[F.col(c).alias(f" {raw[c]} " if i % 2 == part else raw[c]) for i, c in enumerate(b.columns)])
        paths.append(f"{folder}/part_{part}")
        named.write.mode("overwrite").parquet(paths[-1])
    return paths


def bronze_in_source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with ``source_row``, the place of a row in the export, and with
    export rows that repeat a line key under another description; the copy
    comes first for odd orders, so neither order of text nor of copying is
    the source's."""
    return bronze_from_testdata(spark, sf_dir, source_order=True)


def bronze_from_testdata(spark: SparkSession, sf_dir: str, source_order: bool = False) -> DataFrame:
    """lineitem ⋈ orders ⋈ part ⋈ (supplier ⋈ nation) → 8 bronze columns.

    Join strategy is left to Catalyst/AQE: lineitem⋈orders is a sort-merge on
    the order key at scale; part and supplier are joined by hash and become
    broadcasts only when AQE measures them under the broadcast threshold.
    Explicit broadcasts are nation (25 rows, fixed by the schema) and, up to
    BROADCAST_SUPPLIERS rows (20 MB), supplier with its nation.
    Duplicate export rows are produced by exploding a copy count, so the
    join runs once instead of twice.
    """
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supp_nation = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    if s.count() <= BROADCAST_SUPPLIERS:
        supp_nation = F.broadcast(supp_nation)

    j = (l.join(o, l.l_orderkey == o.o_orderkey)
          .join(p, l.l_partkey == p.p_partkey)
          .join(supp_nation, l.l_suppkey == supp_nation.s_suppkey))
    key = F.col("l_orderkey")
    copies = F.when(key % DUPLICATE_ORDER_MOD == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copy = F.col("_copy").cast("bigint")
    ordered = [((key * 10 + F.col("l_linenumber")) * 2 + F.when(key % 2 == 1, 1 - copy).otherwise(copy)).alias("source_row")]
    out = (j.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), key.cast("string")))
         .otherwise(key.cast("string")).alias("invoice"),
        F.when(F.col("l_partkey") % POSTAGE_PART_MOD == 0, F.lit("POST"))
         .otherwise(F.col("l_partkey").cast("string")).alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(key % ZERO_QTY_ORDER_MOD == 0, F.lit(0).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"),
        (F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), (key % MINUTES_MOD).cast("int"))).alias("invoice_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(F.col("o_custkey") % ANON_CUSTOMER_MOD == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("customer_id"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("country"),
        F.explode(copies).alias("_copy")))
    if not source_order:
        return out.drop("_copy", "l_orderkey", "l_linenumber")
    described = F.concat("description", F.lit(" v"), copy.cast("string"))
    return out.select("invoice", "stock_code", described.alias("description"), "quantity", "invoice_date", "unit_price",
                      "customer_id", "country", *ordered)
