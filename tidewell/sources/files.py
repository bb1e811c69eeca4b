"""File sources and sinks."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources import digests

# Fixed source header → bronze column map.
RAW_COLUMNS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
TEXT_COLUMNS = ("invoice", "stock_code", "description", "country")


def conform_text(df: DataFrame) -> DataFrame:
    """Mixed-type text columns as strings, nulls preserved."""
    return df.withColumns({c: F.col(c).cast("string") for c in TEXT_COLUMNS if c in df.columns})


def bronze_union(parts: list[DataFrame], rename: dict[str, str] = RAW_COLUMNS) -> DataFrame:
    """Trim header names of every part, rename by map, conform text per
    part (a part may type a column as number, another as text — conforming
    before the union keeps ANSI coercion from casting text to numbers),
    then UNION ALL by name."""
    ready = []
    for p in parts:
        t = p.toDF(*[c.strip() for c in p.columns])
        ready.append(conform_text(t.withColumnsRenamed({k: v for k, v in rename.items() if k in t.columns})))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ready)


def read_parts(spark: SparkSession, paths: list[str], fmt: str = "parquet", schema=None,
               options: dict | None = None) -> list[DataFrame]:
    """One DataFrame per source part (e.g. yearly exports) in CSV / Parquet / JSON."""
    out = []
    for p in paths:
        r = spark.read.format(fmt).options(**(options or {}))
        if schema is not None:
            r = r.schema(schema)
        out.append(r.load(p))
    return out


def source_manifest(spark: SparkSession, paths: list[str], fmt: str | None = "parquet",
                    piece_bytes: int = digests.PIECE_BYTES) -> DataFrame:
    """Per source file — path, bytes, modified, pieces, sha256,
    tree_sha256, rows.

    Contents are hashed by byte ranges (``sources.digests``), whatever a
    file's size: ``sha256`` is the plain digest of files of one piece, null
    for larger ones, ``tree_sha256`` covers all.  Row counts come from the
    ``fmt`` reader grouped by the hidden file-path column; a file without rows
    has 0, without a ``fmt`` they are null."""
    files = digests.list_files(spark, paths)
    out = files.join(digests.file_digests(files, piece_bytes), "path")
    if fmt is None:
        return out.withColumn("rows", F.lit(None).cast("long"))
    rows = (spark.read.format(fmt).load(paths).select(F.col("_metadata.file_path").alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("rows")))
    return out.join(rows, "path", "left").fillna(0, ["rows"])


def export_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def content_digest(df: DataFrame, decimals: int = 6) -> Column:
    """Order-free digest of the rows of ``df``, as an aggregate: the sum of the
    top 32 md5 bits of each row's cells.  Cells are written as text, numbers
    with a point as whole multiples of 10^-decimals, nulls as nothing; a
    changed, lost, doubled or swapped cell changes it."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = F.round(c * 10 ** decimals).cast("bigint")
        cells.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")), F.lit(0))


def read_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """An export read back with the types it was written from."""
    return spark.read.option("header", True).schema(like.schema).csv(path)


def write_summary(spark: SparkSession, metrics: DataFrame, path: str) -> DataFrame:
    """A tidy (metric, value) summary written as JSON lines and read back."""
    metrics.write.mode("overwrite").json(path)
    return spark.read.schema(metrics.schema).json(path)
