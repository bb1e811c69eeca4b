"""Bronze → silver as a Structured Streaming query.

The reference pipeline is batch only; this is the same cleaning waterfall
(C1–C6) for bronze files that keep arriving.  Rules C1–C4 are stateless
predicates.  C5 de-duplicates within an event-time watermark
(``dropDuplicatesWithinWatermark``): state per line key is kept for
``dedup_delay`` and then dropped.  The watermark cuts both ways: *every* row
that arrives later than ``dedup_delay`` behind the newest event is dropped,
duplicate or not, so a back-fill of older files must go through the batch
plan, which remains the exact form, or run with a delay that spans it.
Per-rule removal counts are kept as a running aggregate written by
``foreachBatch``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import cleaning
from tidewell.params import DEDUP_KEY, NON_PRODUCT_STOCK_CODES


def silver_stream(spark: SparkSession, bronze_dir: str, schema, dedup_delay: str = "1 day",
                  codes=NON_PRODUCT_STOCK_CODES) -> tuple[DataFrame, DataFrame]:
    """Returns (silver rows stream, tagged stream for the DQ counts)."""
    src = spark.readStream.schema(schema).parquet(bronze_dir)
    tagged = cleaning.tag_failed_rule(src, codes)
    # watermarks need a zoned timestamp: the UTC wall clock cast to TIMESTAMP
    kept = (tagged.filter(F.col("failed_rule").isNull()).drop("failed_rule")
            .withColumn("_event_ts", F.to_utc_timestamp(F.col("invoice_date").cast("timestamp"), "UTC"))
            .withWatermark("_event_ts", dedup_delay)
            .dropDuplicatesWithinWatermark(list(DEDUP_KEY))
            .drop("_event_ts"))
    return cleaning.standardize(kept), tagged


def start_silver(spark: SparkSession, bronze_dir: str, schema, out_dir: str, checkpoint_dir: str,
                 dedup_delay: str = "1 day", available_now: bool = True):
    """Start the stream appending silver Parquet files; returns the query."""
    silver, _ = silver_stream(spark, bronze_dir, schema, dedup_delay)
    w = (silver.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_dq_counts(spark: SparkSession, bronze_dir: str, schema, sink, checkpoint_dir: str,
                    available_now: bool = True):
    """Running per-rule counts (C1–C4 tags, null = survivor) handed to ``sink(df, epoch)``."""
    _, tagged = silver_stream(spark, bronze_dir, schema)
    counts = tagged.groupBy(F.coalesce("failed_rule", F.lit("_survivor")).alias("tag")).agg(
        F.count(F.lit(1)).alias("rows"))
    w = (counts.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
