"""Running totals in a global order without a single-task window.

A window with no PARTITION BY sends every row to one task.  Instead the rows
are range-partitioned on the order key (equal keys always land in the same
range) and sorted there, one pass per range accumulates the local sums, and
each row then adds the totals of the ranges before it, a table of at most
ranges + groups rows.  The rows are exchanged once.

Because the result is consumed twice (rows and range totals), it is
checkpointed to the shared checkpoint folder first: two separately planned
consumers could otherwise see differently coalesced partitions.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType, StructField, StructType


def _changes(batch: pa.RecordBatch, groups: tuple[str, ...], before: tuple | None) -> tuple[np.ndarray, tuple]:
    """Mask of rows that start a group, and the last row's group."""
    new = np.zeros(batch.num_rows, bool)
    for g in groups:
        code = pc.dictionary_encode(batch.column(g), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    at = lambda i: tuple(batch.column(g)[i].as_py() for g in groups)
    new[0] = before is None or at(0) != before
    return new, at(batch.num_rows - 1)


def running_totals(df: DataFrame, order: list[Column], values: dict[str, Column],
                   groups: tuple[str, ...] = (), num_partitions: int | None = None) -> DataFrame:
    """Adds ``pos`` (1-based row position) and ``cum_<name>`` (inclusive running
    sum) per group in the given total order.  ``order`` must be a total order
    within each group for positions to be deterministic."""
    from tidewell.session import ensure_checkpoint_dir, ship_package
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    names = list(values)
    base = df.withColumns({f"_v_{k}": v for k, v in values.items()}) if values else df
    whole = {k: isinstance(base.schema[f"_v_{k}"].dataType, IntegralType) for k in names}
    base = base.withColumns({f"_v_{k}": F.col(f"_v_{k}").cast("bigint" if whole[k] else "double") for k in names}) \
        if values else base
    by = [*[F.col(g) for g in groups], *order]
    ranged = base.repartitionByRange(num_partitions, *by) if num_partitions else base.repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*by)
    fields = [f for f in ranged.schema.fields if not f.name.startswith("_v_")]
    kept = [f.name for f in fields]
    schema = StructType(fields + [StructField("_pid", LongType()), StructField("_l__one", LongType())]
                        + [StructField(f"_l_{k}", LongType() if whole[k] else DoubleType()) for k in names])

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        before, carry = None, {k: 0 for k in ["_one", *names]}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new, before = _changes(batch, groups, before)
            starts = np.flatnonzero(new)
            segment = np.cumsum(new)              # 0: rows that continue the last batch's group
            out = [batch.column(c) for c in kept] + [pa.array(np.full(n, pid, np.int64))]
            for k in carry:
                if k == "_one":
                    v = np.ones(n, np.int64)
                else:
                    v = pc.fill_null(batch.column(f"_v_{k}"), 0).to_numpy(zero_copy_only=False)
                total = np.cumsum(v)
                skipped = np.r_[-carry[k], (total - v)[starts]]
                local = total - skipped[segment]
                carry[k] = local[-1]
                out.append(pa.array(local))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

    local = ranged.mapInArrow(accumulate, schema).checkpoint(eager=True)
    sums = [f"_l_{k}" for k in ["_one", *names]]
    tot = local.groupBy("_pid", *groups).agg(F.max(F.struct(*sums)).alias("_t"))   # the longest row count is the last
    wo = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(F.col("_pid").alias("_q"), *[F.col(g).alias(f"_g_{g}") for g in groups], *[
        F.coalesce(F.sum(F.col("_t")[s]).over(wo), F.lit(0)).alias("_o" + s) for s in sums])
    on = local["_pid"] == offs["_q"]
    for g in groups:
        on = on & local[g].eqNullSafe(offs[f"_g_{g}"])
    out = local.join(offs, on)
    out = out.withColumns({"pos": (F.col("_l__one") + F.col("_o_l__one")).cast("bigint")}
                          | {f"cum_{k}": F.col(f"_l_{k}") + F.col(f"_o_l_{k}") for k in names})
    return out.select(*kept, "pos", *[f"cum_{k}" for k in names])
