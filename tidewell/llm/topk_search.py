"""Exact top-k inner products by no-random-access aggregation.

Vectors lie in blocks.  In a block every component is a list sorted by value;
a query reads it from the top where its own component is positive and from
the bottom where that is negative, so what it meets first counts most.

1. Reading.  All lists of a block are read to the same depth, in growing steps.
   A candidate's upper score bound takes the component itself where its entry
   has been read and the list's last read value elsewhere, its lower bound the
   list's far end there.
2. Stopping.  The k-th greatest lower bound, of this block or of those the task
   read before, is a floor for the answer.  Candidates whose upper bound is below it
   are out; those not met at all are bounded by the last read values alone.
   A query stops reading when at most RESOLVE candidates remain.
3. Resolving.  The scores of what remains are worked out in full; ties go to
   smaller ids.  A query that never stops reads the lists to their ends, where
   both bounds are the score.

Tasks keep k rows a query; Spark ranks those of all tasks.  Queries are rows of
the same table.  They are handed to the tasks in passes of QUERY_BYTES at most
(checked), each over all blocks, so the memory does not grow with the table; the
number of passes does, as the work of any exact search by a share of all rows.

Components are scaled and floored to integers; sums below 2^53 are exact in
floating point, larger ones are computed with Python's integers, and a score
beyond a long is cut to its range.

Defined cases: vectors that are null, or hold a null or non-finite component, take
no part.  Shorter vectors count as ending in zeros; empty ones score 0.  Each row is
one of its own: rows sharing an id are candidates of each other, and each is a
query.  Null ids are no queries and come last among ties.  Only the id and vector
columns are read.  Empty tables give empty results.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import stage
from tidewell.session import ship_package, sql_conf

BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20
QUERY_BYTES = 32 << 20
QUERIES_AT_ONCE = 256
RESOLVE = 64                  # candidates of a query that are scored one by one
DEPTHS = (16, 4, 2, 1)        # a list is read to its length over these
LAST = np.iinfo(np.int64).max

BLOCK = "block long, n int, d int, ids binary, no_id binary, queries binary, vectors binary"


def _parse(column: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places of the vectors that take part, their scaled components)."""
    lists = column.cast(pa.list_(pa.float64()))
    offsets, values = lists.offsets.to_numpy(), lists.values
    bad = np.zeros(len(values) + 1, np.int64)
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)      # null components become NaN
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
    flat = np.floor(flat * scale)
    keep = np.flatnonzero(ok)
    return keep, [flat[offsets[k]:offsets[k + 1]] for k in keep]


def _block(ids: list, no_id: list, queries: list, vectors: list[np.ndarray]) -> pa.RecordBatch:
    # in the order of ids, so that places settle ties
    order = np.lexsort((np.array(ids, np.int64), np.array(no_id, bool)))
    d = max((len(v) for v in vectors), default=0)
    full = np.zeros((len(vectors), d))
    for at, k in enumerate(order):
        full[at, :len(vectors[k])] = vectors[k]
    columns = [np.array(ids, np.int64)[order], np.array(no_id, bool)[order],
               np.flatnonzero(np.array(queries, bool)[order]).astype(np.int32), full]
    key = uuid.uuid4().int >> 65
    return pa.RecordBatch.from_arrays(
        [pa.array([key], pa.int64()), pa.array([len(vectors)], pa.int32()), pa.array([d], pa.int32()),
         *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
        ["block", "n", "d", "ids", "no_id", "queries", "vectors"])


def blocks(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """The vectors that take part, in stored blocks; a block's key is fixed once it is stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            keep, found = _parse(batch.column(2), scale)
            ids = batch.column(0).fill_null(LAST).to_pylist()
            none, asked = batch.column(0).is_null().to_pylist(), batch.column(1).to_pylist()
            for k, v in zip(keep, found):
                # the widest vector sets the width of all
                if held[0] and (len(held[0]) == BLOCK_ROWS or (len(held[0]) + 1) * 8 * max(size, len(v)) > BLOCK_BYTES):
                    yield _block(*held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, (ids[k], none[k], asked[k], v)):
                    column.append(value)
                size = max(size, len(v))
        if held[0]:
            yield _block(*held)

    ids = F.col(id_col).cast("long")
    rows = vectors.select(ids.alias("id"), F.coalesce(is_query, F.lit(False)).alias("asked"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    with sql_conf(vectors.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        return stage(rows.mapInArrow(run, BLOCK), "vector-blocks")


def _query_parts(stored: DataFrame) -> DataFrame:
    """(block, d, bytes, places, ids, vectors) of the query rows of every block that has some."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                at = np.frombuffer(r["queries"], np.int32)
                x = np.frombuffer(r["vectors"]).reshape(r["n"], r["d"])[at]
                rows.append({"block": r["block"], "d": r["d"], "bytes": x.nbytes + 12 * len(at), "places": r["queries"],
                             "ids": np.frombuffer(r["ids"], np.int64)[at].tobytes(), "vectors": x.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("block", pa.int64()), ("d", pa.int32()), ("bytes", pa.int64()), ("places", pa.binary()),
                 ("ids", pa.binary()), ("vectors", pa.binary())]))

    return stage(stored.filter(F.length("queries") > 0).mapInArrow(
        run, "block long, d int, bytes long, places binary, ids binary, vectors binary"), "query-parts")


def _passes(parts: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Parts dealt into passes, none above ``limit`` (or one part alone, whose size blocks bound)."""
    total = parts.agg(F.sum("bytes")).first()[0] or 0
    n = -(-total // limit)
    while True:
        dealt = parts.withColumn("pass", F.pmod(F.xxhash64("block"), F.lit(max(n, 1))))
        worst = dealt.groupBy("pass").agg(F.sum("bytes").alias("b"), F.count("*").alias("k")).filter(
            (F.col("b") > 2 * limit) & (F.col("k") > 1))
        if n <= 1 or worst.isEmpty():
            return dealt, n
        n *= 2


class Queries:
    """The query rows of a pass, side by side."""

    def __init__(self, rows: list):
        self.d = max((r["d"] for r in rows), default=0)
        size = [len(r["places"]) // 4 for r in rows]
        self.block = np.repeat(np.array([r["block"] for r in rows], np.int64), size)
        self.place = np.frombuffer(b"".join(r["places"] for r in rows), np.int32)
        self.ids = np.frombuffer(b"".join(r["ids"] for r in rows), np.int64)
        self.x = np.zeros((len(self.ids), self.d))
        at = 0
        for r, n in zip(rows, size):
            self.x[at:at + n, :r["d"]] = np.frombuffer(r["vectors"]).reshape(n, r["d"])
            at += n


def _exact_product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of x with all of q, cut to the range of a long."""
    if x.shape[1] == 0:
        return np.zeros((len(x), len(q)), np.int64)
    whole = x.astype(np.int64).astype(object) if np.abs(x).max(initial=0) < 2 ** 62 else np.vectorize(int, otypes=[object])(x)
    other = np.vectorize(int, otypes=[object])(q) if q.size else q.astype(object)
    return np.clip(whole @ other.T, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


class Lists:
    """The sorted lists of a block."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.sorted = np.sort(x, axis=0)
        self.low, self.high = self.sorted[0], self.sorted[-1]

    def bounds(self, depth: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of every query (row) and candidate after reading ``depth`` entries of each list.
        up, down: positive and negative components of the queries."""
        top, bottom = self.sorted[len(self.x) - depth], self.sorted[depth - 1]
        if depth == len(self.x):
            score = (up + down) @ self.x.T
            return score, score
        from_top, from_bottom = self.x >= top, self.x <= bottom
        lower = up @ np.where(from_top, self.x, self.low).T + down @ np.where(from_bottom, self.x, self.high).T
        upper = up @ np.where(from_top, self.x, top).T + down @ np.where(from_bottom, self.x, bottom).T
        return lower, upper


def search_block(lists: Lists, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, places, scores) of every query's candidates that can be among its k best.
    own: the query's place in the block or -1; floor: a score that k others have already."""
    n = len(lists.x)
    live = np.arange(len(q))
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    for depth in sorted({max(1, n // s) for s in DEPTHS}):
        lower, upper = lists.bounds(depth, up[live], down[live])
        mine = np.flatnonzero(own[live] >= 0)
        lower[mine, own[live][mine]] = upper[mine, own[live][mine]] = -np.inf
        least = floor[live]
        if n > k:
            least = np.maximum(least, np.partition(lower, n - k, axis=1)[:, n - k])
        can = (upper >= least[:, None]) & (upper > -np.inf)
        left = can.sum(axis=1)
        done = (left <= RESOLVE) | (depth == n)
        for row in np.flatnonzero(done & (left > 0)):
            at = np.flatnonzero(can[row])
            yield live[row], at, (lists.x[at] @ q[live[row]] if depth < n else lower[row, at])
        live = live[~done]
        if not len(live):
            return


class Best:
    """The k best candidates of every query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.exact = np.zeros((n, k), np.int64)
        self.id = np.full((n, k), LAST)
        self.no_id = np.ones((n, k), bool)

    def add(self, row: int, score: np.ndarray, exact: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        if len(score) > 4 * self.k:
            # equal scores lie in the order of ids
            few = np.sort(np.lexsort((np.arange(len(score)), -exact))[:self.k])
            score, exact, ids, no_id = score[few], exact[few], ids[few], no_id[few]
        score, exact = np.r_[self.score[row], score], np.r_[self.exact[row], exact]
        ids, no_id = np.r_[self.id[row], ids], np.r_[self.no_id[row], no_id]
        # a place not yet filled comes after all that are
        order = np.lexsort((ids, no_id, -exact, score == -np.inf))[:self.k]
        self.score[row], self.exact[row], self.id[row], self.no_id[row] = score[order], exact[order], ids[order], no_id[order]


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Queries = queries.value
        best = Best(len(asked.ids), k)
        for batch in batches:
            for r in batch.to_pylist():
                x = np.frombuffer(r["vectors"]).reshape(r["n"], r["d"])
                d = min(r["d"], asked.d)
                x, q = x[:, :d], asked.x[:, :d]
                ids, no_id = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["no_id"], bool)
                own = np.where(asked.block == r["block"], asked.place, -1)
                small = d * np.abs(x).max(initial=0) * np.abs(q).max(initial=0) < 2 ** 53
                lists = Lists(x)
                for a in range(0, len(q), QUERIES_AT_ONCE if small else 1):
                    b = a + (QUERIES_AT_ONCE if small else 1)
                    if small:
                        for row, at, score in search_block(lists, q[a:b], own[a:b], best.score[a:b, -1], k):
                            best.add(a + row, score, score.astype(np.int64), ids[at], no_id[at])
                    else:
                        at = np.flatnonzero(np.arange(r["n"]) != own[a])
                        exact = _exact_product(x[at], q[a:b])[:, 0]
                        best.add(a, exact.astype(np.float64), exact, ids[at], no_id[at])
        full = best.score > -np.inf
        rows, _ = np.nonzero(full)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(asked.ids[rows], pa.int64()),
             pa.array(best.id[full], pa.int64(), mask=best.no_id[full]), pa.array(best.exact[full], pa.int64())],
            ["row", "query_id", "id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 1.0, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, ``id_col``, score): the k greatest inner products of
    every row that ``is_query`` says, with all other rows of ``vectors``."""
    spark = vectors.sparkSession
    ship_package(spark)
    stored = blocks(vectors, is_query, id_col, vector_col, scale)
    parts, n = _passes(_query_parts(stored), query_bytes)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    out = None
    with sql_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):
        for p in range(n):
            asked = Queries(parts.filter(F.col("pass") == p).orderBy("block").collect())
            if not len(asked.ids):
                continue
            held = spark.sparkContext.broadcast(asked)
            ranked = stored.mapInArrow(_search(held, k), "row long, query_id long, id long, score long").withColumn(
                "rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            done = stage(ranked.select("query_id", "rank", F.col("id").alias(id_col), "score"), "top-k")
            held.destroy()
            out = done if out is None else out.unionByName(done)
    if out is None:
        out = spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    return out
