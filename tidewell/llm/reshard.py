"""Minimum-cost-flow resharding.

Documents lie in old shards.  Given the old shard sizes and the capacities
of the new shards, a minimum-cost flow decides how many bytes each old shard
keeps and how many it sends where, so that every new shard is filled to its
capacity and the fewest bytes move.  Shards are cut into blocks by text
hash; whole blocks are transferred and only the block on a boundary is split
between documents.  What reaches the driver is one row per block (old shards
x BLOCKS x SALTS, fixed).

Inside a shard documents lie in the order of (text-hash block, salt, text hash), and a
cut falls between groups of equal texts: a group goes where its middle byte falls.  Only
a group of more than 1 / HEAVY of a new shard is dealt by document instead (salted by id, so a
text that fills a third of the table falls into SALTS blocks): kept whole it would break
the balance.  There are fewer than HEAVY x new shards of those.

The text is shuffled once, straight into the file layout of the new shards.

Defined cases: null text has no bytes (size 8).  Rows sharing a doc_id, and
repeated rows, are placed each on its own.  Extra columns pass through;
``shard``, ``slot`` and ``size`` replace input columns of that name.  An
empty table gives an empty result.
"""
from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import P, stage, text_hash, text_or_empty

BLOCKS = 64
SALTS = 16
HEAVY = 16
OVERHEAD = 8


def min_cost_transfers(old: list[int], capacity: list[int]) -> np.ndarray:
    """flow[i, j]: bytes of old shard i that go to new shard j, at least total
    moved cost.  Keeping a byte (i == j) is free, moving it costs 1.
    Successive shortest augmenting paths over the residual graph; the graph
    has one node per shard."""
    n, m = len(old), len(capacity)
    cost = np.ones((n, m), np.int64)
    for i in range(min(n, m)):
        cost[i, i] = 0
    flow = np.zeros((n, m), np.int64)
    supply, room = list(old), list(capacity)
    if sum(supply) > sum(room):
        raise ValueError("capacities are less than the bytes to place")
    while any(supply):
        # shortest distance from any old shard with supply left
        dist_i = [0 if s else None for s in supply]
        dist_j: list[int | None] = [None] * m
        came_j, came_i = [-1] * m, [-1] * n
        todo = deque((0, i) for i in range(n) if supply[i])
        while todo:
            side, k = todo.popleft()
            if side == 0:
                for j in range(m):
                    d = dist_i[k] + int(cost[k, j])
                    if dist_j[j] is None or d < dist_j[j]:
                        dist_j[j], came_j[j] = d, k
                        todo.append((1, j))
            else:
                for i in range(n):
                    if flow[i, k] and (dist_i[i] is None or dist_j[k] - int(cost[i, k]) < dist_i[i]):
                        dist_i[i], came_i[i] = dist_j[k] - int(cost[i, k]), k
                        todo.append((0, i))
        j = min((j for j in range(m) if room[j]), key=lambda j: (dist_j[j], j))
        path, end = [], j
        while True:
            i = came_j[j]
            path.append((i, j, 1))
            if came_i[i] < 0:
                break
            path.append((i, came_i[i], -1))
            j = came_i[i]
        push = min([supply[i], room[end], *(int(flow[a, b]) for a, b, s in path if s < 0)])
        for a, b, s in path:
            flow[a, b] += s * push
        supply[i] -= push
        room[end] -= push
    return flow


def even_capacity(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def document_size(text: Column) -> Column:
    return (F.octet_length(text) + OVERHEAD).cast("long")


@dataclass(frozen=True)
class Plan:
    """flow: bytes by old and new shard.  starts: (old_shard, block, salt,
    first byte in the old shard, new shard of that byte).  cuts: per old shard
    the (end byte, new shard) of consecutive intervals.  firsts: (shard,
    old_shard, block, salt, documents before that part in the new shard).
    heavy: hashes of the texts that are dealt by document."""

    flow: np.ndarray
    starts: list[tuple[int, int, int, int, int]]
    cuts: dict[int, list[tuple[int, int]]]
    firsts: list[tuple[int, int, int, int, int]]
    heavy: list[int]

    @property
    def moved_bytes(self) -> int:
        return int(self.flow.sum() - sum(self.flow[i, i] for i in range(min(self.flow.shape))))

    @property
    def touched(self) -> list[int]:
        """Shards that bytes leave or enter."""
        return sorted({k for i, j in zip(*np.nonzero(self.flow)) if i != j for k in (int(i), int(j))})


KEYS = ["old_shard", "block", "salt"]


def _keyed(docs: DataFrame, old_shard: Column) -> DataFrame:
    text = text_or_empty(docs)
    th = text_hash(text)
    return docs.withColumns({
        P + "th": th, P + "size": document_size(text), P + "old_shard": old_shard.cast("int"),
        P + "block": F.pmod(F.xxhash64(F.lit("block"), th), F.lit(BLOCKS)).cast("int")})


def _salted(rows: DataFrame, heavy: list[int]) -> DataFrame:
    """Adds P+salt and P+unit, what goes to one shard together within a text: all of it, or a document."""
    by_document = F.col(P + "th").isin(heavy) if heavy else F.lit(False)
    unit = F.when(by_document, F.xxhash64(F.lit("unit"), "doc_id"))
    return rows.withColumn(P + "unit", unit).withColumn(P + "salt", F.pmod(F.xxhash64(
        F.lit("salt"), F.coalesce(P + "unit", P + "th")), F.lit(SALTS)).cast("int"))


def _shard_at(cuts: dict[int, list[tuple[int, int]]], old_shard: Column, at: Column) -> Column:
    out = F.lit(None).cast("int")
    for i, pieces in cuts.items():
        within = F.lit(pieces[-1][1])
        for upto, j in reversed(pieces[:-1]):
            within = F.when(at < upto, F.lit(j)).otherwise(within)
        out = F.when(old_shard == i, within).otherwise(out)
    return out


def _placed(rows: DataFrame, starts: DataFrame, cuts) -> DataFrame:
    """Adds P+shard: where the middle byte of each unit falls."""
    # "home" follows from the keys: one exchange serves the layout and the windows
    keys = [P + k for k in KEYS]
    inside = Window.partitionBy(P + "home", *keys).orderBy(P + "th", P + "unit", "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # heavy texts hold many units; theirs are single documents, or rows that share an id
    unit = Window.partitionBy(P + "home", *keys, P + "th", P + "unit")
    rows = rows.join(F.broadcast(starts), keys).repartitionByRange(P + "home", *keys)
    rows = rows.withColumn(P + "end", F.sum(P + "size").over(inside))
    middle = F.col(P + "start") + F.max(P + "end").over(unit) - F.ceil(F.sum(P + "size").over(unit) / 2)
    rows = rows.withColumn(P + "at", middle)
    return rows.withColumn(P + "shard", _shard_at(cuts, F.col(P + "old_shard"), F.col(P + "at")).cast("int"))


def _starts_frame(spark, starts) -> DataFrame:
    # at most old shards x BLOCKS x SALTS rows
    return spark.createDataFrame(starts, ", ".join(f"{P}{k} int" for k in KEYS) + f", {P}start long, {P}home int")


def plan(docs: DataFrame, old_shard: Column, old_shards: int, capacity: list[int] | None = None,
         new_shards: int = 24) -> Plan:
    """Solve the transfers.  ``capacity``: bytes per new shard, even if None."""
    spark = docs.sparkSession
    located = stage(_keyed(docs, old_shard).select(
        "doc_id", *[P + c for c in ("th", "size", "old_shard", "block")]), "reshard-rows")
    total = located.agg(F.sum(P + "size")).first()[0] or 0
    shards = len(capacity) if capacity else new_shards
    heavy = [r[0] for r in located.groupBy(P + "th").agg(F.sum(P + "size").alias("b")).filter(
        F.col("b") * HEAVY * shards > total).collect()]
    rows = _salted(located, heavy)
    keys = [P + k for k in KEYS]
    blocks = sorted(tuple(r) for r in rows.groupBy(*keys).agg(F.sum(P + "size"), F.count("*")).collect())
    old = [0] * old_shards
    for s, _, _, size, _ in blocks:
        old[s] += size
    flow = min_cost_transfers(old, capacity or even_capacity(sum(old), new_shards))
    cuts: dict[int, list[tuple[int, int]]] = {}
    for i in range(old_shards):
        at = 0
        for j in [i] * (i < flow.shape[1]) + [j for j in range(flow.shape[1]) if j != i]:
            if flow[i, j]:
                at += int(flow[i, j])
                cuts.setdefault(i, []).append((at, j))
    starts, split, counts, at = [], [], {}, [0] * old_shards
    for s, b, k, size, n in blocks:
        home = next(j for upto, j in cuts[s] if at[s] < upto)
        starts.append((s, b, k, at[s], home))
        if next(j for upto, j in cuts[s] if at[s] + size <= upto) != home:
            split.append(starts[-1])
        else:
            counts[home, s, b, k] = n
        at[s] += size
    if split:
        # only blocks on a boundary need their documents counted
        parts = _placed(rows, _starts_frame(spark, split), cuts)
        for r in parts.groupBy(P + "shard", *keys).count().collect():
            counts[tuple(r)[:4]] = r[4]
    firsts, seen = [], {}
    for key in sorted(counts):
        firsts.append((*key, seen.get(key[0], 0)))
        seen[key[0]] = seen.get(key[0], 0) + counts[key]
    return Plan(flow, starts, cuts, firsts, heavy)


def assign(docs: DataFrame, old_shard: Column, plan: Plan) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` (gapless from 0 in each shard) and
    ``size``, laid out by shard."""
    spark = docs.sparkSession
    out = [c for c in docs.columns if c not in ("shard", "slot", "size")]
    keys = [P + k for k in KEYS]
    rows = _placed(_salted(_keyed(docs, old_shard), plan.heavy), _starts_frame(spark, plan.starts), plan.cuts)
    firsts = spark.createDataFrame(plan.firsts, f"{P}shard int, " + ", ".join(f"{k} int" for k in keys)
                                   + f", {P}first long")
    rank = F.row_number().over(Window.partitionBy(P + "home", *keys, P + "shard").orderBy(P + "at", P + "th", "doc_id"))
    rows = rows.withColumn(P + "rank", rank).join(F.broadcast(firsts), [P + "shard", *keys])
    return rows.select(*out, F.col(P + "size").alias("size"), (F.col(P + "first") + F.col(P + "rank") - 1)
                       .alias("slot"), F.col(P + "shard").alias("shard"))


def rewrite(docs: DataFrame, old_shard: Column, plan: Plan, path: str) -> DataFrame:
    """Write the new files, ``path/shard=N``, of the shards that documents
    enter or leave; others keep their files.  Returns the written rows."""
    touched = plan.touched
    rows = assign(docs, old_shard, plan).filter(F.col("shard").isin(touched) if touched else F.lit(False))
    rows.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)
