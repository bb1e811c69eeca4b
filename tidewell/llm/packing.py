"""Best-fit packing by large-item matching.

Pieces longer than a third of the capacity go at most two to a sequence:
greedy matching pairs the longest open one with the longest partner that
fits.  Shorter pieces then best-fit, longest first, into the smallest gap
that takes them; new sequences open only when no gap does.

Both steps work on the histogram of lengths, so what the driver plans is
bounded by the capacity, not by the number of documents.  The plan is a list
of runs (length, first rank, count, first sequence, offset): the piece of
that length with rank r goes to sequence first + (r - first rank).  Ranks are
counted on the cluster, in parts of a length; a part holds about PART_ROWS
pieces, or a MAX_PARTS-th of all where that is more, so a length that a third
of all pieces have is dealt to as many tasks as the cluster may have, and the
driver sees at most capacity + MAX_PARTS counts.  Pieces as long as the capacity need no rank: each is a sequence of
its own, numbered behind the planned ones.

Defined cases: rows of length 0 or null are returned with null sequence and
offset; a length beyond the capacity is an error.  Extra columns pass
through; ``sequence_id`` and ``offset`` replace input columns of that name.
An empty table gives an empty result.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from tidewell.llm.common import P, stage
from tidewell.session import ship_package

PART_ROWS = 500           # least size of a part: pieces of one length ranked in one group
MAX_PARTS = 50_000
RANK_BITS = 44            # ranks below 2^44 beside a length below 2^19


class _Plan:
    """Sequences as groups (first sequence, how many) by the gap they have."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.gaps: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = {}
        self.rank: dict[int, int] = {}
        self.runs: list[tuple[int, int, int, int, int]] = []

    def put(self, first: int, n: int, gap: int) -> None:
        if n and gap:
            if gap not in self.groups:
                self.groups[gap] = []
                insort(self.gaps, gap)
            self.groups[gap].append((first, n))

    def take(self, gap: int) -> tuple[int, int]:
        group = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap]
            self.gaps.pop(bisect_left(self.gaps, gap))
        return group

    def open(self, n: int) -> int:
        self.next += n
        return self.next - n

    def place(self, length: int, first: int, n: int, offset: int) -> None:
        r = self.rank.get(length, 0)
        self.runs.append((length, r, n, first, offset))
        self.rank[length] = r + n

    def match_large(self, counts: dict[int, int]) -> None:
        lengths = sorted(counts)
        left = dict(counts)
        for a in reversed(lengths):
            while left[a]:
                k = bisect_left(lengths, self.capacity - a + 1) - 1
                while k >= 0 and (not left[lengths[k]] or lengths[k] > a or (lengths[k] == a and left[a] < 2)):
                    k -= 1
                if k < 0:
                    n, left[a] = left[a], 0
                    first = self.open(n)
                    self.place(a, first, n, 0)
                    self.put(first, n, self.capacity - a)
                    continue
                b = lengths[k]
                n = left[a] // 2 if a == b else min(left[a], left[b])
                left[a] -= n
                left[b] -= n
                first = self.open(n)
                self.place(a, first, n, 0)
                self.place(b, first, n, a)
                self.put(first, n, self.capacity - a - b)

    def fit_small(self, length: int, n: int) -> None:
        while n:
            k = bisect_left(self.gaps, length)
            if k < len(self.gaps):
                gap = self.gaps[k]
                first, many = self.take(gap)
            else:
                gap = self.capacity
                many = -(-n // (gap // length))
                first = self.open(many)
            # best fit keeps filling the sequence it has just put a piece into
            each = gap // length
            full = min(many, n // each)
            offset = self.capacity - gap
            for c in range(each if full else 0):
                self.place(length, first, full, offset + c * length)
            n -= full * each
            self.put(first, full, gap - each * length)
            rest = many - full
            if rest and n and n < each:
                for c in range(n):
                    self.place(length, first + full, 1, offset + c * length)
                self.put(first + full, 1, gap - n * length)
                full, rest, n = full + 1, rest - 1, 0
            self.put(first + full, rest, gap)


def plan_runs(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs and the number of sequences for a histogram of lengths."""
    p = _Plan(capacity)
    p.match_large({s: n for s, n in counts.items() if 3 * s > capacity and n})
    for s in sorted((s for s, n in counts.items() if 3 * s <= capacity and n), reverse=True):
        p.fit_small(s, counts[s])
    return p.runs, p.next


def pack(pieces: DataFrame, capacity: int = 4096, key: str = "doc_id") -> DataFrame:
    """``pieces`` (stored, so that its rows stay as they are) with
    ``sequence_id`` and ``offset``.  The columns of a piece spread equal
    lengths over parts, ``key`` orders them there."""
    spark = pieces.sparkSession
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(*cols, F.coalesce(F.col("length").cast("long"), F.lit(0)).alias(P + "len"))
    totals = sorted(tuple(r) for r in rows.filter(F.col(P + "len") > 0).groupBy(P + "len").count().collect())
    if totals and totals[-1][0] > capacity:
        raise ValueError(f"a piece of {totals[-1][0]} exceeds the capacity of {capacity}")
    counts = {s: n for s, n in totals if s < capacity}              # fewer than the capacity
    runs, planned = plan_runs(counts, capacity)
    full = rows.filter(F.col(P + "len") == capacity).select(
        *cols, (F.lit(planned) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bare = rows.filter(F.col(P + "len") <= 0).select(
        *cols, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    if not runs:
        return full.unionByName(bare)
    size = max(PART_ROWS, -(-sum(counts.values()) // MAX_PARTS))
    hot = {s: -(-n // size) for s, n in counts.items() if n > size}
    # parts by length as one literal; null and so 1 beyond the last hot one
    parts = F.coalesce(F.get(F.split(F.lit(",".join(str(hot.get(s, 1)) for s in range(max(hot, default=0) + 1))), ",")
                             .cast("array<int>"), F.col(P + "len").cast("int")), F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols if not isinstance(pieces.schema[c].dataType, MapType)]), parts)
    rows = rows.filter((F.col(P + "len") > 0) & (F.col(P + "len") < capacity)).withColumn(P + "part", spread.cast("int"))
    cells = sorted(tuple(r) for r in rows.groupBy(P + "len", P + "part").count().collect())
    base = np.zeros(capacity + 1, np.int64)     # the first cell of a length
    first, ahead = [], {}
    for s, k, n in cells:
        if s not in ahead:
            base[s] = len(first)
            first += [0] * hot.get(s, 1)
        first[base[s] + k] = ahead.get(s, 0)
        ahead[s] = ahead.get(s, 0) + n
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 5)
    start = (table[:, 0] << RANK_BITS) + table[:, 1]
    # the plan is bounded by the capacity, the cells as above
    held = spark.sparkContext.broadcast((start, table, base, np.array(first, np.int64)))
    ship_package(spark)
    rank = F.row_number().over(Window.partitionBy(P + "len", P + "part").orderBy(key)) - 1
    rows = rows.withColumn(P + "rank", rank.cast("long"))
    types = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, table, base, first = held.value
        for batch in batches:
            n = len(cols)
            size = batch.column(n).to_numpy()
            r = batch.column(n + 2).to_numpy() + first[base[size] + batch.column(n + 1).to_numpy()]
            at = np.searchsorted(start, (size << RANK_BITS) + r, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)]
                + [pa.array(table[at, 3] + r - table[at, 1]), pa.array(table[at, 4])],
                [*cols, "sequence_id", "offset"])

    return rows.mapInArrow(run, schema).unionByName(full).unionByName(bare)


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int | None = 1) -> DataFrame:
    """Tokenize, cut and pack whole documents: (doc_id, piece, start, length,
    ids_crc32, sequence_id, offset).  The ids themselves come from
    ``tokens.token_pieces`` and need no shuffle."""
    from tidewell.llm.tokens import token_pieces
    pieces = token_pieces(docs, path, capacity, end_id)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(stage(digest, "pieces"), capacity)
