"""Exact repeated substrings by difference-cover suffix comparison.

Every byte covered by a ``length``-byte string that also starts elsewhere
(in any document, the same included) is removed.  Suffixes are compared on
their first ``length`` bytes only, and never all at once:

1. Prune.  Each text is sampled by content: the least-hashed 100-gram of every
   240 consecutive ones.  A window of ``length`` bytes holds whole spans, and
   equal windows have equal samples in them; so starts over a span whose
   sample occurs once are out, without loss.  Only texts with remaining starts
   go on.
2. Cover.  Positions p with p mod v in a perfect difference set D (v = q^2 +
   q + 1) are the cover sample.  For any two suffixes there is a common shift
   below v at which both are in the sample, so the suffixes of two equal
   stretches meet in the sample every v bytes.  The rank of a sample position
   is the class of its length + v bytes; where a rank is shared, the next
   v + 1 starts are repeated: long ties are settled by the precomputed ranks,
   at |D| / v of the suffixes.  One owner of each shared rank stands for it.
3. Blocks.  Starts that no rank settles (near the ends of a stretch), and
   those of the owners, are dealt into suffix buckets by the hash of their
   ``length`` bytes; a task sorts one bucket at a time and finds the equal
   neighbours.

Texts with starts left are held in blocks of BLOCK_BYTES.  A block sends each
distinct suffix once, with a mark if it has it twice, so a passage in a third
of all documents is no large group; the number of buckets follows the number
of suffixes, so a bucket has about BUCKET_ROWS.  Equal texts go through once
and count as often as they occur.

Strings are compared by 96-bit hashes (64-bit polynomial of the whole string,
32-bit second).  The first step's 64-bit hashes can only let more through.

Defined cases: null text is empty.  Rows sharing a doc_id, and repeated rows,
are separate documents: a repeated row of ``length`` bytes or more is removed
whole.  A cut may fall inside a character; ``kept`` is binary for that reason.
Extra columns pass through ``remove_repeats``; ``kept``, ``n_bytes``,
``n_removed`` and ``n_spans`` replace input columns of that name.  Empty
tables give empty results.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, shuffle_partitions, stage, stage_path, text_or_empty
from tidewell.session import ship_package, sql_conf

LENGTH = 400
GRAM, SPAN = 100, 240     # GRAM + SPAN - 1 must not exceed the length
ORDER = 7                 # prime; the cover has ORDER + 1 of ORDER^2 + ORDER + 1 positions

BLOCK_BYTES = 2 << 20
BUCKET_ROWS = 1 << 19

_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def difference_cover(q: int) -> tuple[np.ndarray, int]:
    """A perfect difference set modulo q^2 + q + 1 (Singer): the exponents at
    which the powers of a suitable x in GF(q)[x] / cubic have no x^2 term."""
    v = q * q + q + 1
    for c2 in range(q):
        for c1 in range(q):
            for c0 in range(1, q):
                power, found = (1, 0, 0), []
                for e in range(v):
                    if power[2] == 0:
                        found.append(e)
                    a, b, c = power
                    power = (c * c0 % q, (a + c * c1) % q, (b + c * c2) % q)
                if len(found) == q + 1 and len({(a - b) % v for a in found for b in found}) == v:
                    return np.array(found), v
    raise ValueError("the order must be prime")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to n."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, 1 << 16)
        base = _BASES[which]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        _powers[which] = tuple(np.r_[np.uint64(1), np.multiply.accumulate(np.full(size - 1, b, np.uint64))]
                               for b in (base, inverse))
    return _powers[which]


class Prefix:
    """Hashes of any substring from prefix sums."""

    def __init__(self, s: np.ndarray, which: int = 0):
        up, self.down = _tables(which, len(s))
        self.sums = np.zeros(len(s) + 1, np.uint64)
        np.cumsum((s.astype(np.uint64) + np.uint64(1)) * up[:len(s)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.sums[starts + length] - self.sums[starts]) * self.down[starts])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - w + 1], before[w - 1:n])


def _span_minima(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every gram, least hash of every span)."""
    h = Prefix(s).all(GRAM)
    return (h, _sliding_min(h, SPAN)) if len(h) >= SPAN else (h[:0], h[:0])


def content_samples(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the grams that are least in some span."""
    h, least = _span_minima(s)
    if not len(h):
        return np.empty(0, np.int64), h
    edge = np.full(SPAN - 1, np.iinfo(np.uint64).max, np.uint64)
    # the greatest minimum over the spans that hold a gram equals its hash where it is selected
    at = np.flatnonzero(~_sliding_min(np.r_[edge, ~least, edge], SPAN) == h)
    return at, h[at]


def surviving_starts(s: np.ndarray, repeated: np.ndarray, length: int) -> np.ndarray:
    """Mask of the starts whose window holds no span with a single sample.
    repeated: hashes of the text's repeated samples."""
    n = len(s) - length + 1
    _, least = _span_minima(s)
    # spans of one minimum lie together
    first = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
    end = np.r_[first[1:], len(least)]
    single = ~np.isin(least[first], repeated)
    edge = np.zeros(n + 1, np.int64)
    lo, hi = np.maximum(first[single] - (length - GRAM - SPAN + 1), 0), np.minimum(end[single], n)
    ok = lo < hi
    np.add.at(edge, lo[ok], 1)
    np.add.at(edge, hi[ok], -1)
    return np.cumsum(edge[:-1]) == 0


def runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) of the true stretches."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edge.reshape(-1, 2)


def spread(starts: np.ndarray, reach: int, n: int) -> np.ndarray:
    """Mask of n places covered by [start, start + reach)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + reach, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _bytes(text) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), np.uint8) if text.as_buffer() else np.empty(0, np.uint8)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by their text: x and c identify it, n is its bytes."""
    text = text_or_empty(docs)
    return docs.withColumns({P + "text": text, P + "x": F.xxhash64(text), P + "c": F.crc32(text),
                             P + "n": F.octet_length(text).cast("long")})


def _samples(rows: DataFrame) -> DataFrame:
    """(x, c, h, many): the distinct content samples of every text, and
    whether it has one several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [np.unique(content_samples(_bytes(t))[1], return_counts=True) for t in part.column(2)]
                size = [len(h) for h, _ in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(part.column(0).to_numpy(), size)), pa.array(np.repeat(part.column(1).to_numpy(), size)),
                    pa.array(np.concatenate([h for h, _ in found]).view(np.int64)),
                    pa.array(np.concatenate([n for _, n in found]) > 1)], ["x", "c", "h", "many"])

    return rows.select("x", "c", "text").mapInArrow(run, "x long, c long, h long, many boolean")


# a block: texts with starts left (distinct texts), their keys and those starts as runs
BLOCK = "block long, x array<long>, c array<long>, text array<string>, runs array<array<long>>, starts long"


def _blocks(rows: DataFrame, length: int) -> DataFrame:
    """From (x, c, text, hs): texts that have starts left, in blocks."""
    def pack(held: list) -> pa.RecordBatch:
        x, c, text, left, n = (list(v) for v in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0]], pa.int64()), pa.array([x], pa.list_(pa.int64())), pa.array([c], pa.list_(pa.int64())),
             pa.array([text], pa.list_(pa.string())), pa.array([left], pa.list_(pa.list_(pa.int64()))),
             pa.array([sum(n)], pa.int64())], ["block", "x", "c", "text", "runs", "starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for x, c, t, hs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                   batch.column(3)):
                s = _bytes(t)
                left = surviving_starts(s, hs.values.to_numpy().view(np.uint64), length)
                if left.any():
                    held.append((x, c, t.as_py(), runs(left).ravel().tolist(), int(left.sum())))
                    size += len(s)
                    if size >= BLOCK_BYTES:
                        yield pack(held)
                        held, size = [], 0
        if held:
            yield pack(held)

    return rows.mapInArrow(run, BLOCK)


class Suffixes:
    """The distinct (h, g) of a block, sorted, and which of them is where."""

    def __init__(self, h: np.ndarray, g: np.ndarray, buckets: int):
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        self.h, self.g = h[new], g[new]
        self.which = np.empty(len(h), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.twice = np.bincount(self.which, minlength=len(self.h)) > 1
        # buckets are ranges of the sorted hashes
        bounds = [min((1 << 64) - 1, (k << 64) // buckets) for k in range(1, buckets)]
        self.cuts = np.r_[0, np.searchsorted(self.h, np.array(bounds, np.uint64)), len(self.h)].astype(np.int64)

    def rows(self, block: int) -> pa.RecordBatch:
        parts = [(k, a, b) for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])) if a < b]
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([block] * len(parts), pa.int64())]
            + [pa.array([v[a:b].tobytes() for _, a, b in parts], pa.binary()) for v in (self.h, self.g, self.twice)],
            ["bucket", "block", "h", "g", "twice"])

    def marks(self, found: list[dict]) -> np.ndarray:
        """What the buckets say of each occurrence: 0 single, 1 repeated, 2 repeated and owner."""
        out = np.zeros(len(self.h), np.uint8)
        for f in found or []:
            k = f["bucket"]
            out[self.cuts[k]:self.cuts[k + 1]] = np.frombuffer(f["mark"], np.uint8)
        return out[self.which]


def sort_bucket(table: pa.Table) -> pa.Table:
    """One suffix bucket: sort, compare neighbours, mark each block's suffixes."""
    h = [np.frombuffer(b, "<u8") for b in table["h"].to_pylist()]
    g = [np.frombuffer(b, "<u4") for b in table["g"].to_pylist()]
    twice = [np.frombuffer(b, bool) for b in table["twice"].to_pylist()]
    size = [len(x) for x in h]
    h, g, twice = np.concatenate(h), np.concatenate(g), np.concatenate(twice)
    order = np.lexsort((g, h))
    same = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
    first = np.r_[True, ~same]
    many = twice[order]
    many[1:] |= same
    many[:-1] |= same
    # a mark of one occurrence holds for its whole class
    group = np.cumsum(first) - 1
    many = np.bitwise_or.reduceat(many, np.flatnonzero(first))[group]
    mark = np.zeros(len(h), np.uint8)
    mark[order] = many.astype(np.uint8) + (many & first)
    ends = np.cumsum(size)
    return pa.table({"block": table["block"], "bucket": table["bucket"],
                     "mark": pa.array([mark[e - n:e].tobytes() for e, n in zip(ends, size)], pa.binary())})


def _sorted(rows: DataFrame, name: str) -> DataFrame:
    """(block, name): per block the marks of its suffixes, bucket by bucket."""
    marks = rows.groupBy("bucket").applyInArrow(sort_bucket, "block long, bucket int, mark binary")
    return stage(marks, name).groupBy("block").agg(F.collect_list(F.struct("bucket", "mark")).alias(name))


class _Text:
    """A text of a block: bytes, starts left, and what is known of them."""

    def __init__(self, text, left: list[int], length: int, v: int, member: np.ndarray):
        self.s, self.length, self.v = _bytes(text), length, v
        self.left = np.zeros(len(self.s) - length + 1, bool)
        for a, b in zip(left[::2], left[1::2]):
            self.left[a:b] = True
        at = [np.arange(a, b - v) for a, b in zip(left[::2], left[1::2]) if b - a > v]
        at = np.concatenate(at) if at else np.empty(0, np.int64)
        self.cover = at[member[at % v]]
        self.prefix, self.second = Prefix(self.s), Prefix(self.s, 1)

    def hashes(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        return self.prefix.at(at, length), (self.second.at(at, length) >> np.uint64(32)).astype(np.uint32)


def _suffixes(texts: list[_Text], places: list[np.ndarray], length: int, buckets: int) -> Suffixes:
    pairs = [t.hashes(at, length) for t, at in zip(texts, places)]
    return Suffixes(np.concatenate([h for h, _ in pairs]), np.concatenate([g for _, g in pairs]), buckets)


class _Block:
    """Both sorting rounds of a block; each is worked out anew from the text."""

    def __init__(self, row: dict, text_scalars, length: int, v: int, member: np.ndarray, n_ranks: int, n_starts: int):
        self.texts = [_Text(t, r, length, v, member) for t, r in zip(text_scalars, row["runs"])]
        self.length, self.v, self.n_ranks, self.n_starts = length, v, n_ranks, n_starts

    def ranks(self) -> Suffixes:
        return _suffixes(self.texts, [t.cover for t in self.texts], self.length + self.v, self.n_ranks)

    def settle(self, found: list[dict]) -> None:
        """Settled starts of each text, and the starts to be sorted."""
        mark = self.ranks().marks(found)
        self.settled, self.open, k = [], [], 0
        for t in self.texts:
            own = mark[k:k + len(t.cover)]
            k += len(t.cover)
            n = len(t.left)
            done = spread(t.cover[own > 0], self.v + 1, n)
            self.settled.append(done)
            self.open.append(np.flatnonzero((t.left & ~done) | spread(t.cover[own == 2], self.v + 1, n)))

    def starts(self) -> Suffixes:
        return _suffixes(self.texts, self.open, self.length, self.n_starts)

    def spans(self, found: list[dict]) -> list[list[int]]:
        mark = self.starts().marks(found) > 0
        out, k = [], 0
        for t, done, at in zip(self.texts, self.settled, self.open):
            done[at[mark[k:k + len(at)]]] = True
            k += len(at)
            out.append(runs(spread(np.flatnonzero(done), self.length, len(t.s))).ravel().tolist())
        return out


def _per_block(frame: DataFrame, schema: str, work: Callable[[dict, list], Iterator[pa.RecordBatch] | pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.schema.get_field_index("text")
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                row = {n: one.column(i)[0].as_py() for i, n in enumerate(batch.schema.names) if i != texts}
                yield work(row, list(one.column(texts)[0].values))

    return frame.mapInArrow(run, schema)


def _kept_digest(s: np.ndarray, spans: list[int]) -> str:
    digest, at = hashlib.sha256(), 0
    for a, b in zip(spans[::2], spans[1::2]):
        digest.update(s[at:a])
        at = b
    digest.update(s[at:])
    return digest.hexdigest()


SPANS = "x long, c long, spans array<long>, kept_sha256 string"
ROWS = "bucket int, block long, h binary, g binary, twice binary"


def repeated_spans(docs: DataFrame, length: int = LENGTH, order: int = ORDER) -> DataFrame:
    """(x, c, spans, kept_sha256) per distinct text that loses bytes: sorted
    starts and ends of its maximal removed runs, alternating, and the digest
    of what stays.  x is the text's xxhash64, c its CRC-32."""
    spark = docs.sparkSession
    ship_package(spark)
    cover, v = difference_cover(order)
    if length < GRAM + SPAN - 1:
        raise ValueError("the length must hold a whole sampling span")
    rows = _keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(P + "x").alias("x"),
                               F.col(P + "c").alias("c"), F.col(P + "n").alias("n"), F.col(P + "text").alias("text"))
    rows = rows.filter(F.col("n") >= length)
    member = np.zeros(v, bool)
    member[cover] = True
    with sql_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        classes = stage(rows.groupBy("x", "c", "n").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies")),
                        "texts")
        samples = stage(_samples(rows), "content-samples")
        # a stored table joined on its own: a join may then split a frequent sample's rows
        place = F.xxhash64("x", "c")
        again = stage(samples.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("many").alias("many"))
                      .filter("many or lo < hi").select("h"), "repeated-samples")
        seen = samples.join(again, "h", "left_semi").groupBy("x", "c").agg(F.collect_set("h").alias("hs"))
        seen = seen.join(classes.select("x", "c", "doc"), ["x", "c"]).withColumnsRenamed({"x": "rx", "c": "rc"})
        # one row of each distinct text
        one = rows.join(seen, rows["doc_id"].eqNullSafe(seen["doc"]) & (rows["x"] == seen["rx"])
                        & (rows["c"] == seen["rc"])).dropDuplicates(["x", "c"])
        name = _stored(_blocks(one.select("x", "c", "text", "hs"), length))
        blocks = spark.table(name)
    total = blocks.agg(F.sum("starts")).first()[0] or 0
    n_ranks = 1 + total * len(cover) // v // BUCKET_ROWS
    n_starts = 1 + total // 2 // BUCKET_ROWS

    def block(row, texts):
        return _Block(row, texts, length, v, member, n_ranks, n_starts)

    def rank_rows(row, texts):
        return block(row, texts).ranks().rows(row["block"])

    def start_rows(row, texts):
        b = block(row, texts)
        b.settle(row["ranks"])
        return b.starts().rows(row["block"])

    def span_rows(row, texts):
        b = block(row, texts)
        b.settle(row["ranks"])
        spans = b.spans(row["found"])
        return pa.RecordBatch.from_arrays(
            [pa.array(row["x"], pa.int64()), pa.array(row["c"], pa.int64()), pa.array(spans, pa.list_(pa.int64())),
             pa.array([_kept_digest(t.s, r) for t, r in zip(b.texts, spans)])], ["x", "c", "spans", "kept_sha256"])

    with sql_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        ranks = _sorted(_per_block(blocks, ROWS, rank_rows), "ranks")
        ranked = blocks.join(ranks, "block", "left")
        found = _sorted(_per_block(ranked, ROWS, start_rows), "found")
        cut = stage(_per_block(ranked.join(found, "block", "left"), SPANS, span_rows)
                    .filter(F.size("spans") > 0), "cut")
    spark.sql(f"DROP TABLE {name}")        # the catalog entry; files stay with the checkpoint folder
    whole = classes.filter("copies > 1").select(
        "x", "c", F.array(F.lit(0).cast("long"), F.col("n")).alias("spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    rest = cut.join(whole, ["x", "c"], "left_anti")
    return rest.unionByName(whole)


def _stored(blocks: DataFrame) -> str:
    """Name of a table of blocks bucketed by id: later joins bring the marks to them, not them to the marks."""
    spark = blocks.sparkSession
    name = f"tidewell_blocks_{uuid.uuid4().hex}"
    n = shuffle_partitions(spark)
    (blocks.repartition(n, "block").write.bucketBy(n, "block").option("path", stage_path(spark, "blocks"))
           .format("parquet").saveAsTable(name))
    return name


def span_bytes(spans: Column) -> Column:
    """Bytes inside spans (null: none)."""
    index = F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1)
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, F.aggregate(index, F.lit(0).cast("long"), lambda a, i: a + F.get(
        spans, 2 * i + 1) - F.get(spans, 2 * i))).otherwise(F.lit(0).cast("long"))


def span_count(spans: Column) -> Column:
    return F.when(spans.isNull(), 0).otherwise(F.size(spans) / 2).cast("long")


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    spans = spans.select(*[F.col(c).alias(P + "s_" + c) for c in spans.columns])
    return rows.join(spans, (F.col(P + "x") == F.col(P + "s_x")) & (F.col(P + "c") == F.col(P + "s_c")), "left")


def repeat_report(docs: DataFrame, length: int = LENGTH, order: int = ORDER) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``;
    the texts themselves are not shuffled for it."""
    spans = repeated_spans(docs, length, order)
    rows = _keyed(docs).select("doc_id", P + "x", P + "c", P + "n", F.sha2(P + "text", 256).alias(P + "sha"))
    cut = F.col(P + "s_spans")
    return _with_spans(rows, spans).select(
        "doc_id", F.col(P + "n").alias("n_bytes"), span_bytes(cut).alias("n_removed"), span_count(cut).alias("n_spans"),
        F.coalesce(P + "s_kept_sha256", P + "sha").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, order: int = ORDER) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), ``n_bytes``,
    ``n_removed`` and ``n_spans``."""
    both = _with_spans(_keyed(docs), repeated_spans(docs, length, order))
    raw, spans = F.col(P + "text").cast("binary"), F.col(P + "s_spans")
    # what stays: from the end of a run to the start of the next
    edges = F.concat(F.array(F.lit(0).cast("long")), spans, F.array(F.col(P + "n")))
    stay = F.transform(F.sequence(F.lit(0), span_count(spans).cast("int")), lambda i: F.substring(
        raw, (F.get(edges, 2 * i) + 1).cast("int"), (F.get(edges, 2 * i + 1) - F.get(edges, 2 * i)).cast("int")))
    kept = F.when(spans.isNull(), raw).otherwise(F.aggregate(stay, F.lit(b""), lambda a, b: F.concat(a, b)))
    new = {"kept": kept, "n_bytes": F.col(P + "n"), "n_removed": span_bytes(spans), "n_spans": span_count(spans)}
    return both.select(*[c for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])
