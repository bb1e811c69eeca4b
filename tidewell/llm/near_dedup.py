"""Near-duplicates by HyperMinHash.

A document's set is that of its distinct word shingles.  Its sketch has 256
buckets; each keeps the leading-zero count (6 bits) and 10 mantissa bits of
the smallest shingle hash that falls into it.  Then:

1. Documents with equal sets form one class; only classes go on.
2. Sketches, empty buckets filled from full ones, are cut into 42 bands of 6
   registers.  A class is paired with the least and the greatest class of
   each band bucket it is in (class ids are hashes, so these are random
   members): as many candidates as rows, whatever the size of a bucket.
3. Candidates of compatible size whose collision-corrected sketch estimate
   comes within 4.5 standard errors of the threshold are verified on the full
   sets; verified links give components.
4. Candidates that pass the estimate give families, wider than components.
   A leader that is unlike a member says nothing of the others in the bucket:
   where a bucket of four or more holds several families, its members outside
   the largest are compared with the whole bucket by the same estimate, block
   by block, and families that meet are joined.
5. Where a family has several components, its members outside the largest are
   compared with all of the family on full sets, block by block; only links
   that join two components come out.  So pairs that no bucket leader linked
   are found without listing pairs, and the work shrinks to the members left
   over.

At similarity 0.8 a pair shares no band with a chance of (1 - 0.8^6)^42, about
3 in a million.  Sets are held as 64-bit shingle hashes.

Defined cases: null, empty or wordless texts have an empty set and link with
nothing; fewer words than a shingle has are one shingle.  Rows sharing a
doc_id are judged each by its own text and carry the doc_id into their
components.  A row without doc_id takes the component of what it links with,
else null, and is kept in that case.  Extra columns pass through
``drop_near_copies``.  Empty tables give empty results.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, stage, text_hash, text_or_empty
from tidewell.llm.components import components
from tidewell.session import ship_package, sql_conf

BUCKETS = 256
MANTISSA = 10
BANDS, ROWS = 42, 6
PERCENT = 80
ERRORS = 4.5
BLOCK_SHINGLES = 1 << 18
BLOCK_SKETCHES = 1 << 12
CACHE_WORDS = 100_000
BATCH_ROWS = 500          # sets of long texts are large

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, w: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) > CACHE_WORDS:
            self.clear()
        self[w] = h
        return h


_words = _WordHashes()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()    # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    m = max(1, len(h) - width + 1)
    out = np.full(m, len(h[:width]), np.uint64)
    for k in range(min(width, len(h))):
        out = _mix(out * _K1 + h[k:k + m] + _K2)
    return np.unique(out)


def registers(s: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set; 0 marks an empty bucket."""
    bucket = (s >> np.uint64(56)).astype(np.int64)
    first = np.ones(len(s), bool)
    first[1:] = bucket[1:] != bucket[:-1]          # sorted: the first of a bucket is its least
    low = (s[first] & np.uint64((1 << 56) - 1)) | np.uint64(1)
    zeros = 55 - np.floor(np.log2(low.astype(np.float64))).astype(np.int64)
    zeros = np.clip(zeros, 0, 45)                  # leaves MANTISSA bits
    mantissa = (low >> (55 - MANTISSA - zeros).astype(np.uint64)).astype(np.int64) & ((1 << MANTISSA) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = ((zeros + 1) << MANTISSA) | mantissa
    return out


def _probes() -> np.ndarray:
    """For each bucket, a fixed random order in which it looks for a full one."""
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(BUCKETS) for _ in range(BUCKETS)])


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per sketch and band, empty buckets filled first."""
    probes = _probes()
    full = sketches.astype(np.uint64)
    todo = np.argwhere(sketches == 0)
    for k in range(BUCKETS):
        if not len(todo):
            break
        v = sketches[todo[:, 0], probes[todo[:, 1], k]]
        ok = v > 0
        # what a bucket borrows differs by bucket, as its own value would
        full[todo[ok, 0], todo[ok, 1]] = v[ok].astype(np.uint64) + (todo[ok, 1].astype(np.uint64) << np.uint64(20))
        todo = todo[~ok]
    order = np.random.default_rng(20240301).permutation(BUCKETS)[:BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.empty((len(sketches), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sketches), b + 1, np.uint64)
        for r in order[b]:
            key = _mix(key * _K1 + full[:, r])
        keys[:, b] = key
    return keys


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(collision-corrected Jaccard estimate, its standard error at the
    threshold) for rows of sketches and set sizes."""
    used = ((x > 0) | (y > 0)).sum(1)
    same = ((x == y) & (x > 0)).sum(1) / used
    # chance that two different minima of a bucket agree in their register
    a, b = nx / BUCKETS, ny / BUCKETS
    zeros = 2.0 ** -np.arange(0, 46)
    s = (a + b)[:, None]
    cells = zeros[None, :] / 2 / (1 << MANTISSA) * (np.exp(-s * zeros / 2) - np.exp(-s * zeros)) / s
    chance = np.minimum(0.5, a * b * cells.sum(1))
    t = PERCENT / 100
    return (same - chance) / (1 - chance), np.sqrt(t * (1 - t) / used)


def _similar(inter, nx, ny):
    return 100 * inter >= PERCENT * (nx + ny - inter)


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u8") for b in column.to_pylist()]


SIGNATURE = "doc_id long, th long, n long, k long, sketch binary"


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: n shingles, class id k (null without shingles) and sketch."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k, sketch = [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py(), width)
                n.append(len(s))
                if len(s):
                    mixed = _mix(s + np.uint64(len(s)))
                    k.append(int((mixed.sum() ^ np.bitwise_xor.reduce(_mix(mixed * _K1))).astype(np.int64)))
                    sketch.append(registers(s).astype("<u2").tobytes())
                else:
                    k.append(None)
                    sketch.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                 pa.array(sketch, pa.binary())], ["doc_id", "th", "n", "k", "sketch"])

    text = text_or_empty(docs)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_hash(text).alias("th"), text.alias("text"))
    return stage(src.mapInArrow(run, SIGNATURE), "signatures")


def _meetings(classes: DataFrame) -> DataFrame:
    """(band, k, lo, hi, many): each class in its band buckets of two or more,
    with the least and greatest class of the bucket and its size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sketches = np.stack([np.frombuffer(b, "<u2") for b in batch.column(1).to_pylist()])
                keys = band_keys(sketches).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(list(keys), pa.list_(pa.int64()))], ["k", "bands"])

    rows = classes.select("k", "sketch").mapInArrow(run, "k long, bands array<long>").select(
        "k", F.explode("bands").alias("band"))
    ends = rows.groupBy("band").agg(F.min("k").alias("lo"), F.max("k").alias("hi"),
                                    F.count("*").alias("many")).filter("lo < hi")
    return rows.join(ends, "band")


def _candidates(met: DataFrame) -> DataFrame:
    """(u, v): each class with the least and greatest of its band buckets."""
    pairs = met.select("k", F.explode(F.array("lo", "hi")).alias("o")).filter("k <> o")
    return pairs.select(F.greatest("k", "o").alias("u"), F.least("k", "o").alias("v")).distinct()


def _promising(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs of compatible size whose estimate allows the threshold."""
    x = near.select(F.col("k").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    y = near.select(F.col("k").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    both = pairs.join(x, "u").join(y, "v").filter(
        100 * F.least("nu", "nv") >= PERCENT * F.greatest("nu", "nv")).select("u", "v", "nu", "nv", "su", "sv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nx, ny = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
                x, y = (np.stack([np.frombuffer(b, "<u2") for b in batch.column(c).to_pylist()]) for c in (4, 5))
                j, error = estimate(x, y, nx, ny)
                ok = pa.array(j >= PERCENT / 100 - ERRORS * error)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def sketch_links(table: pa.Table) -> pa.Table:
    """Promising pairs that join two families within one block: rows with side
    0 (left over) against all rows with side 1; at most one less than the families."""
    side, k, f = (np.asarray(table[c]) for c in ("side", "k", "f"))
    n = np.asarray(table["n"]).astype(float)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    u_out, v_out = [], []
    if len(left) and len(right):
        sketches = np.stack([np.frombuffer(b, "<u2") for b in table["sketch"].to_pylist()])
        full = (sketches > 0).sum(1)
        f = np.unique(f, return_inverse=True)[1]
        t = PERCENT / 100
        for i in left:
            least, most = np.minimum(n[i], n[right]), np.maximum(n[i], n[right])
            other = right[(f[right] != f[i]) & (100 * least >= PERCENT * most)]
            if not len(other):
                continue
            # an upper bound of the estimate against a lower bound of what it is held to;
            # equal registers are summed as bytes of 64-bit words, at most 32 each
            equal = (sketches[other] == sketches[i]).view(np.uint64).sum(1).view(np.uint8).reshape(-1, 8).sum(1)
            other = other[equal / BUCKETS >= t - ERRORS * np.sqrt(t * (1 - t) / np.maximum(full[i], full[other]))]
            if not len(other):
                continue
            j, error = estimate(sketches[other], sketches[i][None], n[other], np.full(len(other), n[i]))
            for o in other[j >= t - ERRORS * error]:
                if f[o] != f[i]:
                    f[f == f[o]] = f[i]
                    u_out.append(k[i].item())
                    v_out.append(k[o].item())
    return pa.table({"u": pa.array(u_out, pa.int64()), "v": pa.array(v_out, pa.int64())})


def _bucket_links(met: DataFrame, near: DataFrame, family: DataFrame) -> DataFrame:
    """Promising pairs of two families that share a bucket but no leader:
    members outside a bucket's largest family against the whole bucket, in
    blocks of bounded size.  Up to three members, leaders have met all."""
    rows = met.filter("many > 3").select("band", "k").join(
        family.select(F.col("node").alias("k"), "root"), "k", "left").select("band", "k", F.coalesce("root", "k").alias("f"))
    rows = stage(rows, "buckets")
    top = rows.groupBy("band", "f").agg(F.count("*").alias("s")).groupBy("band").agg(
        F.max(F.struct("s", "f")).alias("top"), F.sum("s").alias("all")).filter("all > top.s").select(
        "band", F.col("top.f").alias("main"), F.ceil(F.col("all") / BLOCK_SKETCHES).cast("int").alias("wide"),
        F.ceil((F.col("all") - F.col("top.s")) / BLOCK_SKETCHES).cast("int").alias("tall"))
    return _in_blocks(rows.join(top, "band"), "band", "f", near.select("k", "n", "sketch"), sketch_links)


def _in_blocks(mixed: DataFrame, group: str, part: str, content: DataFrame, links) -> DataFrame:
    """``links`` of the rows of each group outside its main part with all of
    the group, dealt into tall x wide blocks."""
    own = lambda n: F.pmod(F.xxhash64("k"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = mixed.filter(F.col(part) != F.col("main")).withColumn("i", own(F.col("tall"))).withColumn("j", every(F.col("wide")))
    right = mixed.withColumn("j", own(F.col("wide"))).withColumn("i", every(F.col("tall")))
    cols = [group, "i", "j", "k", part]
    rows = left.select(*cols, F.lit(0).alias("side")).unionByName(right.select(*cols, F.lit(1).alias("side")))
    return rows.join(content, "k").groupBy(group, "i", "j").applyInArrow(links, "u long, v long")


def _full_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(k, n, words): the full set of each member class, from one document of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["k", "n", "words"])

    text = text_or_empty(docs)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_hash(text).alias("th"), text.alias("text"))
    one = members.select("k", F.col("one.doc_id").alias("d"), F.col("one.th").alias("t"))
    found = src.join(one, src["doc_id"].eqNullSafe(one["d"]) & (src["th"] == one["t"])).select("k", "text")
    return found.dropDuplicates(["k"]).mapInArrow(run, "k long, n long, words binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x = sets.select(F.col("k").alias("u"), F.col("words").alias("x"))
    y = sets.select(F.col("k").alias("v"), F.col("words").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ok = [_similar(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))
                      for a, b in zip(_sets(part.column(2)), _sets(part.column(3)))]
                ok = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(ok), part.column(1).filter(ok)], ["u", "v"])

    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def block_links(table: pa.Table) -> pa.Table:
    """Links between components within one block: rows with side 0 (left
    over) against all rows with side 1; at most one less than the components."""
    side = np.asarray(table["side"])
    k, c = np.asarray(table["k"]), np.asarray(table["c"])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    u_out, v_out = [], []
    if len(left) and len(right):
        sets = _sets(table["words"])
        flat = np.concatenate([sets[i] for i in right])
        sizes = np.array([len(sets[i]) for i in right])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        vocabulary, ids = np.unique(flat, return_inverse=True)
        mark = np.zeros(len(vocabulary), np.int32)
        root = {x: x for x in c.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in left:
            at = np.searchsorted(vocabulary, sets[i])
            at = at[at < len(vocabulary)]
            at = at[np.isin(vocabulary[at], sets[i], assume_unique=True)]
            mark[at] = 1
            inter = np.add.reduceat(mark[ids], starts)
            mark[at] = 0
            for j in np.flatnonzero(_similar(inter, len(sets[i]), sizes)):
                a, b = find(c[i].item()), find(c[right[j]].item())
                if a != b:
                    root[max(a, b)] = min(a, b)
                    u_out.append(k[i].item())
                    v_out.append(k[right[j]].item())
    return pa.table({"u": pa.array(u_out, pa.int64()), "v": pa.array(v_out, pa.int64())})


def _leftover_links(family: DataFrame, linked: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that leaders missed: members outside their family's largest
    component against the whole family, in blocks of bounded size."""
    family = family.withColumnRenamed("root", "f")
    comp = linked.select("node", F.col("root").alias("c"))
    nodes = family.join(comp, "node", "left").select(
        F.col("node").alias("k"), "f", F.coalesce("c", "node").alias("c"))
    nodes = stage(nodes.join(sets.select("k", "n"), "k"), "families")
    sizes = nodes.groupBy("f", "c").agg(F.sum("n").alias("s"))
    top = sizes.groupBy("f").agg(F.max(F.struct("s", "c")).alias("top"), F.sum("s").alias("all"),
                                 F.count("*").alias("many")).filter("many > 1").select(
        "f", F.col("top.c").alias("main"), F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("wide"),
        F.ceil((F.col("all") - F.col("top.s")) / BLOCK_SHINGLES).cast("int").alias("tall"))
    return _in_blocks(nodes.select("k", "f", "c").join(top, "f"), "f", "c", sets.select("k", "words"), block_links)


def near_components(docs: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, kept), one row per row of ``docs``."""
    with sql_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        rows = signatures(docs, width)
        classes = stage(rows.filter("k is not null").groupBy("k", "n").agg(
            F.min("doc_id").alias("doc"), F.min(F.struct("doc_id", "th")).alias("one"),
            F.first("sketch").alias("sketch")), "classes")
        met = stage(_meetings(classes), "meetings")
        pairs = stage(_candidates(met), "candidates")
        ends = pairs.select(F.explode(F.array("u", "v")).alias("k")).distinct()
        near = stage(classes.join(ends, "k"), "near")
        promising = stage(_promising(pairs, near), "promising")
        family = components(promising)
        wider = stage(_bucket_links(met, near, family), "wider")
        if not wider.isEmpty():
            promising = promising.unionByName(wider)
            family = components(family.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(wider))
        members = near.join(promising.select(F.explode(F.array("u", "v")).alias("k")).distinct(), "k")
        sets = stage(_full_sets(docs, members, width), "sets")
        links = stage(_verified(promising, sets), "links")
        linked = stage(components(links), "components")
        more = stage(_leftover_links(family, linked, sets), "links")
    # from the stars found so far, few rounds are left
    comp = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
    least = comp.join(classes.select(F.col("k").alias("node"), "doc"), "node").groupBy("root").agg(
        F.min("doc").alias("component_id"))
    linked = comp.join(least, "root").select(F.col("node").alias("k"), "component_id")
    # stored: the rows of a class with very many copies may then be split in the join
    ids = stage(classes.select("k", "doc").join(linked, "k", "left").select(
        "k", F.coalesce("component_id", "doc").alias("component_id")), "class-components")
    out = rows.select("doc_id", "th", "n", "k").join(ids, "k", "left")
    found = F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), found.alias("component_id"),
                      F.col("doc_id").eqNullSafe(found).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one document per component: that of the smallest doc_id
    (all rows of that doc_id)."""
    lost = near_components(docs, width).filter(~F.col("kept")).select(
        F.col("doc_id").alias(P + "doc"), F.col("th").alias(P + "t")).distinct()
    keyed = docs.withColumn(P + "th", text_hash(text_or_empty(docs)))
    return keyed.join(lost, keyed["doc_id"].eqNullSafe(lost[P + "doc"]) & (keyed[P + "th"] == lost[P + "t"]),
                      "left_anti").select(*docs.columns)
