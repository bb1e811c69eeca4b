import random

import numpy as np
import pyarrow as pa
from helpers import DIR, DOC, docs, duck, same

from tidewell.llm import near_dedup as N
from tidewell.llm import queries
from tidewell.llm.components import components


def sets(t, width):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width):
    s = [sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids and s[i] else d
        out.append((d, len(s[i]), c, d == c))
    return sorted(out, key=repr)


def corpus(seed, n, width):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = [None, "", " \n", "one", "ONE", "one two", "two one", "É x", "é x"]
    for _ in range(n):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 8, 30, 120]))]
        out.append(" ".join(base))
        for _ in range(rnd.choice([0, 0, 1, 5, 25])):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // (8 * width)))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            out.append((" " if rnd.random() < .5 else "\n").join(copy).replace("w1", "W1"))
    rnd.shuffle(out)
    return out


def test_against_brute_force(spark):
    for seed, width in ((1, 2), (2, 5)):
        texts = corpus(seed, 40, width)
        ids = rnd_ids = list(range(100, 100 + len(texts)))
        rows = list(zip(rnd_ids, texts)) + [(100, "one two three"), (None, texts[20]), (None, "quite alone here now"), (101, texts[21])]
        ids = [d for d, _ in rows]
        got = N.near_components(docs(spark, [t for _, t in rows], ids).withColumnRenamed("lang", "k"), width).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == brute(rows, width)


def test_leftover_blocks_find_what_leaders_miss(spark, monkeypatch):
    """With small blocks and no verified leader links, all links come from the blocks."""
    texts = corpus(3, 12, 2)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(N, "_verified", lambda pairs, sets: pairs.limit(0))
    got = N.near_components(docs(spark, texts), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == brute(list(enumerate(texts)), 2)


def test_close_pairs_among_heavily_edited_copies(spark, monkeypatch):
    """Bucket leaders are unlike all others here: close pairs must meet without them."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(600)]
    fresh = (f"f{i}" for i in range(10**9))

    def edited(words, runs):
        out = list(words)
        for at in rnd.sample(range(0, len(out) // 10), runs):
            out[10 * at:10 * at + 10] = [next(fresh) for _ in range(10)]
        return out

    texts = [" ".join(edited(base, 9)) for _ in range(4000)]
    pairs = [(rnd.randrange(4000), 4000 + i) for i in range(20)]
    texts += [" ".join(edited(texts[a].split(), 3)) for a, _ in pairs]
    monkeypatch.setattr(N, "BLOCK_SKETCHES", 100)
    got = {r.doc_id: r.component_id for r in N.near_components(docs(spark, texts), 2).collect()}
    assert [got[b] for _, b in pairs] == [a for a, _ in pairs]
    assert all(got[i] == i for i in range(4000))


def test_estimate_is_corrected():
    rng = np.random.default_rng(1)
    for n, j in ((400, .8), (3000, .5), (20000, .9), (5000, 0.0)):
        common = int(n * 2 * j / (1 + j))
        a, b, c = (np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)) for k in (common, n - common, n - common))
        x, y = (N.registers(np.unique(np.concatenate([a, z]))) for z in (b, c))
        got, error = N.estimate(x[None], y[None], np.array([float(n)]), np.array([float(n)]))
        assert abs(got[0] - j) < 5 * error[0]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for x in near:
        seen, todo = {x}, [x]
        while todo:
            for z in near[todo.pop()] - seen:
                seen.add(z)
                todo.append(z)
        assert got[x] == min(seen)
    assert set(got) == set(near)


def test_block_links_empty_side():
    t = pa.table({"side": [1], "k": [1], "c": [1], "words": [b""]})
    assert N.block_links(t).num_rows == 0


def test_drop(spark):
    long = " ".join(f"w{i}" for i in range(60))
    df = docs(spark, [long, long + " end", long.upper(), None, "", "other words"], [5, 3, 9, 1, 2, 4]).withColumnRenamed("lang", "sketch")
    out = N.drop_near_copies(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 4]
    assert N.drop_near_copies(spark.createDataFrame([], DOC)).count() == 0


def test_query_matches_sql(spark):
    same(queries.QUERIES["op8_near_dedup"](spark, DIR), duck(queries.ORACLE["op8_near_dedup"]))
