import random
import zlib
from collections import defaultdict

from helpers import DIR, DOC, docs
from pyspark.sql import functions as F

from tidewell.llm import queries, reshard as R


def brute_min_moved(old, cap):
    """A byte stays unless its shard holds more than its new capacity."""
    return sum(max(0, s - (cap[i] if i < len(cap) else 0)) for i, s in enumerate(old))


def test_flow_is_least_cost_and_feasible():
    rnd = random.Random(2)
    for _ in range(60):
        n, m = rnd.randint(1, 7), rnd.randint(1, 7)
        old = [rnd.choice([0, rnd.randint(0, 400)]) for _ in range(n)]
        cap = R.even_capacity(sum(old), m) if rnd.random() < .5 else [rnd.randint(0, 300) for _ in range(m)]
        cap[-1] += max(0, sum(old) - sum(cap))
        f = R.min_cost_transfers(old, cap)
        assert (f >= 0).all() and list(f.sum(1)) == old and (f.sum(0) <= cap).all()
        assert f.sum() - sum(f[i, i] for i in range(min(n, m))) == brute_min_moved(old, cap)


def check(rows, shards, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.slot, r.size))
    total = sum(r.size for r in rows)
    for s in range(shards):
        got = sorted(by.get(s, []))
        assert [x for x, _ in got] == list(range(len(got)))
        assert abs(sum(z for _, z in got) - total / shards) <= slack


def test_hot_text_nulls_and_repeats(spark, tmp_path):
    rnd = random.Random(4)
    texts = ["copy of one text " * 3] * 300 + [None, "", "é"] + ["t" * rnd.randint(1, 90) + str(i) for i in range(500)]
    ids = [*range(800), 5, None, None]
    df = docs(spark, texts, ids).withColumn("shard", F.lit("x")).withColumn("block", F.lit(1))
    df = df.unionByName(df.filter("doc_id = 7"))
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(4))
    plan = R.plan(df, old, 4, new_shards=6)
    out = R.rewrite(df, old, plan, str(tmp_path / "new"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "block", "size", "slot", "shard"]
    rows = out.collect()
    assert len(rows) == 804
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, (
        (r.doc_id, r.text) for r in df.collect())))
    check(rows, 6, 400)
    groups = defaultdict(set)
    for r in rows:
        groups[r.text or ""].add(r.shard)
    hot = groups.pop("copy of one text " * 3)
    assert len(hot) > 1 and all(len(s) == 1 for s in groups.values()) and len(plan.heavy) == 1
    stays = sum(r.size for r in R.assign(df, old, plan).withColumn("old", old).filter("old = shard").collect())
    total = sum(r.size for r in rows)
    assert total - stays <= plan.moved_bytes + 400


def test_untouched_shards_keep_their_files(spark, tmp_path):
    df = docs(spark, ["x" * 12] * 30)
    old = F.pmod("doc_id", F.lit(3))
    plan = R.plan(df, old, 3, capacity=[100, 200, 400])
    assert plan.touched == [0, 2]
    out = R.rewrite(df, old, plan, str(tmp_path / "new")).collect()
    assert {r.shard for r in out} == {0, 2} and len(out) == 20


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], DOC)
    plan = R.plan(df, F.lit(0), 2, new_shards=3)
    assert R.rewrite(df, F.lit(0), plan, str(tmp_path / "none")).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_resharding"](spark, DIR).collect()
    assert len(rows) == len(texts) and {r.doc_id for r in rows} == set(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
        assert r.law == "bytes" and r.grown_shard is None
    check(rows, 24, 2 * max(r.size for r in rows))
    # equal texts lie together, but for those of more than a sixteenth of a shard
    groups = defaultdict(list)
    for r in rows:
        groups[texts[r.doc_id]].append(r)
    heavy = sum(r.size for r in rows) / 24 / R.HEAVY
    light = [g for g in groups.values() if len(g) > 1 and sum(r.size for r in g) <= heavy]
    assert len(light) > 20 and all(len({r.shard for r in g}) == 1 for g in light)
