import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import DIR, DOC, docs
from tokenizers import Tokenizer

from tidewell.llm import packing, queries, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for got in by.values():
        at = 0
        for off, n in sorted(got):
            assert off == at
            at += n
        assert at <= capacity
    return len(by)


def brute_best_fit(lengths, cap):
    """Item by item: match the large ones, then best-fit the small ones."""
    large = sorted((x for x in lengths if 3 * x > cap), reverse=True)
    gaps = []
    while large:
        a = large.pop(0)
        fit = [x for x in large if a + x <= cap]
        if fit:
            large.remove(max(fit))
        gaps.append(cap - a - (max(fit) if fit else 0))
    for x in sorted((x for x in lengths if 3 * x <= cap), reverse=True):
        ok = [g for g in gaps if g >= x]
        if ok:
            gaps.remove(min(ok))
            gaps.append(min(ok) - x)
        else:
            gaps.append(cap - x)
    return len(gaps)


def test_plan_equals_item_by_item():
    rnd = random.Random(1)
    for _ in range(300):
        cap = rnd.choice([7, 12, 30, 100])
        lengths = [min(cap, max(1, int(rnd.expovariate(3 / cap)))) for _ in range(rnd.randint(0, 60))]
        runs, n = packing.plan_runs(Counter(lengths), cap)
        assert n == brute_best_fit(lengths, cap)
        got = Counter()
        seen = set()
        for s, r, k, first, off in runs:
            got[s] += k
            for i in range(k):
                cell = {(first + i, off + x) for x in range(s)}
                assert not cell & seen and off + s <= cap
                seen |= cell
        assert got == Counter(lengths)


def test_pack_rows(spark):
    rows = [(i, n, "x") for i, n in enumerate([5] * 40 + [10, 9, 1, 1, 2, 3] * 3)] + [(None, 4, "x"), (7, 0, "y"), (8, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, length int, offset string")
    out = packing.pack(df, 10).collect()
    assert len(out) == len(rows)
    assert check_sequences([r for r in out if r.length], 10) == brute_best_fit([r[1] for r in rows if r[1]], 10)
    assert all(r.sequence_id is None for r in out if not r.length)
    with pytest.raises(ValueError):
        packing.pack(df, 9)
    assert packing.pack(df.limit(0), 10).count() == 0


@pytest.mark.parametrize("part_rows, max_parts", [(50, 50_000), (7, 4), (500, 50_000), (10_000, 1)])
def test_hot_lengths_are_dealt_to_parts(spark, monkeypatch, part_rows, max_parts):
    monkeypatch.setattr(packing, "PART_ROWS", part_rows)
    monkeypatch.setattr(packing, "MAX_PARTS", max_parts)
    rnd = random.Random(9)
    lengths = [4] * 700 + [3] * 260 + [10] * 300 + [rnd.randint(1, 9) for _ in range(200)]
    rows = [(i % 400, n, {"a": i}) for i, n in enumerate(lengths)] + [(7, 4, {"a": 1})] * 120     # the same row again and again
    df = spark.createDataFrame(rows, "doc_id long, length int, extra map<string, int>")
    out = packing.pack(df.repartition(5), 10).collect()
    assert Counter(r.length for r in out) == Counter(r[1] for r in rows)
    assert check_sequences(out, 10) == brute_best_fit([r[1] for r in rows], 10)
    full = [r for r in out if r.length == 10]
    assert len({r.sequence_id for r in full}) == 300 and all(r.offset == 0 for r in full)
    # only full pieces: nothing to plan
    out = packing.pack(df.filter("length = 10"), 10).collect()
    assert len({r.sequence_id for r in out}) == len(out) == 300
    plan = packing.pack(df.filter("length = 10"), 10)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_ids_equal_the_tokenizer():
    t = Tokenizer.from_file(PATH)
    enc = tokens.Encoder(PATH)
    rnd = random.Random(3)
    pool = ["The", "the,", "don't", "it's.", "ÉCOLE.", "éreau,", "été,", "a1b2", "...", "***", "x$$$", "<|endoftext|>",
            "we'll!", "ß.", "ı", "İ,", " ", "a b", "a\x1cb.", "日本語。", "́x", "", "\n", "\t", "\r\n", "q" * 300, "l'd", "a.b", "'s", "ſ,", "Ⅷ."]
    texts = ["", " ", "\n"] + ["".join(rnd.choice(pool) + rnd.choice([" ", "\n", "  ", ""]) for _ in range(30)) for _ in range(300)]
    for a in range(0, len(texts), 50):
        for s, raw in zip(texts[a:a + 50], enc.batch(pa.array(texts[a:a + 50]))):
            assert np.frombuffer(raw, "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_documents_cases(spark):
    df = docs(spark, [None, "", "word " * 9000, "word", "word"], [3, None, 5, 5, 5]).withColumnRenamed("lang", "ids")
    out = packing.pack_documents(df, PATH, 4096).collect()
    assert sorted((r.length for r in out)) == [1, 1, 2, 2, 809, 4096, 4096]
    check_sequences(out, 4096)
    assert packing.pack_documents(spark.createDataFrame([], DOC), PATH).count() == 0


def test_query(spark):
    out = queries.QUERIES["op4_best_fit_packing"](spark, DIR).collect()
    t = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    want = {}
    for d, s in texts.items():
        ids = np.array(t.encode(s, add_special_tokens=False).ids + [1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            want[d, k] = (a, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want and len(out) == len(want)
    n = check_sequences(out, 4096)
    least = -(-sum(r.length for r in out) // 4096)
    assert n <= 1.02 * least + 1
