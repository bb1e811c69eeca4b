import random
import re
import zlib

import numpy as np
import public_tokenizers
from helpers import DIR, DOC
from test_decontaminate import brute as hits
from test_line_dedup import brute as lines
from test_near_dedup import brute as near
from test_packing import check_sequences
from tokenizers import Tokenizer

import corpus_pipeline as cp


def tables(spark, path, rows, labels, items):
    spark.createDataFrame(rows, DOC).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_against_brute_force(spark, tmp_path):
    rnd = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmn" for b in ("ar", "el", "in", "os", "um", "ay")]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    item = say(14)
    rows = []
    for i in range(80):
        text = "\n".join(say(rnd.randint(12, 40)) for _ in range(rnd.randint(1, 4)))
        rows.append(text)
        if i % 8 == 0:
            rows.append(text.replace("bar", "car", 1))                      # near copy
        if i % 10 == 0:
            rows.append(say(15) + " " + item.upper() + " " + say(15))       # benchmark passage
        if i % 9 == 0:
            rows.append("A line that several share\n" + say(30))
    rows += [None, "", "short one", "ww " * 40, rows[0], say(20) + " a### b$$$"]
    rnd.shuffle(rows)
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(rows)]
    tables(spark, str(tmp_path), rows, [(0, 1, 0)], [(7, item), (8, None)])

    # too few labels to certify a cutoff: the base rules alone judge
    def base(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        wins = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        twice = {j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(k, k + 5)}
        return len(w) >= 10 and 100 * len(twice) <= 20 * len(w)

    want = [(d, t) for d, t, *_ in rows if base(t)]
    want = [(d, t) for d, t, _, _ in lines(want)]
    kept = {d for d, _, _, k in near(want, 5) if k}
    want = [(d, t) for d, t in want if d in kept]
    want = {d: t for d, t in want if hits(t, [(7, item)], 10)[1] == 0}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    step = docs
    for name, f in cp.STAGES[:-1]:
        step = f(spark, step, str(tmp_path))
        assert step.columns == docs.columns, name
    got = {r.doc_id: r.text for r in step.collect()}
    assert got == want and 0 < len(want) < len(rows)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = cp.run(spark, str(tmp_path)).collect()
    check_sequences(out, 4096)
    assert {r.doc_id: r.ids_crc32 for r in out} == {
        d: zlib.crc32(np.array(t.encode(x, add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, x in want.items()}


def test_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path), [], [], [])
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_given_documents(spark):
    out = cp.run(spark, DIR).collect()
    check_sequences(out, 4096)
    assert 400 < len({r.doc_id for r in out}) < 1000
