import hashlib
import random
import zlib

import numpy as np
from helpers import DIR, DOC, docs
from pyspark.sql import functions as F

from tidewell.llm import periodic_runs as R
from tidewell.llm import queries


def brute(words, p=R.RunParams()):
    """Runs by comparing every word with that q places on, for every q."""
    n, found = len(words), {}
    for q in range(1, n // p.min_repeats + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(p.min_words, p.min_repeats * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rnd):
    letters, n = rnd.choice([1, 2, 2, 3, 5, 30]), rnd.choice([0, 1, 5, 6, 7, 20, 60, 150])
    w = [rnd.randrange(letters) for _ in range(n)]
    if n and rnd.random() < .6:
        a, q = rnd.randrange(n), rnd.randint(1, max(1, n // 4))
        w = (w[:a] + w[a:a + q] * rnd.randint(1, 12) + w[a:]) * rnd.choice([1, 1, 1, 4, 5])
    return np.array(w, np.int64)


def test_runs_against_brute_force(monkeypatch):
    rnd = random.Random(7)
    for round_ in range(60):
        # small slices too, so that periods and points are split
        monkeypatch.setattr(R, "GRID_POINTS", rnd.choice([7, 100, 1 << 20]))
        texts = [random_words(rnd) for _ in range(rnd.randint(1, 6))]
        assert R.find_runs(texts) == [brute(t.tolist()) for t in texts]
    p = R.RunParams(min_words=3, min_repeats=2)
    for _ in range(40):
        t = random_words(rnd)
        assert R.find_runs([t], p) == [brute(t.tolist(), p)]


def test_extensions_against_comparison():
    rnd = random.Random(3)
    for _ in range(30):
        t = np.r_[-1, random_words(rnd), -2]
        g = R.Grammar(t, np.zeros(len(t), np.int64))
        i, j = (np.array([rnd.randrange(len(t)) for _ in range(200)]) for _ in range(2))
        i, j = i[i != j], j[i != j]

        def agree(a, b, step):
            k = 0
            while 0 <= a + k * step < len(t) and 0 <= b + k * step < len(t) and t[a + k * step] == t[b + k * step]:
                k += 1
            return k

        assert g.extension(i, j).tolist() == [agree(a, b, 1) for a, b in zip(i, j)]
        assert g.extension(i, j, backwards=True).tolist() == [agree(a, b, -1) for a, b in zip(i, j)]


def test_long_texts():
    n = 300_000
    assert R.find_runs([np.zeros(n, np.int64)]) == [[(0, n, 1)]]
    w = np.arange(n) % 137
    w[n // 2] = 500
    assert R.find_runs([w]) == [[(0, n // 2, 137), (n // 2 + 1, n // 2 - 1, 137)]]


def test_documents(spark):
    texts = [None, "", " \n\t", "a b c", "x a a\na a a a y", "a b " * 4, "a b " * 3, "é ü " * 5 + "end", "z" * 300000,
             "no break " * 6, "a " * 6]
    df = docs(spark, texts, [1, 1, 2, 3, 4, 5, 6, 7, 8, None, 9]).withColumn("was", F.col("text"))
    got = {(r.doc_id, r.was): (r.n_words, [tuple(x) for x in r.runs], r.text) for r in R.periodic_runs(df).collect()}
    assert len(got) == len(texts)
    assert got[1, None] == got[1, ""] == (0, [], "")
    assert got[2, " \n\t"] == (0, [], "")
    assert got[4, texts[4]] == (8, [(1, 6, 1)], "x a y")
    assert got[5, texts[5]] == (8, [(0, 8, 2)], "a b") and got[6, texts[6]][1] == []
    assert got[7, texts[7]] == (11, [(0, 10, 2)], "é ü end")
    assert got[None, texts[9]] == (6, [(0, 6, 1)], "no break")
    assert got[8, texts[8]][2] == "z" * 300000


def test_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a a a a a a", "mine", 4)], "doc_id long, text string, runs string, start int")
    out = R.periodic_runs(df)
    assert out.columns == ["doc_id", "text", "start", "n_words", "runs"]
    assert R.periodic_runs(spark.createDataFrame([], DOC)).count() == 0


def test_query_against_brute_force(spark):
    want = []
    for r in spark.read.parquet(f"{DIR}/documents.parquet").collect():
        w = (r.text or "").encode().split()
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        codes = np.unique(w, return_inverse=True)[1].tolist() if w else []
        # the plain comparison, with periods that have no grid of equal words left out
        found = {}
        for q in range(1, n // 4 + 1):
            x = np.array(codes)
            same = np.r_[False, x[q:] == x[:-q], False].astype(np.int8)
            edge = np.flatnonzero(np.diff(same))
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if e - s + q >= max(6, 4 * q):
                    found.setdefault((s, e - s + q), q)
        runs = sorted(((s, m, q) for (s, m), q in found.items()), key=lambda t: (t[0], t[2]))
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda t: (-t[1], t[0], t[2])) if runs else (None, None, None)
        want.append((r.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    got = [tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, DIR).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[1] > 0 for r in got) > 20
