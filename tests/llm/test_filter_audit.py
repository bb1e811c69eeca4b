import random
import re
from itertools import permutations

import numpy as np
from helpers import DIR, DOC, duck, same

from tidewell.llm import filter_audit as A
from tidewell.llm import queries

LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * capitals > 2 * len(text), any(c in "#$%&*|" for c in text)]


def brute(rows, labels):
    """rows: (doc_id, text, part).  Applies the filters one after the other."""
    flags = []
    for i, t, part in rows:
        copy = any(i is not None and j is not None and j < i and (u or "") == (t or "") for j, u, _ in rows)
        mine = [x for x in labels if i is not None and x[0] == i]
        flags.append((part or "", fails(t or "") + [copy], any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, removed_by = [], {}
    for part in {f[0] for f in flags}:
        own = [f for f in flags if f[0] == part]
        for order in permutations(range(5)):
            left = own
            for step, k in enumerate(order):
                gone = [f for f in left if f[1][k]]
                left = [f for f in left if not f[1][k]]
                failing = [f for f in own if f[1][k]]
                removed_by[part, k] = removed_by.get((part, k), 0) + len(gone)
                out.append([part, "".join("ABCDE"[x] for x in order), step + 1, len(left), len(gone), len(failing) - len(gone),
                            sum(sum(f[1]) == 1 for f in failing), sum(f[2] for f in gone), sum(f[3] for f in gone), k])
    return sorted((*r[:-1], removed_by[r[0], r[-1]]) for r in out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "Bc", "é", "#x", "lorem", "ipsum", "dolor"]) + str(rnd.randrange(rnd.choice([3, 900])))
    texts = [None, "", " \n", "One", "x" * 100000] + [" ".join(word() for _ in range(rnd.choice([1, 30, 200, 260]))) for _ in range(30)]
    clean = " ".join(f"wort{k}é" for k in range(200))
    texts += [clean, clean, clean + " A", " ".join("ab" for _ in range(300)), clean + " " + "B" * 40, clean + "|"]
    rows = [(i, t, rnd.choice([None, "", "s1", "s2"])) for i, t in enumerate(texts)]
    rows += [(rnd.randrange(60), rnd.choice(texts), "s1") for _ in range(25)] + [(None, clean, "s2"), (None, clean, "s1"), (3, "One", "s1")]
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(50)]
    return rows, labels


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows, labels = corpus(seed)
        df = spark.createDataFrame([(i, t, "en", p, 0) for i, t, p in rows], DOC)
        assert got(A.audit(df, spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_transducer_batches():
    rnd = random.Random(5)
    tables = A.transducer("#$%&*|")
    for _ in range(40):
        texts = ["".join(rnd.choice("aB# \n\x0b\x1cé漢😀 ") for _ in range(rnd.choice([0, 0, 1, 5, 40]))) for _ in range(rnd.randint(1, 8))]
        raw = [t.encode() for t in texts]
        scan = A.Scan(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(b) for b in raw]), tables)
        words = [b.split() for b in raw]
        assert scan.n_words.tolist() == [len(w) for w in words]
        assert scan.distinct_words().tolist() == [len(set(w)) for w in words]
        assert scan.n_points.tolist() == [len(t) for t in texts]
        assert scan.n_capitals.tolist() == [t.count("B") for t in texts]
        assert scan.n_symbols.tolist() == [t.count("#") for t in texts]


def test_empty_missing_and_clashing_columns(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(spark.createDataFrame([], DOC), none).count() == 0
    df = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 6, "y")], "doc_id long, text string, n int, failed string")
    rows = A.audit(df, none).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.removed, r.redundant) for r in rows if r.filter_order[r.step - 1] == "E"} == {(1, 0), (0, 1)}


def test_query_matches_sql(spark):
    same(queries.QUERIES["op12_filter_audit"](spark, DIR), duck(queries.ORACLE["op12_filter_audit"]))
