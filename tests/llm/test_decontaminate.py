import random
import re

from helpers import DIR, DOC, docs, duck, same

from tidewell.llm import decontaminate as D
from tidewell.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ws(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items, window):
    w = ws(text)
    hit, ids = set(), set()
    for i, t in items:
        v = ws(t)
        m = min(len(v), window)
        for a in range(len(v) - m + 1 if m else 0):
            for b in range(len(w) - m + 1):
                if w[b:b + m] == v[a:a + m]:
                    hit |= set(range(b, b + m))
                    ids.add(str(i))
    return len(w), len(hit), sorted(ids)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    rnd = random.Random(7)
    pool = ["a", "B", "c1", "É", "x-y", "d", "9", "été"]
    say = lambda n: rnd.choice(["", " ", ".."]).join([""]) + "".join(rnd.choice(pool) + rnd.choice([" ", ", ", "\n"]) for _ in range(n))
    for window in (4, 10):
        items = [(i, say(rnd.randint(0, 24))) for i in range(12)] + [(3, "twin of an item id"), (50, None), (51, ""), (52, "..."), (None, say(14))]
        texts = [None, "", "...", "a"] + [say(rnd.randint(1, 60)) for _ in range(30)]
        texts += [say(5) + "\n" + (t or "") + " tail " + say(4) for _, t in items if t]
        texts += [texts[-1]] * 3
        ids = [*range(len(texts) - 2), None, 3]
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.contamination(
            docs(spark, texts, ids), bench(spark, items), window).collect()), key=repr)
        want = []
        for i, t in zip(ids, texts):
            n, h, k = brute(t, [(i, x) for i, x in items if i is not None], window)
            n, h2, _ = brute(t, items, window)
            want.append((i, n, h2, k, h2 > 0))
        assert got == sorted(want, key=repr)


ITEM = "one two three four five six seven eight nine ten eleven"


def test_removing(spark):
    df = docs(spark, ["clean words here", f"Before; {ITEM.upper()}! after it.", None, "x " + ITEM]).withColumnRenamed("lang", "items")
    b = bench(spark, [(1, ITEM)])
    assert sorted(r.doc_id for r in D.decontaminate(df, b).collect()) == [0, 2]
    cut = {r.doc_id: r.text for r in D.decontaminate(df, b, "spans").collect()}
    assert cut == {0: "clean words here", 1: "Before; after it.", 2: None, 3: "x "}
    assert D.decontaminate(df, b, "spans").columns == df.columns


def test_large_benchmark_shuffles_and_empty(spark, monkeypatch):
    df = docs(spark, ["clean words here", "x " + ITEM])
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(r.doc_id for r in D.decontaminate(df, bench(spark, [(1, ITEM)])).collect()) == [0]
    assert D.contamination(df, bench(spark, [])).filter("n_words > 0 and not contaminated").count() == 2
    assert D.contamination(spark.createDataFrame([], DOC), bench(spark, [(1, ITEM)])).count() == 0


def test_no_python_in_the_plan(spark):
    df = docs(spark, ["a b c"])
    plan = D.contamination(df, bench(spark, [(1, ITEM)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_query_matches_sql(spark):
    same(queries.QUERIES["op6_decontamination"](spark, DIR), duck(queries.ORACLE["op6_decontamination"]))
