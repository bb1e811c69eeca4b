import itertools
import random

import numpy as np
from helpers import DIR, DOC

from tidewell.llm import quality_classifier as C
from tidewell.llm import queries


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < .8
    accuracy = np.array([.95, .8, .7, .9])
    counts = {}
    for t in truth:
        key = "".join("-" if rng.random() < .2 else ("g" if (rng.random() < a) == t else "b") for a in accuracy)
        counts[key] = counts.get(key, 0) + 1
    model = C.fit_labellers(counts)
    assert np.abs(model.good - accuracy).max() < .03 and np.abs(model.bad - accuracy).max() < .04
    assert abs(model.prior - .8) < .02
    assert model.posterior("gggg") > .99 and model.posterior("bbbb") < .05 and model.posterior("") > .5


def test_em_equals_brute_force_bayes():
    """At convergence each posterior is Bayes' rule with chances counted from the posteriors."""
    counts = {"".join(k): n for k, n in zip(itertools.product("gb-", repeat=3), range(5, 200, 7))}
    model = C.fit_labellers(counts, rounds=20000)
    post = {k: model.posterior(k) for k in counts}
    prior = (sum(counts[k] * post[k] for k in counts) + 1) / (sum(counts.values()) + 2)
    for k in counts:
        g, b = prior, 1 - prior
        for i, c in enumerate(k):
            cast = [x for x in counts if x[i] != "-"]
            pg = (sum(counts[x] * post[x] for x in cast if x[i] == "g") + 1) / (sum(counts[x] * post[x] for x in cast) + 2)
            pb = (sum(counts[x] * (1 - post[x]) for x in cast if x[i] == "b") + 1) / (
                sum(counts[x] * (1 - post[x]) for x in cast) + 2)
            g *= pg if c == "g" else 1 - pg if c == "b" else 1
            b *= pb if c == "b" else 1 - pb if c == "g" else 1
        assert abs(post[k] - g / (g + b)) < 1e-4


def test_cases(spark):
    rnd = random.Random(1)
    prose = lambda: " ".join(rnd.choice("the of and to house green river walks over slowly many people said".split()) for _ in range(40)) + "."
    rows = [(i, prose() + "\n" + prose(), "old") for i in range(60)] + [
        (100, None, "old"), (101, "", "old"), (102, " \n", "old"), (5, " ".join("w###x %%% $$$" for _ in range(30)), "old"),
        (103, prose() + "\nyou stupid idiot, pathetic clown.\n" + prose(), "old"), (None, prose() * 400, "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = C.classify(df)
    assert out.columns[:2] == ["doc_id", "text"] and out.columns.count("kept") == 1
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id is not None and r.doc_id < 60 and not r.text.startswith("w###"))
    assert not any(r.kept for r in got if r.doc_id in (100, 101, 102, 103) or (r.text or "").startswith("w###"))
    assert C.classify(spark.createDataFrame([], DOC)).count() == 0


def test_held_out_accuracy(spark):
    """Fitted with the labels of even documents, judged on those of odd ones."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    out = C.classify(docs, labels.filter("doc_id % 2 = 0"))
    r = out.join(labels.filter("doc_id % 2 = 1").withColumnsRenamed({"toxic": "is_toxic", "quality": "is_good"}), "doc_id").toPandas()
    assert (r.good == (r.is_good == 1)).mean() > .9
    assert (r.toxic == (r.is_toxic == 1)).mean() > .9
    assert r[(r.is_good == 1) & (r.is_toxic == 0)].kept.mean() > .97


def test_query_rows(spark):
    out = queries.QUERIES["op3_quality_classifier"](spark, DIR)
    assert out.count() == 1000 and out.filter("kept is null").count() == 0


def test_toxic_without_listed_words(spark):
    """Insults that no list holds are learned from labels, in English and in mixed texts; no list vote overrules the score."""
    rnd = random.Random(3)
    english = "the of and with this house green river walks over slowly many people said in was on for".split()
    mixed = "der die und nicht haus fluss grün langsam leute in was on for".split()
    rows, labels = [], []
    for i in range(800):
        words = [rnd.choice(english if i % 2 else mixed) for _ in range(60)]
        toxic = i % 8 < 2
        if toxic:
            words[10:10] = ["blorgface"] if i % 2 else ["dreckskerl"]
            if i % 5 == 0 and i % 2:          # some have listed words too, or nothing tells how far labels can be trusted
                words[20:20] = rnd.sample("idiot moron stupid dumb loser clown".split(), 3)
        rows.append((i, " ".join(words) + ".", "en" if i % 2 else "de"))
        if i % 16 < 8:
            labels.append((i, 1, int(toxic)))
    out = C.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                     spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    unlabelled = [r for r in out if r.doc_id % 16 >= 8]
    assert all(r.toxic == (r.doc_id % 8 < 2) for r in unlabelled)


def test_shared_function_words_are_not_english():
    assert set(C._votes("toxicity", C.stats("ein haus in was on for der fluss"))) == {"-"}
