import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import DIR, DOC, duck, same

from tidewell.llm import queries
from tidewell.llm import substring_dedup as S


def brute(texts, length):
    """Removed masks by counting every string of that length."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(hashlib.blake2b(b[i:i + length], digest_size=16).digest() for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[hashlib.blake2b(b[i:i + length], digest_size=16).digest()] > 1:
                gone[i:i + length] = True
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), len(b), int(gone.sum()), len(S.runs(gone))))
    return out


def got(df, length=S.LENGTH, order=S.ORDER):
    return [(bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in
            S.remove_repeats(df, length, order).orderBy("n_chars").collect()]


def numbered(spark, texts):
    return spark.createDataFrame(
        [(i, t, "en", "s", i) for i, t in enumerate(texts)], DOC)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghé ") for _ in range(rnd.randint(1, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    long, short = say(1500), say(95)
    texts = [None, "", "x", say(400), say(400)]
    for _ in range(25):
        a = rnd.randint(0, len(long) - 1)
        b = min(len(long), a + rnd.choice([100, 380, 399, 400, 401, 420, 460, 700, 3000]))
        texts.append(say(rnd.randint(0, 90)) + long[a:b] + say(rnd.randint(0, 90)))
        texts.append(say(rnd.randint(0, 60)) + short + say(rnd.randint(0, 200)))
    texts += [texts[7]] * 3 + ["z" * 399, "z" * 900, "ab" * 700, "y" * 401, "q" * 400]
    own = say(80)
    return texts + [own + say(40) + own, say(30) * 12]


def test_difference_cover():
    for q in (2, 3, 5, 7, 11):
        d, v = S.difference_cover(q)
        assert v == q * q + q + 1 and len({(a - b) % v for a in d for b in d}) == v
    with pytest.raises(ValueError):
        S.difference_cover(4)


@pytest.mark.parametrize("seed,order,rows", [(1, 7, 1 << 20), (2, 3, 500), (3, 11, 2000)])
def test_against_brute_force(spark, monkeypatch, seed, order, rows):
    monkeypatch.setattr(S, "BUCKET_ROWS", rows)       # many buckets
    monkeypatch.setattr(S, "BLOCK_BYTES", 5000)       # many blocks
    texts = corpus(seed)
    assert got(numbered(spark, texts), order=order) == brute(texts, S.LENGTH)


def test_short_match_of_a_settled_stretch(spark):
    """Two texts share a long stretch; a third shares only 410 bytes of its middle."""
    rnd = random.Random(9)
    say = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    long = say(4000)
    texts = [long, say(77) + long, say(60) + long[2000:2410] + say(50), say(500)]
    assert got(numbered(spark, texts)) == brute(texts, S.LENGTH)


def test_repeated_rows_clashing_columns_and_empty(spark):
    rnd = random.Random(4)
    text = "".join(rnd.choice("abc ") for _ in range(600))
    df = spark.createDataFrame([(1, text, 5, "k"), (1, text, 5, "k"), (None, text[:300], 5, "k"), (None, None, 5, "k")],
                               "doc_id long, text string, n_bytes int, kept string")
    out = S.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans"]
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in out.collect()) == [(0, 0, 0), (300, 0, 0), (600, 600, 1), (600, 600, 1)]
    assert S.remove_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_query_against_brute_force(spark):

    src = spark.read.parquet(f"{DIR}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in src], 400)
    out = {r.doc_id: r for r in queries.QUERIES["op10_substring_dedup"](spark, DIR).collect()}
    assert len(out) == len(src)
    for r, (kept, n, gone, spans) in zip(src, want):
        o = out[r.doc_id]
        assert (o.n_bytes, o.n_removed, o.n_spans) == (n, gone, spans)
        assert o.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_query_matches_sql(spark):
    same(queries.QUERIES["op10_substring_dedup"](spark, DIR), duck(queries.ORACLE["op10_substring_dedup"]))
