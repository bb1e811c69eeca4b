"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document; they
overlap and err.  Annotators' labels, where there are some, are one more
labeller that mostly abstains and may err too.  Expectation-maximisation
estimates each labeller's accuracy and the share of good documents from the
votes (patterns of votes are counted on the cluster; there are at most
3^labellers of them) and so gives each pattern a posterior.  The posteriors
of documents with votes, as soft labels, train a hashed linear scorer
(logistic regression with an L1 term over hashed words and word shapes).  The
verdict is the mean of the heuristics' posterior and the score, or the score
alone where all heuristics abstain and, for toxicity, where no listed insult
occurs: that a short English list has no hit says little.  Where there are
labels, such a document teaches what its label says, else nothing.

The same machinery serves two targets: quality (is it prose?) and toxicity
(does it insult?).  A document is kept if it is good and not toxic.

The scorer is fitted on about TRAIN_ROWS documents chosen by hash, half of
them with labels if there are so many; votes, counts, posteriors and scores
cover all documents.

Defined cases: null, empty and wordless texts are bad and not toxic.  Rows
sharing a doc_id are judged each by its own text, and share its labels.
Labels of one document are merged to the largest; null labels abstain.  Extra columns pass
through; result columns replace input columns of the same name.  An empty
table gives an empty result.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, stage, text_or_empty
from tidewell.session import ship_package, sql_conf

TRAIN_ROWS = 40_000
BUCKETS = 1 << 15         # word buckets; as many again for shapes
ROUNDS = 100
LABEL_TRUST = 0.98        # chance that a toxicity label is right where no list speaks
SPACES = b" \t\n\x0b\x0c\r"
CACHE_WORDS = 250_000

# FIXED VALUES: common function words of the four languages, and insults
# (of English those that other languages don't have: no "in", "was", "on", "for", "is", "to", "that")
ENGLISH = frozenset(b"the of and with this are from which have they".split())
COMMON = ENGLISH | frozenset(w.encode() for w in (
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they "
    "der die und das von zu den mit ist des im ein eine nicht auf für sich dem auch als an es "
    "de la le et les des en un du une que est pour qui dans par plus sur pas au il avec "
    "el los las y por con una para su al lo como más del se no").split())
INSULTS = tuple("idiot moron stupid dumb loser clown scum trash pathetic worthless disgusting imbecile jerk fool "
                "ugly vermin filthy coward freak creep lowlife".split())

_POINTS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SYMBOLS = b"#*$%&|<>=_~^"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


@dataclass(frozen=True)
class Stats:
    words: int
    symbols: int
    bangs: int
    upper: int
    lower: int
    lines: int
    dup_lines: int
    chars: int
    common: int
    english: int
    runs: int
    distinct: int
    insults: tuple[int, ...]


def _without(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def stats(text: str) -> Stats:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().translate(None, _POINTS).split()
    n = len(raw.split())
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    found = set(words)
    return Stats(n, _without(raw, _SYMBOLS), raw.count(b"!!"), _without(raw, _UPPER), _without(raw, _LOWER), len(lines),
                 len(lines) - len(set(lines)), len(raw) - _without(raw, SPACES),
                 sum(map(COMMON.__contains__, words)), sum(map(ENGLISH.__contains__, words)),
                 sum(map(eq, words, islice(words, 1, None))), len(found),
                 tuple(int(w.encode() in found) for w in INSULTS))


def _vote(good: bool, bad: bool) -> str:
    return "b" if bad else "g" if good else "-"


# labeller -> vote: g(ood), b(ad) or - (abstains)
QUALITY: dict[str, Callable[[Stats], str]] = {
    "symbols": lambda s: _vote(20 * s.symbols < s.words, 4 * s.symbols > s.words),
    "shouting": lambda s: _vote(5 * s.upper < s.lower, s.upper > s.lower and s.words >= 5),
    "bangs": lambda s: _vote(s.words >= 20 and s.bangs == 0, 4 * s.bangs > s.words),
    "repeated_lines": lambda s: _vote(s.lines > 1 and s.dup_lines == 0, 2 * s.dup_lines > s.lines),
    "repeated_words": lambda s: _vote(20 * s.runs < s.words, 5 * s.runs > s.words),
    "word_length": lambda s: _vote(4 * s.words <= s.chars <= 7 * s.words, s.words >= 20 and s.chars > 8 * s.words),
    "common_words": lambda s: _vote(6 * s.common > s.words, s.words >= 20 and 50 * s.common < s.words),
    "variety": lambda s: _vote(s.words >= 20 and 3 * s.distinct > s.words, 8 * s.distinct < s.words and s.words < 2000)}


def _insults(which: slice) -> Callable[[Stats], str]:
    # the lists are English: without a hit they speak only for English texts
    return lambda s: _vote(any(s.insults[which]), not any(s.insults[which]) and 12 * s.english > s.words)


# for toxicity "g" is insulting, "b" is not; the word lists overlap
TOXICITY: dict[str, Callable[[Stats], str]] = {
    "first_words": _insults(slice(0, 14)), "later_words": _insults(slice(7, None)),
    "odd_words": _insults(slice(0, None, 2)), "even_words": _insults(slice(1, None, 2)),
    "several": lambda s: _vote(sum(s.insults) > 1, False)}
TARGETS = {"quality": QUALITY, "toxicity": TOXICITY}
LABELS = {"quality": "quality", "toxicity": "toxic"}


def _votes(target: str, s: Stats) -> str:
    return "".join(f(s) for f in TARGETS[target].values())


def _heard(target: str, pattern: str, labels: bool) -> str:
    """The votes that count beside labels: not those of insult lists without a hit."""
    return "-" * len(pattern) if labels and target == "toxicity" and "g" not in pattern else pattern


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, quality, toxicity): a letter per labeller, one row per row of ``docs``."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [stats(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([_votes(k, s) for s in each], pa.string()) for k in TARGETS)],
                ["doc_id", *TARGETS])

    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    with sql_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        return stage(src.mapInArrow(run, "doc_id long, quality string, toxicity string"), "votes")


@dataclass(frozen=True)
class Labellers:
    """prior: share of "g".  good[i]: chance that labeller i votes g on a g;
    bad[i]: chance that it votes b on a b (both of the votes it casts)."""

    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, pattern: str) -> float:
        """Chance of "g" given some labellers' votes; shorter patterns leave out the last labellers."""
        z = np.log(self.prior / (1 - self.prior))
        for c, g, b in zip(pattern, self.good, self.bad):
            z += np.log(g / (1 - b)) if c == "g" else np.log((1 - g) / b) if c == "b" else 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_labellers(patterns: dict[str, int], rounds: int = ROUNDS) -> Labellers:
    """EM over vote patterns and their counts.  Starts from the majority;
    Laplace smoothing keeps all chances inside (0, 1)."""
    keys = list(patterns)
    n = np.array([patterns[k] for k in keys], float)
    v = np.array([[1 if c == "g" else -1 if c == "b" else 0 for c in k] for k in keys])
    post = np.clip(0.5 + v.sum(1) / (2 * np.maximum(1, np.abs(v).sum(1))), 0.02, 0.98)
    for _ in range(rounds):
        a, b = n * post, n * (1 - post)
        model = Labellers((a.sum() + 1) / (n.sum() + 2), ((a @ (v > 0)) + 1) / ((a @ (v != 0)) + 2),
                          ((b @ (v < 0)) + 1) / ((b @ (v != 0)) + 2))
        new = np.array([model.posterior(k) for k in keys])
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return model


# letters, capitals and digits as one a, A or 0 each run; all else as it is
_CLASSES = bytes(ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit()
                 else c for c in range(256))
_RUNS = re.compile(rb"([aA0])\1+")


def _shape(word: bytes) -> bytes:
    return _RUNS.sub(rb"\1", word.translate(_CLASSES))[:12]


class _Buckets(dict):
    """word -> word bucket * 2^32 + shape bucket"""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > CACHE_WORDS:
            self.clear()
        core = word.lower().strip(_POINTS)
        out = (xxhash.xxh3_64_intdigest(core) % BUCKETS) << 32 | (xxhash.xxh3_64_intdigest(b"\x00" + _shape(word)) % BUCKETS)
        self[word] = out
        return out


_buckets = _Buckets()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): words present, and ten times the share of each word shape."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    packed = np.fromiter(map(_buckets.__getitem__, words), np.int64, len(words))
    present = np.unique(packed >> 32)
    shapes, n = np.unique(packed & 0xFFFFFFFF, return_counts=True)
    return np.r_[present, shapes + BUCKETS], np.r_[np.ones(len(present)), 10.0 * n / len(words)]


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float


def fit_scorer(sample: DataFrame, target: str) -> Scorer:
    """sample: (vector, <target>) with soft labels in [0, 1]."""
    soft = sample.select("vector", F.col(target).alias("p"))
    rows = soft.select("vector", F.lit(1.0).alias("label"), F.col("p").alias("w")).unionByName(
        soft.select("vector", F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w"))).filter("w > 0.001")
    model = LogisticRegression(featuresCol="vector", weightCol="w", regParam=0.002, elasticNetParam=1.0,
                               maxIter=40).fit(rows)
    return Scorer(np.asarray(model.coefficients.toArray()), float(model.intercept))


def classify(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with quality_posterior, quality_score, toxic_posterior,
    toxic_score (chances), good, toxic and kept.  ``labels``: doc_id,
    quality and toxic (0/1), for some documents."""
    spark = docs.sparkSession
    ship_package(spark)
    new = ["quality_posterior", "quality_score", "toxic_posterior", "toxic_score", "good", "toxic", "kept"]
    voted = votes(docs)
    letter = lambda c: F.when(F.max(c) > 0, "g").when(F.max(c) <= 0, "b").otherwise("-")
    if labels is None:
        said = voted.select("doc_id", F.lit("-").alias("l_quality"), F.lit("-").alias("l_toxicity")).limit(0)
    else:
        said = labels.groupBy("doc_id").agg(*[letter(c).alias("l_" + t) for t, c in LABELS.items()])
    voted = voted.join(said, "doc_id", "left").fillna("-", ["l_quality", "l_toxicity"])
    models, some = {}, {}
    for target in TARGETS:
        # at most 3^(labellers + 1) rows
        counts = {r[0]: r[1] for r in voted.groupBy(F.concat(target, "l_" + target)).count().collect()}
        heard: dict[str, int] = {}
        for k, n in counts.items():
            k = _heard(target, k[:-1], k[-1] != "-") + k[-1]
            heard[k] = heard.get(k, 0) + n
        models[target] = fit_labellers(heard) if counts else None
        some = {"rows": sum(counts.values()), "labelled": sum(n for k, n in counts.items() if k[-1] != "-")}
    text = text_or_empty(docs)

    # a fixed share of the hash range with and without labels: about train_rows documents
    hashed = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("train")), F.lit(1 << 20))
    below = lambda n, of: F.lit(int(min(1.0, n / max(1, of)) * (1 << 20)))
    many = min(some["labelled"], train_rows // 2)
    limit = F.greatest(below(train_rows - many, some["rows"]), below(many, some["labelled"]))
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).filter(hashed < limit)
    chosen = chosen.join(said.filter(hashed < limit), "doc_id", "left").filter(
        (hashed < below(train_rows - many, some["rows"])) | F.col("l_quality").isNotNull())

    def soft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, val, chance = [], [], {t: [] for t in TARGETS}
            for t, *label in zip(*(batch.column(k).to_pylist() for k in range(3))):
                s, f = stats(t), features(t)
                idx.append(f[0].tolist())
                val.append(f[1].tolist())
                for target, x in zip(TARGETS, label):
                    pattern = _heard(target, _votes(target, s), some["labelled"] > 0) + (x or "-")
                    # a document without votes teaches nothing
                    if target == "toxicity" and x in ("g", "b") and set(pattern[:-1]) == {"-"}:
                        # beyond the lists nothing but the label speaks
                        chance[target].append(LABEL_TRUST if x == "g" else 1 - LABEL_TRUST)
                    else:
                        chance[target].append(models[target].posterior(pattern) if set(pattern) != {"-"} else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64())),
                 *(pa.array(c, pa.float64()) for c in chance.values())], ["idx", "val", *TARGETS])

    scorers: dict[str, Scorer | None] = dict.fromkeys(TARGETS)
    if some["rows"]:
        with sql_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
            sample = stage(chosen.select("text", "l_quality", "l_toxicity").mapInArrow(
                soft, "idx array<int>, val array<double>, quality double, toxicity double"), "train")
        vector = F.udf(lambda i, v: Vectors.sparse(2 * BUCKETS, i, v), VectorUDT())
        sample = stage(sample.select(vector("idx", "val").alias("vector"), *TARGETS), "train-vectors")
        for target in TARGETS:
            # a target that the sample shows in one class only says what the votes say
            mean = sample.agg(F.avg(target)).first()[0]
            if mean is not None and 1e-4 < mean < 1 - 1e-4:
                scorers[target] = fit_scorer(sample.filter(F.col(target).isNotNull()), target)
    # 2^16 weights per target, a fixed size
    held = spark.sparkContext.broadcast((models, scorers))

    @F.pandas_udf(", ".join(f"{c} double" for c in new[:4]) + ", good boolean, toxic boolean")
    def run(texts):
        import pandas as pd
        models, scorers = held.value
        known: dict[str, float] = {}
        out = []
        for t in texts:
            s, (i, v) = stats(t), features(t)
            row, verdict = [], []
            for target in TARGETS:
                pattern = _votes(target, s)
                if target + pattern not in known:
                    known[target + pattern] = models[target].posterior(pattern)
                p = z = known[target + pattern] if s.words else 0.0
                model = scorers[target]
                if model is not None and s.words:
                    z = float(1 / (1 + np.exp(-np.clip(model.bias + model.weights[i] @ v, -30, 30))))
                row += [p, z]
                alone = set(pattern) == {"-"} or (target == "toxicity" and "g" not in pattern)
                verdict.append(z >= 0.5 if alone else p + z >= 1)
            out.append(row + verdict)
        return pd.DataFrame(out, columns=new[:6])

    done = docs.withColumn(P + "f", run(text)).select(*[c for c in docs.columns if c not in new], P + "f.*")
    return done.withColumn("kept", F.col("good") & ~F.col("toxic"))
