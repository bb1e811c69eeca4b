"""Periodic word runs by recompression.

A run is a stretch of words with smallest period q and at least
max(min_words, min_repeats * q) words that no neighbouring word extends
keeping the period.

1. Harmonic grid.  A run with period q holds ``min_repeats`` neighbouring
   points of the grid 0, q, 2q, ..., and the words there are equal.  Over all q
   that is n / 1 + n / 2 + ... points, taken in slices of GRID_POINTS.
2. Recompression.  The texts that hold such points become one run-length
   grammar: rounds of block compression (a maximal block a^k becomes one
   symbol) and of pair compression (symbols fall into left and right ones by a
   hash; every left-right pair becomes one symbol), until no symbol occurs twice
   in a text.  Equal pairs and blocks get equal names, so equal stretches are
   parsed alike but for their edges.
3. Longest common extensions of (j, j + q), forwards and backwards, climb the
   levels of the grammar while both places start a symbol and come down where
   symbols differ: a few steps a level, for a slice of candidates at once.  They are
   exact, since names are.

Words are compared as bytes.  Of the same stretch found under several periods
the smallest is its period (the others are multiples of it).  A document is
worked on within one task; nothing is shuffled.

Defined cases: null or empty text, and texts of white space, have no words and
no runs, and collapse to the empty text.  Every row is a document of its own,
whatever its id; one with a null id is never handed to ``rewrite``.  Other
columns pass through; result columns replace input columns of the same name.
Empty tables give empty results.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, stage, text_or_empty
from tidewell.session import ship_package, sql_conf

GRID_POINTS = 1 << 20
BATCH_ROWS = 500
RUNS = "array<struct<start:long,length:long,period:long>>"


@dataclass(frozen=True)
class RunParams:
    min_words: int = 6
    min_repeats: int = 4


@dataclass
class Level:
    """Symbols of one round and how the next one groups them."""
    symbols: np.ndarray
    parent: np.ndarray       # index in the next round
    first: np.ndarray        # first member of every symbol of the next round, and the end
    blocks: bool

    def mirrored(self) -> "Level":
        n, m = len(self.symbols), len(self.first) - 1
        return Level(self.symbols[::-1], (m - 1 - self.parent)[::-1], (n - self.first)[::-1], self.blocks)


def _side(symbols: np.ndarray, round_: int) -> np.ndarray:
    """Pseudo-random side of each symbol, new in every round."""
    x = (symbols.astype(np.uint64) + np.uint64(round_ * 0x632BE5AB + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(63)).astype(bool)


class Grammar:
    """Recompression of a sequence of names.  Negative names are separators:
    each occurs once and is never paired."""

    def __init__(self, symbols: np.ndarray, text: np.ndarray):
        """text: number of the text of every place."""
        self.levels: list[Level] = []
        self.fresh = int(symbols.max(initial=0)) + 1
        s, owner, round_ = symbols.astype(np.int64), text, 0
        while self._repeats(s, owner):
            s, owner = self._group(s, owner, np.r_[True, s[1:] != s[:-1]], True)
            left = (s >= 0) & ~_side(s, round_)
            right = (s >= 0) & _side(s, round_)
            s, owner = self._group(s, owner, np.r_[True, ~(left[:-1] & right[1:])], False)
            round_ += 1
        # the last round groups nothing; its symbols differ within each text
        self.top = s
        self.back = [x.mirrored() for x in self.levels]

    @staticmethod
    def _repeats(s: np.ndarray, owner: np.ndarray) -> bool:
        at = np.lexsort((s, owner))
        return bool(((s[at][1:] == s[at][:-1]) & (owner[at][1:] == owner[at][:-1])).any())

    def _group(self, s: np.ndarray, owner: np.ndarray, starts: np.ndarray, blocks: bool):
        """Name the groups that begin at ``starts``; groups of one keep their name."""
        first = np.flatnonzero(starts)
        if len(first) == len(s):
            return s, owner
        ends = np.r_[first[1:], len(s)]
        size = ends - first
        many = np.flatnonzero(size > 1)
        head = s[first[many]]
        other = size[many] if blocks else s[first[many] + 1]
        pairs = np.stack([head, other])
        order = np.lexsort(pairs)
        new = np.r_[True, (pairs[:, order][:, 1:] != pairs[:, order][:, :-1]).any(axis=0)]
        names = np.empty(len(many), np.int64)
        names[order] = self.fresh + np.cumsum(new) - 1
        self.fresh += int(new.sum())
        up = s[first]
        up[many] = names
        self.levels.append(Level(s, np.cumsum(starts) - 1, np.r_[first, len(s)], blocks))
        return up, owner[first]

    def extension(self, i: np.ndarray, j: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many names from i and from j on (or back) agree; i differs from j."""
        levels = self.back if backwards else self.levels
        n = len(levels[0].symbols) if levels else len(self.top)
        if backwards:
            i, j = n - 1 - i, n - 1 - j
        x, y = i.copy(), j.copy()
        height = np.full(len(x), len(levels))
        climbing = np.arange(len(x))
        for k, level in enumerate(levels):
            a, b = x[climbing], y[climbing]
            pa, pb = level.parent[a], level.parent[b]
            ra, rb = level.first[pa + 1] - a, level.first[pb + 1] - b
            inside = (level.first[pa] != a) | (level.first[pb] != b)
            same = level.symbols[a] == level.symbols[b]
            # within a group: its rest is compared at this level
            step = np.where(inside & same, np.minimum(ra, rb), 0)
            stop = inside & (~same | (ra != rb))
            x[climbing] = np.where(stop, a + step, np.where(inside, pa + 1, pa))
            y[climbing] = np.where(stop, b + step, np.where(inside, pb + 1, pb))
            height[climbing[stop]] = k
            climbing = climbing[~stop]
        for k in range(len(levels) - 1, -1, -1):
            level = levels[k]
            at = np.flatnonzero(height > k)
            pa, pb = x[at], y[at]
            a, b = level.first[pa], level.first[pb]
            size = np.minimum(level.first[pa + 1] - a, level.first[pb + 1] - b) if level.blocks else 1
            step = np.where(level.symbols[a] == level.symbols[b], size, 0)
            x[at], y[at] = a + step, b + step
        return x - i


def grid_candidates(names: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                    params: RunParams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(j, q): grid points of every text and period with equal names at j, j + q, ..."""
    reach = params.min_repeats - 1
    n_q = np.where(sizes >= params.min_words, sizes // params.min_repeats, 0)
    begins = np.r_[0, np.cumsum(n_q)]
    lo = 0
    while lo < begins[-1]:
        # periods in slices, each period's points again in slices
        hi = min(lo + GRID_POINTS, int(begins[-1]))
        text = np.searchsorted(begins, np.arange(lo, hi), side="right") - 1
        q = np.arange(lo, hi) - begins[text] + 1
        points = (sizes[text] - 1) // q - reach + 1
        ends = np.cumsum(points)
        for a in range(0, int(ends[-1]), GRID_POINTS):
            b = min(a + GRID_POINTS, int(ends[-1]))
            u, v = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b - 1, side="right") + 1
            count = np.minimum(ends[u:v], b) - np.maximum(ends[u:v] - points[u:v], a)
            which = np.repeat(np.arange(u, v), count)
            step = q[which]
            j = starts[text[which]] + (np.arange(a, b) - (ends[which] - points[which])) * step
            for r in range(reach):
                hit = np.flatnonzero(names[j + r * step] == names[j + (r + 1) * step])
                j, step = j[hit], step[hit]
            if len(j):
                yield j, step
        lo = hi


def find_runs(texts: list[np.ndarray], params: RunParams = RunParams()) -> list[list[tuple[int, int, int]]]:
    """Per text of word names: its runs (start, length, period) in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    names = np.concatenate(texts) if texts else np.empty(0, np.int64)
    found = list(grid_candidates(names, ends - sizes, sizes, params))
    if not found:
        return out
    j, q = (np.concatenate(x) for x in zip(*found))
    text = np.searchsorted(ends, j, side="right")
    held, local = np.unique(text, return_inverse=True)
    # the texts with candidates, a separator before each and one after the last
    parts, at, begin = [], 0, np.empty(len(held), np.int64)
    for k, t in enumerate(held):
        parts += [np.array([-1 - k]), texts[t]]
        begin[k] = at + 1
        at += 1 + len(texts[t])
    s = np.concatenate([*parts, [-1 - len(held)]])
    owner = np.repeat(np.arange(len(held) + 1), [*(1 + sizes[held]), 1])
    grammar = Grammar(s, owner)
    j = j - (ends - sizes)[text] + begin[local]
    rows = []
    for a in range(0, len(j), GRID_POINTS):
        p, d, k = j[a:a + GRID_POINTS], q[a:a + GRID_POINTS], local[a:a + GRID_POINTS]
        start = p - grammar.extension(p - 1, p + d - 1, backwards=True)
        length = p + d + grammar.extension(p, p + d) - start
        ok = length >= np.maximum(params.min_words, params.min_repeats * d)
        rows.append(_smallest_periods(np.stack([k, start - begin[k], length, d])[:, ok]))
    for k, start, length, period in _smallest_periods(np.concatenate(rows, axis=1)).T.tolist():
        out[held[k]].append((start, length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """Columns (text, start, length, period): of each stretch the smallest period."""
    # the points of a run follow each other
    rows = rows[:, np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(axis=0)][:rows.shape[1]]]
    rows = rows[:, np.lexsort(rows[::-1])]
    return rows[:, np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)][:rows.shape[1]]]


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words left when each run keeps its first period, joined by a blank."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep)])


Rewrite = Callable[[int, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, params: RunParams = RunParams(), rewrite: Rewrite | None = None) -> DataFrame:
    """``docs`` with the collapsed ``text``, ``n_words`` and ``runs`` (by start,
    then period), stored in the shared folder.  ``rewrite`` changes the words
    of a document (given its id) before they are searched."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(f"n_words long, runs {RUNS}, collapsed string")
    def search(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        names: dict[bytes, int] = {}
        words, coded = [], []
        for i, t in zip(ids, texts):
            w = t.encode("utf-8", "surrogatepass").split()      # exactly the six ASCII white-space bytes
            if rewrite is not None and w and i is not None:
                w = rewrite(int(i), w)
            words.append(w)
            coded.append(np.fromiter((names.setdefault(x, len(names)) for x in w), np.int64, len(w)))
        found = find_runs(coded, params)
        return pd.DataFrame({
            "n_words": [len(w) for w in words],
            "runs": [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in found],
            "collapsed": [collapse(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, found)]})

    # the id goes as text: a null one must not turn the others into floats
    out = docs.withColumn(P + "r", search(docs["doc_id"].cast("long").cast("string"), text_or_empty(docs)))
    found = F.col(P + "r")
    out = out.select(*[found["collapsed"].alias(c) if c == "text" else F.col(c) for c in docs.columns
                       if c not in ("n_words", "runs")], found["n_words"].alias("n_words"), found["runs"].alias("runs"))
    with sql_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return stage(out, "periodic-runs")
