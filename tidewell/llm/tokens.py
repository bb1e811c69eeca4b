"""Token ids of whole documents, with a per-worker cache of words.

The tokenizer never joins text across white space, so a document's ids are
the concatenation of the ids of its pieces between blanks, tabs and line
ends; each distinct piece is encoded once per worker."""
from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidewell.llm.common import text_or_empty
from tidewell.session import ship_package

CACHE_WORDS = 250_000     # entries a worker keeps; then it starts anew
LONG_PIECE = 64           # longer pieces are encoded but not kept
# Latin letters: each is one character in NFC and in lower case
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = re.compile(f"[{_LATIN}]+")
_POINTS = ".,;:!?#$%&*"
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    def _encode(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Words of plain letters: one text, whose n-th word is the n-th."""
        out = []
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, of = array("I", e.ids), e.word_ids
            ends = [k for k in range(1, len(of)) if of[k] != of[k - 1]] + [len(of)]
            if len(ends) != len(part):
                return self._encode(words)
            start = 0
            for end in ends:
                out.append(ids[start:end].tobytes())
                start = end
        return out

    def _learn(self, words: list[str]) -> None:
        known = self.known
        low = {w: w.lower() for w in words if _LETTERS.fullmatch(w)}
        plain = [x for x in set(low.values()) if x not in known]
        known.update(zip(plain, self._encode_letters(plain)))
        for w, x in low.items():
            known[w] = known[x]
        other = [w for w in words if w not in low]
        known.update(zip(other, self._encode(other)))

    @staticmethod
    def _apart(texts: pa.StringArray) -> pa.StringArray:
        """The same ids from fewer distinct words: a blank between a letter or
        digit and the point after it, where the tokenizer cuts anyway, and
        lower case where all is ASCII (and no special token could arise)."""
        for c in "\n\t\r":
            texts = pc.replace_substring(texts, c, " ")
        odd = pc.match_substring_regex(texts, f"[^0-9 {_LATIN}][.,]|[{_POINTS[2:]}]")
        spaced = pc.replace_substring(pc.replace_substring(texts, ".", " ."), ",", " ,")
        mixed = pc.replace_substring_regex(texts.filter(odd), f"([0-9{_LATIN}])([{_POINTS}])", r"\1 \2")
        texts = pc.replace_with_mask(spaced, odd, mixed)
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "|>")))
        return pc.if_else(plain, pc.ascii_lower(texts), texts)

    def batch(self, texts: pa.StringArray) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
            known[""] = b""
        split = pc.split_pattern(self._apart(texts), " ")
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in known]
        long = [w for w in new if len(w) > LONG_PIECE]
        self._learn([w for w in new if len(w) <= LONG_PIECE])
        both = dict(zip(long, self._encode(long)))
        raws = pa.array([known[w] if w in known else both[w] for w in distinct], pa.large_binary())
        joined = raws.take(words.indices)
        # the words' ids lie end to end: a text is the stretch of its words
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        cuts = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        data = joined.buffers()[2]
        return [data[x:y].to_pybytes() if y > x else b"" for x, y in zip(cuts, cuts[1:])]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


SLICE_BYTES = 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int | None = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids, ``end_id``
    appended, cut into pieces of at most ``capacity``.  ``ids`` holds
    little-endian unsigned 32-bit integers.  Null text is empty."""
    ship_package(docs.sparkSession)
    end = b"" if end_id is None else end_id.to_bytes(4, "little")
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            # slices of bounded size: a batch may hold many long texts
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // SLICE_BYTES
            edges = np.r_[0, np.flatnonzero(sizes[1:] != sizes[:-1]) + 1, len(ids)] if ids else []
            for at, upto in zip(edges, edges[1:]):
                docs_, pieces, starts, lengths, raws = [], [], [], [], []
                for d, raw in zip(ids[at:upto], enc.batch(texts.slice(at, upto - at))):
                    raw += end
                    for k, b in enumerate(range(0, len(raw), step)):
                        docs_.append(d)
                        pieces.append(k)
                        starts.append(b // 4)
                        raws.append(raw[b:b + step])
                        lengths.append(len(raws[-1]) // 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(raws, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])
        # workers live on: hand back what the last slices took
        pa.default_memory_pool().release_unused()

    src = docs.select(docs["doc_id"].cast("long"), text_or_empty(docs).alias("text"))
    return src.mapInArrow(run, PIECES)
