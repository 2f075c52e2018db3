"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the vocabulary's pieces drives one pass of
Viterbi: at each character the automaton reports every piece that ends there
(its state and the states along its output links), and each relaxes the best
score of the position after it. Characters no piece covers fall back to their
UTF-8 bytes, at ``min(score) - 10``.

A space becomes U+2581 and a text starts with one, as the vocabulary expects.
A U+2581 of the text itself is written as bytes, so decoding gives back every
text exactly. Where no piece continues past a boundary (a U+2581 after another
character, a line break that is in no longer piece) the best path may be
closed there: such stretches are encoded on their own and remembered.

The vocabulary is read once on the driver and broadcast (its size is that of
the file). Nothing is shuffled. Null texts encode to null and decode to null,
empty texts to no ids.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEPT = 400_000  # remembered stretches per generation
NOWHERE = float("-inf")


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(MODEL))


@dataclass
class Vocabulary:
    """Pieces by id; ``kinds``: n normal, a always one token, b byte, x unused
    in texts (control, unknown)."""

    pieces: list[str]
    scores: list[float]
    kinds: str


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, scores, kinds = [sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], []
    for i in range(n):
        if sp.is_byte(i):
            kinds.append("b")
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            kinds.append("x")
        else:
            kinds.append("a" if scores[i] <= -1e8 else "n")
    return Vocabulary(pieces, scores, "".join(kinds))


class Codec:
    def __init__(self, v: Vocabulary):
        normal = [s for s, k in zip(v.scores, v.kinds) if k == "n"]
        self.unknown = min(normal, default=0.0) - 10.0
        self.byte_ids = [0] * 256
        self.scores: dict[str, tuple[float, int]] = {}
        for i, (p, s, k) in enumerate(zip(v.pieces, v.scores, v.kinds)):
            if k == "b":
                self.byte_ids[int(p[3:5], 16)] = i
            elif k in "na":
                self.scores[p] = (s if k == "n" else -0.1, i)
        self.text_of = [
            bytes([int(p[3:5], 16)]) if k == "b" else b"" if k == "x" else p.replace(SPACE, " ").encode()
            for p, k in zip(v.pieces, v.kinds)
        ]
        self.automaton = ahocorasick.Automaton()
        for p, (s, i) in self.scores.items():
            self.automaton.add_word(p, (len(p), s, i))
        self.automaton.make_automaton()
        longer = {c for p in self.scores if len(p) > 1 for c in p}
        open_ = any(SPACE in p.lstrip(SPACE) for p in self.scores)
        lone = "".join(c for c in "\n\t\r" if c not in longer)
        stretch = f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" + (f"|[{lone}]" if lone else "")
        self.split = None if open_ else regex.compile(stretch)
        self.by_line = self.split is not None and "\n" in lone
        # ids as bytes: an entry is small, and a text's ids are one join
        self.young: dict[str, tuple[bytes, float]] = {}
        self.old: dict[str, tuple[bytes, float]] = {}
        self.words: dict[str, tuple[bytes, float]] = {}
        self.old_words: dict[str, tuple[bytes, float]] = {}

    # U+2581 in the text itself is not a space: a private mark keeps them apart
    MARK = "▁"

    def viterbi(self, text: str) -> tuple[bytes, float]:
        """Ids (little-endian int32) and score of the best segmentation of
        escaped text."""
        n = len(text)
        best, back, piece = [NOWHERE] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        unknown, closed = self.unknown, 0
        for end, (size, score, i) in self.automaton.iter(text):
            while closed < end:  # no piece ends here any more: a character alone?
                closed += 1
                alone = best[closed - 1] + unknown
                if alone > best[closed]:
                    best[closed], back[closed], piece[closed] = alone, closed - 1, -1
            got = best[end + 1 - size] + score
            if got > best[end + 1]:
                best[end + 1], back[end + 1], piece[end + 1] = got, end + 1 - size, i
        while closed < n:
            closed += 1
            alone = best[closed - 1] + unknown
            if alone > best[closed]:
                best[closed], back[closed], piece[closed] = alone, closed - 1, -1
        ids: list[int] = []
        at = n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            at = back[at]
        ids.reverse()
        return struct.pack(f"<{len(ids)}i", *ids), best[n]

    def _stretch(self, s: str) -> tuple[bytes, float]:
        got = self.young.get(s)
        if got is None:
            got = self.old.pop(s, None) or self.viterbi(s)
            if len(self.young) >= KEPT:
                self.old, self.young = self.young, {}
            if len(s) <= 64:
                self.young[s] = got
        return got

    def _word(self, w: str) -> tuple[bytes, float]:
        """A word after one space."""
        got = self.old_words.pop(w, None) or self.viterbi(SPACE + w)
        if len(self.words) >= KEPT:
            self.old_words, self.words = self.words, {}
        if len(w) <= 64:
            self.words[w] = got
        return got

    def _escaped(self, text: str) -> list[tuple[bytes, float]]:
        return [self._stretch(s) for s in self.split.findall(text)] if self.split else [self.viterbi(text)]

    def _lines(self, text: str) -> list[tuple[bytes, float]]:
        """As ``_escaped``, without its search: lines and single spaces."""
        out: list[tuple[bytes, float]] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self._stretch("\n"))
            words = line.split(" ")
            if "" in words:
                out.extend(self._escaped(("" if k else SPACE) + line.replace(" ", SPACE)))
                continue
            if k:
                out.append(self._stretch(words[0]))
                del words[0]
            got = list(map(self.words.get, words))
            if None in got:
                got = [g or self._word(w) for g, w in zip(got, words)]
            out.extend(got)
        return out

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        """Ids (int32) and score of a text."""
        if not text:
            return np.zeros(0, "<i4"), 0.0
        if self.by_line and SPACE not in text:
            out = self._lines(text)
        else:
            out = []
            for k, part in enumerate(text.split(SPACE)):
                if k:  # a U+2581 of the text itself
                    own = [self.byte_ids[b] for b in SPACE.encode()]
                    out.append((struct.pack(f"<{len(own)}i", *own), self.unknown))
                out.extend(self._escaped(("" if k else SPACE) + part.replace(" ", SPACE)))
        return np.frombuffer(b"".join([g[0] for g in out]), "<i4"), math.fsum([g[1] for g in out])

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(v: Vocabulary) -> Codec:
    """The codec of a vocabulary, once per Python worker."""
    key = hashlib.sha256("\n".join(v.pieces).encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(v)
    return _codecs[key]


def encode(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ids array<int> and piece_score double."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model or default_model()))
    names = [c for c in docs.columns if c not in ("ids", "piece_score")]
    schema = docs.select(*names).schema.add("ids", ArrayType(IntegerType())).add("piece_score", DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for batch in batches:
            column = batch.column(names.index(text))
            for lo in range(0, batch.num_rows, 256):  # ids of some rows at a time
                part = batch.slice(lo, 256)
                ids, scores = [], []
                for t in column.slice(lo, 256):
                    got = (None, None) if not t.is_valid else c.encode(t.as_py())
                    ids.append(got[0])
                    scores.append(got[1])
                yield pa.record_batch(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(scores, pa.float64())],
                    [*names, "ids", "piece_score"],
                )

    return docs.select(*names).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with decoded string, from its column ids."""
    spark = encoded.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(model or default_model()))
    names = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*names).schema.add("decoded", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [
                    c.decode(x.values.to_numpy()) if x.is_valid else None for x in part.column(names.index("ids"))
                ]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, schema)


def report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the ids as little-endian
    int32), piece_score, decoded_sha256, exact (decoding gives the text back).

    Encoding and decoding share a pass, so that ids need not leave the task.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model or default_model()))
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_()]
    names = ["n_tokens", "ids_sha256", "piece_score", "decoded_sha256", "exact"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for batch in batches:
            out: list[tuple] = []
            for t in batch.column("text"):
                if not t.is_valid:
                    out.append((0, None, None, None, True))
                    continue
                text = t.as_py()
                ids, score = c.encode(text)
                back = c.decode(ids)
                shas = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), back.encode())]
                out.append((len(ids), shas[0], score, shas[1], back == text))
            cols = zip(*out) if out else [()] * len(kinds)
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(cols, kinds))], ["doc_id", *names]
            )

    return rows.mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, piece_score double, decoded_sha256 string, exact boolean"
    )
