r"""Line dedup with two Bloom filters.

A line's key is the line without ``[\x20\x09-\x0D]`` at both ends, A-Z in
lower case. Keys of at least 10 code points that two documents hold lose all
their lines except in the document with the smallest id.

1. Each document gives the 64-bit hashes of its distinct keys; a task reduces
   them before anything is written.
2. The hashes are dealt to segments. A segment holds two Bloom filters: a hash
   that finds all its bits in *once* is entered in *twice*, else in *once*.
   The twice filter is folded (its halves joined by OR, which loses no member)
   to at most ``2**FOLDED`` bits in all, so its size has a bound, and sent to
   all tasks.
3. Texts are read again: only keys that the twice filter reports, the suspected
   repeats, are shuffled, as SHA-256 digests with their document. Grouping by
   digest confirms them exactly and finds the first document.
4. Documents meet the digests they lose and are written without those lines.

A wrong report of a filter costs a digest in the shuffle, never a line; with
far more repeated keys than the folded filter can tell apart, step 3 shuffles
more digests and the result is the same. A hot line is reduced to one row per
task by partial aggregation, and its digest is a skewed join key that Spark
splits.

Null and empty texts are one empty line and stay so (null becomes ''). Rows
that share a doc_id are one document; rows without an id together are one
document, which comes after all others. Repeated rows get equal results. A
text of any length is handled whole, one at a time. An empty table gives an
empty result. Other columns pass through, except those named like a result
column (n_lines, n_dropped), which are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

LEAST = 10  # code points of a key
WHITE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that start no code point

WIDTH = 20  # log2 of a segment's bits
KEYS = 1 << 16  # keys of a segment, on average: 16 bits a key
PROBES = 4
FOLDED = 28  # log2 of the bits of the filter that is sent out: 32 MB
LEAST_WIDTH = 10
HELD = 1 << 18  # hashes a task gathers before it reduces them


def key_of(line: bytes) -> bytes | None:
    """The key of a line, None if it is too short to count."""
    key = line.strip(WHITE).lower()  # bytes: A-Z only
    n = len(key)
    if n < LEAST or (n < 4 * LEAST and not key.isascii() and len(key.translate(None, CONTINUATION)) < LEAST):
        return None
    return key


def keys_of(text: bytes) -> set[bytes]:
    keys = {key_of(line) for line in text.split(b"\n") if len(line) >= LEAST}
    keys.discard(None)
    return keys


def hash_of(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column.cast(pa.large_binary()):
        yield t.as_py() or b""


# ---- filters --------------------------------------------------------------------
def positions(hashes: np.ndarray) -> np.ndarray:
    """PROBES positions (rows) of each hash in a segment of any width."""
    a = arrays.mix(hashes)
    b = (a >> np.uint64(32)) | np.uint64(1)
    return a + np.arange(PROBES, dtype=np.uint64)[:, None] * b


class Segment:
    """The once and twice filters of one segment."""

    def __init__(self, width: int = WIDTH):
        self.mask = np.uint64((1 << width) - 1)
        self.once = np.zeros(1 << width, bool)
        self.twice = np.zeros(1 << width, bool)

    def add(self, hashes: np.ndarray, again: np.ndarray) -> None:
        """Distinct hashes; ``again``: known to be repeats already."""
        at = (positions(hashes) & self.mask).astype(np.int64)
        repeated = again | self.once[at].all(axis=0)
        self.once[at.ravel()] = True
        self.twice[at[:, repeated].ravel()] = True

    def folded(self, width: int) -> np.ndarray:
        return self.twice.reshape(-1, 1 << width).any(axis=0)


def layout(n: int, folded: int | None = None) -> tuple[int, int, int]:
    """log2 of: segments for n hashes, segments and width after folding."""
    folded = FOLDED if folded is None else folded
    segments = max(0, math.ceil(math.log2(max(n, 1) / KEYS)))
    width = max(LEAST_WIDTH, min(WIDTH, folded - segments))
    return segments, min(segments, max(0, folded - width)), width


class Suspects:
    """The folded twice filter."""

    def __init__(self, bits: np.ndarray, segments: int, width: int):
        self.bits, self.segments, self.width = bits, np.uint64((1 << segments) - 1), width

    def reports(self, hashes: np.ndarray) -> np.ndarray:
        start = (hashes & self.segments).astype(np.int64) << self.width
        at = (positions(hashes) & np.uint64((1 << self.width) - 1)).astype(np.int64) + start
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _hashes(docs: DataFrame, text: str) -> DataFrame:
    """h, again: distinct hashes of keys per stretch of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []

        def reduced() -> pa.RecordBatch:
            h, n = np.unique(np.array(held, np.uint64), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(arrays.signed(h)), pa.array(n > 1)], ["h", "again"])

        for batch in batches:
            for t in _texts(batch.column(0)):
                held.extend(map(hash_of, keys_of(t)))
                if len(held) >= HELD:
                    yield reduced()
        if held:
            yield reduced()

    return docs.select(text).mapInArrow(run, "h bigint, again boolean")


def _twice(hashes: DataFrame, n: int) -> Suspects:
    """Build the filters segment by segment; collect the folded twice filter,
    of at most 2**FOLDED bits."""
    whole, segments, width = layout(n)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[int, np.ndarray] = {}  # no more than the folded filter
        at, now = -1, None

        def close() -> None:
            part = now.folded(width)
            k = at & ((1 << segments) - 1)
            done[k] = done[k] | part if k in done else part

        for batch in batches:  # ordered by segment
            seg = batch.column("segment").to_numpy()
            h = batch.column("h").to_numpy().view(np.uint64)
            again = batch.column("again").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(seg)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(seg)]):
                if lo == hi:
                    continue
                if seg[lo] != at:
                    if now is not None:
                        close()
                    at, now = int(seg[lo]), Segment()
                u, first, count = np.unique(h[lo:hi], return_index=True, return_counts=True)
                now.add(u, again[lo:hi][first] | (count > 1))
        if now is not None:
            close()
        for k, bits in done.items():
            yield pa.record_batch(
                [pa.array([k]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["k", "bits"]
            )

    def union(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in parts["bits"]])
        return pd.DataFrame({"k": [key[0]], "bits": [bits.tobytes()]})

    dealt = (
        hashes.withColumn("segment", F.col("h").bitwiseAND((1 << whole) - 1))
        .repartition("segment").sortWithinPartitions("segment")
    )
    built = dealt.mapInArrow(build, "k bigint, bits binary").groupBy("k").applyInPandas(union, "k bigint, bits binary")
    bits = np.zeros((1 << segments) * (1 << width) // 8, np.uint8)
    size = (1 << width) // 8
    for r in built.collect():
        bits[r.k * size : (r.k + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return Suspects(bits, segments, width)


# ---- documents ------------------------------------------------------------------
def _suspects(docs: DataFrame, text: str, found: Suspects) -> DataFrame:
    """doc_id, th (hash of the text), digest of each suspected key."""
    sent = docs.sparkSession.sparkContext.broadcast(found)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            row: list[int] = []
            for k, t in enumerate(_texts(batch.column("t"))):
                own = keys_of(t)
                keys.extend(own)
                row.extend([k] * len(own))
            hit = np.zeros(0, np.int64)
            if keys:
                hashes = np.fromiter(map(hash_of, keys), np.uint64, len(keys))
                hit = np.flatnonzero(sent.value.reports(hashes))
            at = pa.array(np.array(row, np.int64)[hit])
            digests = pa.array([hashlib.sha256(keys[i]).digest() for i in hit], pa.binary())
            yield pa.record_batch([batch.column("doc_id").take(at), batch.column("th").take(at), digests], ["doc_id", "th", "digest"])

    return rows.mapInArrow(run, "doc_id bigint, th bigint, digest binary")


def repeats(suspects: DataFrame) -> DataFrame:
    """digest, first: the keys of two documents or more, and the document that
    keeps them."""
    g = suspects.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("bare")
    )
    return g.where((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & F.col("bare"))).select("digest", "first")


def losses(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, th, lost: the digests of the keys that a document loses."""
    hashes = common.stored(_hashes(docs, text), "line-hashes")
    suspects = common.stored(_suspects(docs, text, _twice(hashes, hashes.count())), "line-suspects")
    # two tables side by side: Spark splits a hot digest of a join without an aggregate below it
    first = common.stored(repeats(suspects), "line-repeats")
    lost = suspects.join(first, "digest").where(~F.col("doc_id").eqNullSafe(F.col("first")))
    return lost.groupBy("doc_id", "th").agg(F.collect_set("digest").alias("lost"))


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with their texts as they stay, n_lines (before) and n_dropped."""
    names = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    rest = F.struct(*[F.col(f"`{c}`") for c in names])
    d = docs.select(F.col("doc_id").cast("bigint").alias("i"), F.xxhash64(text).alias("h"), rest.alias("rest"), F.col(text).alias("t"))
    lost = losses(docs, text)
    rows = d.join(lost, d.i.eqNullSafe(lost.doc_id) & (d.h == lost.th), "left").select("rest", "t", "lost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for t, lost in zip(_texts(batch.column("t")), batch.column("lost")):
                lines = t.split(b"\n")
                stay = lines
                if lost.is_valid:
                    gone = set(lost.as_py())
                    stay = []
                    for line in lines:
                        key = key_of(line) if len(line) >= LEAST else None
                        if key is None or hashlib.sha256(key).digest() not in gone:
                            stay.append(line)
                kept.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.record_batch(
                [batch.column("rest"), pa.array(kept, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["rest", "t", "n_lines", "n_dropped"],
            )

    schema = rows.select("rest").schema.add("t", "binary").add("n_lines", "long").add("n_dropped", "long")
    done = rows.mapInArrow(run, schema)
    columns = [
        F.col("t").cast("string").alias(c) if c == text else F.col("rest").getField(c).alias(c)
        for c in docs.columns if c in (text, *names)
    ]
    return done.select(*columns, "n_lines", "n_dropped")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the lines that stay)."""
    d = dedup(docs.select("doc_id", "text"))
    return d.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
    k AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l
    ),
    f AS (
        SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1 OR (count(doc_id) > 0 AND count(*) > count(doc_id))
    ),
    m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.first AS gone FROM k LEFT JOIN f USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY r
"""
