"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's features are its distinct hashed words (``BUCKETS`` buckets, each
with the same weight, together of length 1), its structure statistics (shares
of letter cases, digits, marks and repeats, lengths), each standardised and
also cut at quantiles into indicator features, and its declared length. All
pairs of features interact through vectors of ``RANK`` numbers, scored in
linear time: half the square of the sum less the sum of squares.

It is fitted on a bounded sample of labelled training documents by AdaGrad;
every whole text is scored. Null texts count as empty; a null declared length
is the real one. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, sampling

SAMPLE = 12_000
BUCKETS = 1 << 15
RANK = 8
BINS = 8
EPOCHS = 12
MINIBATCH = 128
THRESHOLD = 0.7
SEED = 10


def _class(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


CLASSES = {
    "upper": _class(lambda b: 65 <= b <= 90),
    "lower": _class(lambda b: 97 <= b <= 122),
    "digit": _class(lambda b: 48 <= b <= 57),
    "wide": _class(lambda b: b >= 128),
    "stop": _class(lambda b: b in b".,;:?"),
    "shout": _class(lambda b: b in b"!"),
    "bar": _class(lambda b: b in b"|"),
    "symbol": _class(lambda b: 32 < b < 127 and not chr(b).isalnum() and b not in b".,;:?!|'\"-"),
    "line": _class(lambda b: b == 10),
    "white": arrays.WHITE,
}
STATS = [
    "log_bytes", *(f"share_{k}" for k in CLASSES), "log_words", "word_bytes", "distinct_words", "top_word",
    "same_as_before", "distinct_lines", "log_declared", "declared_ratio",
]


def _repeats(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct, most frequent's count) per row, and the distinct pairs."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(r)))
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, r[first], n)
    return np.bincount(r[first], minlength=rows), top, r[first], x[first]


def features(text, declared: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, statistics, rows of words, buckets of words) by groups of rows."""
    counts = arrays.class_counts(text, list(CLASSES.values())).astype(np.float64)
    offsets, _ = arrays.buffers(text)
    size = np.diff(offsets).astype(np.float64)
    lines = arrays.words(text, arrays.LINE)
    for w in arrays.words(text, arrays.WHITE, lower=True):
        lw = next(lines)
        lo, hi, rows = w.lo, w.hi, w.rows
        n = w.per_row().astype(np.float64)
        distinct, top, r, x = _repeats(w.row, w.hash, rows)
        n_lines = lw.per_row()
        distinct_lines, _, _, _ = _repeats(lw.row, lw.hash, rows)
        same = np.zeros(rows)
        if len(w.hash) > 1:
            again = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
            same = np.bincount(w.row[1:][again], minlength=rows).astype(np.float64)
        some, bytes_ = np.maximum(n, 1), np.maximum(size[lo:hi], 1)
        word_bytes = np.bincount(w.row, w.size, minlength=rows) / some
        d = declared[lo:hi]
        d = np.where(np.isnan(d), size[lo:hi], d)
        stats = np.column_stack([
            np.log1p(size[lo:hi]), *(counts[lo:hi] / bytes_[:, None]).T, np.log1p(n), word_bytes,
            distinct / some, top / some, same / some, distinct_lines / np.maximum(n_lines, 1),
            np.log1p(np.maximum(d, 0)), np.clip(d / bytes_, 0, 2),
        ])
        yield lo, hi, stats, r, (x >> np.uint64(49)).astype(np.int64) % BUCKETS


@dataclass
class Machine:
    """Feature ids: word buckets, then statistics, then their bins."""

    mean: np.ndarray
    scale: np.ndarray
    cuts: np.ndarray  # statistics x (BINS - 1)
    bias: float
    weight: np.ndarray
    vectors: np.ndarray

    def rows(self, stats: np.ndarray, r: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) triples, by row."""
        return triples(stats, r, buckets, self.mean, self.scale, self.cuts)

    def logits(self, row: np.ndarray, feat: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        linear = np.bincount(row, self.weight[feat] * value, minlength=rows)
        xv = self.vectors[feat] * value[:, None]
        sums, squares = np.zeros((rows, RANK)), np.zeros((rows, RANK))
        for k in range(RANK):
            sums[:, k] = np.bincount(row, xv[:, k], minlength=rows)
            squares[:, k] = np.bincount(row, xv[:, k] ** 2, minlength=rows)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)


def triples(stats, r, buckets, mean, scale, cuts):
    rows, m = stats.shape
    z = np.clip((stats - mean) / scale, -4, 4)
    bins = (stats[:, :, None] > cuts[None, :, :]).sum(axis=2)
    n = np.maximum(np.bincount(r, minlength=rows), 1)
    at = np.repeat(np.arange(rows), m)
    row = np.concatenate([r, at, at])
    feat = np.concatenate([
        buckets, np.tile(BUCKETS + np.arange(m), rows), (BUCKETS + m + np.arange(m) * BINS + bins).ravel()
    ])
    value = np.concatenate([1 / np.sqrt(n[r]), z.ravel() * 0.3, np.full(rows * m, 0.3)])
    return row, feat, value


def train(stats: np.ndarray, words: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Machine:
    m = stats.shape[1]
    if not len(y):
        size = BUCKETS + m + m * BINS
        return Machine(np.zeros(m), np.ones(m), np.zeros((m, BINS - 1)), 0.0, np.zeros(size), np.zeros((size, RANK)))
    mean, scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
    cuts = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    size = BUCKETS + m + m * BINS
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    fm = Machine(mean, scale, cuts, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), MINIBATCH):
            ids = order[a : a + MINIBATCH]
            r = np.repeat(np.arange(len(ids)), [len(words[i]) for i in ids])
            b = np.concatenate([words[i] for i in ids])
            row, feat, value = fm.rows(stats[ids], r, b)
            d = 1 / (1 + np.exp(-np.clip(fm.logits(row, feat, value, len(ids)), -30, 30))) - y[ids]
            xv = fm.vectors[feat] * value[:, None]
            sums = np.zeros((len(ids), RANK))
            for k in range(RANK):
                sums[:, k] = np.bincount(row, xv[:, k], minlength=len(ids))
            used, back = np.unique(feat, return_inverse=True)
            dv = d[row] * value
            grad_w = np.bincount(back, dv, minlength=len(used)) / len(ids) + 1e-5 * fm.weight[used]
            part = dv[:, None] * (sums[row] - xv)
            grad_v = np.column_stack([np.bincount(back, part[:, k], minlength=len(used)) for k in range(RANK)])
            grad_v = grad_v / len(ids) + 1e-4 * fm.vectors[used]
            g = d.mean()
            gw[used] += grad_w**2
            gv[used] += grad_v**2
            gb += g * g
            fm.weight[used] -= 0.1 * grad_w / np.sqrt(gw[used])
            fm.vectors[used] -= 0.03 * grad_v / np.sqrt(gv[used])
            fm.bias -= 0.1 * g / np.sqrt(gb)
    return fm


def _declared(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = 0
    for batch in batches:
        for lo, hi, stats, r, b in features(batch.column("text"), _declared(batch)):
            cut = np.concatenate(([0], np.cumsum(np.bincount(r, minlength=hi - lo))))
            words = [np.unique(b[cut[k] : cut[k + 1]]).astype(np.int32) for k in range(hi - lo)]
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(lo, hi - lo), pa.array(np.arange(row, row + hi - lo)),
                    batch.column("label").slice(lo, hi - lo), pa.array(list(stats), pa.list_(pa.float64())),
                    pa.array(words, pa.list_(pa.int32())),
                ],
                ["doc_id", "row", "label", "stats", "words"],
            )
            row += hi - lo


def _rows(docs: DataFrame, *more) -> DataFrame:
    declared = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", declared.alias("n_chars"), *more)


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    slim = _rows(docs)
    drawn = sampling.labelled(slim, labels, "quality", SAMPLE, SEED, keep=["n_chars"])
    found = drawn.mapInArrow(
        _sample_features, "doc_id bigint, row bigint, label int, stats array<double>, words array<int>"
    )
    t = sampling.collected(found)
    if not t.num_rows:
        return train(np.zeros((0, len(STATS))), [], np.zeros(0))
    stats = np.array(t.column("stats").to_pylist())
    words = [np.asarray(x.values.to_numpy(), np.int64) for x in t.column("words")]
    return train(stats, words, t.column("label").to_numpy().astype(np.float64))


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        for batch in batches:
            for lo, hi, stats, r, b in features(batch.column("text"), _declared(batch)):
                z = fm.logits(*fm.rows(stats, r, b), hi - lo)
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), pa.array(score)], ["doc_id", "score"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    s = scores(docs, fit(docs, labels))
    return s.select(
        "doc_id",
        (common.fold("doc_id", sampling.FOLDS) == sampling.HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
