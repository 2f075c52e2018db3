"""Language-model scores from Brown class-based bigrams.

Exchange clustering assigns a class to every word of the table of frequent
words that occurs at least ``OFTEN`` times, in two steps:

1. The ``HOT`` most frequent words, the end of a text and ``GROUPS`` groups of
   all other words (by their last bytes and length) are exchanged one after
   another on the driver; their bigrams number at most (HOT + GROUPS + 1) ** 2
   whatever the corpus holds.
2. The other words start in the class of their group and are then exchanged one
   by one in Spark tasks, each with its own bigrams: a word goes to the class
   that raises the likelihood most under the class table of the round. A round
   moves one half of the words, and the last one is undone if it lowered the
   likelihood; rounds end when two in a row gain less than ``LEAST_GAIN``. A
   task reads the bigrams of the round's half only, and looks up what small
   counts gain in a table of its own.

Bigrams are counted inside each task, dealt as packed arrays to shards of
words and added up there, so the shuffle has a row per task and shard. A shard
holds its distinct bigrams only; the number of shards grows with the shuffle
partitions.

Words below ``OFTEN``, beyond the table or never seen keep the class of their
group, so every word has one.

A token's probability is p(class | class before) * p(word | class); the first
is smoothed towards the class frequencies, the second adds one to each word of
the class and to a slot for unseen words.

Counts cover every training text. Words are counted by 64-bit hashes, first
inside each task, then over the shuffle. The table of the most frequent words
(at most ``TABLE``) goes to every task, and the counts of the others are
joined to the words of the texts that lack them.

Null texts count as empty (one end token). Rows that repeat an id are scored
one by one, and count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

HOT = 767
GROUPS = 256
UNITS = HOT + 1 + GROUPS
END = HOT
TABLE = 1 << 18
CLASSES = 128
SWEEPS = 8
OFTEN = 3  # occurrences from which a word is exchanged by itself
ROUNDS = 12  # most rounds over halves of the words
LEAST_GAIN = 1e-3  # nats a token
PACK = 1 << 13  # bigrams a row of packed counts holds, of whole words if these are exchanged in tasks
STEPS = 32  # counts up to which the gain of a count is looked up
CHUNK = 128  # words whose gains a task computes at once
BETA = 50.0  # weight of the class frequencies in a transition
KEPT = 1 << 20  # distinct words a task holds before it passes them on

EXTRAS = {
    "ending": lambda p: ((p.byte(1) * np.uint64(31) + p.byte(2)) * np.uint64(31)
                         + np.minimum(p.end - p.start, 12).astype(np.uint64) // np.uint64(3)) % np.uint64(GROUPS)
}


def _words(col) -> Iterator[arrays.Words]:
    return arrays.words(col, arrays.WHITE, lower=True, extras=EXTRAS)


# ---- counts ---------------------------------------------------------------------
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size, docs = 0, 0

    def emit(parts) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(parts[0]), 1 << 16):
            h, n, g = (x[i : i + (1 << 16)] for x in parts)
            yield pa.record_batch([pa.array(arrays.signed(h)), pa.array(g.astype(np.int32)), pa.array(n)], ["hash", "ending", "n"])

    def merged() -> tuple:
        h, n, g = (np.concatenate([p[i] for p in held]) for i in range(3))
        keys, total, ends = arrays.merge_counts(h, n, g * n)
        return keys, total, ends // np.maximum(total, 1)

    for batch in batches:
        docs += batch.num_rows
        for w in _words(batch.column(0)):
            keys, at, n = np.unique(w.hash, return_index=True, return_counts=True)
            held.append((keys, n, w.more["ending"][at].astype(np.int64)))
            size += len(keys)
            if size > 2 * KEPT:
                held = [merged()]
                size = len(held[0][0])
                if size > KEPT:
                    yield from emit(held.pop())
                    size = 0
    if held:
        yield from emit(merged())
    # the end tokens of this task's texts, under a group of their own
    yield pa.record_batch(
        [pa.array([0], pa.int64()), pa.array([-1], pa.int32()), pa.array([docs], pa.int64())], ["hash", "ending", "n"]
    )


def count_words(texts: DataFrame) -> DataFrame:
    """(hash, ending, n) of the words of ``text``; ending -1 counts the texts."""
    parts = texts.select("text").mapInArrow(_count, "hash bigint, ending int, n bigint")
    return parts.groupBy("ending", "hash").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hashes, counts and endings of at most ``TABLE`` words, most frequent
    first, and the smallest count bucket among them.

    The cut comes from a histogram over sixteenths of powers of two, so
    nothing is sorted; a bucket is taken whole or not at all.
    """
    bucket = F.floor(F.log2("n") * 16).cast("int")
    hist = words.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("k")).collect()
    least, total = 1 << 20, 0
    for b, k in sorted(((r.b, r.k) for r in hist), reverse=True):
        if total + k > TABLE:
            break
        least, total = b, total + k
    top = words.where(bucket >= least).select("hash", "n", "ending").toArrow()
    h, n, g = (top.column(c).to_numpy() for c in ("hash", "n", "ending"))
    order = np.lexsort((h, -n))
    return h[order].astype(np.int64).view(np.uint64), n[order].astype(np.int64), g[order].astype(np.int64), least


class Lookup:
    """Word hash to position in a table."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at], -1)


def _with_ends(w: arrays.Words, units: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit sequence of the rows with an end after each, and each one's row."""
    n = w.per_row()
    ends = np.cumsum(n + 1) - 1
    seq = np.empty(len(units) + w.rows, np.int64)
    rows = np.repeat(np.arange(w.rows), n + 1)
    is_word = np.ones(len(seq), bool)
    is_word[ends] = False
    seq[is_word] = units
    seq[ends] = end
    return seq, rows


class Units:
    """Numbers of the words that are exchanged (positions in the table of
    frequent words), the end of a text, and the groups of all others."""

    def __init__(self, hashes: np.ndarray, endings: np.ndarray):
        self.hashes, self.endings = hashes, endings
        self.end = len(hashes)
        self.size = len(hashes) + 1 + GROUPS
        self.hot = min(HOT, len(hashes))

    def of(self, w: arrays.Words, known: Lookup) -> np.ndarray:
        at = known(w.hash)
        return np.where(at >= 0, at, self.end + 1 + w.more["ending"].astype(np.int64))

    def coarse(self) -> np.ndarray:
        """Of each unit: itself if hot, the end, or its group, as numbers below
        ``UNITS``."""
        groups = np.concatenate((self.endings, [-1], np.arange(GROUPS)))
        out = HOT + 1 + groups
        out[: self.hot] = np.arange(self.hot)
        out[self.end] = END
        return out


PACKED = "half int, after binary, after_n binary, before binary, before_n binary"


def _sums(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by key, in the order of the keys."""
    if len(held) == 1:
        keys, n = held[0]
        if (keys[1:] < keys[:-1]).any():  # those before a word come as the words before them did
            order = np.argsort(keys, kind="stable")
            return keys[order], n[order]
        return held[0]
    return arrays.merge_counts(*(np.concatenate([h[i] for h in held]) for i in range(2)))


def _raw(x: np.ndarray, dtype) -> bytes:
    return x.astype(dtype).tobytes()


def _unpacked(batch: pa.RecordBatch, keys: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the packed rows of a batch, end to end."""
    return tuple(
        np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64) for c in (keys, f"{keys}_n")
    )


def bigrams(texts: DataFrame, units: Units) -> DataFrame:
    """Bigrams of units as packed rows: keys ``word * units.size + other`` and
    counts of the units that follow (``after``) and precede (``before``) some
    words; an end precedes each first word. The words exchanged in tasks have
    all theirs in one row, of one ``half`` (odd or even words); the other units
    only ``after``, with half -1."""
    size, spark = units.size, texts.sparkSession
    shards = 4 * common.partitions(spark)  # even: a shard's words are of one half

    def dealt(keys: np.ndarray, n: np.ndarray, is_after: bool) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        shard = (keys // size) % shards
        order = np.argsort(shard.astype(np.int32), kind="stable")
        shard, keys, n = shard[order], keys[order], n[order]
        cut = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True])))
        rows = list(zip(cut[:-1], cut[1:]))
        for i in range(0, len(rows), 64):
            part = rows[i : i + 64]
            yield pa.record_batch(
                [
                    pa.array([int(shard[a]) for a, _ in part], pa.int32()),
                    pa.array([is_after] * len(part)),
                    pa.array([_raw(keys[a:b], np.int64) for a, b in part], pa.binary()),
                    pa.array([_raw(n[a:b], np.int64) for a, b in part], pa.binary()),
                ],
                ["shard", "is_after", "key", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, held_size = Lookup(units.hashes), [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            yield from dealt(keys, n, True)
            u, v = keys // size, keys % size
            own = (v >= units.hot) & (v < units.end)
            yield from dealt(v[own] * size + u[own], n[own], False)

        for batch in batches:
            for w in _words(batch.column(0)):
                seq, _ = _with_ends(w, units.of(w, known), units.end)
                held.append(np.concatenate(([units.end], seq[:-1])) * size + seq)
                held_size += len(seq)
                if held_size > 2 * KEPT:
                    yield from emit()
                    held, held_size = [], 0
        if held:
            yield from emit()

    def rows_of(sides: dict[bool, list[tuple]]) -> Iterator[tuple]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        after, before = (_sums(sides[x]) if sides[x] else none for x in (True, False))
        # a cut between words, in either list, once a row is full; the units
        # that are not exchanged here are cut anywhere
        word = after[0] // size
        own = (word >= units.hot) & (word < units.end)
        for k in range(0, int((~own).sum()), PACK):
            yield -1, *(x[~own][k : k + PACK] for x in after), *none
        after = tuple(x[own] for x in after)
        words, n = arrays.merge_counts(
            np.concatenate((after[0] // size, before[0] // size)), np.ones(len(after[0]) + len(before[0]), np.int64)
        )
        if not len(words):
            return
        row = np.cumsum(n) // PACK
        low = words[np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))] * size
        cuts = [np.append(np.searchsorted(x[0], low), len(x[0])) for x in (after, before)]
        for k in range(len(low)):
            yield int(words[0] % 2), *(x[c[k] : c[k + 1]] for side, c in zip((after, before), cuts) for x in side)

    def packed(sides: dict[bool, list[tuple]]) -> Iterator[pa.RecordBatch]:
        rows = [(half, *(_raw(x, np.int64) for x in r)) for half, *r in rows_of(sides)]
        for i in range(0, len(rows), 32):
            cols = list(zip(*rows[i : i + 32]))
            yield pa.record_batch(
                [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                ["half", "after", "after_n", "before", "before_n"],
            )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, new = None, {True: [], False: []}, 0
        for batch in batches:
            for shard, side, key, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "is_after", "key", "n"))):
                if shard != now:
                    yield from packed(sides)
                    now, sides, new = shard, {True: [], False: []}, 0
                sides[side].append((np.frombuffer(key, np.int64), np.frombuffer(n, np.int64)))
                new += len(sides[side][-1][0])
                if new > max(KEPT, 2 * sum(len(x[0][0]) for x in sides.values() if x)):
                    sides, new = {k: [_sums(x)] if x else [] for k, x in sides.items()}, 0
        yield from packed(sides)

    parts = texts.select("text").mapInArrow(count, "shard int, is_after boolean, key binary, n binary")
    by_shard = parts.repartition(common.partitions(spark), "shard").sortWithinPartitions("shard")
    return by_shard.mapInArrow(add_up, PACKED)


def tally(pairs: DataFrame, units: Units, of: np.ndarray, size: int) -> np.ndarray:
    """size x size sums of the bigrams' counts by ``of`` their units."""
    shared = pairs.sparkSession.sparkContext.broadcast(of)
    base = units.size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = shared.value, np.zeros(size * size)
        for batch in batches:
            key, n = _unpacked(batch, "after")
            total += np.bincount(of[key // base] * size + of[key % base], n, minlength=size * size)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(total[part].astype(np.int64))], ["pair", "n"])

    sums = pairs.select("after", "after_n").mapInArrow(count, "pair bigint, n bigint")
    got = sums.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    shared.unpersist()
    return out.reshape(size, size)


# ---- exchange clustering ----------------------------------------------------------
def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS, fixed: int = END) -> np.ndarray:
    """Class of each unit: units move, most frequent first, to the class that
    raises the bigram likelihood of the classes most, until none moves. The
    unit ``fixed`` keeps the last class to itself."""
    size = len(bigrams)
    freq = bigrams.sum(0) + bigrams.sum(1)
    order = [u for u in np.argsort(-freq, kind="stable") if u != fixed]
    of = np.zeros(size, np.int64)
    of[order] = np.arange(len(order)) % (classes - 1)
    of[fixed] = classes - 1
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    to, frm = bigrams @ member, bigrams.T @ member  # unit to class, class to unit
    table = member.T @ to
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not freq[u]:
                continue
            a, own = of[u], bigrams[u, u]
            right, left = to[u].copy(), frm[u].copy()
            right[a] -= own
            left[a] -= own
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= own
            rows, cols = table.sum(1), table.sum(0)
            now = _f(table)
            gain = (_f(table + right) - now).sum(1) + (_f(table.T + left) - now.T).sum(1)
            diag = np.diag(table)
            gain -= _f(diag + right) + _f(diag + left) - 2 * _f(diag)
            gain += _f(diag + right + left + own) - _f(diag)
            gain -= _f(rows + right.sum() + own) - _f(rows) + _f(cols + left.sum() + own) - _f(cols)
            gain[classes - 1] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += right
            table[:, b] += left
            table[b, b] += own
            if b != a:
                moved += 1
                of[u] = b
                to[:, a] -= bigrams[:, u]
                to[:, b] += bigrams[:, u]
                frm[:, a] -= bigrams[u]
                frm[:, b] += bigrams[u]
        if not moved:
            break
    return of


def steps_of(table: np.ndarray) -> np.ndarray:
    """[x - 1, c, b]: what ``_f(table[b, c])`` gains by x more bigrams, for x
    up to ``STEPS``: words share these, so each is computed once."""
    x = np.arange(1.0, STEPS + 1)[:, None, None]
    return _f(table.T + x) - _f(table.T)


def gains(
    table: np.ndarray, of: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray,
    steps: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """words x classes: the likelihood with each word taken out of its class
    ``of`` and put into every class, beside the one without it. ``after`` and
    ``before`` count the word's bigrams with each class, without its bigrams
    with itself, which are ``own``; ``table`` holds all bigrams of classes, and
    ``steps`` is ``steps_of`` it and its transpose."""
    steps = steps or (steps_of(table), steps_of(table.T))
    out = np.zeros(after.shape)
    for mine, other, t, step in ((after, before, table, steps[0]), (before, after, table.T, steps[1])):
        i, c = np.nonzero(mine)
        if not len(i):
            continue
        x, a = mine[i, c], of[i]
        part = step[np.minimum(x, STEPS).astype(np.int64) - 1, c]
        same = c == a
        k = np.flatnonzero((x > STEPS) & ~same)
        part[k] = _f(t.T[c[k]] + x[k, None]) - _f(t.T)[c[k]]
        # the class table without the word, where that matters
        k = np.flatnonzero(same)
        base = t.T[c[k]] - other[i[k]]
        base[np.arange(len(k)), a[k]] = 0  # set below
        part[k] = _f(base + x[k, None]) - _f(base)
        rest = t[a, c] - x - np.where(same, other[i, a] + own[i], 0)
        part[np.arange(len(i)), a] = _f(rest + x) - _f(rest)
        first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
        out[i[first]] += np.add.reduceat(part, first, axis=0)
    # bigrams of a class with itself gain both sides at once
    i, c = np.nonzero(after + before + own[:, None])
    x, y, z = after[i, c], before[i, c], own[i]
    diag = np.diag(table)[c] - np.where(c == of[i], x + y + z, 0)
    out[i, c] += _f(diag + x + y + z) - _f(diag + x) - _f(diag + y) + _f(diag)
    for sums, mine in ((table.sum(1), after), (table.sum(0), before)):
        whole = mine.sum(1) + own
        sizes, at = np.unique(whole, return_inverse=True)
        more = (_f(sums + sizes[:, None]) - _f(sums))[at]
        more[np.arange(len(of)), of] = _f(sums[of]) - _f(sums[of] - whole)
        out -= more
    return out


def likelihood(table: np.ndarray) -> float:
    return float(_f(table).sum() - _f(table.sum(1)).sum() - _f(table.sum(0)).sum())


def _by_class(
    word: np.ndarray, unit: np.ndarray, n: np.ndarray, words: np.ndarray, of: np.ndarray, classes: int
) -> tuple[np.ndarray, np.ndarray]:
    """words x classes counts of bigrams, and each word's with itself."""
    row, self_ = np.searchsorted(words, word), unit == word
    counts = np.bincount(row * classes + of[unit], np.where(self_, 0, n), minlength=len(words) * classes)
    return counts.reshape(len(words), classes), np.bincount(row, np.where(self_, n, 0), minlength=len(words))


def exchange_words(
    pairs: DataFrame, units: Units, of: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units after the words exchanged in tasks have moved, and
    the class table. The last class is the end's own."""
    base = units.size

    def moves(shared, half: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (of, table), steps = shared.value, None
            for batch in batches:
                steps = steps or (steps_of(table), steps_of(table.T))
                for row in zip(*(batch.column(c).to_pylist() for c in ("after", "after_n", "before", "before_n"))):
                    # all bigrams of some words, ordered by word
                    keys, counts = ([np.frombuffer(x, np.int64) for x in row[k::2]] for k in range(2))
                    owners = [key // base for key in keys]
                    lists = [(w, key - w * base, n) for w, key, n in zip(owners, keys, counts)]
                    all_words = np.unique(np.concatenate(owners))
                    for i in range(0, len(all_words), CHUNK):
                        words = all_words[i : i + CHUNK]
                        at = [np.searchsorted(w, (words[0], words[-1] + 1)) for w in owners]
                        (after, own), (before, _) = (
                            _by_class(*(x[a:b] for x in side), words, of, classes) for side, (a, b) in zip(lists, at)
                        )
                        gain = gains(table, of[words], after, before, own, steps)
                        gain[:, -1] = -np.inf
                        to = gain.argmax(1)
                        k = np.arange(len(words))
                        better = gain[k, to] > gain[k, of[words]] + 1e-9
                        yield pa.record_batch([pa.array(words[better]), pa.array(to[better])], ["word", "to"])

        mine = pairs.where(F.col("half") == half).select("after", "after_n", "before", "before_n")
        return mine.mapInArrow(run, "word bigint, to bigint")

    table = tally(pairs, units, of, classes)
    still = 0
    for r in range(rounds):
        shared = pairs.sparkSession.sparkContext.broadcast((of, table))
        moved = moves(shared, r % 2).toArrow()
        shared.unpersist()
        new = of.copy()
        new[moved.column("word").to_numpy()] = moved.column("to").to_numpy()
        new_table = tally(pairs, units, new, classes) if moved.num_rows else table
        gain = likelihood(new_table) - likelihood(table)
        if gain < 0:
            break
        of, table = new, new_table
        still = still + 1 if gain <= LEAST_GAIN * table.sum() else 0
        if still == 2:
            break
    return of, table


class Model:
    """What a task needs to score texts, apart from rare words' counts."""

    def __init__(self, words: DataFrame, texts: DataFrame):
        real = words.where("ending >= 0")
        stats = words.groupBy("ending").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()
        self.docs = sum(r.n for r in stats if r.ending < 0)
        h, n, g, self.least = frequent(real)
        self.hashes, self.counts = h, n
        cut = int((n >= OFTEN).sum())  # most frequent first
        self.units = units = Units(h[:cut], g[:cut])
        unit_n, unit_v = np.zeros(units.size), np.zeros(units.size)
        for r in stats:
            if r.ending >= 0:
                unit_n[units.end + 1 + r.ending] += r.n
                unit_v[units.end + 1 + r.ending] += r.v
        np.subtract.at(unit_n, units.end + 1 + g[:cut], n[:cut])
        np.subtract.at(unit_v, units.end + 1 + g[:cut], 1)
        unit_n[:cut], unit_v[:cut] = n[:cut], 1
        unit_n[units.end], unit_v[units.end] = self.docs, 1 if self.docs else 0
        self.tokens, self.distinct = int(unit_n.sum()), int(unit_v.sum())
        self.exchanged = int(n[:cut].sum())
        pairs = common.stored(bigrams(texts, units), "bigrams")
        coarse = units.coarse()
        of = exchange(tally(pairs, units, coarse, UNITS))[coarse]
        self.of, table = exchange_words(pairs, units, of)
        per_class = np.bincount(self.of, unit_n, minlength=CLASSES)
        share = (per_class + 1) / (self.tokens + CLASSES)
        trans = (table + BETA * share) / (table.sum(1, keepdims=True) + BETA)
        self.trans = np.log10(trans)
        self.room = np.log10(per_class + np.bincount(self.of, unit_v, minlength=CLASSES) + 1)


SCORED = (
    "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
    "rare array<bigint>, times array<int>"
)


def _score(model) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        table, exchanged = Lookup(m.hashes), Lookup(m.units.hashes)
        logs = np.log10(m.counts + 1.0)
        whole = np.log10(m.tokens + m.distinct + 1.0)
        end_known, end_log = int(m.docs > 0), np.log10(m.docs + 1.0)
        for batch in batches:
            rid, ids, held = (batch.column(c) for c in ("rid", "doc_id", "held_out"))
            for w in _words(batch.column("text")):
                keys, back = np.unique(w.hash, return_inverse=True)
                at = table(keys)[back]
                seq, rows = _with_ends(w, m.units.of(w, exchanged), m.units.end)
                cls = m.of[seq]
                before = np.concatenate(([m.of[m.units.end]], cls[:-1]))
                local = np.bincount(rows, m.trans[before, cls] - m.room[cls], minlength=w.rows)
                in_table = at >= 0
                top = np.bincount(w.row[in_table], logs[at[in_table]], minlength=w.rows) + end_log
                known = np.bincount(w.row[in_table], minlength=w.rows) + end_known
                n = w.per_row() + 1
                # the other words, once per row
                r, h = w.row[~in_table], w.hash[~in_table]
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(r))).astype(np.int32)
                off = np.concatenate(([0], np.cumsum(np.bincount(r[first], minlength=w.rows)))).astype(np.int32)
                yield pa.record_batch(
                    [
                        *(c.slice(w.lo, w.rows) for c in (rid, ids, held)),
                        pa.array(n), pa.array(known), pa.array(top - n * whole), pa.array(top + local),
                        pa.ListArray.from_arrays(pa.array(off), pa.array(arrays.signed(h[first]))),
                        pa.ListArray.from_arrays(pa.array(off), pa.array(times)),
                    ],
                    ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "times"],
                )

    return run


def score(docs: DataFrame, train_fold: int = 7, out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity per row of ``docs``."""
    spark = docs.sparkSession
    out = common.fold("doc_id", train_fold) == out_fold
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out.alias("held_out"), "text")
    train = texts.where(~F.col("held_out"))
    words = common.stored(count_words(train), "word-counts")
    model = Model(words, train)
    shared = spark.sparkContext.broadcast(model)
    # numbered where they are read: a task of the stored table runs several partitions
    numbered = texts.withColumn("rid", F.monotonically_increasing_id())
    scored = common.stored(numbered.mapInArrow(_score(shared), SCORED), "word-scores")
    pairs = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    pairs = pairs.select("rid", F.col("w.rare").alias("hash"), F.col("w.times").alias("times"))
    others = words.where((F.col("ending") >= 0) & (F.floor(F.log2("n") * 16) < model.least)).select("hash", "n")
    rest = (
        pairs.join(others, "hash")
        .groupBy("rid")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("also"))
    )
    more = F.coalesce(F.col("more"), F.lit(0.0))
    total = F.col("score") + more
    return scored.drop("rare", "times").join(rest, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce(F.col("also"), F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
