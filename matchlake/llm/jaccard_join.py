"""Self-join of texts on n-gram Jaccard similarity, by chosen paths.

A text is its set of ``N``-word runs (texts of fewer words: one run of all of
them; texts without words match nothing). Texts with equal sets form one
class, and the classes are joined:

1. every class has ``SAMPLES`` minhash tokens. In each of ``RUNS`` runs the
   classes start in one node; at a node, ``FANOUT`` positions are drawn by the
   node's hash and each class goes on to the child named by its token there.
   Two classes stay together at one draw with the probability of their
   similarity, so with two draws a pair at 0.8 survives any depth with
   probability 0.9375 or more, and all runs miss it with about 2e-5;
2. children of one class end; children of at most ``SMALL`` classes, or of over
   half their parent, are leaves; others are split again, down to ``DEPTH``.
   Leaves still larger are cut into blocks, and every pair of blocks is a task unit of its own: no
   leaf meets whole in one task;
3. in a leaf (or pair of blocks) all pairs are compared, first on their
   tokens, then on their whole sets. A pair is counted in its first common
   leaf only, which both sides can tell from their lists of leaves; so numbers
   of links are summed without ever writing pairs. A leaf passes on one edge
   per linked class;
4. groups are the connected components of the edges (labels are lowered over
   edges and then over labels until nothing changes).

Texts are shuffled once, to fetch the sets of classes that have a candidate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays, common

N = 5
LEAST = 0.8
SAMPLES = 64
RUNS = 4
FANOUT = 2
SMALL = 128
DEPTH = 3
BLOCK = 1024
SLACK = 0.25  # tokens that agree may fall short of LEAST by this share
LABELS = 1 << 20  # rows of a file of labels
SEED = 6

_rng = np.random.default_rng(SEED)
_MUL = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_STEP = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(N)]


# ---- sets -----------------------------------------------------------------------
def shingles(w: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the runs of N words of one text."""
    if not len(w):
        return w
    n = max(1, len(w) - N + 1)
    x = np.zeros(n, np.uint64)
    for k in range(min(N, len(w))):
        x += w[k : k + n] * _STEP[k]
    return np.unique(arrays.mix(x))


def tokens(s: np.ndarray) -> np.ndarray:
    """SAMPLES minhash tokens of a set."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        np.minimum(best, (low[i : i + 4096, None] * _MUL + _ADD).min(axis=0), out=best)
    return best.view(np.int32)


def _set_key(s: np.ndarray) -> bytes:
    twice = arrays.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    size = np.uint64(len(s))
    ends = np.array([s.sum(dtype=np.uint64) + size, twice.sum(dtype=np.uint64) ^ size], np.uint64)
    return arrays.mix(ends).tobytes()


def _sets(col) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of each row of a text column, in order."""
    for w in arrays.words(col):
        cut = np.concatenate(([0], np.cumsum(w.per_row())))
        for r in range(w.rows):
            yield w.lo + r, shingles(w.hash[cut[r] : cut[r + 1]])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sigs = [], []
        for _, s in _sets(batch.column("text")):
            keys.append(_set_key(s) if len(s) else None)
            sigs.append(tokens(s) if len(s) else None)
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("th"), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
            ["doc_id", "th", "cid", "sig"],
        )


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.tobytes() for _, s in _sets(batch.column("text"))]
        yield pa.record_batch([batch.column("cid"), pa.array(sets, pa.binary())], ["cid", "whole"])


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, th (hash of the text), cid (class, null without
    words), sig (its tokens)."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text"
    )
    return rows.mapInArrow(_signatures, "doc_id bigint, th bigint, cid binary, sig array<int>")


# ---- chosen paths ------------------------------------------------------------------
def _children(rows: DataFrame) -> DataFrame:
    """(cid, up, node) one level down, from (cid, up, node, sig); up is the
    number of classes in the parent."""

    def child(s: int):
        at = F.pmod(F.xxhash64(F.col("node"), F.lit(s)), F.lit(SAMPLES)).cast("int")
        return F.xxhash64(F.col("node"), F.lit(s), F.element_at("sig", at + 1))

    return rows.select("cid", "up", F.explode(F.array(*[child(s) for s in range(FANOUT)])).alias("node"))


def leaves(classes: DataFrame) -> DataFrame:
    """(cid, node, n): the leaves of at least two classes."""
    roots = F.array(*[F.xxhash64(F.lit(SEED), F.lit(r)) for r in range(RUNS)])
    everything = F.lit(None).cast("bigint").alias("up")
    rows = _children(classes.select("cid", "sig", everything, F.explode(roots).alias("node")))
    out = []
    for depth in range(1, DEPTH + 1):
        size = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        here = common.stored(rows.join(size, "node"), f"nodes-{depth}")
        if depth == DEPTH:
            out.append(here)
            break
        # a child with over half its parent is one cluster: no use to split it
        tight = F.coalesce(F.col("n") * 2 > F.col("up"), F.lit(False))
        out.append(here.where((F.col("n") <= SMALL) | tight))
        large = here.where((F.col("n") > SMALL) & ~tight)
        if large.isEmpty():
            break
        below = large.select("cid", "node", F.col("n").alias("up")).join(classes.select("cid", "sig"), "cid")
        rows = _children(below)
    all_ = out[0]
    for more in out[1:]:
        all_ = all_.unionByName(more)
    return all_.select("cid", "node", "n")


def _units(rows: DataFrame) -> DataFrame:
    """Rows of leaves dealt to units (node, i, j) of one or two blocks; side
    tells the row's block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("g", blocks).withColumn(
        "side", F.pmod(F.xxhash64("cid", "node"), F.col("g")).cast("int")
    )
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return rows.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("g", "other", "n")


def _by_unit(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work`` on the rows of each unit, units in a stream: rows of a
    unit lie side by side after a sort, and only one unit is held."""
    keys = ["node", "i", "j"]
    dealt = rows.repartition(common.partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "cid")
    names = dealt.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        held_key = None
        out: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            k = np.stack([table.column(c).to_numpy().astype(np.int64) for c in keys])
            cut = np.concatenate(([0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [table.num_rows]))
            for a, b in zip(cut[:-1], cut[1:]):
                key = tuple(k[:, a])
                if held and key != held_key:
                    out.append(work(held_key, held))
                    held = []
                held_key = key
                held.append(table.slice(a, b - a))
            if len(out) > 256:
                yield from _flush(out)
                out = []
        if held:
            out.append(work(held_key, held))
        yield from _flush(out)

    def _flush(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        full = [p for p in parts if p is not None]
        if full:
            yield from pa.concat_tables(full).combine_chunks().to_batches()

    assert set(keys) <= set(names)
    return dealt.mapInArrow(run, schema)


def _together(held: list[pa.Table]) -> pa.Table:
    return (pa.concat_tables(held) if len(held) > 1 else held[0]).combine_chunks()


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, owner) of a list column."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = arr.offsets.to_numpy()
    values = arr.values.to_numpy()[off[0] : off[-1]]
    return values, np.repeat(np.arange(len(arr)), np.diff(off))


def _overlap(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x n counts of shared values; each owner's values are distinct."""
    out = np.zeros((n, n), np.float32)
    if not len(values):
        return out
    order = np.argsort(values, kind="stable")
    v, o = values[order], owner[order]
    new = np.concatenate(([True], v[1:] != v[:-1]))
    col = np.cumsum(new) - 1
    shared = np.bincount(col) > 1
    keep = shared[col]
    o, col = o[keep], (np.cumsum(shared) - 1)[col[keep]]
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
        a, b = np.searchsorted(col, (c, c + 4096))
        part = np.zeros((n, int(col[b - 1]) - c + 1), np.float32)
        part[o[a:b], col[a:b] - c] = 1
        out += part @ part.T
    return out


def _pairs_here(t: pa.Table, key: tuple) -> np.ndarray:
    """n x n: the pair belongs to this unit, and this node is its first common
    leaf."""
    node, i, j = key
    n = t.num_rows
    side = t.column("side").to_numpy()
    ok = np.triu(np.ones((n, n), bool), 1)
    if i != j:
        ok &= side[:, None] != side[None, :]
    values, owner = _flat(t.column("leaves"))
    before = values < node
    return ok & (_overlap(values[before], owner[before], n) == 0)


def _candidates(key: tuple, held: list[pa.Table]):
    t = _together(held)
    n = t.num_rows
    if n < 2:
        return None
    sig = _flat(t.column("sig"))[0].reshape(n, SAMPLES)
    near = np.zeros((n, n), bool)
    least = (LEAST - SLACK) * SAMPLES
    for a in range(0, n, 64):
        near[a : a + 64] = (sig[a : a + 64, None, :] == sig[None, :, :]).sum(axis=2) >= least
    near = np.triu(near, 1)
    if not near.any():
        return None
    near &= _pairs_here(t, key)
    mine = near.any(axis=0) | near.any(axis=1)
    return t.select(["node", "i", "j", "side", "cid"]).filter(pa.array(mine)) if mine.any() else None


def _links(key: tuple, held: list[pa.Table]):
    t = _together(held)
    n = t.num_rows
    if n < 2:
        return None
    whole = [np.frombuffer(x, np.uint64) for x in t.column("whole").to_pylist()]
    size = np.array([len(x) for x in whole], np.float64)
    both = _overlap(np.concatenate(whole), np.repeat(np.arange(n), size.astype(np.int64)), n).astype(np.float64)
    union = size[:, None] + size[None, :] - both
    linked = (both >= LEAST * union - 1e-9) & _pairs_here(t, key)
    linked |= linked.T
    if not linked.any():
        return None
    copies = t.column("copies").to_numpy()
    cids = t.column("cid").to_pylist()
    root = np.arange(n)
    while True:  # lowest member reached, cids are in order
        low = np.minimum(root, np.where(linked, root[None, :], n).min(axis=1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    mine = np.flatnonzero(linked.any(axis=1))
    return pa.table({
        "cid": pa.array([cids[k] for k in mine], pa.binary()),
        "root": pa.array([cids[root[k]] for k in mine], pa.binary()),
        "links": pa.array((linked @ copies)[mine].astype(np.int64)),
    })


# ---- components ---------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(cid, label): the smallest member of each connected component. Labels
    are a table per round, in files of about ``LABELS`` rows."""
    back = edges.select(F.col("root").alias("cid"), F.col("cid").alias("root"))
    both = common.stored(edges.unionByName(back).where("cid <> root").distinct(), "edges")
    labels = both.groupBy("cid").agg(F.least("cid", F.min("root")).alias("label"))
    files = 1 + both.count() // LABELS
    while True:
        near = (
            both.join(labels.select(F.col("cid").alias("root"), "label"), "root")
            .groupBy("cid").agg(F.min("label").alias("low"))
        )
        lower = labels.join(near, "cid").select("cid", F.least("label", "low").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("cid").alias("label"), F.col("label").alias("next"))
        lower = lower.join(jump, "label", "left").select(
            "cid", F.least("label", F.coalesce("next", "label")).alias("label"), "was"
        )
        lower = common.stored(lower.coalesce(files), "labels")
        labels = lower.select("cid", "label")
        if lower.where("label <> was").isEmpty():
            return labels


# ---- the join -------------------------------------------------------------------------
def join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, th, cid, label (the linked group),
    copy_id (smallest id of the rows with an equal set), class_id (smallest id
    of the linked group), n_links (other rows with a similarity of at least
    LEAST).

    Rows without words have null cid and label, themselves as class and no
    links. Null ids lose to every other id. Rows that repeat are documents of
    their own. Groups are told apart by label: class_id is null for a group
    without ids, and groups that share an id can share it.
    """
    rows = common.stored(signatures(docs), "signatures")
    classes = common.stored(
        rows.where("cid is not null").groupBy("cid").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("copy_id"),
            F.min(F.struct("doc_id", "th")).alias("member"), F.min("sig").alias("sig"),
        ),
        "classes",
    )
    in_leaves = leaves(classes)
    lists = in_leaves.groupBy("cid").agg(F.sort_array(F.collect_set("node")).alias("leaves"))
    known = common.stored(classes.select("cid", "sig", "copies", "member").join(lists, "cid"), "leaf-lists")
    unit_rows = _units(in_leaves)
    near = _by_unit(
        unit_rows.join(known.select("cid", "sig", "leaves"), "cid"),
        _candidates, "node bigint, i int, j int, side int, cid binary",
    )
    near = common.stored(near, "candidates")
    # the whole sets of the classes that have a candidate
    wanted = near.select("cid").distinct().join(known.select("cid", "member"), "cid")
    wanted = wanted.select("cid", F.col("member.doc_id").alias("w_id"), F.col("member.th").alias("w_th"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("t_id"), "text")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    found = texts.join(wanted, texts.t_id.eqNullSafe(wanted.w_id) & (text_hash == wanted.w_th)).select("cid", "text")
    whole = found.mapInArrow(_whole_sets, "cid binary, whole binary").groupBy("cid").agg(F.min("whole").alias("whole"))
    full = near.join(whole, "cid").join(known.select("cid", "copies", "leaves"), "cid")
    linked = common.stored(_by_unit(full, _links, "cid binary, root binary, links bigint"), "links")
    labels = components(linked.select("cid", "root"))
    counts = linked.groupBy("cid").agg(F.sum("links").alias("others"))
    # smallest document id per component, through its classes
    per_class = classes.select("cid", "copies", "copy_id").join(labels, "cid", "left").join(counts, "cid", "left")
    per_class = per_class.withColumn("label", F.coalesce("label", "cid"))
    lowest = per_class.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    per_class = per_class.join(lowest, "label").select(
        "cid", "label", "copy_id", "class_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    return rows.drop("sig").join(per_class, "cid", "left").select(
        "doc_id", "th", "cid", "label",
        F.coalesce("copy_id", F.when(F.col("cid").isNull(), F.col("doc_id"))).alias("copy_id"),
        F.coalesce("class_id", F.when(F.col("cid").isNull(), F.col("doc_id"))).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each linked group (the smallest id, null last,
    then text hash); rows without words stay. Columns of any names pass."""
    k, n = common.free_names(docs, "__k", "__n")
    j = common.stored(join(docs), "joined")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th"))
    one = j.where("cid is not null").groupBy("label").agg(first.alias("m"))
    stay = one.select(F.col("m.doc_id").alias("doc_id"), F.col("m.th").alias("th"))
    stay = stay.unionByName(j.where("cid is null").select("doc_id", "th")).distinct()
    stay = stay.select(F.xxhash64("doc_id", "th").alias(k)).distinct()
    tagged = docs.withColumn(
        k, F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    )
    nth = F.row_number().over(Window.partitionBy(k).orderBy(F.lit(1)))
    bare = ~F.coalesce(F.col("text"), F.lit("")).rlike(common.WORD)
    kept = tagged.join(stay, k, "left_semi").withColumn(n, nth).where((F.col(n) == 1) | bare)
    return kept.select(*docs.columns)
