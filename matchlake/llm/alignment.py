r"""Cross-tokenizer alignment by shared ends.

Tokenizer A (byte-level BPE) encodes space + text, tokenizer B (SentencePiece)
the text, before which it puts a space itself. Cumulative byte lengths give
each token's end; a dictionary maps the ends of A, another those of B, to token
numbers. The intersection of their keys, sorted, cuts both id lists into
groups. The links of a group are expanded from its slices: its tokens' pairs
whose ranges end together (the last of A with the last of B; with
``rule="slice"`` all pairs of the two slices).

A text is taken in stretches, cut at each space between two characters that
are no white space. Both tokenizers end a token there (A's pattern binds a
space to what follows; B is cut only if none of its pieces holds a space after
another character), so aligning stretch by stretch gives the groups of the
whole text, and frequent stretches are remembered. Texts with U+2581 are one
stretch.

Counts of id pairs cover all links: each task adds up its pairs, Spark sums
them. Scoring then reads the stored links again. Pair counts at or above a
power of two, at most ``SENT`` pairs, are sent to all tasks; the links of
rarer pairs, if there are any, are joined with their counts by shuffle, where
no key is hot.

Null and empty texts, and texts whose tokens do not give back space + text
byte by byte, have no tokens: zeros and ''. Repeated rows count each time, ids
are only passed on. Ties for the highest count all are best. Long texts are
encoded whole. An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
#: the usual pattern of byte-level BPE (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 400_000  # remembered stretches per generation
SENT = 2_000_000
HELD = 1 << 20  # links that a task gathers before it adds them up


def default_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> dict[str, int]:
    """The byte of each letter of byte-level BPE: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: groups as text, A's ids + (B's ids << 32), links (a | b << shift, packed)
Stretch = tuple[str, int, bytes]


def merges_by_id(spec: dict) -> bool:
    """Whether a byte-level BPE merges in the order of its ids, with the usual
    pattern: then its vocabulary is a table of ranks."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"].get("".join(p)) for p in pairs]
    rest = set(model["vocab"].values()) - set(ids) - {t["id"] for t in spec.get("added_tokens", [])}
    return (
        model.get("type") == "BPE" and spec.get("normalizer") is None and before.get("type") == "ByteLevel"
        and before.get("use_regex", True) and not model.get("ignore_merges") and not model.get("dropout")
        and None not in ids and ids == sorted(ids) and len(rest) == 256 and max(rest) < min(ids, default=256)
    )


class Aligner:
    def __init__(self, a_json: str, b_model: bytes, rule: str = "end"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.slices = rule == "slice"
        spec = json.loads(a_json)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        vocabulary = {bytes(letters[c] for c in p): i for p, i in spec["model"]["vocab"].items() if p not in special}
        self.bytes_a = [b""] * (max([*vocabulary.values(), *special.values()], default=-1) + 1)
        for x, i in [*vocabulary.items(), *((p.encode(), i) for p, i in special.items())]:
            self.bytes_a[i] = x
        self.ids_a = self._ranked(vocabulary) if merges_by_id(spec) else self._merged(a_json)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.name_a, self.name_b = [str(i) for i in range(len(self.bytes_a))], [str(i) for i in range(n)]
        self.shift = 16 if max(len(self.bytes_a), n) <= 1 << 16 else 32
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.young: dict[str, Stretch] = {}
        self.old: dict[str, Stretch] = {}

    @staticmethod
    def _ranked(ranks: dict[bytes, int]) -> Callable[[str], list[int]]:
        """The same ids, several times faster than by the vocabulary's library."""
        import tiktoken

        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @staticmethod
    def _merged(a_json: str) -> Callable[[str], list[int]]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(a_json)
        t.encode_special_tokens = True  # their strings in a text are text
        return lambda text: t.encode(text, add_special_tokens=False).ids

    def align(self, text: str, stops: list[int]) -> list[Stretch] | None:
        """The stretches of a text that end at the bytes ``stops`` of space +
        text; None if the tokens do not give it back, or do not end there."""
        whole = (" " + text).encode()
        ids_a, ids_b = self.ids_a(" " + text), self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
            return None
        ends_a = dict(zip(accumulate(map(self.size_a.__getitem__, ids_a)), range(1, len(ids_a) + 1)))
        ends_b = dict(zip(accumulate(map(self.size_b.__getitem__, ids_b)), range(1, len(ids_b) + 1)))
        common_ends = sorted(ends_a.keys() & ends_b.keys())
        number = dict(zip(common_ends, range(1, len(common_ends) + 1)))
        if not all([e in number for e in stops]):
            return None
        names_a, names_b = list(map(self.name_a.__getitem__, ids_a)), list(map(self.name_b.__getitem__, ids_b))
        groups: list[str] = []
        pairs: list[list[int]] = []
        i = j = 0
        for end in common_ends:
            k, m = ends_a[end], ends_b[end]
            left = names_a[i] if k == i + 1 else ",".join(names_a[i:k])
            right = names_b[j] if m == j + 1 else ",".join(names_b[j:m])
            groups.append(left + "|" + right)
            if self.slices:
                pairs.append([x | y << self.shift for x in ids_a[i:k] for y in ids_b[j:m]])
            i, j = k, m
        kind, width = f"<u{self.shift // 4}", self.shift // 4
        if self.slices:
            at = [0, *accumulate(map(len, pairs))]
            codes = np.array([x for p in pairs for x in p], kind).tobytes()
        else:  # the last tokens of each group end together
            at = range(len(common_ends) + 1)
            last_a = np.array(ids_a, kind)[np.array([ends_a[e] - 1 for e in common_ends])]
            last_b = np.array(ids_b, kind)[np.array([ends_b[e] - 1 for e in common_ends])]
            codes = (last_a | last_b << np.array(self.shift, kind)).tobytes()
        out = []
        i = j = g = 0
        for e in stops:
            k, m, h = ends_a[e], ends_b[e], number[e]
            out.append((";".join(groups[g:h]), k - i + (m - j << 32), codes[width * at[g] : width * at[h]]))
            i, j, g = k, m, h
        return out

    def _alone(self, stretch: str) -> Stretch | None:
        got = self.align(stretch, [len(stretch.encode()) + 1])
        return got and got[0]

    def _new(self, stretches: list[str]) -> list[Stretch | None]:
        """Stretches not seen before, tokenized as one text."""
        stops = list(accumulate([len(s.encode()) + 1 for s in stretches]))
        return self.align(" ".join(stretches), stops) or [self._alone(s) for s in stretches]

    def parts(self, text: str) -> list[Stretch | None]:
        """The stretches of a text that is not empty."""
        if not self.cuts or SPACE in text:
            return [self._alone(text)]
        words = text.split(" ")
        got = list(map(self.young.get, words))
        if None not in got:
            return got
        missing = dict.fromkeys([w for w, g in zip(words, got) if g is None])
        if any([not w or w[0].isspace() or w[-1].isspace() for w in missing]):
            words = CUT.split(text)  # white space beside a space
            missing = dict.fromkeys([w for w in words if w not in self.young])
        fresh = {w: g for w in missing if (g := self.old.get(w)) is not None}
        unseen = [w for w in missing if w not in fresh]
        if unseen:
            fresh.update(zip(unseen, self._new(unseen)))
        out = [fresh[w] if w in fresh else self.young[w] for w in words]
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        for w, g in fresh.items():  # only what str.split finds, and no long stretches
            if g is not None and len(w) <= 64 and " " not in w and not (w[0].isspace() or w[-1].isspace()):
                self.young[w] = g
        return out

    def __call__(self, text: str | None) -> tuple[str, int, int, int, bytes] | None:
        """(groups, n_a, n_b, n_groups, links) of a text; None if it has no
        tokens."""
        got = self.parts(text) if text else [None]
        if None in got:
            return None
        groups, counts, links = zip(*got)
        joined, n = ";".join(groups), sum(counts)
        return joined, n & 0xFFFFFFFF, n >> 32, joined.count(";") + 1, b"".join(links)


_aligners: dict[str, Aligner] = {}


def _aligner(files: tuple[str, bytes], rule: str) -> Aligner:
    """Once per Python worker."""
    key = hashlib.sha256(json.dumps([files[0], files[1].hex(), rule]).encode()).hexdigest()
    if key not in _aligners:
        _aligners[key] = Aligner(*files, rule)
    return _aligners[key]


def aligned(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, rule: str = "end") -> DataFrame:
    """Per row: doc_id, row (its number), n_a, n_b, n_groups, n_links, groups,
    and links: a | b << 16 of each link as little-endian uint32, or a | b << 32
    as uint64 where a vocabulary has more than 65,536 ids."""
    with open(a_file or default_file(A_FILE), encoding="utf-8") as f:
        a_json = f.read()
    with open(b_file or default_file(B_FILE), "rb") as f:
        b_model = f.read()
    files = docs.sparkSession.sparkContext.broadcast((a_json, b_model))
    # numbered where they are read: a task of a stored table runs several partitions
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(files.value, rule)
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                out: list[tuple] = []
                for t in part.column("text"):
                    groups, n_a, n_b, n_groups, links = align(t.as_py()) or ("", 0, 0, 0, b"")
                    out.append((n_a, n_b, n_groups, len(links) * 4 // align.shift, groups, links))
                yield pa.record_batch([part.column("doc_id"), part.column("row"), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))], names)

    schema = "doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary"
    return rows.mapInArrow(run, schema)


# ---- counts of id pairs -----------------------------------------------------------
def _keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The links of each row, as numbers."""
    for n, links in zip(batch.column("n_links").to_pylist(), batch.column("links")):
        links = links.as_py()
        yield np.frombuffer(links, f"<u{len(links) // n if n else 4}")


def pair_counts(rows: DataFrame) -> DataFrame:
    """key (as in links), count of all links, best (its B id has no higher
    count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def added() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            shift = key.dtype.itemsize * 4
            return pa.record_batch(
                [pa.array(key.astype(np.int64)), pa.array((key >> shift).astype(np.int64)), pa.array(n.astype(np.int64))],
                ["key", "b", "n"],
            )

        for batch in batches:
            for keys in _keys(batch):
                if len(keys):
                    held.append(keys)
                    size += len(keys)
                if size >= HELD:
                    yield added()
                    size = 0
        if held:
            yield added()

    links = rows.select("n_links", "links")
    counts = links.mapInArrow(run, "key bigint, b bigint, n bigint").groupBy("b", "key").agg(F.sum("n").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("key", "count", (F.col("count") == F.col("most")).alias("best"))


def _frequent(pairs: DataFrame, sent: int) -> tuple[int, bool]:
    """(least count of the pairs sent to all tasks, whether others remain)."""
    by = pairs.groupBy(F.floor(F.log2("count") + 1e-9).cast("int").alias("power")).count().collect()  # at most 63 rows
    total = 0
    for r in sorted(by, key=lambda r: -r.power):
        total += r["count"]
        if total > sent:
            return 1 << (r.power + 1), True
    return 1, False


def scored(rows: DataFrame, pairs: DataFrame, sent: int | None = None) -> DataFrame:
    """``rows`` of ``aligned`` (a stored table) with n_best and count_sum."""
    least, others = _frequent(pairs, SENT if sent is None else sent)
    table = pairs.where(F.col("count") >= least).toArrow().sort_by("key")  # at most ``sent`` rows
    known = rows.sparkSession.sparkContext.broadcast((
        table.column("key").to_numpy(), table.column("count").to_numpy(), table.column("best").to_numpy().astype(bool)
    ))

    def at(keys: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the sent table, and whether it is there."""
        place = np.minimum(np.searchsorted(own, keys), max(len(own) - 1, 0))
        return place, own[place] == keys if len(own) else np.zeros(len(keys), bool)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, count, best = known.value
        names = [n for n in names_in if n != "links"]
        for batch in batches:
            n_best, sums = [], []
            for keys in _keys(batch):
                place, there = at(keys.astype(np.int64), own)
                n_best.append(int(best[place[there]].sum()))
                sums.append(int(count[place[there]].sum()))
            yield pa.record_batch(
                [*(batch.column(n) for n in names), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())],
                [*names, "n_best", "count_sum"],
            )

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value[0]
        for batch in batches:
            for row, keys in zip(batch.column("row").to_pylist(), _keys(batch)):
                keys = keys.astype(np.int64)
                key, n = np.unique(keys[~at(keys, own)[1]], return_counts=True)
                if len(key):
                    yield pa.record_batch([pa.array([row] * len(key), pa.int64()), pa.array(key), pa.array(n)], ["row", "key", "n"])

    names_in = rows.columns
    schema = rows.drop("links").schema.add("n_best", "long").add("count_sum", "long")
    out = rows.mapInArrow(score, schema)
    if not others:
        return out
    rare = rows.select("row", "n_links", "links").mapInArrow(rest, "row bigint, key bigint, n bigint")
    more = (
        rare.join(pairs.where(F.col("count") < least), "key")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more_sum"))
    )
    out = out.join(more, "row", "left")
    return out.withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }).drop("more_best", "more_sum")


def report(docs: DataFrame, sent: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    a = aligned(docs)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    rows = common.stored(a.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "links", "zstd")
    pairs = common.stored(pair_counts(rows), "pair-counts")
    return scored(rows, pairs, sent).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
