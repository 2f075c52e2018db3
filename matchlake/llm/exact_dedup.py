"""Exact dedup against a history, with minimal perfect hashes.

The distinct digests of the history are dealt to shards by a hash of the
digest; each shard becomes one row of the index table:

* ``sizes`` / ``bits``: the levels of a minimal perfect hash (a digest takes
  the first level where its position is its alone; its slot is the number of
  set bits before it);
* ``digests``: 32 bytes per slot, ``winners``: the locator (smallest doc_id)
  per slot.

New texts are first reduced to one row per digest, then looked up shard by
shard: the slot's 32 bytes are compared in full, so a nonmember that falls on
a slot is never taken for a member. Members join the history's group,
nonmembers form groups of their own.

A shard holds at most about ``SHARD`` digests however large the history is. Groups of
copies are reduced by partial aggregation before any shuffle, and the last
join carries ids and digests only (Spark splits a hot digest there).

Null text counts as empty; null ids lose to every other id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARD = 1024  # rows per shard, on average
GAMMA = 1.5  # positions per digest on each level
LEVELS = 64

INDEX_SCHEMA = "shard bigint, sizes array<int>, bits binary, digests binary, winners binary, copies binary, no_id binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), common.SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text (32 bytes)."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


# ---- minimal perfect hash of one shard ----------------------------------------
def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, level % 4] ^ np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def _words(digests) -> np.ndarray:
    raw = np.frombuffer(b"".join(bytes(d) for d in digests), dtype="<u8")
    return raw.reshape(-1, 4)


def build_slots(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes, bits, slot of each digest) for distinct digests."""
    left = np.arange(len(words))
    slot = np.full(len(words), -1, dtype=np.int64)
    sizes, bits, taken = [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(GAMMA * len(left)))
        pos = _positions(words[left], level, size)
        alone = np.bincount(pos, minlength=size) == 1
        mine = alone[pos]
        slot[left[mine]] = taken + np.cumsum(alone)[pos[mine]] - 1
        taken += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~mine]
    if len(left):
        raise ValueError("digests of a shard are not distinct")
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def find_slots(words: np.ndarray, sizes, bits: np.ndarray) -> np.ndarray:
    """Slot per digest, -1 where no level claims it (surely no member)."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(words), -1, dtype=np.int64)
    open_, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(open_):
            break
        at = start + _positions(words[open_], level, int(size))
        hit = bits[at]
        out[open_[hit]] = rank[at[hit]]
        open_, start = open_[~hit], start + int(size)
    return out


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    words = _words(pdf["digest"])
    sizes, bits, slot = build_slots(words)
    order = np.argsort(slot)
    no_id = pdf["winner"].isna().to_numpy()[order]
    winners = pdf["winner"].fillna(0).to_numpy("int64")[order]
    return pd.DataFrame({
        "shard": [int(key[0])], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
        "digests": [words[order].tobytes()], "winners": [winners.tobytes()],
        "copies": [pdf["copies"].to_numpy("int64")[order].tobytes()], "no_id": [no_id.tobytes()],
    })


def _lookup(key: tuple, new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = new[["digest", "winner", "copies"]].copy()
    out["member"] = False
    out["old_winner"] = pd.Series([None] * len(out), dtype="Int64", index=out.index)
    out["old_copies"] = 0
    if len(index) and len(out):
        row = index.iloc[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: int(sum(row["sizes"]))].astype(bool)
        words = _words(out["digest"])
        slot = find_slots(words, row["sizes"], bits)
        full = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
        member = (slot >= 0) & (full[slot] == words).all(axis=1)
        winner = pd.Series(np.frombuffer(row["winners"], "int64")[slot], dtype="Int64", index=out.index)
        winner[~member | np.frombuffer(row["no_id"], bool)[slot]] = pd.NA
        out["member"] = member
        out["old_winner"] = winner
        out["old_copies"] = np.where(member, np.frombuffer(row["copies"], "int64")[slot], 0)
    return out[["digest", "winner", "copies", "member", "old_winner", "old_copies"]]


# ---- Spark jobs ---------------------------------------------------------------
def reduced(rows: DataFrame) -> DataFrame:
    """One row per digest: smallest id and number of rows."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count(F.lit(1)).alias("copies"))


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame) -> tuple[DataFrame, int]:
    """The stored index over (doc_id, digest) rows, and its number of shards."""
    shards = max(1, -(-history.count() // SHARD))
    index = _sharded(reduced(history), shards).groupBy("shard").applyInPandas(_build, INDEX_SCHEMA)
    return common.stored(index, "mph"), shards


def groups(history: DataFrame, new: DataFrame) -> DataFrame:
    """One row per distinct digest of both: digest, keep_id, group_size."""
    index, shards = build_index(history)
    found = common.stored(
        _sharded(reduced(new), shards)
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInPandas(
            _lookup,
            "digest binary, winner bigint, copies bigint, member boolean, old_winner bigint, old_copies bigint",
        ),
        "lookups",
    )
    new_groups = found.select(
        "digest",
        F.least("winner", "old_winner").alias("keep_id"),
        (F.col("copies") + F.col("old_copies")).alias("group_size"),
    )
    # the history's digests that no new text has
    rest = reduced(history).join(found.where("member").select("digest"), "digest", "left_anti")
    return new_groups.unionByName(
        rest.select("digest", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size"))
    )


def split_history(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows up to the median id are the history, the others the arrivals."""
    middle = rows.agg(F.percentile_approx("doc_id", 0.5, 1000)).first()[0]
    if middle is None:
        return rows.where(F.lit(False)), rows
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return rows.where(old), rows.where(~old)


def decisions(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256. Of rows that repeat id and text, one is kept."""
    rows = common.stored(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    g = groups(*split_history(rows))
    # numbered by both keys before the join: nothing above it keeps a hot
    # digest's rows together
    again = Window.partitionBy("digest", "doc_id").orderBy(F.lit(1))
    j = rows.withColumn("nth", F.row_number().over(again)).join(g, "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return j.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns (of any names)."""
    d, k, n = common.free_names(docs, "__digest", "__k", "__n")

    def key(of: str) -> Column:
        return F.xxhash64(F.col("doc_id"), F.col(of))

    tagged = docs.withColumn(d, digest(F.col("text"))).withColumn(k, key(d))
    rows = common.stored(tagged.select("doc_id", F.col(d).alias("digest")), "digests")
    g = groups(*split_history(rows)).select("digest", F.col("keep_id").alias("doc_id"))
    stay = g.select(F.col("digest").alias(d), key("digest").alias(k))
    # join and numbering share their keys, and so one shuffle of the texts
    again = Window.partitionBy(k, d).orderBy(F.lit(1))
    j = tagged.join(stay, [k, d], "left_semi")
    return j.withColumn(n, F.row_number().over(again)).where(F.col(n) == 1).select(*docs.columns)
