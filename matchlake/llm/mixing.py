"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts. Each source gets a target; whole passes over the
source are taken as far as they fit, and the remaining budget is filled by a
subset of its documents whose sizes add up to it as closely as possible:

1. documents are counted per (source, size): the histogram is all the fit
   needs, so a source with a third of all rows is a few thousand rows here;
2. per source, each size first gets its proportional share of documents,
   then a single document while it fits, and a bounded-knapsack dynamic
   programme over the remaining counts, and some given back, closes the last
   words;
3. per (source, size), the wanted number of documents is chosen by a seeded
   hash. Only the hash bucket that holds the cut is ranked, so one frequent
   size is never sorted whole in one task.

Null text has size 0; documents of size 0 take 0 words. Long texts are counted
whole. An empty table gives an empty mix; extra columns are not read. Reruns
agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARE = 1.5
MOST = 2.0
WEIGHTS = (3, 1, 2)
SEED = 20
BUCKETS = 4096
WORK = 1 << 28  # bytes of reachable sums that widening a fit may take


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(common.WORD)).cast("bigint")


def targets(totals: DataFrame, share: float = SHARE, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per
    source, by code point, null last.

    Resharing the excess of capped sources by weight ends where every open
    source has level * weight; sources reach their cap in order of
    cap / weight, so the level is found with running sums in that order. The
    two windows order one row per source, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("rank", F.row_number().over(by_name)).withColumn("w", w)
    t = t.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    t = t.withColumn("level", level)
    fixed = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    # the first source that stays below its cap fixes the level of all after it
    t = t.withColumn("open", F.first(fixed, ignorenulls=True).over(everything))
    t = t.withColumn(
        "target", F.least(F.col("cap"), F.coalesce(F.col("open") * F.col("w"), F.col("cap")))
    )
    return t.select("source", "source_size", "target")


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that the words taken are the
    greatest reachable sum that is not above ``budget``.

    Shares are rounded, then documents are given back, up to ``width`` a size,
    and the knapsack fills what is open; the width doubles until nothing nearer
    can be reached. That is so where the sum meets the budget (less its
    remainder by the sizes' common divisor), or the width is twice the largest
    size and the words left: a longer exchange of documents has a part that
    sums to zero. Only where the reachable sums of the next width would take
    more than ``WORK`` bytes does the best sum of the last one stand.
    """
    order = np.argsort(sizes)[::-1]
    s, c = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((s * c).sum())
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.astype(np.int64).copy()
    # floors of the proportional shares, in integers
    took = np.array([int(n) * budget // total for n in c], np.int64)
    left = budget - int((s * took).sum())
    for i in range(len(s)):  # then single documents, large sizes first
        more = min(int(c[i] - took[i]), 1, left // int(s[i])) if s[i] else 0
        took[i] += more
        left -= more * int(s[i])
    spare = budget % int(np.gcd.reduce(s[(s > 0) & (c > 0)]))
    enough = 2 * int(s[0]) + left + 1
    best, missing, width = took, left, 1
    while missing > spare:
        base, open_words, room = took.copy(), left, 2 * width * int(s[0])
        for i in range(len(s)):
            # the first widths open a few large documents' worth, which
            # is nearly always enough
            if width < enough and open_words >= room:
                break
            back = min(int(base[i]), width)
            base[i] -= back
            open_words += back * int(s[i])
        items = sum(min(int(n), open_words // int(z)).bit_length() for n, z in zip(c - base, s) if z)
        if width > 1 and items * open_words // 8 > WORK:
            break
        filled = _knapsack(s, c - base, open_words)
        still = open_words - int((s * filled).sum())
        if still < missing:
            best, missing = base + filled, still
        if width >= enough or not (base * s).any():
            break
        width = min(2 * width, enough)
    out = np.empty(len(sizes), np.int64)
    out[order] = best
    return out


def _knapsack(s: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset-sum: counts per size whose total is the reachable sum
    nearest below ``budget``. Copies of a size are split into powers of two
    and reachable sums are the bits of one integer."""
    take = np.zeros(len(s), np.int64)
    if budget <= 0:
        return take
    mask = (1 << (budget + 1)) - 1
    items, reach = [], [1]
    for i in range(len(s)):
        n, part = min(int(free[i]), budget // int(s[i]) if s[i] else 0), 1
        while n > 0:
            part = min(part, n)
            step = part * int(s[i])
            after = (reach[-1] | (reach[-1] << step)) & mask
            if after != reach[-1]:
                items.append((i, part, step))
                reach.append(after)
                if after >> budget & 1:
                    n = 0
            n -= part
            part *= 2
        if reach[-1] >> budget & 1:
            break
    at = reach[-1].bit_length() - 1
    for (i, part, step), was in zip(reversed(items), reversed(reach[:-1])):
        if not was >> at & 1:
            take[i] += part
            at -= step
    return take


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    sizes, counts = pdf["size"].to_numpy("int64"), pdf["n"].to_numpy("int64")
    whole, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    passes = int(target // whole) if whole else 0
    passes = min(passes, int(MOST))
    extra = fit_counts(sizes, counts, int(round(target - passes * whole))) if passes < MOST else np.zeros(len(sizes), np.int64)
    out = pdf[["source", "size", "n", "source_size", "target"]].copy()
    out["passes"] = passes
    out["extra"] = extra
    return out


def plan(sized: DataFrame) -> DataFrame:
    """(source, size, n, source_size, target, passes, extra) per source and size."""
    hist = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"))
    t = targets(totals)
    h = hist.alias("h").join(t.alias("t"), F.col("h.source").eqNullSafe(F.col("t.source")))
    h = h.select("h.source", "h.size", "h.n", "t.source_size", "t.target")
    return h.groupBy("source").applyInPandas(
        _fit,
        "source string, size bigint, n bigint, source_size bigint, target double, passes bigint, extra bigint",
    )


def _sized(docs: DataFrame) -> DataFrame:
    """Ids, sources, sizes and seeded hashes: all that the mix needs."""
    h = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"),
        h.alias("hash"), F.pmod(F.shiftright(h, 8), F.lit(BUCKETS)).alias("bucket"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    taken. A document is taken 0, 1 or 2 times; rows that repeat an id are
    documents of their own (ties in the seeded hash break by row)."""
    sized = common.stored(_sized(docs), "sized")
    p = common.stored(plan(sized), "mix-plan")
    keys = ["source", "size"]
    # cumulated counts per hash bucket: at most BUCKETS rows per (source, size)
    per = sized.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("here"))
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("upto", F.sum("here").over(run))
    a, b = per.alias("a"), p.alias("b")
    cut = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")))
    left = F.col("b.extra") - (F.col("a.upto") - F.col("a.here"))
    cut = cut.select(
        F.col("a.source").alias("c_source"), F.col("a.size").alias("c_size"), F.col("a.bucket").alias("c_bucket"),
        "b.source_size", "b.target", "b.passes",
        F.greatest(F.lit(0), F.least(left, F.col("a.here"))).alias("quota"), F.col("a.here").alias("here"),
    )
    j = sized.join(
        cut,
        sized["source"].eqNullSafe(cut["c_source"]) & (sized["size"] == cut["c_size"])
        & (sized["bucket"] == cut["c_bucket"]),
    )
    whole = j.where("quota = 0 or quota = here").withColumn("more", (F.col("quota") > 0).cast("bigint"))
    rank = F.row_number().over(Window.partitionBy(*keys, "bucket").orderBy("hash", "doc_id"))
    split = j.where("quota > 0 and quota < here").withColumn("more", (rank <= F.col("quota")).cast("bigint"))
    both = whole.unionByName(split)
    return both.select(
        "doc_id", "source", "size", "source_size", "target",
        ((F.col("passes") + F.col("more")) * F.col("size")).cast("bigint").alias("taken"),
        (F.col("passes") + F.col("more")).alias("copies"),
    )


def report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; documents
    without words cost nothing and stay once."""

    def key(size: Column) -> Column:
        return F.xxhash64(F.col("doc_id"), F.col("source").cast("string"), size)

    k, takes, copies, copy = common.free_names(docs, "__k", "__takes", "__copies", "__copy")
    m = mix(docs).withColumn(k, key(F.col("size")))
    m = m.withColumn("copies", F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int"))
    # one entry per document; more only where rows repeat id, source and size
    m = m.groupBy(k).agg(F.sort_array(F.collect_list("copies"), asc=False).alias(takes))
    j = docs.withColumn(k, key(size_of(F.col("text")))).join(m, k)
    nth = F.row_number().over(Window.partitionBy(k).orderBy(F.xxhash64("text")))
    j = j.withColumn(copies, F.element_at(takes, nth))
    j = j.where(F.col(copies) > 0).withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copies))))
    return j.select(*docs.columns)
