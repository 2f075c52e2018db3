r"""Source divergence audit with a translate-table tokenizer.

``bytes.translate`` maps A-Z to lower case and every other ASCII byte that is
no letter to a blank in one pass, ``bytes.split`` gives the terms (runs of
letters and non-ASCII code points) and a ``Counter`` per document their
frequencies. A task adds the Counters up per (lang, source) and hands on sparse
rows (lang, source, term, occurrences, documents), not one row per token.

The rows are dealt once by (lang, term): that gives the occurrences per group,
and by a window over the same keys the language's occurrences and documents.
Terms in at least ``LEAST_DOCS`` documents of a language are its kept terms.

Smoothed shares are integers: p = 1 + floor(10**9 (count + 5) / (N + 5 V)), by
long division in three steps of 1000, so nothing overflows while N + 5 V is
below 9 * 10**15.

Distances between sources are summed in tiles: sources of a language are dealt
to blocks of about ``SOURCES``, its terms to blocks of about ``TERMS``, and a
task gets two blocks of sources on one block of terms as a small dense matrix.
It returns one sum per pair of sources; no rows per pair and term are made.

Null text, lang and source count as ''. Every row is a document, repeated rows
too; ids are not used. Ties rank by the item's UTF-8 bytes. Groups without any
term, and languages without kept terms (all distances 0), are in the result. A
long text is split whole, one at a time. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

LEAST_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
ADD = 5
HELD = 300_000  # (group, term) entries that a task gathers
SOURCES = 64
TERMS = 2048

#: A-Z to a-z, separators to a blank; other bytes stay
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> Counter:
    return Counter(text.translate(TABLE).split())


def term_rows(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: sums over stretches of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                k = len(n)
                yield pa.record_batch(
                    [
                        pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(list(n), pa.binary()),
                        pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            held.clear()

        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text").cast(pa.large_binary())):
                own = terms_of(text.as_py())
                if not own:
                    continue
                n, docs = held.setdefault(group, (Counter(), Counter()))
                size -= len(n)
                n.update(own)
                docs.update(own.keys())
                size += len(n)
                if size >= HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    got = docs.mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return got.withColumn("term", F.col("term").cast("string"))


def kept_terms(rows: DataFrame, least: int) -> DataFrame:
    """lang, source, term, n, n_lang, head (1 on one row of each lang's term)."""
    # one exchange: both keys of the window are among the keys of the groups
    g = rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    g = g.select(
        "lang", "source", "term", "n", F.sum("n").over(whole).alias("n_lang"), F.sum("docs").over(whole).alias("docs"),
        F.when(F.row_number().over(whole.orderBy("source")) == 1, 1).otherwise(0).alias("head"),
    )
    return g.where(F.col("docs") >= least).drop("docs")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10**9 (count + 5) / (n + 5 v)); count is at most n. 0 if v is."""
    d = F.greatest(n + ADD * v, F.lit(1))
    left, out = count + ADD, F.lit(0).cast("bigint")
    for _ in range(3):
        out, left = out * 1000 + F.call_function("div", left * 1000, d), left * 1000 % d
    return F.when(v > 0, 1 + out).otherwise(F.lit(0).cast("bigint"))


def facts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per group: lang, source, n_group, v, n_all, p0 (share of a term
    that the group lacks), sources (of the lang)."""
    zero = F.lit(0).cast("bigint")
    groups = docs.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.sum("head").alias("v"), F.sum("n").alias("n_all")), "lang", "left"
    )
    f = groups.join(own, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", "sources", *[F.coalesce(c, zero).alias(c) for c in ("n_group", "v", "n_all")]
    )
    return f.withColumn("p0", share(F.lit(0), F.col("n_group"), F.col("v")))


# ---- distances ------------------------------------------------------------------
def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| between the sources of two blocks over a block of terms."""
    lang, i, j, _ = key
    heads = rows[rows["term"].isna()].drop_duplicates("source").sort_values("source")
    names, block, p0 = heads["source"].to_numpy(), heads["block"].to_numpy(), heads["p"].to_numpy("int64")
    some = rows[rows["term"].notna()]
    row = pd.Index(names).get_indexer(some["source"])
    column, terms = pd.factorize(some["term"])
    p = np.repeat(p0[:, None], len(terms), axis=1)
    p[row, column] = some["p"].to_numpy("int64")
    a, b, value = [], [], []
    second = np.flatnonzero(block == j)
    for k in np.flatnonzero(block == i):
        others = second[second > k] if i == j else second
        a.append(np.full(len(others), k))
        b.append(others)
        value.append(np.abs(p[others] - p[k]).sum(axis=1))
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    return pd.DataFrame({
        "lang": lang, "a": names[a], "b": names[b], "value": value, "terms": len(terms),
        "a0": p0[a], "b0": p0[b],
    })


def distances(kept: DataFrame, f: DataFrame) -> DataFrame:
    """lang, source, item, value for each ordered pair of a lang's sources."""

    def blocks(c: str, size: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(c) / size)).cast("bigint")

    f = f.withColumns({"nb": blocks("sources", SOURCES), "nt": blocks("v", TERMS)})
    f = f.withColumn("block", F.pmod(F.xxhash64("source"), F.col("nb")))
    cells = kept.join(f, ["lang", "source"]).select(
        "lang", "source", "block", "nb", F.pmod(F.xxhash64("term"), F.col("nt")).alias("part"), "term",
        share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"),
    )
    heads = f.select(
        "lang", "source", "block", "nb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nt") - 1)).alias("part"),
        F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"),
    )
    tiles = (
        cells.unionByName(heads)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)))
        .select(
            "lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "part", "source", "block",
            "term", "p",
        )
    )
    sums = (
        tiles.groupBy("lang", "i", "j", "part")
        .applyInPandas(_tile, "lang string, a string, b string, value bigint, terms bigint, a0 bigint, b0 bigint")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.first("a0").alias("a0"), F.first("b0").alias("b0"))
        .join(f.groupBy("lang").agg(F.first("v").alias("v")), "lang")
    )
    # terms of the language that neither block holds
    rest = (F.col("v") - F.col("terms")) * F.abs(F.col("a0") - F.col("b0"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return sums.select("lang", both.alias("x"), (F.col("value") + rest).alias("value")).select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair, term), item, value, rank."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = common.stored(kept_terms(term_rows(docs), least), "kept-terms", files=common.partitions(docs.sparkSession))
    f = common.stored(facts(docs.select("lang", "source"), kept), "source-facts")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def part(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    v = F.col("v")
    over = share(F.col("n"), F.col("n_group"), v) - share(F.col("n_lang"), F.col("n_all"), v)
    terms = kept.join(f, ["lang", "source"]).where(F.col("n") > 0).select("lang", "source", F.col("term").alias("item"), over.alias("value"))
    best = part("term", terms.where("value > 0")).where(F.col("rank") <= top)
    return part("pair", distances(kept, f)).unionByName(best)


ORACLE = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
        FROM documents
    ),
    t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
    lv AS (SELECT lang, count(*)::HUGEINT AS v, sum(n) AS n_all FROM k GROUP BY lang),
    c AS (SELECT t.lang, source, term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n_group FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS (
        SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.n_group + 5 * lv.v) AS p,
               1 + (1000000000::HUGEINT * (k.n + 5)) // (lv.n_all + 5 * lv.v) AS q
        FROM gn JOIN k USING (lang) JOIN lv USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term
    ),
    x AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(a.p - b.p)), 0) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ),
    pr AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    ),
    tm AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
    u AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm)
    )
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM u WHERE part = 'pair' OR rank <= 50
"""
