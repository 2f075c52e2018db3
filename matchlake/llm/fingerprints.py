"""Document fingerprints: a homomorphic multiset hash over paragraph pieces.

A text is the multiset of its paragraph pieces: every line, cut after each
``PIECE_WORDS`` words. Each piece is hashed to a wide vector and the vectors
are added lane by lane modulo a power of two, so that order does not matter,
equal texts give equal fingerprints, and a piece is inserted or deleted by
adding or subtracting its vector (``combine``).

The vector has two parts:

* ``EXACT`` lanes of 32 random bits, added modulo 2**32: equality;
* ``SIGNS`` lanes of +1 / -1, added modulo 2**32: the inner product of two
  such sums estimates the size of the multiset intersection, so that the
  cosine of two fingerprints is a likeness from 0 to 1.

Everything is a column expression on the row that holds the text (array
functions over its pieces), so nothing is shuffled or grouped for it: a long
document costs its own length and no key can be hot.

Null texts count as empty. A text without words has the zero fingerprint,
which is like another zero fingerprint (1.0) and unlike all else (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

PIECE_WORDS = 8
EXACT = 8
SIGNS = 64
LOW32 = 0xFFFFFFFF
PAIR = 0x100000001


def pieces(text: Column) -> Column:
    """Lines cut into runs of at most ``PIECE_WORDS`` words."""
    pattern = r"\S+(?:[^\S\n]+\S+){0,%d}" % (PIECE_WORDS - 1)
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _hashes(parts: Column, seed: int) -> Column:
    # one parameter only: a second one would be the place in the array
    return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))


def _total(hashes: Column, part) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(hashes, zero, lambda acc, h: acc + part(h))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: struct(exact array<bigint>, signs array<bigint>)."""
    hs = [f"_{out}_h{i}" for i in range(EXACT // 2 + 1)]
    df = df.withColumn(f"_{out}_p", pieces(F.col(text)))
    df = df.withColumns({h: _hashes(F.col(f"_{out}_p"), i) for i, h in enumerate(hs)})
    exact = []
    for h in hs[1:]:
        exact.append(_total(F.col(h), lambda x: x.bitwiseAND(F.lit(LOW32))))
        exact.append(_total(F.col(h), lambda x: F.shiftrightunsigned(x, 32)))
    # one 64-bit hash gives 64 signs; two set-bit counts share one running sum
    both = [
        _total(F.col(hs[0]), lambda x, j=j: F.shiftrightunsigned(x, j).bitwiseAND(F.lit(PAIR)))
        for j in range(32)
    ]
    df = df.withColumn(f"_{out}_b", F.array(*both)).withColumn(
        f"_{out}_e", F.transform(F.array(*exact), lambda x: x.bitwiseAND(F.lit(LOW32)))
    )
    n = F.size(f"_{out}_p").cast("bigint")
    counts = F.concat(
        F.transform(f"_{out}_b", lambda x: x.bitwiseAND(F.lit(LOW32))),
        F.transform(f"_{out}_b", lambda x: F.shiftrightunsigned(x, 32)),
    )
    signs = F.transform(counts, lambda c: F.pmod(c * 2 - n, F.lit(1 << 32)))
    df = df.withColumn(out, F.struct(F.col(f"_{out}_e").alias("exact"), signs.alias("signs")))
    return df.drop(f"_{out}_p", f"_{out}_b", f"_{out}_e", *hs)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the union of two multisets (``sign=1``), or of ``a``
    without the pieces of ``b`` (``sign=-1``)."""
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: F.pmod(x + y * sign, F.lit(1 << 32))).alias("exact"),
        F.zip_with(a["signs"], b["signs"], lambda x, y: F.pmod(x + y * sign, F.lit(1 << 32))).alias("signs"),
    )


def as_text(fp: Column) -> Column:
    """Lowercase hex: the exact lanes, then the sign lanes."""
    return F.lower(
        F.concat(
            F.array_join(F.transform(fp["exact"], lambda x: F.lpad(F.hex(x), 8, "0")), ""),
            F.array_join(F.transform(fp["signs"], lambda x: F.lpad(F.hex(x), 8, "0")), ""),
        )
    )


def _dot(a: Column, b: Column) -> Column:
    # as doubles: the products of long texts' lanes do not fit 64 bits
    centred = lambda x: F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x).cast("double")
    return F.aggregate(
        F.zip_with(a["signs"], b["signs"], lambda x, y: centred(x) * centred(y)), F.lit(0.0), lambda acc, x: acc + x
    )


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sign parts, at least 0; exactly 1 for equal fingerprints."""
    norm = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(norm > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), _dot(a, b) / norm)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(cosine, F.lit(0.0)))


# ---- the next document ------------------------------------------------------
def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, k, next_id, next_hash): the next distinct id in ascending
    order, null last, the first after the last.

    Ids are dealt to ranges and stored with their range number; the next id is
    a window inside each range, and the first id of the following range (one
    row per range) closes the gaps.
    """
    spark = ids.sparkSession
    n = common.partitions(spark)
    one = ids.groupBy("doc_id").agg(F.min("hash").alias("hash"), F.max("k").alias("k"))
    ranged = common.stored(
        one.repartitionByRange(n, F.col("doc_id").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "ids",
    )
    order = F.col("doc_id").asc_nulls_last()
    row = F.struct("doc_id", "hash")
    inside = Window.partitionBy("part").orderBy(order)
    led = ranged.repartitionByRange(n, "part").withColumn("following", F.lead(row).over(inside))
    # one row per range
    firsts = (
        ranged.groupBy("part")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")).alias("f"))
        .select("part", F.struct(F.col("f.doc_id").alias("doc_id"), F.col("f.hash").alias("hash")).alias("first"))
    )
    parts = Window.orderBy("part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = firsts.select(
        "part", F.coalesce(F.lead("first").over(parts), F.first("first").over(whole)).alias("first_after")
    )
    nxt = led.join(gaps, "part").withColumn("n", F.coalesce("following", "first_after"))
    return nxt.select("doc_id", "k", F.col("n.doc_id").alias("next_id"), F.col("n.hash").alias("next_hash"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text, edited text, and fingerprints of
    both and of the next document.

    Rows sharing a doc_id share the next id; where the next id has several
    rows, the text with the smallest hash stands for it. Extra columns are
    ignored. An empty table gives an empty result; a single id is its own
    next document.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = base.select(
        "doc_id", F.xxhash64("text").alias("hash"), F.floor(F.length("text") / 4).cast("int").alias("k")
    )
    nxt = next_ids(ids)
    # the texts enter both joins under the same names and with the same keys
    # (the hash is none), so that Spark shuffles them once for both
    nxt = nxt.withColumnRenamed("doc_id", "h_id")
    same = F.col("next_hash").bitwiseXOR(F.xxhash64("text")) == 0
    heads = nxt.join(base, nxt.next_id.eqNullSafe(base.doc_id) & same).select(
        "h_id", F.col("text").alias("n_text"), "k"
    )
    heads = with_fingerprint(heads, "n_text", "next_fp").select(
        "h_id", F.expr("substring(n_text, 1, k)").alias("head"), "next_fp"
    )
    heads = heads.dropDuplicates(["h_id"])
    n = F.length("text")
    j = base.join(heads, base.doc_id.eqNullSafe(heads.h_id)).withColumn("k", F.floor(n / 4).cast("int"))
    j = j.withColumn(
        "edited", F.concat(F.expr("substring(text, 1, length(text) - k)"), F.expr("substring(head, 1, k)"))
    )
    j = with_fingerprint(with_fingerprint(j, "text", "fp"), "edited", "edited_fp")
    return j.select("doc_id", "text", "edited", "fp", "edited_fp", "next_fp")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    e = edited_pairs(docs)
    fp, ed, nx = F.col("fp"), F.col("edited_fp"), F.col("next_fp")
    return e.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(fp).alias("fingerprint"),
        as_text(ed).alias("edited_fingerprint"),
        likeness(fp, ed).alias("near_edited"),
        likeness(fp, nx).alias("near_next"),
    )
