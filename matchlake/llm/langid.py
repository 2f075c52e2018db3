"""Language ID by compression with per-language zstandard dictionaries.

Each language's dictionary is raw text of that language: passages of a bounded
sample of the training documents (``DOCS`` documents a language, picked by a
seeded hash, and up to ``PASSAGE`` characters from the middle of each).
Dictionaries and texts are reduced to lower-case words of letters, and a word
that repeats at once counts once: digits, marks and runs of one word compress
alike in every language. A text is cut into blocks, every block is compressed
with every dictionary, and the smallest total wins (of equal totals, the
language of more training documents). Blocks keep the text from becoming its
own dictionary.

The score is a two-sided comparison with the runner-up; ``rejected`` marks
narrow margins. Null texts and texts without a letter get ``und`` and 0.
With no training rows every text gets ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

DOCS = 160
PASSAGE = 600
BLOCK = 1024
LEVEL = 6
NARROW = 0.01
BITS = 0.1  # weight of a saved bit against the runner-up
SEED = 7
LETTER = regex.compile(r"\p{L}")
LETTERS = regex.compile(r"[\p{L}\p{M}]+")


def words_only(text: str) -> bytes:
    """Lower-case words of letters, each once where it repeats at once."""
    return f" {' '.join(w for w, _ in groupby(LETTERS.findall(text.lower())))} ".encode()


def training_passages(docs: DataFrame) -> list[tuple[str, list[bytes]]]:
    """Per language, passages of about ``DOCS`` documents; languages in the
    order of their training documents, most first.

    The share to draw per language comes from its count, so one language with
    most rows is thinned before it meets in a task. Number of languages times
    ``DOCS`` passages bounds what reaches the driver.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (common.fold("doc_id", 5) != 0))
    train = train.where(F.col("text").rlike(r"\p{L}"))
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(1 << 30))
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r.lang, F.lit(int(min(1.0, 2 * DOCS / r.n) * (1 << 30)))).otherwise(share)
    drawn = train.withColumn("draw", draw).where(F.col("draw") < share)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    start = F.greatest(F.lit(1), (F.length("text") - PASSAGE) / 2).cast("int")
    passage = F.col("text").substr(start, F.lit(PASSAGE))
    rows = drawn.withColumn("nth", nth).where(F.col("nth") <= DOCS).select("lang", "nth", passage.alias("p")).collect()
    by: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, -r.nth)):
        by.setdefault(r.lang, []).append(words_only(r.p))
    count = {r.lang: r.n for r in sizes}
    return sorted(by.items(), key=lambda e: (-count[e[0]], e[0]))


class Compressors:
    """One compressor per language."""

    def __init__(self, dictionaries: list[tuple[str, list[bytes]]]):
        self.names, self.ways = [], []
        for name, passages in dictionaries:
            d = zstandard.ZstdCompressionDict(b"\n".join(passages), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.names.append(name)
            self.ways.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, text: str) -> list[int]:
        data = words_only(text)
        n = max(1, -(-len(data) // BLOCK))
        step = -(-len(data) // n)
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        return [sum(len(w.compress(b)) for b in blocks) for w in self.ways]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.names or not LETTER.search(text):
            return "und", 0.0, True
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        if len(order) == 1:
            return self.names[0], 1.0, False
        second = sizes[order[1]]
        bits = min(500.0, 8 * (second - best) * BITS)
        return self.names[order[0]], 1.0 / (1.0 + 2.0**-bits), (second - best) / second < NARROW


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(training_passages(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = Compressors(model.value)
        for batch in batches:
            got = [ways.predict(t.as_py()) for t in batch.column("text")]
            names, scores, rejected = zip(*got) if got else ((), (), ())
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (common.fold("doc_id", 5) == 0).alias("held_out"), "text"
    )
    return rows.mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    )
