"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Batches of whole texts: thousands of long texts would not fit a reader's
#: buffers or a Python worker.
BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}


def bounded_batches(spark: SparkSession) -> None:
    """Session settings for rows that hold whole texts, and the package for
    the Python workers that read them."""
    ship_package(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def gathered(df: DataFrame, files: int | None = None) -> DataFrame:
    """``df`` in as many partitions as ``stored`` writes files, without a
    shuffle. On a local file system the JVM starts helper processes for the
    files it writes, which count as a second JVM for a moment."""
    spark = df.sparkSession
    return df.coalesce(files or max(2 * spark.sparkContext.defaultParallelism, partitions(spark) // 8))


def stored(df: DataFrame, name: str, compression: str = "snappy", files: int | None = None) -> DataFrame:
    """``df`` written once below the shared folder and read back: later stages
    (and retries after a lost executor) start from files, not from lineage.

    Such tables are much smaller than the texts, so several partitions share a
    file: an eighth of the shuffle partitions, and at least two a core. Where
    the last stage reads far more than it writes, ``files`` asks for more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    gathered(df, files).write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; a null id counts as ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n
