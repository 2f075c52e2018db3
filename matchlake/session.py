"""Session helpers: a local builder for tests / bench, and the shared scratch
location derived from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime from real
# shuffle sizes (broadcast only below the threshold, skew-join splitting of
# hot partitions, coalescing of small partitions).
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the rebalance before partitioned writes relies on this to split a hot day
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "matchlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MATCHLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level settings the jobs need; safe to call repeatedly."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


#: a step's shuffle files go when the step ends, not when the driver next
#: happens to collect garbage
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: files of partition values that a task keeps open: with none, its rows are
#: sorted by the value before they are written; beyond, the rest is
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def released(spark: SparkSession) -> AbstractContextManager[None]:
    """Every query that is run inside leaves no shuffle files. For steps whose
    outcome is stored: a frame that is run again would shuffle again."""
    return _setting(spark, RELEASE, "true")


def unsorted_writes(spark: SparkSession, files: int = 40) -> AbstractContextManager[None]:
    """Partitioned writes inside do not sort a task's rows by partition value,
    for tasks with rows of up to ``files`` values: wide rows would be copied,
    and spilled where a task holds many."""
    return _setting(spark, OPEN_FILES, str(files))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once per context: a
    worker need not share the driver's working folder or PYTHONPATH. Spark
    copies the archive to each executor itself."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import tempfile
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="matchlake-code-")) / "matchlake-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session (conf first, then the context). Where it is unset, a
    local master (tests) gets a folder under the system temp dir; on a cluster
    that folder would be each machine's own, so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
    import tempfile

    sc.setCheckpointDir(tempfile.mkdtemp(prefix="matchlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared dir (never reused)."""
    return f"{shared_dir(spark).rstrip('/')}/matchlake/{name}-{uuid.uuid4().hex[:12]}"
