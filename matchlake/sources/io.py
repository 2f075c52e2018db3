"""Reading and writing bronze documents and raw tables.

Layout: ``<root>/extract_date=<yyyy-MM-dd>/part-*`` for landed bronze, and
``<raw_root>/<table>/run=<id>/extract_date=.../`` for the raw tables. The day
column is a Hive-style partition: a day predicate prunes directories. A run
stands for some partitions (``Cover``) and replaces them in all tables at the
moment it is published in the commit log (``commits``), even where nothing is
left of them. (The reference appends, which duplicates rows on a re-run;
``mode='append'`` keeps that on request.)
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE, RAW, RAW_TABLES
from ..session import released, scratch_path, unsorted_writes
from . import commits
from .commits import RUN, Cover

PART = "extract_date"
MONTH = "extract_month"
CORRUPT = "_corrupt_record"
# beside a landing folder: runs that replace parts of it, and their log
RUNS, COMMITS = ".runs", ".commits"
# storage layouts: directory column per layout; "day" is the reference's
LAYOUTS = {"day": PART, "month": MONTH}
# of landed documents, raw tables and scratch tables as large
COMPRESSION = {"parquet": "zstd", "json": "gzip"}
# where a row is dealt to be landed, and of how many documents a file is made
PLACE = "_place"
DOCUMENTS_A_FILE = 100_000


def _with_part(schema: T.StructType, layout: str = "day") -> T.StructType:
    # declaring the partition column keeps it text (inference would make it DATE)
    extra = [T.StructField(PART, T.StringType(), True)]
    if layout == "month":
        extra.append(T.StructField(MONTH, T.StringType(), True))
    return T.StructType(list(schema.fields) + extra)


def with_layout(df: DataFrame, layout: str) -> DataFrame:
    """Add the directory column of the layout (month = first 7 chars of the day)."""
    if layout == "month" and MONTH not in df.columns:
        return df.withColumn(MONTH, F.substring(F.col(PART), 1, 7))
    return df


def day_filter(
    day: str | None = None, start: str | None = None, end: str | None = None, layout: str = "day"
) -> Column | None:
    """Predicate on the day; for the month layout the matching predicate on
    the directory column is added, so directories are pruned at planning."""
    c = F.col(PART)
    m = F.col(MONTH)
    if day is not None:
        cond = c == day
        return cond & (m == day[:7]) if layout == "month" else cond
    cond = None
    if start is not None:
        cond = c >= start
        if layout == "month":
            cond = cond & (m >= start[:7])
    if end is not None:
        e = c <= end
        if layout == "month":
            e = e & (m <= end[:7])
        cond = e if cond is None else cond & e
    return cond


# ---- bronze (S1-S3, S9) --------------------------------------------------------
def read_bronze(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    day: str | None = None,
    start: str | None = None,
    end: str | None = None,
    layout: str = "day",
) -> DataFrame:
    """Documents under ``root`` with the fixed bronze schema.

    JSON is read in line mode; a line holding a whole JSON array (the
    reference's daily file) yields one row per element. Only the given day or
    range is listed and read. Malformed JSON lines are left out here;
    ``malformed`` returns them.
    """
    df = _load(spark, root, fmt, day_filter(day, start, end, layout), layout)
    return df.where(_well_formed()).drop(CORRUPT) if fmt == "json" else df


def malformed(
    spark: SparkSession, root: str, day: str | None = None, start: str | None = None, end: str | None = None,
    layout: str = "day",
) -> DataFrame:
    """The JSON lines that are no documents, with their day: for a side table."""
    df = _load(spark, root, "json", day_filter(day, start, end, layout), layout)
    return df.where(~_well_formed()).select(PART, F.col(CORRUPT).alias("line"))


def parsed_lines(spark: SparkSession, root: str, layout: str = "day") -> DataFrame:
    """Good and malformed JSON lines side by side, from one parse: the
    landed text is read and parsed once into a scratch table, with the raw line
    in ``_corrupt_record`` where it is no document. The directory column of the
    layout stays, as a broken line has no day of its own."""
    df = _load(spark, root, "json", None, layout, keep_directory=True)
    path = scratch_path(spark, "parsed-lines")
    df.write.parquet(path, compression=COMPRESSION["parquet"])
    return spark.read.schema(df.schema).parquet(path)


def _well_formed() -> Column:
    # Spark refuses to read the corrupt column of raw JSON alone, as a count
    # would: a second column, in a test that is always true
    return F.col(CORRUPT).isNull() & (F.length(F.coalesce("match_id", F.lit(""))) >= 0)


def read_days(spark: SparkSession, root: str, days: list[str], fmt: str = "parquet", layout: str = "day") -> DataFrame:
    """Documents of the listed days (or months): a literal list, so that only
    their directories are read."""
    df = _load(spark, root, fmt, F.col(LAYOUTS[layout]).isin(days), layout)
    return df.where(_well_formed()).drop(CORRUPT) if fmt == "json" else df


def _load(
    spark: SparkSession, root: str, fmt: str, cond: Column | None, layout: str, keep_directory: bool = False
) -> DataFrame:
    """Landed files, without what published runs have replaced, and the runs."""
    schema = _with_part(BRONZE, layout)
    options = {}
    if fmt == "json":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    root, col = root.rstrip("/"), LAYOUTS[layout]
    runs = commits.read_log(spark, f"{root}{COMMITS}")
    if not runs:
        df = spark.read.schema(schema).options(**options).format(fmt).load(root)
    else:
        commits.check_layout(runs, layout)
        parts = []
        gone = commits.hidden(runs, Cover())
        plain = commits.load(spark, fmt, schema, root, **options) if gone is not None else None
        if plain is not None:
            parts.append(plain.where(~reduce(or_, [c.column(col) for c in gone])) if gone else plain)
        with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType(), True)])
        new = commits.live_rows(spark, fmt, with_run, f"{root}{RUNS}", runs, col, **options)
        if new is not None:
            parts.append(new.drop(RUN))
        df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    df = df if cond is None else df.where(cond)
    return df.drop(MONTH) if layout == "month" and not keep_directory else df


class Places:
    """Deals the rows of documents by the month they are landed in, while they
    are narrow: the tasks that assemble the documents then write them.

    A month has as many places as its documents fill files, and a match has one
    of them. The places are dealt round to the partitions, so that none gets many
    by chance. ``docs`` has the day of every document as ``extract_date``; one
    number a month reaches the driver."""

    def __init__(self, docs: DataFrame, documents: int = DOCUMENTS_A_FILE):
        spark = docs.sparkSession
        per_month = docs.groupBy(F.substring(PART, 1, 7).alias(MONTH)).agg(F.count(F.lit(1)).alias("n"))
        with released(spark):
            counts = per_month.where(F.col(MONTH).isNotNull()).orderBy(MONTH).collect()
        self.months: dict[str, tuple[int, int]] = {}
        places = 0
        for month, n in counts:
            self.months[month] = (places, -(-n // documents))
            places += -(-n // documents)
        self.partitions = max(1, min(places, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def of(self, day: Column, *key: Column | str) -> Column:
        """The place of a document; documents without a day share one."""
        if not self.months:
            return F.lit(0)
        entries = [c for m, (first, parts) in self.months.items() for c in (F.lit(m), F.struct(F.lit(first).alias("first"), F.lit(parts).alias("parts")))]
        at = F.try_element_at(F.create_map(*entries), F.substring(day, 1, 7))
        place = at["first"] + F.pmod(F.xxhash64(*key), at["parts"])
        return F.coalesce(F.pmod(place, F.lit(self.partitions)), F.lit(0)).cast("int")

    def deal(self, df: DataFrame) -> DataFrame:
        """Rows with a place to the partition of their place."""
        return df.repartitionById(self.partitions, PLACE)

    def distinct(self, df: DataFrame) -> DataFrame:
        """The distinct rows of a frame with the day, dealt by month: equal rows
        have one place."""
        placed = df.withColumn(PLACE, self.of(F.col(PART), *df.columns))
        return self.deal(placed).dropDuplicates().drop(PLACE)


def clustered(df: DataFrame, col: str) -> DataFrame:
    """Rows of one partition value together before a partitioned write, so
    each value gets few files. A rebalance, not a repartition: AQE splits a
    hot value (a day holding a third of the rows) over several tasks and
    merges small ones."""
    return df.hint("rebalance", col)


def _written_values(spark: SparkSession, path: str, schema: T.StructType, col: str, fmt: str = "parquet") -> set[str]:
    """The partition values of a table: names of its folders, no rows are read."""
    df = commits.load(spark, fmt, schema, path)
    return {r[0] for r in df.select(col).distinct().collect() if r[0] is not None} if df is not None else set()


def land_documents(
    docs: DataFrame, root: str, fmt: str = "parquet", mode: str = "overwrite", layout: str = "day",
    cover: Cover | None = None, as_read: bool = False,
) -> None:
    """S3: write documents into day (or month) partitions, non-ASCII text as
    UTF-8.

    Plainly, ``mode='overwrite'`` replaces the partitions present in ``docs``.
    With ``cover`` the documents replace all of those partitions, also the ones
    that they leave empty, at one moment: they are written as a run beside the
    landing folder and published in its commit log (see ``commits``).

    The tasks that read ``docs`` write them where ``as_read`` tells that they
    come from files of few partition values each, as landed documents do, or
    were dealt so (``Places``); others go through an exchange, whose files are
    removed when it is done."""
    col = LAYOUTS[layout]
    root = root.rstrip("/")
    run = commits.new_run()
    placed = with_layout(docs, layout)
    w = (placed if as_read else clustered(placed, col)).write.partitionBy(col).option("partitionOverwriteMode", "dynamic")
    # explicit nulls, as the reference's json.dump writes them (a reader
    # that infers the schema then still sees every field)
    # compressed: the field names make plain lines a dozen times as large
    w = w.option("ignoreNullFields", "false") if fmt == "json" else w
    w = w.option("compression", COMPRESSION[fmt]) if fmt in COMPRESSION else w
    with released(docs.sparkSession), unsorted_writes(docs.sparkSession):
        if cover is None:
            w.mode(mode).format(fmt).save(root)
            return
        w.mode("errorifexists").format(fmt).save(f"{root}{RUNS}/{RUN}={run}")
    commits.publish(docs.sparkSession, f"{root}{COMMITS}", run, mode, layout, cover)


def is_empty(df: DataFrame) -> bool:
    """Cheap emptiness probe (reads at most one row)."""
    return df.isEmpty()


# ---- raw tables (S4-S6) --------------------------------------------------------------
def check_schema(name: str, df: DataFrame) -> DataFrame:
    """The frame must carry the raw table's columns; they are selected in
    DDL order and cast to the declared types."""
    cols = []
    have = set(df.columns)
    for f in RAW[name].fields:
        if f.name not in have:
            raise ValueError(f"raw table {name}: missing column {f.name}")
        cols.append(F.col(f.name).cast(f.dataType))
    extra = [PART] if PART in have else []
    return df.select(*cols, *extra)


def write_raw(
    tables: dict[str, DataFrame],
    raw_root: str,
    mode: str = "overwrite",
    layout: str = "day",
    parallel: bool = True,
    cover: Cover | None = None,
    as_read: Collection[str] = (),
) -> None:
    """The raw tables of one run, partitioned by the storage day (or
    month), published together: readers see all of them or none.

    ``mode='overwrite'`` replaces the partitions of ``cover``, also those that
    the new rows leave empty (without ``cover``: the partitions written);
    ``'append'`` is the reference's behaviour (rows repeat on a re-run).
    With ``parallel`` the tables are written as concurrent Spark jobs (one
    thread each submits its job; the cluster runs their tasks side by side);
    the first failure is raised after all writes have finished, and nothing of
    the run is published then. The shuffle files of each table are removed
    when it is written. The tables named in ``as_read`` are written from
    the tasks that read their input, without an exchange: for rows that come
    from files of few partition values each, as landed documents do, or were
    dealt so."""
    col, root, run = LAYOUTS[layout], raw_root.rstrip("/"), commits.new_run()

    def write(name: str, df: DataFrame) -> None:
        out = check_schema(name, df)
        w = out.write
        if PART in out.columns:
            placed = with_layout(out, layout)
            w = (placed if name in as_read else clustered(placed, col)).write.partitionBy(col)
        w.mode("errorifexists").parquet(f"{root}/{name}/{RUN}={run}", compression=COMPRESSION["parquet"])

    spark = next(iter(tables.values())).sparkSession
    with released(spark), unsorted_writes(spark):
        if not parallel or len(tables) < 2:
            for name, df in tables.items():
                write(name, df)
        else:
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(max_workers=len(tables)) as pool:
                futures = [pool.submit(write, name, df) for name, df in tables.items()]
            errors = [f.exception() for f in futures if f.exception() is not None]
            if errors:
                raise errors[0]
    if cover is None:
        paths = [(f"{root}/{n}/{RUN}={run}", _with_part(RAW[n], layout)) for n, df in tables.items() if PART in df.columns]
        values = set().union(*[_written_values(spark, p, schema, col) for p, schema in paths])
        cover = Cover(values=tuple(sorted(values))) if paths else Cover()
    commits.publish(spark, f"{root}/commits", run, mode, layout, cover)


def read_raw(
    spark: SparkSession, raw_root: str, name: str, keep_day: bool = False, layout: str = "day",
    runs: Sequence[commits.Run] | None = None,
) -> DataFrame:
    """A raw table by logical name, as the published runs leave it (or the
    given ones: a snapshot of several tables); the storage day is dropped
    unless asked."""
    root = raw_root.rstrip("/")
    runs = commits.read_log(spark, f"{root}/commits") if runs is None else runs
    if not runs:
        raise ValueError(f"no published run below {root}")
    commits.check_layout(runs, layout)
    schema = _with_part(RAW[name], layout)
    with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType(), True)])
    df = commits.live_rows(spark, "parquet", with_run, f"{root}/{name}", runs, LAYOUTS[layout])
    df = df.drop(RUN) if df is not None else spark.createDataFrame([], schema)
    if layout == "month":
        df = df.drop(MONTH)
    return df if keep_day else df.drop(PART)


def compact(spark: SparkSession, raw_root: str, layout: str = "day") -> None:
    """Fold all published runs into one: the log's later readers need no other."""
    runs = commits.read_log(spark, f"{raw_root.rstrip('/')}/commits")
    tables = {n: read_raw(spark, raw_root, n, keep_day=True, layout=layout, runs=runs) for n in RAW_TABLES}
    write_raw(tables, raw_root, layout=layout, cover=Cover())


class RawCatalog:
    """Logical names to tables; models take the frames from here."""

    def __init__(
        self, spark: SparkSession, raw_root: str, maps: DataFrame | None = None, layout: str = "day"
    ):
        self.spark, self.root, self._maps, self.layout = spark, raw_root, maps, layout
        # one snapshot for all tables
        self.runs = commits.read_log(spark, f"{raw_root.rstrip('/')}/commits")

    def __getitem__(self, name: str) -> DataFrame:
        if name == "maps":
            from .adapters import maps_dimension

            return self._maps if self._maps is not None else maps_dimension(self.spark)
        return read_raw(self.spark, self.root, name, layout=self.layout, runs=self.runs)

    def register_views(self, names: Iterable[str] = tuple(RAW) + ("maps",)) -> None:
        for n in names:
            self[n].createOrReplaceTempView(n)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """S4 (JDBC variant): append to a database table; URL and credentials come
    from the caller's configuration, never from code."""
    df.write.format("jdbc").options(url=url, dbtable=table, **properties).mode(mode).save()
