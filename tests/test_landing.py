"""Documents dealt by month while they are narrow, and what is written of them."""

import copy
import datetime as dt

from pyspark.sql import functions as F

from matchlake.operators import flatten
from matchlake.plans import job
from matchlake.plans.queries import documents
from matchlake.schemas import BRONZE, RAW_TABLES
from matchlake.session import OPEN_FILES, unsorted_writes
from matchlake.sources import io

from .golden import g1, g6, g7
from .test_job import left_behind, shuffle_files


def bag(df):
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).collect())


def tables(spark, root):
    """Orders of several months: a key in two months and twice in one, keys and
    days that are NULL, teams that are no supplier, one supplier with two names."""
    day = lambda m, d=1: dt.datetime(2022, m, d)
    orders = [(k, k * 3, "FO"[k % 2], day(1 + k % 5, 1 + k), f"{k % 6}-X") for k in range(1, 25)]
    orders += [(3, 4, "F", day(9), "1-X"), (3, 7, "O", day(9), "2-X"), (None, 2, "F", day(2), None), (30, None, "F", day(3), "1-X"), (31, 5, None, None, "1-X")]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    lines = [
        (k, k * 7 % 11, k % 5, n, float(k % 13), k * 100.0 + n, 0.01 * n, "ARN"[(k + n) % 3], "OF"[n % 2])
        for k in [*range(1, 25), 30, 31, 99] for n in (1, 2, 3, 7) for _ in range(1 + k % 2)
    ]
    lines += [(None, 1, 1, 3, 5.0, 100.0, 0.0, "A", "O"), (4, None, None, None, None, None, None, None, None), (4, 2, 1, 3, 1.0, 5.0, 0.0, "A", "F")]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string",
    ).write.parquet(f"{root}/lineitem.parquet")
    names = [(0, "s0"), (1, "s1"), (1, "again"), (2, None), (4, "s4"), (9, "s9")]
    spark.createDataFrame(names, "s_suppkey bigint, s_name string").write.parquet(f"{root}/supplier.parquet")
    return root


def test_documents_dealt_by_month_are_the_same(spark, tmp_root):
    root = tables(spark, tmp_root)
    placed = documents(spark, root, placed=True)
    assert bag(placed) == bag(documents(spark, root))
    months = placed.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set(F.substring("extract_date", 1, 7)).alias("m")).collect()
    seen = [m for r in months for m in r.m]
    assert len(seen) == len(set(seen)) == 6  # no month in two tasks


def test_a_landing_by_month_does_not_deal_documents_again(spark, tmp_root, monkeypatch):
    from matchlake.plans import queries

    root = tables(spark, tmp_root)
    expected = bag(documents(spark, root))

    def exchanged(*_):
        raise AssertionError("whole documents are dealt")

    monkeypatch.setattr(io, "clustered", exchanged)
    for fmt in ("parquet", "json"):
        landed = io.read_bronze(spark, queries.land(spark, root, fmt, layout="month"), fmt=fmt, layout="month")
        assert bag(landed) == expected
    # nor are those of a stream; two of these documents share a match, so the
    # tables are deduplicated by an exchange
    cluster_again = lambda df, col: df.hint("rebalance", col)
    monkeypatch.setattr(io, "clustered", lambda df, col: exchanged() if "maps" in df.columns else cluster_again(df, col))
    want = {n: bag(t.drop("extract_date")) for n, t in job.range_tables(landed).items()}
    known = job.range_tables(landed.where(F.col("extract_date").isNotNull()))  # a stream names the months it got
    assert queries.q_streaming_run(spark, root).count() == sum(t.count() for t in known.values())
    raw = queries.range_run(spark, root)
    assert {n: bag(io.read_raw(spark, raw, n, layout="month")) for n in RAW_TABLES} == want


def test_a_month_has_as_many_places_as_files(spark):
    days = [("2022-01-05",)] * 50 + [("2022-02-01",)] * 5 + [(None,)]
    docs = spark.createDataFrame(days, "extract_date string").withColumn("id", F.monotonically_increasing_id())
    places = io.Places(docs, documents=10)
    at = docs.select("extract_date", places.of(F.col("extract_date"), "id").alias("p"))
    used = {r.extract_date: set(r.p) for r in at.groupBy("extract_date").agg(F.collect_set("p").alias("p")).collect()}
    assert len(used["2022-01-05"]) > 2 and len(used["2022-02-01"]) == 1 and used[None] == {0}
    assert places.partitions == 6
    assert io.Places(docs.where("false")).of(F.lit("2022-01-05"), F.lit(1)) is not None


def test_distinct_rows_are_dealt_once(spark, capsys):
    rows = [("2022-01-01", str(k % 7), None if k % 3 else "x") for k in range(60)] + [("2022-02-01", "1", None), (None, "1", None)] * 2
    df = spark.createDataFrame(rows, "extract_date string, team_id string, name string")
    got = io.Places(df, documents=4).distinct(df)
    assert bag(got) == bag(df.distinct())
    got.explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_partitioned_writes_are_not_sorted(spark, tmp_root):
    before = spark.conf.get(OPEN_FILES, None)
    df = spark.range(1000).select((F.col("id") % 100).alias("part"), F.col("id").alias("v"))
    with unsorted_writes(spark):
        assert int(spark.conf.get(OPEN_FILES)) > 1
        df.write.partitionBy("part").parquet(tmp_root)  # more values than files are kept open
    assert spark.conf.get(OPEN_FILES, None) == before
    assert spark.read.parquet(tmp_root).distinct().count() == 1000


def test_maps_named_twice_and_missing_players(spark):
    twice = g1()
    twice["match_id"] = "800"
    again = copy.deepcopy(twice["stats"][0])
    again["team1"]["total"].append(again["team1"]["total"][0] | {"nick": "other"})
    again["team2"]["ct"] = None
    twice["stats"].append(again)
    twice["stats"][1]["team1"]["ct"] += [None, None, dict.fromkeys(twice["stats"][1]["team1"]["ct"][0])]
    twice["stats"][2]["team2"] = None
    odd = g7()
    odd["stats"][0]["team1"]["total"] += odd["stats"][0]["team1"]["total"] + [None, dict.fromkeys(odd["stats"][0]["team1"]["total"][0])]
    odd["stats"][1]["map"] = None
    bare = g6() | {"stats": None}
    docs = spark.createDataFrame([g1(), twice, odd, bare, g6() | {"match_id": "601", "stats": [None]}], BRONZE)
    for keep in (False, True):
        want = flatten.stats(docs, keep_slot=keep)
        assert bag(flatten.stats(docs, keep_slot=keep, unique=True)) == bag(want) and want.count() > 70


def test_pages_are_landed_by_the_tasks_that_read_them(spark, tmp_root, monkeypatch):
    from matchlake.plans import queries

    root = tables(spark, tmp_root)
    cluster = io.clustered

    def clustered(df, col):
        assert "maps" not in df.columns, "whole documents are dealt"
        return cluster(df, col)

    monkeypatch.setattr(io, "clustered", clustered)
    assert queries.q_pages_to_raw(spark, root).count() > 100


def test_stored_ranges_leave_no_shuffle_files(spark):
    from matchlake.plans import models

    df = spark.range(1000).select(F.xxhash64("id").alias("v"))
    before = shuffle_files(spark)
    x = models.with_position(df, "v")
    assert not left_behind(spark, before)
    assert x.agg(F.count_distinct("position")).first()[0] == x.agg(F.max("position")).first()[0] == 1000
