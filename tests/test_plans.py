"""Guards on the physical plans the scale design relies on."""

from matchlake.operators import flatten
from matchlake.plans import job, models
from matchlake.plans.queries import documents, raw
from matchlake.sources import io


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_map_results_is_a_semi_join_without_fan_out(spark):
    r = raw(spark, "/root/testdata/sf0.001", materialize=True)
    p = plan(models.stg_maps_results(r.stored("mr", r.maps_results()), r.matchs(), r.teams()))
    assert "LeftSemi" in p
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_stats_model_shuffles_each_side_once_on_the_join_keys(spark):
    r = raw(spark, "/root/testdata/sf0.001", materialize=True)
    ms = r.stored("ms", r.match_stats())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(models.stg_match_stats(ms))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    p = p.split("== Initial Plan ==")[0]
    assert p.count("Exchange hashpartitioning(match_id") == 3 and "sequence" not in p


def test_listed_days_prune_and_json_is_parsed_once(spark, tmp_root):
    d = documents(spark, "/root/testdata/sf0.001")
    day = d.select("extract_date").first().extract_date
    io.land_documents(d.where(d.extract_date.isin(day, "1999-01-01")), tmp_root, fmt="json")
    docs = io.read_days(spark, tmp_root, [day], "json")
    assert day in plan(docs).split("PartitionFilters: [")[1].split("]")[0]
    parsed = job._parsed(spark, docs, "json")
    assert all("json" not in plan(t).split("FileScan")[1][:10] for t in job.range_tables(parsed).values())


def test_flatten_stats_is_one_generator_and_one_dedupe(spark, tmp_root):
    io.land_documents(documents(spark, "/root/testdata/sf0.001"), tmp_root, layout="month")
    docs = io.read_bronze(spark, tmp_root, layout="month")
    p = plan(flatten.stats(docs))
    assert p.count("FileScan") == 1
    assert p.count("Generate explode(stats") == 1
    scan = [line for line in p.splitlines() if "FileScan" in line][0]
    assert "maps" not in scan.split("]")[0] and "teams" not in scan.split("]")[0]  # nested/column pruning
    w2 = plan(job.range_tables(docs)["maps_vetos"])
    assert w2.count("FileScan") == 1


def test_day_read_prunes_partitions(spark, tmp_root):
    d = documents(spark, "/root/testdata/sf0.001")
    day = d.select("extract_date").first().extract_date
    io.land_documents(d.where(d.extract_date.isin(day, "1999-01-01")), tmp_root)
    p = plan(io.read_bronze(spark, tmp_root, day=day))
    assert "PartitionFilters: [isnotnull(extract_date" in p and day in p


def before_aqe(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_groups_are_dealt_by_order_once(spark):
    p = before_aqe(raw(spark, "/root/testdata/sf0.001").line_groups())
    assert "hashpartitioning(l_orderkey" in p and "l_linenumber" not in "".join(x for x in p.splitlines() if "Exchange" in x)


def test_documents_are_assembled_from_narrow_rows(spark):
    # each frame is dealt by match before its rows are unnested, and not again
    lines = before_aqe(documents(spark, "/root/testdata/sf0.001")).splitlines()
    at = [k for k, x in enumerate(lines) if "Generate explode" in x or "Generate posexplode" in x]
    below = [next(x for x in lines[k:] if "Exchange" in x or "Scan" in x) for k in at]
    assert len(at) == 2 and all("hashpartitioning(match_id" in x and "REPARTITION_BY_COL" in x for x in below)
    assert sum("Exchange hashpartitioning(match_id" in x for x in lines) == 4


def test_landed_documents_are_unnested_without_an_exchange(spark, tmp_root):
    io.land_documents(documents(spark, "/root/testdata/sf0.001"), tmp_root, layout="month")
    docs = io.read_bronze(spark, tmp_root, layout="month")
    assert job.one_document_each(docs) and not job.one_document_each(docs.unionByName(docs.limit(1)))
    tables = job.range_tables(docs, unique=True)
    assert not any("Exchange" in before_aqe(tables[n]) for n in flatten.PER_MATCH)


def test_map_results_are_dealt_once_for_both_sides(spark):
    from pyspark.sql import functions as F

    r = raw(spark, "/root/testdata/sf0.001", materialize=True)
    mr = r.stored("mr", r.maps_results())
    p = before_aqe(models.stg_maps_results(mr, r.matchs(), r.teams()))
    assert "hashpartitioning(match_id#" in p and "choice_number" not in "".join(x for x in p.splitlines() if "Exchange" in x)
    # copies of a row, and rows without a name, match or choice, add nothing
    odd = mr.limit(20)
    for c in ("team_name", "match_id", "choice_number"):
        mr = mr.unionByName(odd.withColumn(c, F.lit(None).cast("string")))
    more = models.stg_maps_results(mr.unionByName(odd), r.matchs(), r.teams())
    want = models.stg_maps_results(r.stored("mr", mr), r.matchs(), r.teams())
    assert sorted(map(str, more.collect())) == sorted(map(str, want.collect()))


def test_positions_are_given_where_the_ranges_are_stored(spark):
    df = spark.range(1000).selectExpr("cast(id * 7919 % 1000 as string) AS k", "if(id % 9 = 0, null, id % 5) AS v")
    x = models.with_position(df, "v", "k")
    assert "Exchange hashpartitioning(_range" not in before_aqe(x).replace("Exchange hashpartitioning(_range#", "", 1)
    assert "SortMergeJoin" not in before_aqe(x)
    rows = sorted(x.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 1001))
    assert [(r.v, r.k) for r in rows] == sorted(((r.v, r.k) for r in rows), key=lambda t: (t[0] is None, t[0] or 0, t[1]))
