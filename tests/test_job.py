import json
import os
import time

from pyspark.sql import functions as F

from matchlake.plans import job
from matchlake.plans.queries import documents
from matchlake.schemas import RAW_TABLES
from matchlake.session import RELEASE
from matchlake.sources import io

from .golden import g1, g6


def three_days(spark):
    d = documents(spark, "/root/testdata/sf0.001")
    days = [r.extract_date for r in d.select("extract_date").distinct().orderBy("extract_date").limit(3).collect()]
    return d.where(F.col("extract_date").isin(days)), days


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_runs_equal_range_run_and_rerun_is_idempotent(spark, tmp_root):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze)
    per_day, ranged = f"{tmp_root}/per_day", f"{tmp_root}/ranged"
    for d in days:
        assert job.run_day(spark, bronze, d, per_day)
    job.run_range(spark, bronze, ranged, start=days[0], end=days[-1])
    for name in RAW_TABLES:
        a = io.read_raw(spark, per_day, name, keep_day=True)
        b = io.read_raw(spark, ranged, name, keep_day=True).select(*a.columns)
        assert bag(a) == bag(b), name
    before = {n: io.read_raw(spark, per_day, n).count() for n in RAW_TABLES}
    job.run_day(spark, bronze, days[0], per_day)  # dynamic overwrite: replaces the day
    assert {n: io.read_raw(spark, per_day, n).count() for n in RAW_TABLES} == before
    job.run_day(spark, bronze, days[0], per_day, mode="append")  # the reference's append
    m = io.read_raw(spark, per_day, "matchs", keep_day=True).where(F.col("extract_date") == days[0])
    single = io.read_raw(spark, ranged, "matchs", keep_day=True).where(F.col("extract_date") == days[0])
    assert m.count() == 2 * single.count()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for k in range(files.size()) if (f := files.apply(k).getName()).startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that came since; their removal may take a moment."""
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_stored_steps_leave_no_shuffle_files(spark, tmp_root):
    docs, days = three_days(spark)
    bronze, raw = f"{tmp_root}/bronze", f"{tmp_root}/raw"
    setting = spark.conf.get(RELEASE, None)
    before = shuffle_files(spark)
    io.land_documents(docs, bronze, layout="month")
    assert not left_behind(spark, before)
    for _ in range(2):
        job.run_range(spark, bronze, raw, layout="month")
    assert not left_behind(spark, before)
    assert spark.conf.get(RELEASE, None) == setting
    assert io.read_raw(spark, raw, "matchs", layout="month").count() == docs.count()


def test_corrected_documents_are_landed_by_the_tasks_that_read_them(spark, tmp_root, monkeypatch):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze, layout="month")
    d = io.read_bronze(spark, bronze, layout="month").withColumn("type", F.lit("corrected"))
    expected = bag(d.select("match_id", "type", "extract_date").where(F.col("extract_date") != days[0]))

    def exchanged(*_):
        raise AssertionError("the documents are dealt again")

    monkeypatch.setattr(io, "clustered", exchanged)
    io.land_documents(d.where(F.col("extract_date") != days[0]), bronze, layout="month", cover=io.Cover(), as_read=True)
    got = io.read_bronze(spark, bronze, layout="month").select("match_id", "type", "extract_date")
    assert bag(got) == expected and expected


def test_match_date_is_day_before(spark, tmp_root):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze)
    out = f"{tmp_root}/raw"
    job.run_day(spark, bronze, days[1], out)
    dates = {r.date for r in io.read_raw(spark, out, "matchs").collect()}
    import datetime as dt

    assert dates == {(dt.date.fromisoformat(days[1]) - dt.timedelta(days=1)).isoformat()}


def test_empty_day_is_skipped(spark, tmp_root):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze)
    assert job.run_day(spark, bronze, "1900-01-01", f"{tmp_root}/raw", skip_if_empty=True) is False


def test_reads_the_daily_json_array_file_and_prunes(spark, tmp_root):
    # the reference lands a whole day as one JSON array on one line
    day_dir = f"{tmp_root}/landing/extract_date=2022-02-26"
    local = day_dir.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/matches_20220226.json", "w", encoding="utf-8") as fh:
        json.dump([g1(), g6()], fh, ensure_ascii=False)
    df = io.read_bronze(spark, f"{tmp_root}/landing", fmt="json", day="2022-02-26")
    assert sorted(r.match_id for r in df.collect()) == ["100", "600"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "extract_date" in plan
    t = job.day_tables(df, "2022-02-26")
    assert {r.date for r in t["matchs"].collect()} == {"2022-02-25"}


def test_month_layout_requires_whole_months(spark, tmp_root):
    import pytest

    with pytest.raises(ValueError):
        job.run_range(spark, tmp_root, tmp_root, start="2022-02-03", layout="month")


def test_cli_runs_a_range(spark, tmp_root):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze)
    out = f"{tmp_root}/cli"
    job.main(["--src", bronze, "--dst", out, "--start", days[0], "--end", days[-1]])
    assert io.read_raw(spark, out, "matchs").count() == docs.count()


def test_parallel_write_raises_the_first_error(spark, tmp_root):
    import pytest

    good = spark.createDataFrame([("1", "a", "l")], "team_id string, name string, link string")
    bad = spark.createDataFrame([("1",)], "player_id string")  # lacks team_id, nick
    with pytest.raises(ValueError):
        io.write_raw({"teams": good, "players": bad}, f"{tmp_root}/raw")


def test_models_published_as_views(spark, tmp_root):
    from matchlake.plans import models
    from matchlake.plans.queries import raw

    r = raw(spark, "/root/testdata/sf0.001")
    frames = r.tables()
    models.publish(frames)
    n = spark.sql("SELECT count(*) AS n FROM stg_matchs").first().n
    assert n == frames["matchs"].count()
    assert spark.sql("SELECT count(*) AS n FROM stg_maps").first().n == 7


def test_a_corrected_day_replaces_the_day(spark, tmp_root):
    docs, days = three_days(spark)
    bronze, raw = f"{tmp_root}/bronze", f"{tmp_root}/raw"
    io.land_documents(docs, bronze)
    for d in days:
        job.run_day(spark, bronze, d, raw)

    def rows(name, day):
        return io.read_raw(spark, raw, name, keep_day=True).where(F.col("extract_date") == day).count()

    others = {n: rows(n, days[1]) for n in RAW_TABLES}
    # the corrected extract of the first day has no bans, that of the last is empty
    first = docs.where(F.col("extract_date") == days[0])
    first = first.withColumn("maps", F.col("maps").withField("bans", F.slice("maps.bans", 1, 0)))
    io.land_documents(first, bronze, cover=io.Cover(values=(days[0],)))
    io.land_documents(docs.where("false"), bronze, cover=io.Cover(values=(days[2],)))
    assert job.run_day(spark, bronze, days[0], raw)
    assert not job.run_day(spark, bronze, days[2], raw, skip_if_empty=True)
    assert rows("maps_vetos", days[0]) == rows("maps_results", days[0]) == 0 < rows("matchs", days[0])
    assert all(rows(n, days[2]) == 0 for n in RAW_TABLES)
    assert {n: rows(n, days[1]) for n in RAW_TABLES} == others


def test_a_failed_run_changes_nothing(spark, tmp_root):
    import pytest

    docs, days = three_days(spark)
    bronze, raw = f"{tmp_root}/bronze", f"{tmp_root}/raw"
    io.land_documents(docs, bronze)
    job.run_range(spark, bronze, raw)
    cat = io.RawCatalog(spark, raw)
    before = {n: bag(io.read_raw(spark, raw, n, keep_day=True)) for n in RAW_TABLES}
    tables = job.range_tables(docs.where(F.col("extract_date") == days[0]).withColumn("type", F.lit("new")))
    # the last of the six tables dies while its rows are written
    dying = tables | {"match_stats": tables["match_stats"].withColumn("nick", F.raise_error(F.lit("killed")).cast("string"))}
    for parallel in (True, False):
        with pytest.raises(Exception, match="killed"):
            io.write_raw(dying, raw, cover=io.Cover(), parallel=parallel)
        assert {n: bag(io.read_raw(spark, raw, n, keep_day=True)) for n in RAW_TABLES} == before
    # the whole run, published: one day instead of three; the older catalog still reads its snapshot
    io.write_raw(tables, raw, cover=io.Cover())
    after = io.read_raw(spark, raw, "matchs", keep_day=True).collect()
    assert {(r.extract_date, r.type) for r in after} == {(days[0], "new")}
    assert cat["matchs"].count() == len(before["matchs"])


def test_runs_replace_what_they_cover(spark, tmp_root):
    def frame(rows):
        return {"players": spark.createDataFrame(rows, "player_id string, team_id string, nick string, extract_date string")}

    def shown():
        return sorted((r.extract_date, r.nick) for r in io.read_raw(spark, tmp_root, "players", keep_day=True).collect())

    def put(nick, days, **how):
        io.write_raw(frame([("1", "2", nick, f"2022-01-0{d}") for d in days]), tmp_root, **how)

    put("a", "123", cover=io.Cover())
    put("b", "2")  # the partitions written
    assert shown() == [("2022-01-01", "a"), ("2022-01-02", "b"), ("2022-01-03", "a")]
    put("c", "2", mode="append")
    assert shown()[1:3] == [("2022-01-02", "b"), ("2022-01-02", "c")]
    put("d", "3", cover=io.Cover(low="2022-01-02"))  # the second is left empty
    assert shown() == [("2022-01-01", "a"), ("2022-01-03", "d")]
    io.write_raw({"players": frame([("1", "2", "x", "2022-01-01")])["players"].where("false")}, tmp_root, cover=io.Cover(high="2022-01-01"))
    assert shown() == [("2022-01-03", "d")]
    live, _ = io.commits.visible(io.commits.read_log(spark, f"{tmp_root}/commits"), "extract_date")
    assert len(live) == 3  # of five runs: the first is covered by two later ones together
    import pytest

    with pytest.raises(ValueError):
        io.read_raw(spark, tmp_root, "players", layout="month")
    with pytest.raises(ValueError):
        io.read_raw(spark, f"{tmp_root}-none", "players")


def test_compaction_keeps_every_row(spark, tmp_root):
    docs, days = three_days(spark)
    bronze, raw = f"{tmp_root}/bronze", f"{tmp_root}/raw"
    io.land_documents(docs, bronze)
    for d in days:
        job.run_day(spark, bronze, d, raw)
    job.run_day(spark, bronze, days[1], raw, mode="append")
    before = {n: bag(io.read_raw(spark, raw, n, keep_day=True)) for n in RAW_TABLES}
    io.compact(spark, raw)
    assert {n: bag(io.read_raw(spark, raw, n, keep_day=True)) for n in RAW_TABLES} == before
    live, _ = io.commits.visible(io.commits.read_log(spark, f"{raw}/commits"), "extract_date")
    assert len(live) == 1


def test_covers():
    c = io.Cover
    a, b, v = c("2", "5"), c("4", None), c(values=("3", "9"))
    assert a.touches(b) and not c("1", "3").touches(b) and v.touches(a) and a.touches(v) and not v.touches(c("4", "8"))
    assert c("4", "5").within(a) and not b.within(a) and a.within(c()) and not c().within(a) and v.within(c("3", None)) and not a.within(v)


def test_malformed_lines_are_set_aside(spark, tmp_root):
    local = f"{tmp_root}/landing/extract_date=2022-02-26".replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.json", "w", encoding="utf-8") as fh:
        fh.write(json.dumps(g1()) + "\n{broken\n")
    root = f"{tmp_root}/landing"
    assert [r.match_id for r in io.read_bronze(spark, root, fmt="json").collect()] == ["100"]
    assert [tuple(r) for r in io.malformed(spark, root).collect()] == [("2022-02-26", "{broken")]


def test_one_parse_gives_both_sides(spark, tmp_root):
    local = f"{tmp_root}/landing/extract_date=2022-02-26".replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/a.json", "w", encoding="utf-8") as fh:
        fh.write(json.dumps(g1()) + "\n{broken\n\n[1, 2\n" + json.dumps([g1(), g6()]) + "\n")
    both = io.parsed_lines(spark, f"{tmp_root}/landing").collect()
    good = sorted(r.match_id for r in both if r[io.CORRUPT] is None)
    assert good == ["100", "100", "600"]
    assert sorted(r[io.CORRUPT] for r in both if r[io.CORRUPT] is not None) == ["[1, 2", "{broken"]
    assert {r.extract_date for r in both} == {"2022-02-26"}


def test_cli_rejects_a_month_layout_for_one_day(spark, tmp_root):
    import pytest

    with pytest.raises(SystemExit):
        job.main(["--src", tmp_root, "--dst", tmp_root, "--process-date", "2022-02-26", "--layout", "month"])


def test_landed_json_is_compressed(spark, tmp_root):
    docs, days = three_days(spark)
    io.land_documents(docs, f"{tmp_root}/json", fmt="json")
    local = f"{tmp_root}/json".replace("file:", "")
    files = [f for _, _, names in os.walk(local) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    back = io.read_bronze(spark, f"{tmp_root}/json", fmt="json")
    assert bag(back.select("match_id", "teams", "extract_date")) == bag(docs.select("match_id", "teams", "extract_date"))


def test_documents_that_share_a_match_are_deduplicated(spark, tmp_root):
    docs, days = three_days(spark)
    bronze = f"{tmp_root}/bronze"
    io.land_documents(docs, bronze)
    io.land_documents(docs.where(F.col("extract_date") == days[0]), bronze, mode="append")
    job.run_range(spark, bronze, f"{tmp_root}/raw")
    want = job.range_tables(docs)
    for name in RAW_TABLES:
        got = io.read_raw(spark, f"{tmp_root}/raw", name, keep_day=True)
        assert bag(got) == bag(want[name].select(*got.columns)), name
