"""Registry of the queries checked against the DuckDB oracle.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables at that scale factor; nothing is collected. Queries that reuse
a derived input, or that exercise landing and the jobs, first write those
inputs / outputs as tables below the shared checkpoint folder, and the
returned frame reads them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import day_before
from ..operators import assemble, extract, flatten, pages
from ..schemas import RAW, RAW_TABLES
from ..session import released, scratch_path
from ..sources import catalog, io
from ..sources.adapters import RawFromDriver, TextFromDriver, maps_dimension, rendered_pages
from ..sources.tables import DriverTables
from ..streaming import incremental
from . import job, models
from . import oracle as _oracle

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str, materialize: bool = False, placed: bool = False) -> RawFromDriver:
    return RawFromDriver(DriverTables(spark, sf_dir), materialize=materialize, placed=placed)


# ---- models -----------------------------------------------------------------
def q_stg_matchs(spark, sf_dir):
    return models.stg_matchs(raw(spark, sf_dir).matchs())


def q_stg_teams(spark, sf_dir):
    return models.stg_teams(raw(spark, sf_dir).teams())


def q_stg_players(spark, sf_dir):
    return models.stg_players(raw(spark, sf_dir).players())


def q_stg_maps_vetos(spark, sf_dir):
    r = raw(spark, sf_dir)
    return models.stg_maps_vetos(r.maps_vetos(), r.maps())


def q_stg_match_stats(spark, sf_dir):
    r = raw(spark, sf_dir, materialize=True)
    return models.stg_match_stats(r.stored("match_stats", r.match_stats()))


def q_stg_match_stats_lists(spark, sf_dir):
    """M6 by J4'."""
    r = raw(spark, sf_dir, materialize=True)
    return models.stg_match_stats_lists(r.stored("match_stats", r.match_stats()))


def q_stg_maps_results(spark, sf_dir):
    # the results table feeds three branches of the model: derive it once
    r = raw(spark, sf_dir, materialize=True)
    return models.stg_maps_results(r.stored("maps_results", r.maps_results()), r.matchs(), r.teams())


def q_last_sorts(spark, sf_dir):
    """O1: the map-results model in its written order (match_id, then
    map_choice, NULLs last): a range-partitioned global sort."""
    return models.ordered_maps_results(q_stg_maps_results(spark, sf_dir))


def q_sorted_positions(spark, sf_dir):
    """O1 and O2 as data: the place of every row in the models' written order,
    made total by the rest of the row's keys."""
    r = raw(spark, sf_dir, materialize=True)
    results = models.stg_maps_results(r.stored("maps_results", r.maps_results()), r.matchs(), r.teams())
    order = ("match_id", "map_choice", "choice_number", "map_name", "pick_team_id", "team1_id", "team1_result", "team2_id")
    by_match = models.with_position(results.select(*order), *order)
    stats = models.stg_match_stats(r.stored("match_stats", r.match_stats()))
    keys = ("map_name", "match_id", "player_id", "team_id", "kd_total", "adr_total", "kd_ct", "adr_ct", "kd_tr", "adr_tr")
    by_map = models.with_position(stats.select(*keys), *keys)

    def rows(name, df, columns):
        text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("-")) for c in columns])
        return df.select(F.lit(name).alias("model"), "position", F.md5(text.cast("binary")).alias("row_md5"))

    return rows("stg_maps_results", by_match, order).unionByName(rows("stg_match_stats", by_map, keys))


def q_pair_bounds(spark, sf_dir):
    r = raw(spark, sf_dir)
    return models.pair_bounds(r.maps_results(), r.teams())


# ---- documents and flatten --------------------------------------------------
def documents(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Bronze documents assembled (N13) from the derived raw rows (the line
    groups feed vetos and results, so they are derived once); ``placed``, they
    are dealt by the month they are landed in."""
    r = raw(spark, sf_dir, materialize=True, placed=placed)
    return assemble.documents(
        r.matchs() if placed else r.matchs().repartition("match_id"), r.teams(), r.maps_vetos(dealt=True),
        r.maps_results(with_side_no=True, dealt=True), r.match_stats(with_slot=True, dealt=True), dealt=True, places=r.places,
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, landed as month partitions and read back."""
    return io.read_bronze(spark, land(spark, sf_dir, layout="month"), layout="month")


def q_flatten_matchs(spark, sf_dir):
    return flatten.matchs(landed(spark, sf_dir), day_before("extract_date"))


def q_flatten_teams(spark, sf_dir):
    return flatten.teams(landed(spark, sf_dir))


def q_flatten_players(spark, sf_dir):
    return flatten.players(documents(spark, sf_dir))


def q_flatten_vetos(spark, sf_dir):
    return flatten.vetos(documents(spark, sf_dir))


def q_flatten_results(spark, sf_dir):
    return flatten.results(documents(spark, sf_dir))


def q_flatten_stats(spark, sf_dir):
    return flatten.stats(documents(spark, sf_dir))


# ---- landing, jobs -------------------------------------------------------------
def land(spark: SparkSession, sf_dir: str, fmt: str = "parquet", layout: str = "day") -> str:
    """Write the assembled documents into partitions of a fresh folder below
    the shared checkpoint dir; returns the folder."""
    root, placed = scratch_path(spark, f"bronze-{fmt}"), layout == "month"
    io.land_documents(documents(spark, sf_dir, placed), root, fmt=fmt, layout=layout, as_read=placed)
    return root


def content(spark: SparkSession, raw_root: str, layout: str) -> DataFrame:
    """Every row of the six raw tables as (table_name, extract_date, row_md5)."""
    out = None
    for name, schema in RAW.items():
        if name not in RAW_TABLES:
            continue
        t = io.read_raw(spark, raw_root, name, keep_day=True, layout=layout)
        text = F.concat_ws("|", *[F.coalesce(F.col(f.name).cast("string"), F.lit("-")) for f in sorted(schema.fields, key=lambda f: f.name)])
        t = t.select(F.lit(name).alias("table_name"), io.PART, F.md5(text.cast("binary")).alias("row_md5"))
        out = t if out is None else out.unionByName(t)
    return out


def q_json_round_trip(spark, sf_dir):
    root = land(spark, sf_dir, "json", layout="month")
    d = io.read_bronze(spark, root, fmt="json", layout="month")
    return flatten.matchs(d, day_before("extract_date"))


def q_parsed_lines(spark, sf_dir):
    """Landed documents and, in the same folders, broken lines (one per
    seventh match): both sides of one parse."""
    root = land(spark, sf_dir, "json", layout="month")
    m = raw(spark, sf_dir).matchs().where(F.col("match_id").cast("bigint") % 7 == 0)
    line = F.concat(F.lit('{"match_id": "'), F.col("match_id"), F.lit('", "teams": ['))
    month = F.substring(F.date_add(F.to_date("date"), 1).cast("string"), 1, 7)
    broken = m.select(line.alias("value"), month.alias(io.MONTH))
    io.clustered(broken, io.MONTH).write.partitionBy(io.MONTH).mode("append").text(root)
    both = io.parsed_lines(spark, root, layout="month")
    return both.select(
        io.MONTH, F.col(io.CORRUPT).isNotNull().alias("is_malformed"), F.coalesce(io.CORRUPT, "match_id").alias("content")
    )


def days_of(spark: SparkSession, bronze: str) -> tuple[str, str]:
    """First and last storage day."""
    d = io.read_bronze(spark, bronze, layout="month").agg(F.min(io.PART).alias("low"), F.max(io.PART).alias("high"))
    return tuple(d.first())


def q_daily_run(spark, sf_dir):
    """W1 and W2 over the whole history: the daily job on the first and the
    last day, which holds S9's test for empty days, and the range job on the
    days between them (X16: a start and an end). A day without documents is
    skipped and leaves nothing."""
    months, bronze, raw_root = land(spark, sf_dir, layout="month"), scratch_path(spark, "bronze"), scratch_path(spark, "raw")
    low, high = days_of(spark, months)
    docs = io.read_bronze(spark, months, layout="month")
    # the two ends as day partitions for the daily job, all else by month
    io.land_documents(docs.where(F.col(io.PART).isin(low, high)), bronze)
    for day in (low, high):
        job.run_day(spark, bronze, day, raw_root, skip_if_empty=True)
    empty = (dt.date.fromisoformat(high) + dt.timedelta(days=1)).isoformat()
    if job.run_day(spark, bronze, empty, raw_root, mode="append", skip_if_empty=True):
        raise ValueError(f"{empty} has documents")
    between = scratch_path(spark, "raw")
    inner = docs.where((F.col(io.PART) > low) & (F.col(io.PART) < high))
    job.write_range(inner, between, layout="month")
    return content(spark, raw_root, "day").unionByName(content(spark, between, "month"))


def q_append_run(spark, sf_dir):
    """U3, the reference's append over the whole history: every row twice."""
    bronze, raw_root = land(spark, sf_dir, layout="month"), scratch_path(spark, "raw")
    for _ in range(2):
        job.run_range(spark, bronze, raw_root, mode="append", layout="month")
    return content(spark, raw_root, "month")


def q_range_of_months(spark, sf_dir):
    """The range job from the second to the last but one month of the
    history (both ends given), and once more on a range of no documents."""
    bronze, raw_root = land(spark, sf_dir, layout="month"), scratch_path(spark, "raw")
    low, high = (dt.date.fromisoformat(d) for d in days_of(spark, bronze))
    start = (low.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    end = high.replace(day=1) - dt.timedelta(days=1)
    job.run_range(spark, bronze, raw_root, start.isoformat(), end.isoformat(), layout="month")
    after = (high + dt.timedelta(days=31)).replace(day=1)
    job.run_range(spark, bronze, raw_root, after.isoformat(), None, layout="month")
    return content(spark, raw_root, "month")


def range_run(spark: SparkSession, sf_dir: str, times: int = 1) -> str:
    """W2 over the whole history, in month partitions."""
    bronze, raw_root = land(spark, sf_dir, layout="month"), scratch_path(spark, "raw")
    for _ in range(times):
        job.run_range(spark, bronze, raw_root, layout="month")
    return raw_root


def q_rerun_is_idempotent(spark, sf_dir):
    return content(spark, range_run(spark, sf_dir, times=2), "month")


def q_corrected_rerun(spark, sf_dir):
    """A corrected extract replaces the first: every fifth match lost its
    bans, and nothing is left of the first month."""
    bronze, raw_root = land(spark, sf_dir, layout="month"), scratch_path(spark, "raw")
    job.run_range(spark, bronze, raw_root, layout="month")
    d = io.read_bronze(spark, bronze, layout="month")
    first = d.agg(F.min(F.substring(io.PART, 1, 7))).first()[0]
    no_bans = F.col("match_id").cast("bigint") % 5 == 0
    maps = F.col("maps").withField("bans", F.when(no_bans, F.slice("maps.bans", 1, 0)).otherwise(F.col("maps.bans")))
    corrected = d.where(F.substring(io.PART, 1, 7) != first).withColumn("maps", maps)
    # written as a run beside the files that are read, month by month as they are
    io.land_documents(corrected, bronze, layout="month", cover=io.Cover(), as_read=True)
    job.run_range(spark, bronze, raw_root, layout="month")
    return content(spark, raw_root, "month")


def q_streaming_run(spark, sf_dir):
    """The daily schedule as a stream: the whole history arrives in two parts
    that share all months, the batch of the second is delivered twice."""
    landing, raw_root, checkpoint = (scratch_path(spark, n) for n in ("landing", "raw", "stream-checkpoint"))
    docs = landed(spark, sf_dir)
    part = F.pmod(F.xxhash64("match_id"), F.lit(2))
    for k in range(2):
        io.land_documents(docs.where(part == k), landing, mode="append", layout="month", as_read=True)
        incremental.run_once(spark, landing, raw_root, checkpoint, fmt="parquet", layout="month", deliveries=k + 1)
    return content(spark, raw_root, "month")


def q_backfill(spark, sf_dir):
    cat = io.RawCatalog(spark, range_run(spark, sf_dir), layout="month")
    return models.stg_maps_results(cat["maps_results"], cat["matchs"], cat["teams"])


def q_catalog_backfill(spark, sf_dir):
    """The range job's tables registered by name; a second session reads the
    models as SQL views."""
    root = range_run(spark, sf_dir)
    name = "matchlake_" + root.rsplit("-", 1)[-1]
    catalog.register(spark, root, name, layout="month")
    return spark.newSession().sql(
        f"SELECT r.*, m.best_of_type FROM {name}.stg_maps_results r JOIN {name}.stg_matchs m USING (match_id)"
    )


def q_views_by_ordinal(spark, sf_dir):
    """Models as views, grouped and ordered by ordinals in SQL."""
    r = raw(spark, sf_dir)
    models.publish({n: (maps_dimension(spark) if n == "maps" else getattr(r, n)()) for n in (*RAW_TABLES, "maps")})
    return spark.sql(
        "SELECT m.best_of_type, v.type, count(*) AS n, min(v.choice_number) AS first_choice "
        "FROM stg_maps_vetos v JOIN stg_matchs m USING (match_id) GROUP BY 1, 2 ORDER BY 1, 2"
    )


def q_stats_by_map(spark, sf_dir):
    """O2: the stats model sorted by map."""
    return models.ordered_match_stats(q_stg_match_stats(spark, sf_dir))


# ---- extraction jobs ------------------------------------------------------------
def text(spark: SparkSession, sf_dir: str) -> TextFromDriver:
    return TextFromDriver(DriverTables(spark, sf_dir), materialize=True)


def q_url_fields(spark, sf_dir):
    return extract.url_fields(DriverTables(spark, sf_dir).pages)


def q_page_fields(spark, sf_dir):
    return extract.page_fields(DriverTables(spark, sf_dir).pages)


def q_array_tail(spark, sf_dir):
    return extract.link_pairs(DriverTables(spark, sf_dir).pages)


def q_veto_lines(spark, sf_dir):
    return extract.parse_veto_lines(text(spark, sf_dir).veto_lines())


def q_veto_block(spark, sf_dir):
    return extract.parse_veto_block(text(spark, sf_dir).veto_blocks())


def q_half_scores(spark, sf_dir):
    return extract.half_scores(text(spark, sf_dir).half_score_spans())


def q_headline_day(spark, sf_dir):
    t = text(spark, sf_dir)
    return extract.headline_day(t.headlines(), t.run_days())


def q_format_label(spark, sf_dir):
    return extract.format_label(text(spark, sf_dir).format_lines())


def q_player_rows(spark, sf_dir):
    return extract.player_rows(text(spark, sf_dir).scoreboard_rows())


def q_played_picks(spark, sf_dir):
    return extract.played_picks(text(spark, sf_dir).match_pages())


def q_no_forfeits(spark, sf_dir):
    d = DriverTables(spark, sf_dir).documents
    return extract.no_forfeits(d).select("doc_id", "lang", "source", "n_chars")


def q_team_boxes(spark, sf_dir):
    return extract.team_boxes(text(spark, sf_dir).team_boxes())


def q_nested_team_boxes(spark, sf_dir):
    return extract.nested_team_boxes(text(spark, sf_dir).nested_pages())


def q_nested_tabs(spark, sf_dir):
    return extract.nested_tabs(text(spark, sf_dir).nested_pages())


def q_score_blocks(spark, sf_dir):
    return extract.score_blocks(text(spark, sf_dir).score_blocks())


def q_board_players(spark, sf_dir):
    return extract.board_players(text(spark, sf_dir).scoreboard_rows())


def q_pages_to_raw(spark, sf_dir):
    """Whole match pages to documents, landed, and run through the range job.
    The pages are stored by month, so the tasks that read them land theirs."""
    stored, bronze, raw_root = (scratch_path(spark, n) for n in ("pages", "bronze", "raw"))
    with released(spark):
        rendered_pages(documents(spark, sf_dir, placed=True)).write.parquet(stored, compression=io.COMPRESSION["parquet"])
    io.land_documents(pages.match_documents(spark.read.parquet(stored)), bronze, layout="month", as_read=True)
    job.run_range(spark, bronze, raw_root, layout="month")
    return content(spark, raw_root, "month")


def q_no_forfeit_matches(spark, sf_dir):
    return extract.no_forfeits(text(spark, sf_dir).match_notes(), "note")


QUERIES: dict[str, Query] = {
    "stg_matchs": q_stg_matchs,
    "stg_teams": q_stg_teams,
    "stg_players": q_stg_players,
    "stg_maps_vetos": q_stg_maps_vetos,
    "stg_match_stats": q_stg_match_stats,
    "stg_match_stats_lists": q_stg_match_stats_lists,
    "stg_maps_results": q_stg_maps_results,
    "pair_bounds": q_pair_bounds,
    "last_sorts": q_last_sorts,
    "sorted_positions": q_sorted_positions,
    "flatten_matchs": q_flatten_matchs,
    "flatten_teams": q_flatten_teams,
    "flatten_players": q_flatten_players,
    "flatten_vetos": q_flatten_vetos,
    "flatten_results": q_flatten_results,
    "flatten_stats": q_flatten_stats,
    "json_round_trip": q_json_round_trip,
    "parsed_lines": q_parsed_lines,
    "daily_run": q_daily_run,
    "rerun_is_idempotent": q_rerun_is_idempotent,
    "backfill": q_backfill,
    "catalog_backfill": q_catalog_backfill,
    "append_run": q_append_run,
    "range_of_months": q_range_of_months,
    "streaming_run": q_streaming_run,
    "corrected_rerun": q_corrected_rerun,
    "views_by_ordinal": q_views_by_ordinal,
    "stats_by_map": q_stats_by_map,
    "url_fields": q_url_fields,
    "page_fields": q_page_fields,
    "array_tail": q_array_tail,
    "veto_lines": q_veto_lines,
    "veto_block": q_veto_block,
    "half_scores": q_half_scores,
    "headline_day": q_headline_day,
    "format_label": q_format_label,
    "player_rows": q_player_rows,
    "played_picks": q_played_picks,
    "no_forfeits": q_no_forfeits,
    "no_forfeit_matches": q_no_forfeit_matches,
    "team_boxes": q_team_boxes,
    "nested_team_boxes": q_nested_team_boxes,
    "nested_tabs": q_nested_tabs,
    "score_blocks": q_score_blocks,
    "board_players": q_board_players,
    "pages_to_raw": q_pages_to_raw,
}


# ---- oracle SQL per query -----------------------------------------------------
ORACLES: dict[str, Callable[[], str]] = {
    name: (lambda n=name: _oracle.model_sql(n)) for name in _oracle.MODEL_SQL
}
