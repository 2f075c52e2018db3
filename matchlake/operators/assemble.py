"""Assemble nested match documents from flat rows (the inverse of the
flatten), as the extraction step produces them.

Every list is one filtered aggregate of its own flat table, built bottom-up:
results per pick, six scoreboards per map, then one row per match; all of it
is dealt by match_id once, and each flat row is touched once. A group is one
match's distinct content (two teams, at most seven vetos, the scoreboards of
the maps played), also where raw rows were appended many times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RESULT, TEAM_SLOTS
from ..sources.io import PLACE, Places

BOARD_ORDER = ("total", "tr", "ct")
PLAYER_FIELDS = ["player_id", "team_id", "nick", "kd", "diff", "adr", "kast", "rating"]
_RESULT_TYPE = RESULT.simpleString()


def _team(prefix: str, t: DataFrame) -> DataFrame:
    return t.select(
        F.col("team_id").alias(f"{prefix}_id"),
        F.col("name").alias(f"{prefix}_name"),
        F.col("link").alias(f"{prefix}_link"),
    )


def documents(
    matchs: DataFrame,
    teams: DataFrame,
    maps_vetos: DataFrame,
    maps_results: DataFrame,
    match_stats_slot: DataFrame,
    dealt: bool = False,
    places: Places | None = None,
) -> DataFrame:
    """Bronze documents plus ``extract_date`` (the day after the match date,
    as the daily extraction lands them).

    ``maps_results`` needs a ``side_no`` column (0 for the left team, 1 for
    the right one) for the order of a pick's results; ``match_stats_slot``
    needs the team ``slot`` of each row. ``dealt`` tells that the frames with a
    match_id come dealt by it already: before their rows were widened, which
    moves fewer bytes. With ``places`` they have the place of a match, by which
    all but ``matchs`` come dealt; the documents are then where they are to be
    landed.
    """
    key = ["match_id"] if places is None else ["match_id", PLACE]  # the id first: rows of a task share the place
    by_match = lambda df: df if dealt or places else df.repartition("match_id")
    # teams: two entries in slot order, names and links from the dimension
    h = matchs.join(_team("t1", teams), matchs.team1_id == F.col("t1_id"), "left").join(
        _team("t2", teams), matchs.team2_id == F.col("t2_id"), "left"
    )
    header = h.select(
        *key, "type", "best_of_type",
        F.array(
            F.struct(
                F.col("team1_id").alias("team_id"), F.col("t1_name").alias("name"),
                F.col("team1_score").alias("score"), F.col("t1_link").alias("link"),
            ),
            F.struct(
                F.col("team2_id").alias("team_id"), F.col("t2_name").alias("name"),
                F.col("team2_score").alias("score"), F.col("t2_link").alias("link"),
            ),
        ).alias("teams"),
        F.date_format(F.date_add(F.to_date("date"), 1), "yyyy-MM-dd").alias("extract_date"),
    )
    if places is not None:
        header = places.deal(header)  # the joins may have dealt it by team

    def gathered(cond, *fields):
        """Sorted distinct structs of the rows that meet ``cond``."""
        return F.sort_array(F.collect_set(F.when(cond, F.struct(*fields))))

    veto = [F.col("choice_number"), F.col("team_id"), F.col("map_name")]
    vetos = maps_vetos.groupBy(*key).agg(
        gathered(F.col("type") == "ban", *veto).alias("bans"), gathered(F.col("type") == "pick", *veto).alias("picks")
    )
    per_choice = by_match(maps_results).groupBy(*key, "choice_number").agg(
        gathered(F.lit(True), F.col("side_no").cast("int").alias("n"),
                 F.struct("team_name", "result", "ct", "t").alias("r")).alias("rs")
    )
    results = per_choice.where("choice_number is not null").groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("choice_number", F.col("rs.r").alias("rs")))).alias("results")
    )
    boards = by_match(match_stats_slot).groupBy(*key, "map_name").agg(*[
        gathered((F.col("slot") == slot) & (F.col("side") == side), *PLAYER_FIELDS).alias(f"{slot}_{side}")
        for slot in TEAM_SLOTS for side in BOARD_ORDER
    ])
    per_map = F.struct(
        F.col("map_name").alias("map"),
        *[F.struct(*[F.col(f"{slot}_{side}").alias(side) for side in BOARD_ORDER]).alias(slot) for slot in TEAM_SLOTS],
    )
    stats = boards.groupBy(*key).agg(F.sort_array(F.collect_list(per_map)).alias("stats"))

    no_results = F.array().cast(f"array<{_RESULT_TYPE}>")
    bans = F.transform("bans", lambda x: F.struct(x["team_id"].alias("team_id"), x["choice_number"].alias("choice_number"), x["map_name"].alias("map_name")))
    picks = F.transform(
        "picks",
        lambda x: F.struct(
            x["team_id"].alias("team_id"), x["choice_number"].alias("choice_number"), x["map_name"].alias("map_name"),
            F.lit(True).alias("was_played"),
            F.coalesce(F.try_element_at("results", x["choice_number"]), no_results).alias("results"),
        ),
    )
    nested = (
        header.join(vetos, key, "left").join(results, key, "left").join(stats, key, "left")
        .withColumns({"bans": bans, "picks": picks})
    )

    empty = F.array()
    return nested.select(
        "match_id", "type", "best_of_type", "teams",
        F.struct(
            F.coalesce("bans", empty).alias("bans"),
            F.coalesce("picks", empty).alias("picks"),
        ).alias("maps"),
        F.coalesce("stats", empty).alias("stats"),
        "extract_date",
    )
