"""Fixed schemas of the bronze documents, raw tables and the map dimension.

Bronze is read with an explicit schema instead of inference: an empty
file, an all-empty array or a missing struct then yields typed empty
results instead of an analysis error, and nothing is scanned twice to
infer the schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# one player line of a scoreboard
PLAYER = T.StructType(
    _strings("player_id", "team_id", "nick", "kd", "diff", "adr", "kast", "rating")
)
SIDES = T.StructType(
    [
        T.StructField("total", T.ArrayType(PLAYER), True),
        T.StructField("tr", T.ArrayType(PLAYER), True),
        T.StructField("ct", T.ArrayType(PLAYER), True),
    ]
)
TEAM = T.StructType(_strings("team_id", "name", "score", "link"))
RESULT = T.StructType(_strings("team_name", "result", "ct", "t"))
BAN = T.StructType(_strings("team_id", "choice_number", "map_name"))
PICK = T.StructType(
    _strings("team_id", "choice_number", "map_name")
    + [
        T.StructField("was_played", T.BooleanType(), True),
        T.StructField("results", T.ArrayType(RESULT), True),
    ]
)
MAP_STATS = T.StructType(
    [
        T.StructField("map", S, True),
        T.StructField("team1", SIDES, True),
        T.StructField("team2", SIDES, True),
    ]
)

# one match document (bronze)
BRONZE = T.StructType(
    _strings("match_id", "type", "best_of_type")
    + [
        T.StructField("teams", T.ArrayType(TEAM), True),
        T.StructField(
            "maps",
            T.StructType(
                [
                    T.StructField("bans", T.ArrayType(BAN), True),
                    T.StructField("picks", T.ArrayType(PICK), True),
                ]
            ),
            True,
        ),
        T.StructField("stats", T.ArrayType(MAP_STATS), True),
    ]
)

# raw tables: every column is text, as in the reference's DDL
RAW = {
    "matchs": T.StructType(
        _strings(
            "match_id", "type", "date", "best_of_type",
            "team1_id", "team2_id", "team1_score", "team2_score",
        )
    ),
    "match_stats": T.StructType(
        _strings(
            "match_id", "side", "map_name", "adr", "diff", "kast", "kd",
            "nick", "player_id", "rating", "team_id",
        )
    ),
    "teams": T.StructType(_strings("team_id", "name", "link")),
    "players": T.StructType(_strings("player_id", "team_id", "nick")),
    "maps_vetos": T.StructType(
        _strings("match_id", "type", "choice_number", "map_name", "team_id")
    ),
    "maps_results": T.StructType(
        _strings(
            "match_id", "choice_number", "map_name", "pick_team_id",
            "ct", "result", "t", "team_name",
        )
    ),
}

RAW_TABLES = tuple(RAW)

# The map dimension, ids in insertion order.
MAP_DIMENSION = [
    (1, "Vertigo"),
    (2, "Dust2"),
    (3, "Overpass"),
    (4, "Ancient"),
    (5, "Mirage"),
    (6, "Inferno"),
    (7, "Nuke"),
]
MAPS = T.StructType(
    [T.StructField("id", T.IntegerType(), False), T.StructField("name", S, False)]
)

# stats sides and team slots of a document
STAT_SIDES = ("ct", "tr", "total")
TEAM_SLOTS = ("team1", "team2")
