import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlake.functions import scalar as X


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_best_of_label_and_scores(spark):
    # FIXTURES.md 2.2
    data = [
        ("Best of 1 ", "16", "3", "MD1", 1, 0),
        ("Best of 1", "3", "16", "MD1", 0, 1),
        ("Best of 1", "16", "16", "MD1", 0, 0),
        ("Best of 1", None, "16", "MD1", 0, 0),
        ("Best of 2", "1", "1", "MD1", 1, 1),
        ("Best of 3 ", "2", "1", "MD3", 2, 1),
        ("Best of 5", "3", "0", "MD5", 3, 0),
        (None, "2", "0", "MD1", 2, 0),
    ]
    df = spark.createDataFrame(data, "bo string, s1 string, s2 string, label string, e1 int, e2 int")
    out = df.select(
        X.best_of_label("bo").alias("l"),
        X.series_score("bo", "s1", "s2").alias("a"),
        X.series_score("bo", "s2", "s1").alias("b"),
        "label", "e1", "e2",
    )
    for l, a, b, label, e1, e2 in rows(out):
        assert (l, a, b) == (label, e1, e2)


def test_strict_cast_fails_on_bad_text(spark):
    df = spark.createDataFrame([("Best of 3", "-", "1")], "bo string, s1 string, s2 string")
    with pytest.raises(Exception):
        df.select(X.series_score("bo", "s1", "s2")).collect()


MAP_CHOICE = {  # FIXTURES.md 2.1
    "Best of 1": [None, None, "Map 1", "Map 2", "Map 1", "Map 2", "Map 1"],
    "Best of 2": [None, None, "Map 1", "Map 2", None, None, None],
    "Best of 3": [None, None, "Map 1", "Map 2", None, None, "Map 3"],
    "Best of 5": [None, None, "Map 1", "Map 2", "Map 3", "Map 4", "Map 5"],
    None: [None, None, "Map 1", "Map 2", None, None, None],
}


def test_map_choice_truth_table(spark):
    data = [(bo, str(c), exp) for bo, row in MAP_CHOICE.items() for c, exp in enumerate(row, 1)]
    df = spark.createDataFrame(data, "bo string, ch string, exp string")
    for got, exp in rows(df.select(X.map_choice("bo", "ch"), "exp")):
        assert got == exp


def test_dates(spark):
    df = spark.createDataFrame(
        [("2022-02-26", "Results for February 25th 2022"),
         ("2022-01-02", "Results for January 1st 2022"),
         ("2021-12-23", "Results for December 22nd 2021"),
         ("2021-03-12", "Results for March 11th 2021")],
        "d string, h string",
    )
    out = rows(df.select(X.day_before("d"), X.headline_date("h"), X.headline_of(X.headline_date("h"))))
    assert [o[0] for o in out] == ["2022-02-25", "2022-01-01", "2021-12-22", "2021-03-11"]
    assert [o[1] for o in out] == [dt.date(2022, 2, 25), dt.date(2022, 1, 1), dt.date(2021, 12, 22), dt.date(2021, 3, 11)]
    assert [o[2] for o in out] == [r.h for r in df.collect()]


def test_month_number_unknown_is_null(spark):
    df = spark.createDataFrame([("May",), ("December",), ("Mai",)], "m string")
    assert [r[0] for r in df.select(X.month_number("m")).collect()] == ["05", "12", None]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("https://h.example/player/77/nick", "Best of 3 (LAN)\n* Grand final", "1. Alpha removed Nuke")],
        "u string, f string, v string",
    )
    bo, kind = X.format_parts("f")
    r = df.select(
        X.path_part("u", 4), X.path_part("u", -2), X.path_part("u", -1), X.path_part("u", 9),
        bo, kind, X.token_count("v"), X.strip_chars(F.lit("1."), "."),
    ).collect()[0]
    assert tuple(r) == ("77", "77", "nick", "", "Best of 3 ", "LAN", 4, "1")


def test_malformed_headline_is_null(spark):
    df = spark.createDataFrame([("Results",), ("Results for Smarch 3rd 2022",), (None,)], "h string")
    assert [r[0] for r in df.select(X.headline_date("h")).collect()] == [None, None, None]


def test_quality_check_variant_gives_null(spark):
    from matchlake.plans import models

    df = spark.createDataFrame([("1", "Best of 3", "-", "1")], "match_id string, best_of_type string, team1_score string, team2_score string")
    df = df.selectExpr("match_id", "'LAN' AS type", "'2022-01-01' AS date", "best_of_type", "'a' AS team1_id", "'b' AS team2_id", "team1_score", "team2_score")
    r = models.stg_matchs(df, strict=False).collect()[0]
    assert (r.team1_score, r.team2_score) == (None, 1)
    with pytest.raises(Exception):
        models.stg_matchs(df).collect()


def test_ordinal_suffixes_round_trip(spark):
    days = [1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 24, 30, 31]
    df = spark.createDataFrame([(dt.date(2022, 1, d),) for d in days], "d date")
    out = df.select(X.headline_of("d").alias("h")).select("h", X.headline_date("h").alias("back")).collect()
    suffixes = [r.h.split(" ")[-2] for r in out]
    assert suffixes == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "24th", "30th", "31st"]
    assert [r.back for r in out] == [dt.date(2022, 1, d) for d in days]


def test_strict_int_fails_without_ansi_casts(spark):
    import pytest
    from pyspark.sql import functions as F

    from matchlake.functions import scalar as X

    df = spark.createDataFrame([(" 7 ",), (None,)], "s string")
    assert [r[0] for r in df.select(X.strict_int("s")).collect()] == [7, None]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not an integer"):
            df.select(X.strict_int(F.lit("-"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
