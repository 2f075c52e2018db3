
from matchlake.operators import nested as N


def test_nth_past_end_is_null(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    assert df.select(N.nth("a", 0), N.nth("a", 1)).collect()[0] == (1, None)


def test_concat_keeps_other_side_when_one_is_null(spark):
    df = spark.createDataFrame([([1, 2], None)], "a array<int>, b array<int>")
    assert df.select(N.concat_arrays("a", "b")).collect()[0][0] == [1, 2]


def test_tail_and_zip(spark):
    df = spark.createDataFrame([(1, ["h", "x", "y"], ["H", "X"]), (2, [], [])], "id int, a array<string>, b array<string>")
    x = df.select("id", N.tail("a").alias("a"), N.tail("b").alias("b"))
    got = sorted(tuple(r) for r in N.zip_positions(x, {"a": "a", "b": "b"}, "id").collect())
    assert got == [(1, 0, "x", "X"), (1, 1, "y", None)]


def test_attach_first_and_keep_and_split(spark):
    df = spark.createDataFrame(
        [([("3", "Dust2", True), ("4", "Nuke", None), ("5", "Dust2", False), ("1", "Nuke", True)],
          [("Dust2", 1), ("Dust2", 2), ("Nuke", 3)])],
        "v array<struct<c:string,map_name:string,played:boolean>>, r array<struct<map_name:string,n:int>>",
    )
    bans, picks = N.split_by("v", lambda e: e["c"] == "1")
    picks = N.attach_first(picks, "r", on="map_name", field="n", as_field="n")
    kept = N.keep(picks, lambda p: p["played"])
    b, k = df.select(bans, kept).collect()[0]
    assert [x.c for x in b] == ["1"]
    assert [(x.c, x.n) for x in k] == [("3", 1)]


def test_last_wins_map(spark):
    df = spark.createDataFrame([(["ct", "ct"], ["7", "9"]), (["t", "ct"], ["1", "2"])], "k array<string>, v array<string>")
    out = df.select(N.last_wins_map("k", "v").alias("m")).collect()
    assert out[0].m == {"ct": "9"}
    assert out[1].m == {"t": "1", "ct": "2"}
    got = df.select(N.last_value_of("k", "v", "ct")).collect()
    assert [r[0] for r in got] == ["9", "2"]


def test_unnest_expand_first_where_sorted(spark):
    df = spark.createDataFrame(
        [("m1", [("b", 2), ("a", 1)]), ("m2", []), ("m3", None)],
        "id string, xs array<struct<k:string,v:int>>",
    )
    u = N.unnest(df, "xs", "x", "id")
    assert sorted(tuple(r) for r in N.expand(u, "x", "id").collect()) == [("m1", "a", 1), ("m1", "b", 2)]
    got = df.select(
        N.first_where("xs", lambda x: x["v"] > 1)["k"].alias("k"),
        N.nth(N.sorted_structs("xs"), 0)["k"].alias("s"),
    ).collect()
    assert [tuple(r) for r in got] == [("b", "a"), (None, None), (None, None)]


def test_lines_and_tokens(spark):
    from matchlake.functions import scalar as X

    df = spark.createDataFrame([("a b  c\nd",)], "t string")
    r = df.select(X.lines_of("t").alias("l"), X.token_count("t").alias("n")).collect()[0]
    assert r.l == ["a b  c", "d"] and r.n == 4
