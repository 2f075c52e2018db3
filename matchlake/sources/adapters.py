"""Raw match tables derived from the generated driver tables.

The reference lands crawled documents; here the six raw tables are derived
from the driver tables by fixed rules (FIXTURES.md section 3), so that every
model and flatten job runs over data that grows with the scale factor.
Everything is a DataFrame expression: no collect, no UDF.

Rules, with T = number of suppliers (a scalar subquery, not a driver value):
  match        one per order; teams a = custkey % T, b = (a + 1 + orderkey % 9) % T
  line group   one per (orderkey, linenumber): k = min(partkey) % 9,
               q = min(quantity), f = min(returnflag)
  veto         one per line group: ban for line 1-2, pick for 3-7,
               map = POOL[k], team a if f = 'A', b if f = 'R', else NULL
  map result   two per line group (teams a and b)
  match stats  one per lineitem and side, no 'tr' side for line 7
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAP_DIMENSION, MAPS
from .io import COMPRESSION, PART, PLACE, Places
from .tables import DriverTables

# Map pool indexed by k (the last two are outside the dimension).
POOL = [
    "Vertigo", "Dust2", "Overpass", "Ancient", "Mirage", "Inferno", "Nuke",
    "Train", "Cache",
]
# Best-of text by first character of o_orderpriority (5 -> NULL).
BEST_OF = {"1": "Best of 1 ", "2": "Best of 2", "3": "Best of 3 ", "4": "Best of 5 "}
TEAM_LINK_PREFIX = "https://h.example/team/"
PLAYER_LINK_PREFIX = "https://h.example/player/"
# adr offset per stats side, so that the three sides carry different values
SIDE_ADR_OFFSET = {"total": 0, "ct": 1, "tr": 2}


def _s(c: Column) -> Column:
    return c.cast("string")


def pool_name(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in POOL]), (k + 1).cast("int"))


def maps_dimension(spark) -> DataFrame:
    """The fixed seven-row map dimension with explicit ids."""
    return spark.createDataFrame(MAP_DIMENSION, MAPS)


class RawFromDriver:
    """Lazy derivations; each method returns an unevaluated DataFrame.

    With ``materialize=True`` the inputs that several frames share (the line
    groups; any frame passed to ``stored``) are computed once, written as
    Parquet under the shared checkpoint folder and read back: lineage is cut,
    the work is not repeated per use, and the optimizer sees real sizes.

    With ``placed=True`` the frames with a match_id have the place of the match's
    document (``Places``), and ``dealt`` deals them by it. A match whose key
    repeats in other months has its rows in the place of each of its documents.
    """

    def __init__(self, tables: DriverTables, materialize: bool = False, placed: bool = False):
        self.t = tables
        self.materialize = materialize
        self._stored: dict[str, DataFrame] = {}
        self.places = Places(tables.orders.select(self._landed_on().alias(PART))) if placed else None

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        if name not in self._stored:
            from ..session import released, scratch_path

            spark = self.t.spark
            path = scratch_path(spark, f"derived-{name}")
            with released(spark):
                df.write.mode("overwrite").parquet(path, compression=COMPRESSION["parquet"])
            self._stored[name] = spark.read.parquet(path)
        return self._stored[name]

    # ---- match level -------------------------------------------------
    @staticmethod
    def _landed_on() -> Column:
        """The day a match's document is landed: the day after the match."""
        return _s(F.date_add(F.to_date("o_orderdate"), 1))

    def _place(self) -> list[Column]:
        return [self.places.of(self._landed_on(), F.col("o_orderkey")).alias(PLACE)] if self.places else []

    def team_count(self) -> Column:
        return self.t.supplier.select(F.count(F.lit(1))).scalar()

    def match_header(self) -> DataFrame:
        n = self.team_count()
        o = self.t.orders
        a = F.col("o_custkey") % n
        return o.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
            a.alias("a"),
            ((a + 1 + F.col("o_orderkey") % 9) % n).alias("b"),
            *self._place(),
        )

    def placed_header(self) -> DataFrame:
        """Per match and place of its key: the teams and, where they are
        suppliers, their names."""
        h = self.match_header().select("o_orderkey", "a", "b", PLACE)
        for team in ("a", "b"):
            s = self.t.supplier.select(F.col("s_suppkey").alias(team), F.lit(True).alias(f"{team}_known"), F.col("s_name").alias(f"{team}_name"))
            h = h.join(s, team, "left")
        everywhere = F.collect_set(PLACE).over(Window.partitionBy("o_orderkey"))
        return h.withColumn("_places", everywhere).withColumn(PLACE, F.explode("_places")).drop("_places")

    def best_of_type(self) -> Column:
        p = F.substring("o_orderpriority", 1, 1)
        c = None
        for key, label in BEST_OF.items():
            c = (F.when(p == key, label) if c is None else c.when(p == key, label))
        return c

    def matchs(self) -> DataFrame:
        h = self.match_header()
        return h.select(
            _s(F.col("o_orderkey")).alias("match_id"),
            F.when(F.col("o_orderstatus") == "F", "LAN").otherwise("Online").alias("type"),
            _s(F.to_date("o_orderdate")).alias("date"),
            self.best_of_type().alias("best_of_type"),
            _s(F.col("a")).alias("team1_id"),
            _s(F.col("b")).alias("team2_id"),
            _s(F.col("o_orderkey") % 17).alias("team1_score"),
            _s(F.col("o_custkey") % 17).alias("team2_score"),
            *([F.col(PLACE)] if self.places else []),
        )

    def teams(self) -> DataFrame:
        s = self.t.supplier
        tid = _s(F.col("s_suppkey"))
        return s.select(
            tid.alias("team_id"),
            F.col("s_name").alias("name"),
            F.concat(F.lit(TEAM_LINK_PREFIX), tid, F.lit("/"), F.col("s_name")).alias("link"),
        )

    # ---- per (order, line number) -----------------------------------
    def line_groups(self) -> DataFrame:
        """One row per (order, line number) with the match teams attached."""
        # dealt by order for the join, and before the group: a group is rarely
        # more than a row, so nothing is gained by sorting whole input splits
        g = self.t.lineitem.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
            (F.min("l_partkey") % 9).alias("k"),
            F.floor(F.min("l_quantity")).alias("q"),
            F.min("l_returnflag").alias("f"),
        )
        h = self.placed_header() if self.places else self.match_header().select("o_orderkey", "a", "b")
        return self.stored("line_groups", g.join(h, g.l_orderkey == h.o_orderkey).drop("o_orderkey"))

    def _by_match(self, rows: DataFrame, dealt: bool) -> DataFrame:
        """``rows`` with match_id; ``dealt`` by it (or by place) on request,
        while they are narrow."""
        x = rows.withColumn("match_id", _s(F.col("l_orderkey"))).drop("l_orderkey")
        if self.places:
            return self.places.deal(x) if dealt else x
        return x.repartition("match_id") if dealt else x

    def _key(self) -> list[str]:
        return ["match_id", PLACE] if self.places else ["match_id"]

    @staticmethod
    def _choice_team() -> Column:
        return F.when(F.col("f") == "A", F.col("a")).when(F.col("f") == "R", F.col("b"))

    def maps_vetos(self, dealt: bool = False) -> DataFrame:
        place = [PLACE] if self.places else []
        g = self._by_match(self.line_groups().select("l_orderkey", "l_linenumber", "k", "f", "a", "b", *place), dealt)
        return g.select(
            *self._key(),
            F.when(F.col("l_linenumber") <= 2, "ban").otherwise("pick").alias("type"),
            _s(F.col("l_linenumber")).alias("choice_number"),
            pool_name(F.col("k")).alias("map_name"),
            _s(self._choice_team()).alias("team_id"),
        )

    def maps_results(self, with_side_no: bool = False, dealt: bool = False) -> DataFrame:
        """Two rows per line group; ``side_no`` (0 = team a, 1 = team b) is
        kept on request for the order of results inside a document."""
        g = self._by_match(self.line_groups(), dealt)
        columns = [*self._key(), "l_linenumber", "k", "q", self._choice_team().alias("pick_team")]
        if self.places:  # the names came with the header
            sides = F.array(*[F.struct(F.col(f"{t}_known").alias("known"), F.col(f"{t}_name").alias("s_name")) for t in ("a", "b")])
            j = g.select(*columns, F.posexplode(sides).alias("side_no", "team")).where("team.known").select("*", "team.s_name")
        else:
            g = g.select(*columns, F.posexplode(F.array("a", "b")).alias("side_no", "team_key"))
            s = self.t.supplier.select("s_suppkey", "s_name")
            j = g.join(s, g.team_key == s.s_suppkey)
        q = F.col("q")
        return j.select(
            *self._key(),
            _s(F.col("l_linenumber")).alias("choice_number"),
            pool_name(F.col("k")).alias("map_name"),
            _s(F.col("pick_team")).alias("pick_team_id"),
            _s(q % 9).alias("ct"),
            _s(q).alias("result"),
            _s(q - q % 9).alias("t"),
            F.col("s_name").alias("team_name"),
            *([F.col("side_no")] if with_side_no else []),
        )

    # ---- per lineitem -------------------------------------------------
    def match_stats(
        self, with_slot: bool = False, sides: tuple[str, ...] = ("total", "ct", "tr"), dealt: bool = False
    ) -> DataFrame:
        """One row per lineitem and side; ``sides`` limits the generated
        sides (a filter on the generated column cannot be pushed below the
        generator, so asking for fewer sides saves the work)."""
        li = self.t.lineitem
        if self.places:
            h = self.match_header().repartition("o_orderkey").select("o_orderkey", PLACE).distinct()
            li = li.join(h, li.l_orderkey == h.o_orderkey).drop("o_orderkey")
        li = self._by_match(li, dealt)
        side = F.col("side")
        offset = F.when(side == "ct", SIDE_ADR_OFFSET["ct"]).when(
            side == "tr", SIDE_ADR_OFFSET["tr"]).otherwise(SIDE_ADR_OFFSET["total"])
        qty = F.floor("l_quantity")
        cols = [
            *self._key(),
            side,
            F.when(F.col("l_linestatus") == "O", "Vertigo").otherwise("Dust2").alias("map_name"),
            _s(F.floor(F.col("l_extendedprice") / 1000) + offset).alias("adr"),
            _s(F.col("l_linenumber")).alias("diff"),
            F.concat(_s(qty), F.lit("%")).alias("kast"),
            F.concat(_s(qty), F.lit("-"), _s(F.col("l_linenumber"))).alias("kd"),
            F.concat(F.lit("nick"), _s(F.col("l_suppkey"))).alias("nick"),
            _s(F.col("l_suppkey")).alias("player_id"),
            _s(F.floor(F.col("l_discount") * 100 + 0.5)).alias("rating"),
            _s(F.col("l_suppkey") % 10).alias("team_id"),
        ]
        if with_slot:
            cols.append(
                F.when(F.col("l_suppkey") % 2 == 0, "team1").otherwise("team2").alias("slot")
            )
        gen = F.explode(F.array(*[F.lit(x) for x in sides])).alias("side")
        x = li.select("*", gen)
        x = x.where(~((F.col("side") == "tr") & (F.col("l_linenumber") == 7)))
        return x.select(*cols)

    def players(self) -> DataFrame:
        return (
            self.match_stats(sides=("total",))
            .select("player_id", "team_id", "nick")
            .distinct()
        )

    def maps(self) -> DataFrame:
        return maps_dimension(self.t.spark)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "matchs": self.matchs(),
            "teams": self.teams(),
            "players": self.players(),
            "maps_vetos": self.maps_vetos(),
            "maps_results": self.maps_results(),
            "match_stats": self.match_stats(),
            "maps": self.maps(),
        }


# ---- text inputs of the extraction jobs ------------------------------------------
# Trailer that makes a single-block veto line longer than eight
# tokens (the map name is then the sixth token from the end).
ONE_BLOCK_TRAILER = " in the first round today"
GRAND_FINAL = "\n* Grand final"
# The five lines above the vetos in a single-block veto box.
BLOCK_HEADER = ["Veto", "", "Best of 3", "", "Map pool"]


class TextFromDriver(RawFromDriver):
    """Page-shaped inputs rendered from the driver tables: veto lines,
    format lines, headlines, scoreboard rows, result blocks."""

    def line_groups_named(self) -> DataFrame:
        """Line groups with the names of both teams."""
        g = self.line_groups()
        s = self.t.supplier.select("s_suppkey", "s_name")
        sa = s.select(F.col("s_suppkey").alias("a"), F.col("s_name").alias("a_name"))
        sb = s.select(F.col("s_suppkey").alias("b"), F.col("s_name").alias("b_name"))
        return g.join(sa, "a").join(sb, "b")

    @staticmethod
    def _veto_line(with_trailer: Column) -> Column:
        """'1. <team> removed <map>', '3. <team> picked <map>' (plus the
        trailer when asked), or '<n>. <map> was left over' without a team."""
        team_name = F.when(F.col("f") == "A", F.col("a_name")).when(F.col("f") == "R", F.col("b_name"))
        ln = F.col("l_linenumber").cast("string")
        mp = pool_name(F.col("k"))
        verb = F.when(F.col("l_linenumber") <= 2, " removed ").otherwise(" picked ")
        trailer = F.when(with_trailer, F.lit(ONE_BLOCK_TRAILER)).otherwise(F.lit(""))
        named = F.concat(ln, F.lit(". "), team_name, verb, mp, trailer)
        left = F.concat(ln, F.lit(". "), mp, F.lit(" was left over"))
        return F.when(team_name.isNull(), left).otherwise(named)

    @staticmethod
    def _teams_cols() -> list[Column]:
        return [
            _s(F.col("a")).alias("team1_id"), F.col("a_name").alias("team1_name"),
            _s(F.col("b")).alias("team2_id"), F.col("b_name").alias("team2_name"),
        ]

    def veto_lines(self) -> DataFrame:
        """One veto line per line group, as the page shows it. Lines of a
        single-block page (even order keys) carry a trailer after the map
        when a team is named."""
        g = self.line_groups_named()
        one_block = F.col("l_orderkey") % 2 == 0
        return g.select(
            _s(F.col("l_orderkey")).alias("match_id"),
            F.col("l_linenumber").alias("line_no"),
            self._veto_line(one_block).alias("line"),
            one_block.alias("one_block"),
            *self._teams_cols(),
        )

    def veto_blocks(self) -> DataFrame:
        """Single-block pages: per match one text with five header lines and
        then every veto line (with the trailer), in choice order. A block
        is one match's content (at most seven lines)."""
        g = self.line_groups_named()
        line = self._veto_line(F.lit(True))
        per_match = g.groupBy("l_orderkey", "a", "a_name", "b", "b_name").agg(
            F.sort_array(F.collect_set(F.struct(F.col("l_linenumber"), line.alias("line")))).alias("ls")
        )
        text = F.concat_ws(
            "\n", *[F.lit(h) for h in BLOCK_HEADER], F.transform("ls", lambda x: x["line"])
        )
        return per_match.select(
            _s(F.col("l_orderkey")).alias("match_id"), text.alias("block"), *self._teams_cols()
        )

    def match_notes(self) -> DataFrame:
        """A note line per match; on every third one a team did not show up."""
        key = F.col("o_orderkey")
        note = F.when(key % 3 == 1, F.concat(F.lit("* Match "), _s(key), F.lit(" decided by forfeit")))
        return self.t.orders.select(
            _s(key).alias("match_id"), note.otherwise(F.concat(F.lit("* Match "), _s(key), F.lit(" played"))).alias("note")
        )

    def format_lines(self) -> DataFrame:
        """'Best of <n> (<LAN|Online>)', with a starred note on every third."""
        o = self.t.orders
        p = F.substring("o_orderpriority", 1, 1)
        n = F.when(p == "1", "1").when(p == "2", "2").when(p == "3", "3").otherwise("5")
        kind = F.when(F.col("o_orderstatus") == "F", "LAN").otherwise("Online")
        note = F.when(F.col("o_orderkey") % 3 == 0, F.lit(GRAND_FINAL)).otherwise(F.lit(""))
        return o.select(
            _s(F.col("o_orderkey")).alias("match_id"),
            F.concat(F.lit("Best of "), n, F.lit(" ("), kind, F.lit(")"), note).alias("format_line"),
        )

    def headlines(self) -> DataFrame:
        """Each match under the headline of its day."""
        from ..functions.scalar import headline_of

        o = self.t.orders
        return o.select(
            _s(F.col("o_orderkey")).alias("match_id"),
            headline_of(F.to_date("o_orderdate")).alias("headline"),
        )

    def run_days(self) -> DataFrame:
        """Days on which the extraction ran (ship days), one row each."""
        return self.t.lineitem.select(F.to_date("l_shipdate").alias("run_day")).distinct()

    def scoreboard_rows(self) -> DataFrame:
        """Rows of the 'total' scoreboards: a header row (position 0) per
        (match, team slot) and one row per lineitem (position = line number)."""
        li = self.t.lineitem
        sk = _s(F.col("l_suppkey"))
        qty = _s(F.floor("l_quantity"))
        cell = lambda cls, v: F.concat(F.lit(f'<td class="{cls}">'), v, F.lit("</td>"))
        player = F.concat(
            F.lit('<tr><td class="players"><a href="'), F.lit(PLAYER_LINK_PREFIX), sk,
            F.lit("/nick"), sk, F.lit('">nick'), sk, F.lit("</a></td>"),
            cell("kd text-center", F.concat(qty, F.lit("-"), _s(F.col("l_linenumber")))),
            F.lit('<td class="plus-minus"><span>'), _s(F.col("l_linenumber")), F.lit("</span></td>"),
            cell("adr", _s(F.floor(F.col("l_extendedprice") / 1000))),
            cell("kast", F.concat(qty, F.lit("%"))),
            cell("rating", _s(F.floor(F.col("l_discount") * 100 + 0.5))),
            F.lit("</tr>"),
        )
        slot = F.when(F.col("l_suppkey") % 2 == 0, "team1").otherwise("team2")
        base = li.select(
            _s(F.col("l_orderkey")).alias("match_id"),
            F.when(F.col("l_linestatus") == "O", "Vertigo").otherwise("Dust2").alias("map_name"),
            slot.alias("slot"),
            F.col("l_linenumber").alias("pos"),
            player.alias("row_html"),
        )
        header = (
            base.select("match_id", "map_name", "slot").distinct()
            .select(
                "match_id", "map_name", "slot", F.lit(0).alias("pos"),
                F.concat(F.lit('<tr class="header-row"><td class="players"><a class="teamName team" href="'),
                         F.lit(TEAM_LINK_PREFIX), F.col("slot"), F.lit('/x">'), F.col("slot"),
                         F.lit("</a></td></tr>")).alias("row_html"),
            )
        )
        return base.unionByName(header)

    def result_entries(self) -> DataFrame:
        """Per line group: the veto entry and, for picks, its result block.

        was_played is false for q % 10 = 0 and unknown (NULL) for q % 10 = 5.
        The block's results list the left team (a) first."""
        g = self.line_groups_named()
        q = F.col("q")

        def res(name):
            return F.struct(
                F.col(name).alias("team_name"), _s(q).alias("result"),
                _s(q % 9).alias("ct"), _s(q - q % 9).alias("t"),
            )

        return g.select(
            _s(F.col("l_orderkey")).alias("match_id"),
            F.struct(
                _s(F.col("l_linenumber")).alias("choice_number"),
                _s(self._choice_team()).alias("team_id"),
                pool_name(F.col("k")).alias("map_name"),
                (F.col("l_linenumber") <= 2).alias("removed"),
                F.when(q % 10 == 0, F.lit(False)).when(q % 10 == 5, F.lit(None).cast("boolean"))
                .otherwise(F.lit(True)).alias("was_played"),
            ).alias("entry"),
            F.when(
                F.col("l_linenumber") >= 3,
                F.struct(
                    _s(F.col("l_linenumber")).alias("choice_number"),
                    pool_name(F.col("k")).alias("map_name"),
                    F.array(res("a_name"), res("b_name")).alias("results"),
                ),
            ).alias("block"),
        )

    def match_pages(self) -> DataFrame:
        """One row per match with the page's veto list and result blocks in
        page order (a match's content: at most seven entries)."""
        e = self.result_entries()
        return e.groupBy("match_id").agg(
            F.sort_array(F.collect_set("entry")).alias("vetos"),
            F.sort_array(F.collect_set("block")).alias("blocks"),
        )

    def team_boxes(self) -> DataFrame:
        """Per match the markup of its two team boxes, left team first."""
        m, t = RawFromDriver(self.t), RawFromDriver(self.t).teams()
        box = lambda link, name, score: F.concat(
            F.lit('<div class="team"><a href="'), link, F.lit('"><div class="teamName">'), name,
            F.lit('</div></a><div class="score">'), score, F.lit("</div></div>"),
        )
        side = lambda n: t.select(
            F.col("team_id").alias(f"team{n}_id"), F.col("name").alias(f"n{n}"), F.col("link").alias(f"l{n}")
        )
        j = m.matchs().join(side(1), "team1_id").join(side(2), "team2_id")
        left, right = box(F.col("l1"), F.col("n1"), F.col("team1_score")), box(F.col("l2"), F.col("n2"), F.col("team2_score"))
        return j.select("match_id", F.concat(left, F.lit("\n"), right).alias("html"))

    def nested_pages(self) -> DataFrame:
        """The team boxes in nested markup, and one tab per choice of the
        match: elements of one tag inside each other, other boxes' classes
        inside a box, empty and self-closing ones."""
        boxes = self.team_boxes()
        inner = F.regexp_replace("html", r'<div class="team">', '<div id="x" class="box team big"><div class="logo"><div/><div></div></div>')
        inner = F.regexp_replace(inner, r'<div class="teamName">([^<]*)</div>', '<DIV class="teamName"><div><div>$1</div></div></DIV>')
        inner = F.regexp_replace(inner, r'<div class="score">([^<]*)</div>', '<div class="won score"><div> $1</div><div class="teams"></div></div >')
        tab = F.concat(
            F.lit('<div class="tab"><div class="icon"></div><div class="map-name">'), pool_name(F.col("k")),
            F.lit('</div><div class="boards">'), F.repeat(F.lit("<div><div></div></div>"), (F.col("l_linenumber") % 3).cast("int")),
            F.lit("</div></div>"),
        )
        lines = RawFromDriver(self.t).line_groups().select(_s(F.col("l_orderkey")).alias("match_id"), "l_linenumber", tab.alias("tab"))
        # a match has at most seven choices
        tabs = lines.groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "tab"))).alias("tabs"))
        page = F.concat(
            F.lit('<body><div class="page"><div class="boxes">'), inner, F.lit('</div><div class="tabs">'),
            F.array_join(F.coalesce("tabs.tab", F.array().cast("array<string>")), "\n"), F.lit("</div></div></body>"),
        )
        return boxes.join(tabs, "match_id", "left").select("match_id", page.alias("html"))

    def score_blocks(self) -> DataFrame:
        """Markup of one map's half scores: nine spans, the scores at places
        1, 3, 5 and 7 with the side as class."""
        s = self.half_score_spans()
        left, right = s.where("side_no = 0"), s.where("side_no = 1")
        key = ["match_id", "choice_number", "result"]
        j = left.select(*key, F.col("team_name").alias("left_name"), F.col("classes").alias("lc"), F.col("scores").alias("ls")).join(
            right.select(*key, F.col("team_name").alias("right_name"), F.col("classes").alias("rc"), F.col("scores").alias("rs")), key
        )
        plain = lambda text: F.lit(f"<span>{text}</span>")
        span = lambda c, v, i: F.concat(
            F.lit('<span class="'), F.get(c, F.lit(i)), F.lit('">'), F.get(v, F.lit(i)), F.lit("</span>")
        )
        kind = F.when(F.col("result").cast("int") % 10 == 0, "optional").otherwise("played")
        html = F.concat(
            F.lit('<div class="'), kind, F.lit('">'), plain("("), span("lc", "ls", 0), plain(":"), span("rc", "rs", 0),
            plain("; "), span("lc", "ls", 1), plain(":"), span("rc", "rs", 1), plain(")"), F.lit("</div>"),
        )
        return j.select("match_id", "choice_number", "left_name", "right_name", html.alias("html"))

    def half_score_spans(self) -> DataFrame:
        """Per line group and team: result plus the two half-score spans
        (class, text). Left team: first half 'ct' for even q, else 't', second
        half the other side, but both 'ct' when k = 0 (a repeated key)."""
        g = self.line_groups_named()
        q = F.col("q")
        even = q % 2 == 0
        c1_left = F.when(even, "ct").otherwise("t")
        c2_left = F.when(F.col("k") == 0, "ct").otherwise(F.when(even, "t").otherwise("ct"))
        flip = lambda c: F.when(c == "ct", "t").otherwise("ct")
        s1, s2 = _s(q % 9), _s(F.floor(q / 9))
        teams = F.array(
            F.struct(F.lit(0).alias("side_no"), F.col("a_name").alias("team_name"),
                     F.array(c1_left, c2_left).alias("classes"), F.array(s1, s2).alias("scores")),
            F.struct(F.lit(1).alias("side_no"), F.col("b_name").alias("team_name"),
                     F.array(flip(c1_left), flip(c2_left)).alias("classes"), F.array(s2, s1).alias("scores")),
        )
        x = g.select(
            _s(F.col("l_orderkey")).alias("match_id"),
            _s(F.col("l_linenumber")).alias("choice_number"),
            _s(q).alias("result"),
            F.explode(teams).alias("tm"),
        )
        return x.select("match_id", "choice_number", "result", "tm.*")


def rendered_pages(docs: DataFrame) -> DataFrame:
    """Whole match pages (url, html, extract_date) as markup of bronze documents.

    Pages of even matches show their vetos in one box, the others line by
    line; the note tells a forfeit on every third page; maps whose result is a
    multiple of ten are marked as not played."""
    key = F.col("match_id").cast("bigint")
    note = F.when(key % 3 == 1, F.lit("\n* decided by forfeit")).otherwise(F.lit(""))
    div = lambda cls, *inner: F.concat(F.lit(f'<div class="{cls}">'), *inner, F.lit("</div>"))
    each = lambda arr, f, sep="": F.array_join(F.transform(arr, f), sep)
    one_box = key % 2 == 0

    def box(t: Column) -> Column:
        link = F.concat(F.lit('<a href="'), t["link"], F.lit('">'), div("teamName", t["name"]), F.lit("</a>"))
        return div("team", link, div("score", t["score"]))

    def line(v: Column, verb: str) -> Column:
        left, right = F.get("teams", F.lit(0)), F.get("teams", F.lit(1))
        team = F.when(v["team_id"] == left["team_id"], left["name"]).when(v["team_id"] == right["team_id"], right["name"])
        trailer = F.when(one_box & team.isNotNull(), F.lit(ONE_BLOCK_TRAILER)).otherwise(F.lit(""))
        said = F.concat(v["choice_number"], F.lit(". "), F.coalesce(team, F.lit("nobody")), F.lit(f" {verb} "), v["map_name"], trailer)
        over = F.concat(v["choice_number"], F.lit(". "), v["map_name"], F.lit(" was left over"))
        return F.when(team.isNull() & (v["choice_number"] == "7"), over).otherwise(said)

    def holder(p: Column) -> Column:
        left, right = F.get(p["results"], F.lit(0)), F.get(p["results"], F.lit(1))
        plain = lambda text: F.lit(f"<span>{text}</span>")
        half = lambda r, side: F.concat(F.lit(f'<span class="{side}">'), r[side], F.lit("</span>"))
        team = lambda r: F.concat(div("results-teamname", r["team_name"]), div("results-team-score", r["result"]))
        kind = F.when(left["result"].cast("int") % 10 == 0, "optional").otherwise("played")
        spans = [
            plain("("), half(left, "ct"), plain(":"), half(right, "t"), plain("; "), half(left, "t"), plain(":"), half(right, "ct"), plain(")"),
        ]
        return div(
            "mapholder", F.lit('<div class="'), kind, F.lit('">'), div("mapname", p["map_name"]), team(left), team(right), *spans, F.lit("</div>")
        )

    def table(players: Column, team: Column) -> Column:
        header = F.concat(
            F.lit('<table><tbody><tr class="header-row"><td class="players"><a class="teamName team" href="'), team["link"],
            F.lit('">'), team["name"], F.lit("</a></td></tr>"),
        )
        cell = lambda cls, *v: F.concat(F.lit(f'<td class="{cls}">'), *v, F.lit("</td>"))

        def row(p: Column) -> Column:
            link = F.concat(F.lit(f'<a href="{PLAYER_LINK_PREFIX}'), p["player_id"], F.lit("/"), p["nick"], F.lit('">'), p["nick"], F.lit("</a>"))
            return F.concat(
                F.lit("<tr>"), cell("players", link), cell("kd text-center", p["kd"]),
                cell("plus-minus", F.lit("<span>"), p["diff"], F.lit("</span>")), cell("adr", p["adr"]), cell("kast", p["kast"]),
                cell("rating", p["rating"]), F.lit("</tr>"),
            )

        return F.concat(header, each(players, row), F.lit("</tbody></table>"))

    def boards(s: Column) -> Column:
        tables = [
            table(s[slot][side], F.get("teams", F.lit(k))) for k, slot in enumerate(("team1", "team2")) for side in ("total", "tr", "ct")
        ]
        return div("stats-content", *tables)

    lines = F.concat(F.transform("maps.bans", lambda v: line(v, "removed")), F.transform("maps.picks", lambda v: line(v, "picked")))
    in_box = div("vetobox", F.concat_ws("\n", *[F.lit(t) for t in BLOCK_HEADER], lines))
    html = F.concat(
        F.lit("<html><body>"), div("describe", F.coalesce("best_of_type", F.lit("")), F.lit("("), F.col("type"), F.lit(")"), note),
        each("teams", box, "\n"), F.when(one_box, in_box).otherwise(each(lines, lambda t: div("veto", t))),
        each("maps.picks", holder), div("matchstats", each("stats", lambda s: div("dynamic-map-name-full", s["map"])), each("stats", boards)),
        F.lit("</body></html>"),
    )
    url = F.concat(F.lit("https://h.example/matches/"), F.col("match_id"), F.lit("/x"))
    return docs.select(url.alias("url"), html.alias("html"), "extract_date")
