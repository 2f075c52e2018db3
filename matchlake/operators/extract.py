"""The crawler's per-page extraction, re-aimed as Spark jobs over
tables of pages, lines and rows. Each function maps a DataFrame to a
DataFrame with built-in string / regex / array functions only; a page is
one row, so nothing is grouped or shuffled unless stated.

HTML is not XML, so ``xpath`` does not apply; the regexes cover flat
elements, ``markup.elements`` those that hold elements of the same tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import format_parts, headline_date, path_part, strip_chars
from .markup import count_elements, elements, first_element, first_text, pieces, text_of
from .nested import attach_first, keep, last_wins_map, split_by, tail, zip_positions

# Patterns of the page elements read.
TITLE_RE = r"(?s)<title>(.*?)</title>"
AD_RE = r'(?s)<div class="ad">(.*?)</div>'
HREF_RE = r'href="([^"]*)"'
ANCHOR_HREF_RE = r'<a href="([^"]*)">'
ANCHOR_TEXT_RE = r'<a href="[^"]*">([^<]*)</a>'
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def _cell(html: Column, cls: str, inner: str = "") -> Column:
    return F.regexp_extract(html, f'<td class="[^"]*{cls}[^"]*">{inner}([^<]*)<', 1)


# ---- E1 --------------------------------------------------------------------------
def url_fields(pages: DataFrame) -> DataFrame:
    """Host, the fifth path token (an id in a team link) and the last two
    tokens of the URL (id and nick in a player link)."""
    u = F.col("url")
    return pages.select(
        "page_id",
        F.regexp_extract(u, HOST_RE, 1).alias("host"),
        path_part(u, 4).alias("segment_4"),
        path_part(u, -2).alias("next_to_last"),
        path_part(u, -1).alias("last"),
    )


# ---- E2 --------------------------------------------------------------------------
def page_fields(pages: DataFrame) -> DataFrame:
    """Text of <title>, text of the element marked class="ad", the number of
    links and the first link."""
    h = F.col("html")
    links = F.regexp_extract_all(h, F.lit(HREF_RE), F.lit(1))
    return pages.select(
        "page_id",
        F.regexp_extract(h, TITLE_RE, 1).alias("title"),
        F.regexp_extract(h, AD_RE, 1).alias("ad_text"),
        F.size(links).alias("n_links"),
        F.get(links, 0).alias("first_link"),
    )


def link_pairs(pages: DataFrame) -> DataFrame:
    """N9 + N11: anchors of a page as (href, text) pairs by position, the
    first anchor (the header link) skipped."""
    h = F.col("html")
    hrefs = tail(F.regexp_extract_all(h, F.lit(ANCHOR_HREF_RE), F.lit(1)))
    texts = tail(F.regexp_extract_all(h, F.lit(ANCHOR_TEXT_RE), F.lit(1)))
    x = pages.select("page_id", hrefs.alias("hrefs"), texts.alias("texts"))
    return zip_positions(x, {"href": "hrefs", "text": "texts"}, "page_id")


# Places of the left and the right team's half scores among the
# spans of a block.
LEFT_HALVES, RIGHT_HALVES = (1, 5), (3, 7)
BOX_RE = r'<div class="team"><a href="([^"]*)"><div class="teamName">([^<]*)</div></a><div class="score">([^<]*)</div>'
SPAN_RE = r'<span(?: class="([^"]*)")?>([^<]*)</span>'


def team_boxes(pages: DataFrame) -> DataFrame:
    """One row per team box: place, id (from the link), name, score, link."""
    h = F.col("html")
    part = lambda g: F.regexp_extract_all(h, F.lit(BOX_RE), F.lit(g))
    boxes = F.arrays_zip(part(1).alias("link"), part(2).alias("name"), part(3).alias("score"))
    x = pages.select("match_id", F.posexplode(boxes).alias("pos", "b"))
    return x.select(
        "match_id", "pos", path_part("b.link", 4).alias("team_id"), "b.name", "b.score", "b.link"
    )


def nested_team_boxes(pages: DataFrame) -> DataFrame:
    """``team_boxes`` by structure: a box may hold elements of its own tag at
    any place, and its name and score may stand inside further elements."""
    boxes = F.transform(
        elements(F.col("html"), "div", "team"),
        lambda b: F.struct(
            F.regexp_extract(b, HREF_RE, 1).alias("link"), first_text(b, "div", "teamName").alias("name"),
            first_text(b, "div", "score").alias("score"),
        ),
    )
    x = pages.select("match_id", F.posexplode(boxes).alias("pos", "b"))
    return x.select(
        "match_id", "pos", path_part("b.link", 4).alias("team_id"), "b.name", "b.score", "b.link"
    )


def nested_tabs(pages: DataFrame) -> DataFrame:
    """Map tabs by structure: the place and name of each map, and of how many
    elements of the tag its tab consists."""
    tabs = elements(F.col("html"), "div", "tab")
    x = pages.select("match_id", F.posexplode(tabs).alias("pos", "tab"))
    x = x.select("match_id", "pos", pieces(F.col("tab"), "div").alias("tab"))
    return x.select(
        "match_id", "pos", text_of(first_element(F.col("tab"), "div", "map-name")).alias("map_name"),
        count_elements(F.col("tab"), "div").alias("n_elements"),
    )


def score_blocks(blocks: DataFrame) -> DataFrame:
    """Half scores of both teams from a block's spans, and whether the map was
    played (the block's class)."""
    h = F.col("html")
    part = lambda g: F.regexp_extract_all(h, F.lit(SPAN_RE), F.lit(g))
    at = lambda c, places: F.array(*[F.get(c, F.lit(i)) for i in places])
    x = blocks.select(
        "match_id", "choice_number", "left_name", "right_name", part(1).alias("cls"), part(2).alias("txt"),
        (F.regexp_extract(h, '^<div class="([^"]*)"', 1) == "played").alias("was_played"),
    )
    sides = F.array(*[
        F.struct(F.col(name).alias("team_name"), at(F.col("cls"), places).alias("classes"), at(F.col("txt"), places).alias("scores"))
        for name, places in (("left_name", LEFT_HALVES), ("right_name", RIGHT_HALVES))
    ])
    y = x.select("match_id", "choice_number", "was_played", F.explode(sides).alias("s"))
    y = y.select("match_id", "choice_number", "was_played", "s.*").withColumn("halves", last_wins_map("classes", "scores"))
    return y.select(
        "match_id", "choice_number", "team_name", "was_played",
        F.try_element_at("halves", F.lit("ct")).alias("ct"), F.try_element_at("halves", F.lit("t")).alias("t"),
    )


# ---- E3 --------------------------------------------------------------------------
def parse_veto_lines(lines: DataFrame) -> DataFrame:
    """One veto line to (choice_number, team_id or NULL, map_name, type).

    choice = first token without '.'; team = the first team (in list order)
    whose name occurs in the line; 'removed' marks a ban, anything else a
    pick. Map = last token, but the sixth from the end for a line of a
    single-block page with more than eight tokens, and the second token for a
    line without a team whose choice is '7'.
    """
    in1 = F.coalesce(F.col("line").contains(F.col("team1_name")), F.lit(False))
    in2 = F.coalesce(F.col("line").contains(F.col("team2_name")), F.lit(False))
    team = F.when(in1, F.col("team1_id")).when(in2, F.col("team2_id"))
    line = F.col("line")
    return lines.select("match_id", *veto_fields(line, F.split(line, " "), F.col("one_block"), in1 | in2, team))


def veto_fields(line: Column, tok: Column, one_block: Column, found: Column, team_id: Column) -> list[Column]:
    """The fields of one veto line, given its tokens and whether a team was
    found in it."""
    n = F.size(tok)
    choice = strip_chars(F.get(tok, 0), ".")
    last = F.try_element_at(tok, F.lit(-1))
    named_map = F.when(one_block & (n > 8), F.try_element_at(tok, F.lit(-6))).otherwise(last)
    unnamed_map = F.when(choice == "7", F.get(tok, 1)).otherwise(last)
    return [
        F.when(line.contains("removed"), "ban").otherwise("pick").alias("type"),
        choice.alias("choice_number"),
        F.when(found, named_map).otherwise(unnamed_map).alias("map_name"),
        team_id.alias("team_id"),
    ]


def parse_veto_block(blocks: DataFrame, header_lines: int = 5) -> DataFrame:
    """A single-block veto box: text split into lines (X18), the header
    lines skipped (N9, ``lines[5:]``), each line parsed as a single-block
    line (E3)."""
    lines = tail(F.split(F.col("block"), "\n"), header_lines)
    x = blocks.select(
        "match_id", "team1_id", "team1_name", "team2_id", "team2_name",
        F.explode(lines).alias("line"),
    ).withColumn("one_block", F.lit(True))
    return parse_veto_lines(x)


# ---- E4 --------------------------------------------------------------------------
def half_scores(spans: DataFrame) -> DataFrame:
    """Half scores keyed by the side class of each span; a class seen
    twice keeps the later score."""
    m = last_wins_map("classes", "scores")
    x = spans.select("match_id", "choice_number", "team_name", "result", m.alias("halves"))
    return x.select(
        "match_id", "choice_number", "team_name", "result",
        F.try_element_at("halves", F.lit("ct")).alias("ct"),
        F.try_element_at("halves", F.lit("t")).alias("t"),
    )


# ---- E5 --------------------------------------------------------------------------
def headline_day(headlines: DataFrame, run_days: DataFrame) -> DataFrame:
    """Matches listed under the headline of the day before each run day.

    All headline rows are read (the reference stops at the first result list
    holding the day, which cuts a day split over two pages). The run days
    are calendar days, so that side is small; the join is an equi-join on
    the parsed date and AQE broadcasts the smaller side at runtime."""
    h = headlines.select("match_id", headline_date("headline").alias("day"))
    r = run_days.select(F.col("run_day"), F.date_sub("run_day", 1).alias("day"))
    return h.join(r, "day").select(
        F.date_format("run_day", "yyyy-MM-dd").alias("run_date"), "match_id"
    )


# ---- X15 -------------------------------------------------------------------------
def format_label(format_lines: DataFrame) -> DataFrame:
    best_of, kind = format_parts("format_line")
    return format_lines.select("match_id", best_of.alias("best_of_type"), kind.alias("type"))


# ---- E6 --------------------------------------------------------------------------
def player_link(row: Column) -> Column:
    return F.regexp_extract(row, r'<td class="players"><a href="([^"]*)"', 1)


def player_cells(row: Column, link: Column, team_id: Column | None = None) -> list[Column]:
    """Fields of a scoreboard row; id and nick are the last two tokens of the
    player link. The team comes from the scoreboard's header."""
    return [
        path_part(link, -2).alias("player_id"),
        *([] if team_id is None else [team_id.alias("team_id")]),
        path_part(link, -1).alias("nick"),
        _cell(row, "kd").alias("kd"),
        _cell(row, "plus-minus", "<span>").alias("diff"),
        _cell(row, "adr").alias("adr"),
        _cell(row, "kast").alias("kast"),
        _cell(row, "rating").alias("rating"),
    ]


def team_of_header(markup: Column) -> Column:
    """Team id in the link of a scoreboard's header row."""
    return path_part(F.regexp_extract(markup, r'<a class="teamName team" href="([^"]*)"', 1), -2)


def player_rows(rows: DataFrame) -> DataFrame:
    """Scoreboard rows to player stats: the header row (position 0) is
    skipped."""
    h = F.col("row_html")
    return rows.where(F.col("pos") > 0).select("match_id", *player_cells(h, player_link(h)))


def board_players(rows: DataFrame) -> DataFrame:
    """Player rows with the team of their scoreboard: its id is in the link of
    the header row. A scoreboard has one header, so the join keeps the rows."""
    key = ["match_id", "map_name", "slot"]
    teams = rows.where(F.col("pos") == 0).select(*key, team_of_header(F.col("row_html")).alias("team_id"))
    fields = ["player_id", "nick", "kd", "diff", "adr", "kast", "rating"]
    players = player_rows(rows.withColumn("match_id", F.struct(*key)))
    p = players.select("match_id.*", *fields)
    return p.join(teams, key).select("match_id", "map_name", "team_id", *fields)


# ---- N8 / N10 / N14 -------------------------------------------------------------
def played_picks(pages: DataFrame) -> DataFrame:
    """Split a page's veto list into bans and picks (N14), attach to each
    pick the first result block of the same map (N10), keep the played
    picks (N8), one row per pick."""
    bans, picks = split_by("vetos", lambda e: e["removed"])
    picks = attach_first(picks, "blocks", on="map_name", field="results", as_field="results")
    picks = keep(picks, lambda p: p["was_played"])
    x = pages.select("match_id", F.size(bans).alias("n_bans"), F.explode(picks).alias("p"))
    return x.select(
        "match_id", "n_bans",
        F.col("p.choice_number").alias("choice_number"),
        F.col("p.map_name").alias("map_name"),
        F.col("p.team_id").alias("team_id"),
        F.size("p.results").alias("n_results"),
        F.get("p.results", 0)["team_name"].alias("first_team"),
        F.get("p.results", 0)["result"].alias("first_result"),
    )


# ---- F4 --------------------------------------------------------------------------
def no_forfeits(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop rows whose text mentions a forfeit (case-sensitive)."""
    return docs.where(~F.col(text_col).contains("forfeit"))
