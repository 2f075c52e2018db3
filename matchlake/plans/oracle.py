"""DuckDB oracle SQL: the raw-table derivations and each registered query,
written independently of the Spark code as plain ANSI SQL over the driver
tables (pre-registered as views of the same name)."""

from __future__ import annotations

# Fixed values, from FIXTURES.md: nothing is taken from the code that is checked.
POOL = ["Vertigo", "Dust2", "Overpass", "Ancient", "Mirage", "Inferno", "Nuke", "Train", "Cache"]
BEST_OF = {"1": "Best of 1 ", "2": "Best of 2", "3": "Best of 3 ", "4": "Best of 5 "}
MAP_DIMENSION = [(1, "Vertigo"), (2, "Dust2"), (3, "Overpass"), (4, "Ancient"), (5, "Mirage"), (6, "Inferno"), (7, "Nuke")]
SIDE_ADR_OFFSET = {"total": 0, "ct": 1, "tr": 2}
TEAM_LINK_PREFIX = "https://h.example/team/"
# format ('' for any other), choice number, position of the map (section 2.1)
MAP_CHOICES = [
    ("Best of 1", "3", "Map 1"), ("Best of 1", "4", "Map 2"), ("Best of 1", "5", "Map 1"), ("Best of 1", "6", "Map 2"),
    ("Best of 1", "7", "Map 1"), ("Best of 3", "3", "Map 1"), ("Best of 3", "4", "Map 2"), ("Best of 3", "7", "Map 3"),
    ("Best of 5", "3", "Map 1"), ("Best of 5", "4", "Map 2"), ("Best of 5", "5", "Map 3"), ("Best of 5", "6", "Map 4"),
    ("Best of 5", "7", "Map 5"), ("", "3", "Map 1"), ("", "4", "Map 2"),
]


def _case(expr: str, pairs: list[tuple[str, str]]) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    return f"CASE {expr} {arms} END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


POOL_CASE = _case("k", [(str(i), _q(m)) for i, m in enumerate(POOL)])
BEST_OF_CASE = _case("substr(o_orderpriority, 1, 1)", [(_q(k), _q(v)) for k, v in BEST_OF.items()])
MAPS_VALUES = ", ".join(f"({i}, {_q(n)})" for i, n in MAP_DIMENSION)
ADR_OFFSET = _case("sd.side", [(_q(k), str(v)) for k, v in SIDE_ADR_OFFSET.items()])
N_TEAMS = "(SELECT count(*) FROM supplier)"

RAW_CTES = f"""
mt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         o_custkey % {N_TEAMS} AS a,
         (o_custkey % {N_TEAMS} + 1 + o_orderkey % 9) % {N_TEAMS} AS b
  FROM orders
),
raw_matchs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
         CASE WHEN o_orderstatus = 'F' THEN 'LAN' ELSE 'Online' END AS type,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
         {BEST_OF_CASE} AS best_of_type,
         CAST(a AS VARCHAR) AS team1_id, CAST(b AS VARCHAR) AS team2_id,
         CAST(o_orderkey % 17 AS VARCHAR) AS team1_score,
         CAST(o_custkey % 17 AS VARCHAR) AS team2_score
  FROM mt
),
raw_teams AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS team_id, s_name AS name,
         {_q(TEAM_LINK_PREFIX)} || CAST(s_suppkey AS VARCHAR) || '/' || s_name AS link
  FROM supplier
),
lg AS (
  SELECT g.*, m.a, m.b,
         CASE g.f WHEN 'A' THEN m.a WHEN 'R' THEN m.b END AS pick_team
  FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) % 9 AS k,
               CAST(floor(min(l_quantity)) AS BIGINT) AS q, min(l_returnflag) AS f
        FROM lineitem GROUP BY l_orderkey, l_linenumber) g
  JOIN mt m ON g.l_orderkey = m.o_orderkey
),
raw_vetos AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id,
         CASE WHEN l_linenumber <= 2 THEN 'ban' ELSE 'pick' END AS type,
         CAST(l_linenumber AS VARCHAR) AS choice_number,
         {POOL_CASE} AS map_name,
         CAST(pick_team AS VARCHAR) AS team_id
  FROM lg
),
raw_results AS (
  SELECT CAST(x.l_orderkey AS VARCHAR) AS match_id,
         CAST(x.l_linenumber AS VARCHAR) AS choice_number,
         {POOL_CASE.replace('CASE k', 'CASE x.k')} AS map_name,
         CAST(x.pick_team AS VARCHAR) AS pick_team_id,
         CAST(x.q % 9 AS VARCHAR) AS ct,
         CAST(x.q AS VARCHAR) AS result,
         CAST(x.q - x.q % 9 AS VARCHAR) AS t,
         s.s_name AS team_name,
         x.side_no
  FROM (SELECT lg.*, lg.a AS team_key, 0 AS side_no FROM lg
        UNION ALL SELECT lg.*, lg.b AS team_key, 1 AS side_no FROM lg) x
  JOIN supplier s ON x.team_key = s.s_suppkey
),
raw_stats_slot AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS match_id, sd.side,
         CASE WHEN l.l_linestatus = 'O' THEN 'Vertigo' ELSE 'Dust2' END AS map_name,
         CAST(CAST(floor(l.l_extendedprice / 1000) AS BIGINT) + {ADR_OFFSET} AS VARCHAR) AS adr,
         CAST(l.l_linenumber AS VARCHAR) AS diff,
         CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || '%' AS kast,
         CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS kd,
         'nick' || CAST(l.l_suppkey AS VARCHAR) AS nick,
         CAST(l.l_suppkey AS VARCHAR) AS player_id,
         CAST(CAST(floor(l.l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR) AS rating,
         CAST(l.l_suppkey % 10 AS VARCHAR) AS team_id,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 'team1' ELSE 'team2' END AS slot
  FROM lineitem l, (VALUES ('total'), ('ct'), ('tr')) sd(side)
  WHERE NOT (sd.side = 'tr' AND l.l_linenumber = 7)
),
raw_stats AS (
  SELECT match_id, side, map_name, adr, diff, kast, kd, nick, player_id, rating, team_id
  FROM raw_stats_slot
),
raw_players AS (
  SELECT DISTINCT player_id, team_id, nick FROM raw_stats WHERE side = 'total'
),
dim_maps AS (
  SELECT * FROM (VALUES {MAPS_VALUES}) v(id, name)
)
"""


def with_raw(body: str) -> str:
    return "WITH " + RAW_CTES.strip() + "\n" + body.strip()


MODEL_SQL = {
    # labels and win flags from small tables of the rules, not from the model
    "stg_matchs": """
, label(bo, short) AS (VALUES ('Best of 3', 'MD3'), ('Best of 5', 'MD5')),
num AS (
  SELECT *, trim(best_of_type) AS bo, team1_score::INTEGER AS s1, team2_score::INTEGER AS s2 FROM raw_matchs
)
SELECT n.match_id, n.type, n.date, coalesce(l.short, 'MD1') AS best_of_type, n.team1_id, n.team2_id,
       if(n.bo = 'Best of 1', coalesce(n.s1 > n.s2, false)::INTEGER, n.s1) AS team1_score,
       if(n.bo = 'Best of 1', coalesce(n.s2 > n.s1, false)::INTEGER, n.s2) AS team2_score
FROM num n LEFT JOIN label l ON l.bo = n.bo
""",
    "stg_teams": """
SELECT DISTINCT team_id, name AS team_name, link AS team_link FROM raw_teams
""",
    "stg_players": """
SELECT DISTINCT player_id, team_id, nick AS player_nick FROM raw_players
""",
    "stg_maps_vetos": """
SELECT DISTINCT mv.match_id, mv.type, mv.choice_number, m.id AS map_id,
       coalesce(mv.team_id, 'Left') AS pick_team_id
FROM raw_vetos mv JOIN dim_maps m ON mv.map_name = m.name
""",
    # every key has one list of rows per side; a row of the result is one pick
    # from each list
    "stg_match_stats": """
, boards AS (
  SELECT match_id, map_name, player_id, team_id,
         list({nick: nick, adr: adr, diff: diff, kast: kast, kd: kd, rating: rating}) FILTER (WHERE side = 'total') AS tot,
         list({adr: adr, diff: diff, kast: kast, kd: kd, rating: rating}) FILTER (WHERE side = 'ct') AS ct,
         list({adr: adr, diff: diff, kast: kast, kd: kd, rating: rating}) FILTER (WHERE side = 'tr') AS tr
  FROM raw_stats
  WHERE match_id IS NOT NULL AND map_name IS NOT NULL AND player_id IS NOT NULL AND team_id IS NOT NULL
  GROUP BY ALL
),
one AS (SELECT * EXCLUDE (tot), unnest(tot) AS a FROM boards),
two AS (SELECT * EXCLUDE (ct), unnest(ct) AS b FROM one),
three AS (SELECT * EXCLUDE (tr), unnest(tr) AS c FROM two)
SELECT match_id, map_name, a.nick AS nick, player_id, team_id,
       a.adr AS adr_total, a.diff AS diff_total, a.kast AS kast_total, a.kd AS kd_total, a.rating AS rating_total,
       b.adr AS adr_ct, b.diff AS diff_ct, b.kast AS kast_ct, b.kd AS kd_ct, b.rating AS rating_ct,
       c.adr AS adr_tr, c.diff AS diff_tr, c.kast AS kast_tr, c.kd AS kd_tr, c.rating AS rating_tr
FROM three
""",
    "pair_bounds": """
SELECT mr.match_id, min(t.team_id) AS team1_id, max(t.team_id) AS team2_id
FROM raw_results mr JOIN raw_teams t ON t.name = mr.team_name
GROUP BY 1
""",
}


CHOICES = ", ".join(f"({_q(bo)}, {_q(n)}, {_q(label)})" for bo, n, label in MAP_CHOICES)


def m7_sql(results: str, matchs: str, teams: str) -> str:
    """Body of the map-results model over the given relation names (adds its
    own CTEs, so it starts with a comma): a result and an opponent of the same
    choice are kept if some match has their names as its pair of bounds."""
    return f"""
, choice(bo, choice_number, label) AS (VALUES {CHOICES}),
limits AS (
  SELECT r.match_id, min(t.team_id) AS low, max(t.team_id) AS high
  FROM {results} r, {teams} t WHERE t.name = r.team_name GROUP BY r.match_id
),
named AS (
  SELECT DISTINCT x.name AS low_name, y.name AS high_name
  FROM limits l, {teams} x, {teams} y WHERE x.team_id = l.low AND y.team_id = l.high
),
format AS (
  SELECT DISTINCT match_id, if(trim(best_of_type) IN ('Best of 1', 'Best of 3', 'Best of 5'), trim(best_of_type), '') AS bo
  FROM {matchs}
),
sided AS (
  SELECT DISTINCT r.match_id, r.choice_number, r.map_name, coalesce(r.pick_team_id, 'Left') AS pick_team_id,
         r.team_name AS team1_id, r.result AS team1_result, r.ct AS team1_ct, r.t AS team1_t, f.bo
  FROM {results} r, format f WHERE f.match_id = r.match_id
),
rivals AS (SELECT DISTINCT match_id, choice_number, team_name AS team2_id FROM {results})
SELECT DISTINCT s.match_id, c.label AS map_choice, s.choice_number, s.map_name, s.pick_team_id,
       s.team1_id, s.team1_result, s.team1_ct, s.team1_t, v.team2_id
FROM sided s
JOIN rivals v USING (match_id, choice_number)
LEFT JOIN choice c ON c.bo = s.bo AND c.choice_number = s.choice_number
WHERE v.team2_id <> s.team1_id
  AND EXISTS (SELECT 1 FROM named n WHERE n.low_name = s.team1_id AND n.high_name = v.team2_id)
"""


MODEL_SQL["stg_maps_results"] = m7_sql("raw_results", "raw_matchs", "raw_teams")
MODEL_SQL["last_sorts"] = MODEL_SQL["stg_maps_results"].rstrip() + "\nORDER BY match_id NULLS LAST, map_choice NULLS LAST\n"

# documents keep a match's bans and picks; T1 drops both lists of a match
# in which either is empty
BOTH_LISTS = """
both_lists AS (
  SELECT match_id FROM raw_vetos GROUP BY match_id
  HAVING count(*) FILTER (WHERE type = 'ban') > 0 AND count(*) FILTER (WHERE type = 'pick') > 0
)"""

MODEL_SQL.update({
    "flatten_matchs": "SELECT DISTINCT * FROM raw_matchs",
    "flatten_teams": """
SELECT DISTINCT x.team_id, t.name, t.link
FROM (SELECT team1_id AS team_id FROM raw_matchs UNION ALL SELECT team2_id FROM raw_matchs) x
LEFT JOIN raw_teams t ON t.team_id = x.team_id
""",
    "flatten_players": """
SELECT DISTINCT player_id, team_id, nick FROM raw_stats WHERE side = 'total'
""",
    "flatten_vetos": f"""
, {BOTH_LISTS.strip()}
SELECT DISTINCT v.match_id, v.type, v.choice_number, v.map_name, v.team_id
FROM raw_vetos v WHERE v.match_id IN (SELECT match_id FROM both_lists)
""",
    "flatten_results": f"""
, {BOTH_LISTS.strip()}
SELECT DISTINCT r.match_id, r.choice_number, r.map_name, r.pick_team_id, r.ct, r.result, r.t, r.team_name
FROM raw_results r
JOIN raw_vetos v ON v.match_id = r.match_id AND v.choice_number = r.choice_number AND v.type = 'pick'
WHERE r.match_id IN (SELECT match_id FROM both_lists)
""",
    "flatten_stats": """
SELECT DISTINCT match_id, side, map_name, adr, diff, kast, kd, nick, player_id, rating, team_id
FROM raw_stats
""",
})


# tables written by the range job over the assembled documents (one day per
# match, so per-day dedupe equals plain DISTINCT for match-keyed tables)
JOB_CTES = f"""
, {BOTH_LISTS.strip()},
flat_results AS (
  SELECT DISTINCT r.match_id, r.choice_number, r.map_name, r.pick_team_id, r.ct, r.result, r.t, r.team_name
  FROM raw_results r
  JOIN raw_vetos v ON v.match_id = r.match_id AND v.choice_number = r.choice_number AND v.type = 'pick'
  WHERE r.match_id IN (SELECT match_id FROM both_lists)
),
flat_vetos AS (
  SELECT DISTINCT v.match_id, v.type, v.choice_number, v.map_name, v.team_id
  FROM raw_vetos v WHERE v.match_id IN (SELECT match_id FROM both_lists)
),
flat_matchs AS (SELECT DISTINCT * FROM raw_matchs),
flat_teams AS (
  SELECT DISTINCT x.date, x.team_id, t.name, t.link
  FROM (SELECT date, team1_id AS team_id FROM raw_matchs UNION ALL SELECT date, team2_id FROM raw_matchs) x
  LEFT JOIN raw_teams t ON t.team_id = x.team_id
),
flat_players AS (
  SELECT DISTINCT m.date, s.player_id, s.team_id, s.nick
  FROM raw_stats s JOIN raw_matchs m ON m.match_id = s.match_id
  WHERE s.side = 'total'
),
flat_stats AS (SELECT DISTINCT * FROM raw_stats)"""

JOB_ROW_COLUMNS = {
    "matchs": "best_of_type date match_id team1_id team1_score team2_id team2_score type",
    "teams": "link name team_id",
    "players": "nick player_id team_id",
    "maps_vetos": "choice_number map_name match_id team_id type",
    "maps_results": "choice_number ct map_name match_id pick_team_id result t team_name",
    "match_stats": "adr diff kast kd map_name match_id nick player_id rating side team_id",
}
JOB_ROW_SOURCES = {
    "matchs": "flat_matchs", "teams": "flat_teams", "players": "flat_players",
    "maps_vetos": "(SELECT f.*, m.date FROM flat_vetos f JOIN raw_matchs m USING (match_id))",
    "maps_results": "(SELECT f.*, m.date FROM flat_results f JOIN raw_matchs m USING (match_id))",
    "match_stats": "(SELECT f.*, m.date FROM flat_stats f JOIN raw_matchs m USING (match_id))",
}


def job_rows(where: str = "true", copies: int = 1) -> str:
    """Rows of the six tables with their storage day, as md5 of their text."""
    parts = []
    for name, columns in JOB_ROW_COLUMNS.items():
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns.split())
        parts.append(
            f"SELECT '{name}' AS table_name, strftime(CAST(date AS DATE) + 1, '%Y-%m-%d') AS extract_date, "
            f"md5(concat_ws('|', {text})) AS row_md5 FROM {JOB_ROW_SOURCES[name]} f, range({copies}) WHERE {where}"
        )
    return "\n" + "\nUNION ALL ".join(parts) + "\n"


INNER_MONTHS = (
    "strftime(CAST(date AS DATE) + 1, '%Y-%m') > "
    "(SELECT min(strftime(CAST(date AS DATE) + 1, '%Y-%m')) FROM raw_matchs) AND "
    "strftime(CAST(date AS DATE) + 1, '%Y-%m') < "
    "(SELECT max(strftime(CAST(date AS DATE) + 1, '%Y-%m')) FROM raw_matchs)"
)


# the corrected extract: no bans in every fifth match, nothing of the first month
CORRECTED_CTES = JOB_CTES.replace(
    "WHERE type = 'ban') > 0", "WHERE type = 'ban' AND CAST(match_id AS BIGINT) % 5 <> 0) > 0"
)
AFTER_FIRST_MONTH = (
    "strftime(CAST(date AS DATE) + 1, '%Y-%m') > "
    "(SELECT min(strftime(CAST(date AS DATE) + 1, '%Y-%m')) FROM raw_matchs)"
)

MODEL_SQL.update({
    "json_round_trip": "SELECT DISTINCT * FROM raw_matchs",
    "daily_run": JOB_CTES + job_rows(),
    "append_run": JOB_CTES + job_rows(copies=2),
    "range_of_months": JOB_CTES + job_rows(INNER_MONTHS),
    "streaming_run": JOB_CTES + job_rows(),
    # one broken line per seventh match, in the month of its day
    "parsed_lines": """
SELECT strftime(CAST(date AS DATE) + 1, '%Y-%m') AS extract_month, false AS is_malformed, match_id AS content FROM raw_matchs
UNION ALL
SELECT strftime(CAST(date AS DATE) + 1, '%Y-%m'), true, '{"match_id": "' || match_id || '", "teams": [' FROM raw_matchs
WHERE CAST(match_id AS BIGINT) % 7 = 0
""",
    "corrected_rerun": CORRECTED_CTES + job_rows(AFTER_FIRST_MONTH),
    "rerun_is_idempotent": JOB_CTES + job_rows(),
    "backfill": JOB_CTES + m7_sql("flat_results", "flat_matchs", "flat_teams"),
})

MODEL_SQL["catalog_backfill"] = (
    MODEL_SQL["backfill"].replace(
        "SELECT DISTINCT s.match_id, c.label AS map_choice", ", final AS (SELECT DISTINCT s.match_id, c.label AS map_choice"
    )
    + """)
SELECT r.*, CASE trim(m.best_of_type) WHEN 'Best of 3' THEN 'MD3' WHEN 'Best of 5' THEN 'MD5' ELSE 'MD1' END AS best_of_type
FROM final r JOIN flat_matchs m USING (match_id)
"""
)


_POOL_K = POOL_CASE  # CASE k WHEN 0 THEN 'Vertigo' ...


def _pool(alias: str) -> str:
    return POOL_CASE.replace("CASE k", f"CASE {alias}.k")


MODEL_SQL.update({
    "url_fields": """
SELECT page_id,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) AS host,
       split_part(url, '/', 5) AS segment_4,
       split_part(url, '/', -2) AS next_to_last,
       split_part(url, '/', -1) AS last
FROM pages
""",
    "page_fields": """
SELECT page_id,
       regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
       regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS ad_text,
       CAST(len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS INTEGER) AS n_links,
       regexp_extract_all(html, 'href="([^"]*)"', 1)[1] AS first_link
FROM pages
""",
    "array_tail": """
, x AS (
  SELECT page_id,
         regexp_extract_all(html, '<a href="([^"]*)">', 1)[2:] AS h,
         regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[2:] AS t
  FROM pages
), z AS (
  SELECT page_id, h, t, unnest(generate_series(1, greatest(len(h), len(t)))) AS i FROM x
)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href, t[i] AS text FROM z
""",
    "veto_lines": f"""
SELECT CAST(g.l_orderkey AS VARCHAR) AS match_id,
       CASE WHEN g.pick_team IS NOT NULL AND g.l_linenumber <= 2 THEN 'ban' ELSE 'pick' END AS type,
       CAST(g.l_linenumber AS VARCHAR) AS choice_number,
       CASE WHEN g.pick_team IS NOT NULL OR g.l_linenumber = 7 THEN {_pool('g')} ELSE 'over' END AS map_name,
       CAST(g.pick_team AS VARCHAR) AS team_id
FROM lg g
JOIN supplier sa ON sa.s_suppkey = g.a
JOIN supplier sb ON sb.s_suppkey = g.b
""",
    "half_scores": """
, hs AS (
  SELECT g.l_orderkey, g.l_linenumber, g.q, sa.s_name AS a_name, sb.s_name AS b_name,
         CASE WHEN g.q % 2 = 0 THEN 'ct' ELSE 't' END AS c1,
         CASE WHEN g.k = 0 THEN 'ct' WHEN g.q % 2 = 0 THEN 't' ELSE 'ct' END AS c2,
         CAST(g.q % 9 AS VARCHAR) AS s1,
         CAST(CAST(floor(g.q / 9.0) AS BIGINT) AS VARCHAR) AS s2
  FROM lg g JOIN supplier sa ON sa.s_suppkey = g.a JOIN supplier sb ON sb.s_suppkey = g.b
), sides AS (
  SELECT l_orderkey, l_linenumber, q, a_name AS team_name, c1, c2, s1 AS v1, s2 AS v2 FROM hs
  UNION ALL
  SELECT l_orderkey, l_linenumber, q, b_name,
         CASE WHEN c1 = 'ct' THEN 't' ELSE 'ct' END, CASE WHEN c2 = 'ct' THEN 't' ELSE 'ct' END,
         s2, s1 FROM hs
)
SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_linenumber AS VARCHAR) AS choice_number,
       team_name, CAST(q AS VARCHAR) AS result,
       CASE WHEN c2 = 'ct' THEN v2 WHEN c1 = 'ct' THEN v1 END AS ct,
       CASE WHEN c2 = 't' THEN v2 WHEN c1 = 't' THEN v1 END AS t
FROM sides
""",
    "headline_day": """
, rd AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS run_day FROM lineitem)
SELECT strftime(rd.run_day, '%Y-%m-%d') AS run_date, CAST(o.o_orderkey AS VARCHAR) AS match_id
FROM orders o JOIN rd ON CAST(o.o_orderdate AS DATE) = rd.run_day - 1
""",
    "format_label": """
SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
       'Best of ' || CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '1' WHEN '2' THEN '2'
                          WHEN '3' THEN '3' ELSE '5' END || ' ' AS best_of_type,
       CASE WHEN o_orderstatus = 'F' THEN 'LAN' ELSE 'Online' END AS type
FROM orders
""",
    "player_rows": """
SELECT match_id, player_id, nick, kd, diff, adr, kast, rating FROM raw_stats WHERE side = 'total'
""",
    "played_picks": f"""
, pk AS (SELECT * FROM lg WHERE l_linenumber >= 3),
first_block AS (
  SELECT l_orderkey, k, min(l_linenumber) AS first_ln FROM pk GROUP BY l_orderkey, k
),
nb AS (
  SELECT l_orderkey, CAST(count(*) FILTER (WHERE l_linenumber <= 2) AS INTEGER) AS n_bans
  FROM lg GROUP BY l_orderkey
)
SELECT CAST(p.l_orderkey AS VARCHAR) AS match_id, nb.n_bans,
       CAST(p.l_linenumber AS VARCHAR) AS choice_number, {_pool('p')} AS map_name,
       CAST(p.pick_team AS VARCHAR) AS team_id, 2 AS n_results,
       sa.s_name AS first_team, CAST(fb.q AS VARCHAR) AS first_result
FROM pk p
JOIN first_block f ON f.l_orderkey = p.l_orderkey AND f.k = p.k
JOIN lg fb ON fb.l_orderkey = p.l_orderkey AND fb.l_linenumber = f.first_ln
JOIN supplier sa ON sa.s_suppkey = fb.a
JOIN supplier sb ON sb.s_suppkey = fb.b
JOIN nb ON nb.l_orderkey = p.l_orderkey
WHERE p.q % 10 NOT IN (0, 5)
""",
    "no_forfeits": """
SELECT doc_id, lang, source, n_chars FROM documents WHERE NOT contains(text, 'forfeit')
""",
})


MODEL_SQL["team_boxes"] = """
SELECT m.match_id, x.pos::INTEGER AS pos, t.team_id, t.name, if(x.pos = 0, m.team1_score, m.team2_score) AS score, t.link
FROM raw_matchs m, (VALUES (0), (1)) x(pos), raw_teams t
WHERE t.team_id = if(x.pos = 0, m.team1_id, m.team2_id)
"""
MODEL_SQL["nested_team_boxes"] = MODEL_SQL["team_boxes"]
# a tab is itself, an icon, a name and a list of boards with two elements each
MODEL_SQL["nested_tabs"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS match_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS pos,
       {POOL_CASE} AS map_name, CAST(4 + 2 * (l_linenumber % 3) AS INTEGER) AS n_elements
FROM lg
"""
MODEL_SQL["board_players"] = """
SELECT match_id, map_name, slot AS team_id, player_id, nick, kd, diff, adr, kast, rating
FROM raw_stats_slot WHERE side = 'total'
"""
MODEL_SQL["score_blocks"] = MODEL_SQL["half_scores"].replace(
    "CAST(q AS VARCHAR) AS result", "q % 10 <> 0 AS was_played"
)
# pages show no forfeited match, the board's team instead of the player's, and
# to each pick the first block of its map; unplayed maps are left out
MODEL_SQL["pages_to_raw"] = f"""
, shown AS (SELECT * FROM raw_matchs WHERE CAST(match_id AS BIGINT) % 3 <> 1),
pk AS (
  SELECT g.*, first_value(g.q) OVER (PARTITION BY g.l_orderkey, g.k ORDER BY g.l_linenumber) AS shown_q
  FROM lg g WHERE g.l_linenumber >= 3
),
played AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_linenumber AS VARCHAR) AS choice_number, {POOL_CASE} AS map_name,
         CAST(pick_team AS VARCHAR) AS team_id, a, b, shown_q
  FROM pk WHERE shown_q % 10 <> 0
),
page_vetos AS (
  SELECT match_id, type, choice_number, map_name, team_id FROM raw_vetos WHERE type = 'ban'
  UNION ALL SELECT match_id, 'pick', choice_number, map_name, team_id FROM played
),
flat_vetos AS (
  SELECT DISTINCT * FROM page_vetos SEMI JOIN shown USING (match_id)
  WHERE match_id IN (SELECT match_id FROM page_vetos WHERE type = 'ban') AND match_id IN (SELECT match_id FROM played)
),
flat_results AS (
  SELECT DISTINCT v.match_id, v.choice_number, v.map_name, v.team_id AS pick_team_id, CAST(p.shown_q % 9 AS VARCHAR) AS ct,
         CAST(p.shown_q AS VARCHAR) AS result, CAST(p.shown_q - p.shown_q % 9 AS VARCHAR) AS t, s.s_name AS team_name
  FROM flat_vetos v JOIN played p USING (match_id, choice_number) JOIN supplier s ON s.s_suppkey IN (p.a, p.b)
  WHERE v.type = 'pick'
),
flat_matchs AS (SELECT DISTINCT * REPLACE (coalesce(best_of_type, '') AS best_of_type) FROM shown),
flat_teams AS (
  SELECT DISTINCT m.date, t.team_id, t.name, t.link FROM shown m JOIN raw_teams t ON t.team_id IN (m.team1_id, m.team2_id)
),
flat_stats AS (
  SELECT DISTINCT s.* EXCLUDE (slot) REPLACE (if(s.slot = 'team1', m.team1_id, m.team2_id) AS team_id)
  FROM raw_stats_slot s JOIN shown m USING (match_id)
),
flat_players AS (
  SELECT DISTINCT m.date, s.player_id, s.team_id, s.nick FROM flat_stats s JOIN shown m USING (match_id) WHERE s.side = 'total'
)""" + job_rows()
MODEL_SQL["stats_by_map"] = MODEL_SQL["stg_match_stats"]
MODEL_SQL["stg_match_stats_lists"] = MODEL_SQL["stg_match_stats"]


def _positions(relation: str, name: str, order: str) -> str:
    columns = order.split()
    text = ", ".join(f"coalesce({c}, '-')" for c in columns)
    keys = ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    return (
        f"SELECT '{name}' AS model, row_number() OVER (ORDER BY {keys}) AS position, "
        f"md5(concat_ws('|', {text})) AS row_md5 FROM ({relation})"
    )


def _body(sql: str) -> str:
    """A model's SQL as a relation of its own."""
    s = sql.strip()
    return "WITH " + s[1:].strip() if s.startswith(",") else s


MODEL_SQL["sorted_positions"] = (
    _positions(
        _body(MODEL_SQL["stg_maps_results"]), "stg_maps_results",
        "match_id map_choice choice_number map_name pick_team_id team1_id team1_result team2_id",
    )
    + "\nUNION ALL\n"
    + _positions(
        _body(MODEL_SQL["stg_match_stats"]), "stg_match_stats",
        "map_name match_id player_id team_id kd_total adr_total kd_ct adr_ct kd_tr adr_tr",
    )
)
MODEL_SQL["no_forfeit_matches"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS match_id, '* Match ' || o_orderkey || ' played' AS note
FROM orders WHERE o_orderkey % 3 <> 1
"""
MODEL_SQL["views_by_ordinal"] = """
, vetos AS (
  SELECT DISTINCT v.match_id, v.type, v.choice_number, d.id, coalesce(v.team_id, 'Left') AS pick
  FROM raw_vetos v, dim_maps d WHERE d.name = v.map_name
)
SELECT CASE trim(m.best_of_type) WHEN 'Best of 3' THEN 'MD3' WHEN 'Best of 5' THEN 'MD5' ELSE 'MD1' END AS best_of_type,
       v.type, count(*) AS n, min(v.choice_number) AS first_choice
FROM vetos v, raw_matchs m WHERE m.match_id = v.match_id GROUP BY ALL
"""

# a single-block box parses to the same rows as the separate lines
MODEL_SQL["veto_block"] = MODEL_SQL["veto_lines"]


def model_sql(name: str) -> str:
    body = MODEL_SQL[name].strip()
    if body.startswith(","):
        # the body adds CTEs of its own: ", name AS (...) ... SELECT ..."
        return "WITH " + RAW_CTES.strip() + "\n" + body
    return with_raw(body)
