"""Hand-written golden match documents (FIXTURES.md section 2)."""

from __future__ import annotations

import copy


def player(pid, team, nick, adr="80", kd="20-10", diff="10", kast="70%", rating="1.10"):
    return {"player_id": pid, "team_id": team, "nick": nick, "kd": kd, "diff": diff,
            "adr": adr, "kast": kast, "rating": rating}


def board(team, pids, side_adr):
    return [player(p, team, f"n{p}", adr=side_adr) for p in pids]


def sides(team, pids):
    return {"total": board(team, pids, "80"), "tr": board(team, pids, "70"), "ct": board(team, pids, "90")}


def result(team, res, ct, t):
    return {"team_name": team, "result": res, "ct": ct, "t": t}


def doc(mid, bo, kind, teams, bans, picks, stats):
    return {"match_id": mid, "type": kind, "best_of_type": bo, "teams": teams,
            "maps": {"bans": bans, "picks": picks}, "stats": stats}


TEAMS_AB = [
    {"team_id": "9996", "name": "Alpha", "score": "2", "link": "https://h.example/team/9996/alpha"},
    {"team_id": "10503", "name": "Beta", "score": "1", "link": "https://h.example/team/10503/beta"},
]


def g1():
    """Bo3: 4 bans, 2 picks and a left-over, three played maps, all sides."""
    bans = [
        {"team_id": "9996", "choice_number": "1", "map_name": "Nuke"},
        {"team_id": "10503", "choice_number": "2", "map_name": "Vertigo"},
        {"team_id": "9996", "choice_number": "5", "map_name": "Ancient"},
        {"team_id": "10503", "choice_number": "6", "map_name": "Overpass"},
    ]
    picks = [
        {"team_id": "9996", "choice_number": "3", "map_name": "Dust2", "was_played": True,
         "results": [result("Alpha", "16", "10", "6"), result("Beta", "10", "4", "6")]},
        {"team_id": "10503", "choice_number": "4", "map_name": "Mirage", "was_played": True,
         "results": [result("Alpha", "12", "7", "5"), result("Beta", "16", "9", "7")]},
        {"team_id": None, "choice_number": "7", "map_name": "Inferno", "was_played": True,
         "results": [result("Alpha", "16", "8", "8"), result("Beta", "14", "6", "8")]},
    ]
    stats = [
        {"map": m, "team1": sides("9996", ["1", "2"]), "team2": sides("10503", ["3", "4"])}
        for m in ("Dust2", "Mirage", "Inferno")
    ]
    return doc("100", "Best of 3 ", "LAN", copy.deepcopy(TEAMS_AB), bans, picks, stats)


def g6():
    """Bans empty, one pick played: no veto and no result row."""
    d = g1()
    d["match_id"] = "600"
    d["maps"]["bans"] = []
    d["maps"]["picks"] = d["maps"]["picks"][:1]
    return d


def g7():
    """One player lacks the tr side; a map outside the seven."""
    d = g1()
    d["match_id"] = "700"
    for m in d["stats"]:
        m["team1"]["tr"] = [p for p in m["team1"]["tr"] if p["player_id"] != "2"]
    d["maps"]["picks"][0]["map_name"] = "Train"
    return d


def series(mid, bo, scores, choices, left_over=7):
    """A document with bans 1-2, the given pick choices and a left-over pick
    at ``left_over`` (team NULL); every pick played with two results."""
    d = g1()
    d["match_id"] = mid
    d["best_of_type"] = bo
    d["teams"][0]["score"], d["teams"][1]["score"] = scores
    pool = ["Dust2", "Mirage", "Inferno", "Ancient", "Overpass", "Nuke", "Vertigo"]
    d["maps"]["bans"] = [
        {"team_id": "9996", "choice_number": "1", "map_name": "Nuke"},
        {"team_id": "10503", "choice_number": "2", "map_name": "Vertigo"},
    ]
    picks = []
    for i, c in enumerate(list(choices) + [left_over]):
        team = None if c == left_over else ("9996" if i % 2 == 0 else "10503")
        picks.append({"team_id": team, "choice_number": str(c), "map_name": pool[i], "was_played": True,
                      "results": [result("Alpha", "16", "9", "7"), result("Beta", "10", "5", "5")]})
    d["maps"]["picks"] = picks
    return d


def g2():
    """Bo1, bans, left-over at 7, score 16-3."""
    return series("200", "Best of 1 ", ("16", "3"), [])


def g3():
    """Bo1 16-16, and a copy with a NULL score."""
    return [series("300", "Best of 1", ("16", "16"), []), series("301", "Best of 1", (None, "16"), [])]


def g4():
    """Bo5, picks 3-6, left-over 7."""
    return series("400", "Best of 5", ("3", "0"), [3, 4, 5, 6])


def g5():
    """Bo2 and a NULL format."""
    return [series("500", "Best of 2", ("1", "1"), [3, 4], left_over=99), series("501", None, ("2", "0"), [3, 4], left_over=99)]
