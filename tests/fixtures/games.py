"""Hand-written game documents (live feed shape) and lineups.

G1 major: two innings, eight plate appearances, a scoring play, a defensive
substitution, a pickoff between pitches, full tracking data.
G2 minor: same shape without pitchData, hitData and details.type.
G3 edges: a plate appearance with no play events, empty runners, missing credit,
a substitution in the half's first event.
"""

from __future__ import annotations

import copy
import json
from pathlib import Path


def _pitch(idx, num, balls, strikes, outs=0, play_id=None, dis=None, desc="Ball", ptype="FF", speed=95.0, hit=None):
    e = {
        "playId": play_id or f"p{idx}",
        "index": idx,
        "pitchNumber": num,
        "type": "pitch",
        "isSubstitution": False,
        "count": None if balls is None else {"outs": outs, "balls": balls, "strikes": strikes},
        "details": {"description": desc, "fromCatcher": False, "isOut": False, "type": {"code": ptype}},
        "pitchData": {
            "coordinates": {"aX": -5.1, "aY": 28.2, "aZ": -15.3, "vX0": 6.2, "vY0": -138.1, "vZ0": -4.4, "x0": -1.5, "z0": 5.9},
            "extension": 6.4,
            "breaks": {"spinRate": 2301.0},
            "strikeZoneTop": 3.4,
            "strikeZoneBottom": 1.6,
        },
    }
    if dis is not None:
        e["details"]["disengagementNum"] = dis
    if hit:
        e["hitData"] = {"launchSpeed": hit[0], "launchAngle": hit[1], "coordinates": {"coordX": 120.5, "coordY": 90.25}}
    return e


def _action(idx, typ="action", sub=False, player=None, position=None, event=None, event_type=None, play_id=None, count=None):
    e = {"index": idx, "type": typ, "isSubstitution": sub, "details": {}}
    if play_id:
        e["playId"] = play_id
    if player is not None:
        e["player"] = {"id": player}
    if position is not None:
        e["position"] = {"code": str(position)}
    if event:
        e["details"]["event"] = event
    if event_type:
        e["details"]["eventType"] = event_type
    if count:
        e["count"] = count
    return e


def _runner(start, end, runner, play_index, is_out=False, event_type=None, credit=None):
    r = {
        "movement": {"start": start, "end": end, "isOut": is_out},
        "details": {"runner": {"id": runner}, "playIndex": play_index, "eventType": event_type},
    }
    if credit is not None:
        r["credit"] = [{"position": {"code": str(c)}} for c in credit]
    return r


def _pa(idx, inning, half, batter, pitcher, event, is_out, plays, runners):
    return {
        "about": {"atBatIndex": idx, "inning": inning, "halfInning": half},
        "matchup": {"batter": {"id": batter}, "batSide": {"code": "R"}, "pitcher": {"id": pitcher}, "pitchHand": {"code": "L"}},
        "result": {"event": event, "isOut": is_out},
        "runners": runners,
        "playEvents": plays,
    }


def g1(game_id: str = "g1") -> dict:
    pa0 = _pa(
        0, 1, "top", 11, 21, "Single", False,
        [
            _pitch(0, 1, 1, 0, play_id="a0"),
            _action(1, typ="pickoff", event="Pickoff Attempt 1B", event_type="pickoff_attempt_1b", play_id="a1",
                    count={"outs": 0, "balls": 1, "strikes": 0}),
            _pitch(2, 2, 1, 1, play_id="a2", dis=1),
            _pitch(3, 3, None, None, play_id="a3"),
            _pitch(4, 4, 2, 1, play_id="a4", dis=2, desc="In play, no out", hit=(101.5, 12.0)),
        ],
        [_runner(None, "1B", 11, 4, event_type="single")],
    )
    # disengagements raw: NULL, NULL(pickoff), 1, NULL, 2 -> set on indexes 2 and 4
    pa1 = _pa(
        1, 1, "top", 12, 21, "Groundout", True,
        [
            _pitch(0, 1, 0, 1, play_id="b0"),
            _pitch(1, 2, 0, 1, outs=1, play_id="b1", desc="In play, out(s)", hit=(88.0, -5.0)),
        ],
        [
            _runner("1B", "2B", 11, 1, event_type="field_out"),
            _runner(None, None, 12, 1, is_out=True, event_type="field_out", credit=[6, 3]),
        ],
    )
    pa2 = _pa(
        2, 1, "bottom", 31, 41, "Double", False,
        [_pitch(0, 1, 0, 0, play_id="c0", desc="In play, run(s)", hit=(104.0, 20.0))],
        [
            _runner("3B", "score", 32, 0, event_type="double"),
            _runner(None, "2B", 31, 0, event_type="double"),
            _runner("1B", None, 33, 0, is_out=True, event_type="double"),
            _runner("2B", "score", 34, 0, event_type="double"),
        ],
    )
    pa3 = _pa(3, 1, "bottom", 35, 41, "Strikeout", True, [_pitch(0, 1, 0, 1, outs=1, play_id="d0", desc="Called Strike")], [])
    pa4 = _pa(
        4, 1, "bottom", 36, 41, "Walk", False,
        [_pitch(0, 1, 1, 0, play_id="e0"), _pitch(1, 2, 2, 0, play_id="e1"), _pitch(2, 3, 3, 0, play_id="e2"),
         _pitch(3, 4, 4, 0, play_id="e3")],
        [_runner(None, "1B", 36, 3, event_type="walk"),
         _runner("1B", "2B", 99, 1, event_type="stolen_base_2b")],
    )
    pa5 = _pa(
        5, 2, "top", 13, 22, "Flyout", True,
        [
            _action(0, sub=True, player=200, position=6, event="Defensive Sub", event_type="defensive_substitution"),
            _pitch(1, 1, 0, 1, outs=1, play_id="f1", desc="In play, out(s)", hit=(95.0, 35.0)),
        ],
        [_runner(None, None, 13, 1, is_out=True, event_type="field_out", credit=[8])],
    )
    pa6 = _pa(6, 2, "top", 14, 22, "Single", False, [_pitch(0, 1, 0, 0, play_id="g0", desc="In play, no out")],
              [_runner(None, "1B", 14, 0, event_type="single")])
    pa7 = _pa(
        7, 2, "bottom", 37, 42, "Caught Stealing 2B", True,
        [_pitch(0, 1, 1, 0, outs=1, play_id="h0")],
        [_runner("1B", None, 38, 0, is_out=True, event_type="caught_stealing_2b", credit=[2, 6])],
    )
    return {"game_id": game_id, "liveData": {"plays": {"allPlays": [pa0, pa1, pa2, pa3, pa4, pa5, pa6, pa7]}}}


def g2(game_id: str = "g2") -> dict:
    """Minor league: no pitchData, hitData or details.type anywhere."""
    doc = copy.deepcopy(g1(game_id))
    for pa in doc["liveData"]["plays"]["allPlays"]:
        for e in pa["playEvents"]:
            e.pop("pitchData", None)
            e.pop("hitData", None)
            e.get("details", {}).pop("type", None)
    return doc


def g3(game_id: str = "g3") -> dict:
    """Edges: empty playEvents, empty runners, no credit, substitution first."""
    pa0 = _pa(
        0, 1, "top", 11, 21, "Groundout", True,
        [_action(0, sub=True, player=999, position=2, event="Defensive Switch"),
         _pitch(1, 1, 0, 0, outs=1, play_id="x1")],
        [_runner(None, None, 11, 1, is_out=True)],
    )
    pa1 = _pa(1, 1, "top", 12, 21, "Runner Out", True, [], [])
    pa2 = {"about": {"atBatIndex": 2, "inning": 1, "halfInning": "bottom"},
           "matchup": {"batter": {"id": 31}, "pitcher": {"id": 41}},
           "result": {"event": "Pop Out", "isOut": True},
           "playEvents": [_pitch(0, 1, 0, 0, outs=1, play_id="y0")]}
    return {"game_id": game_id, "liveData": {"plays": {"allPlays": [pa0, pa1, pa2]}}}


def lineup_rows(game_id: str) -> list[tuple]:
    """(game_id, half_inning, position, player_id): home fields in the top half
    (player 100 + position, 100 at shortstop), away in the bottom (200 + p)."""
    rows = []
    for p in range(2, 11):
        rows.append((game_id, "top", p, 100 if p == 6 else 100 + p))
        rows.append((game_id, "bottom", p, 200 + p))
    return rows


def boxscore(game_id: str) -> dict:
    def team(base, six):
        players = {}
        for p in range(2, 11):
            pid = six if p == 6 else base + p
            players[f"ID{pid}"] = {"person": {"id": pid}, "allPositions": [{"code": str(p)}], "battingOrder": f"{p - 1}00"}
        players["ID1"] = {"person": {"id": base + 1}, "allPositions": [{"code": "1"}], "battingOrder": None}
        players["ID77"] = {"person": {"id": base + 77}, "allPositions": [{"code": "4"}], "battingOrder": "301"}
        return {"players": players}

    return {"game_id": game_id, "teams": {"home": team(100, 100), "away": team(200, 206)}}


def write_docs(docs: list[dict], folder: Path) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for d in docs:
        (folder / f"{d['game_id']}.json").write_text(json.dumps(d, indent=1))
    return str(folder)


def random_game(rng, game_id: str) -> tuple[dict, list[tuple]]:
    """A random but well-formed game document and lineup for property tests
    (``rng`` is a ``random.Random``): empty and NULL counts, pickoffs, actions,
    substitutions at odd positions, runner movements, missing tracking data."""
    pas = []
    for idx in range(rng.randint(0, 10)):
        inning, half = 1 + idx // 4, ("top", "bottom")[(idx // 2) % 2]
        events = []
        for j in range(rng.randint(0, 6)):
            kind = rng.choice(["pitch", "pitch", "pitch", "pickoff", "action"])
            if kind == "pitch":
                b = rng.choice([None, 0, 1, 2, 3])
                e = _pitch(j, j + 1, b, None if b is None else rng.randint(0, 2), outs=rng.randint(0, 2),
                           play_id=f"{game_id}-{idx}-{j}", dis=rng.choice([None, None, 1, 2]))
                if rng.random() < 0.3:
                    e.pop("pitchData")
            elif kind == "pickoff":
                e = _action(j, typ="pickoff", event_type=rng.choice(["pickoff_1b", "pickoff_attempt_2b", None]),
                            play_id=f"{game_id}-{idx}-{j}", count={"outs": rng.randint(0, 2), "balls": 1, "strikes": 0})
            else:
                e = _action(j, sub=rng.random() < 0.7, player=rng.randint(500, 520),
                            position=rng.choice(["2", "6", "9", "10", "D", "PH"]),
                            play_id=f"{game_id}-{idx}-{j}" if rng.random() < 0.3 else None)
            events.append(e)
        runners = []
        for _ in range(rng.randint(0, 3)):
            runners.append(_runner(
                rng.choice([None, "1B", "2B", "3B"]), rng.choice([None, "1B", "2B", "3B", "score"]),
                rng.randint(600, 620), rng.choice([None, *range(len(events))]) if events else None,
                is_out=rng.random() < 0.2,
                event_type=rng.choice([None, "single", "stolen_base_2b", "caught_stealing_3b", "field_out"]),
                credit=rng.choice([None, [], [rng.randint(1, 9)], [6, 3]]),
            ))
        pas.append(_pa(idx, inning, half, 100 + idx, 200 + idx % 3, rng.choice(["Single", "Strikeout", None]),
                       rng.choice([True, False, None]), events, runners))
    doc = {"game_id": game_id, "liveData": {"plays": {"allPlays": pas}}}
    lineup = [(game_id, h, p, 1000 + p + (50 if h == "bottom" else 0))
              for h in ("top", "bottom") for p in range(2, 11) if rng.random() < 0.8]
    return doc, lineup
