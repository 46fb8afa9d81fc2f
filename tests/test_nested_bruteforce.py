"""Brute-force oracle for the flattening: the same semantics written as plain
Python loops over the fixture documents, compared with every row and column of
the Spark outputs, base-out state (our own rule) included."""

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import games as G
from pitchlake.operators.nested import flatten_games
from pitchlake.schemas import LINEUP_DDL
from pitchlake.sources.landed import read_game_feed

POSITIONS = range(2, 11)


def _get(d, *path):
    for k in path:
        if d is None:
            return None
        d = d.get(k)
    return d


def brute(doc, lineup_rows):
    gid = doc["game_id"]
    pas = doc["liveData"]["plays"]["allPlays"]
    events, pitches, plays = [], [], []
    for pa in pas:
        idx = pa["about"]["atBatIndex"]
        runners = pa.get("runners") or []
        events.append({
            "game_id": gid, "event_index": idx, "inning": pa["about"]["inning"], "half_inning": pa["about"]["halfInning"],
            "batter_id": _get(pa, "matchup", "batter", "id"), "bat_side": _get(pa, "matchup", "batSide", "code"),
            "pitcher_id": _get(pa, "matchup", "pitcher", "id"), "pitch_hand": _get(pa, "matchup", "pitchHand", "code"),
            "event": _get(pa, "result", "event"), "is_out": _get(pa, "result", "isOut"),
            "runs_on_event": sum(1 for r in runners if (_get(r, "movement", "end") or "") == "score"),
        })
        last_dis, prev = None, None
        for e in pa.get("playEvents") or []:
            dis = _get(e, "details", "disengagementNum")
            pre_dis = (prev or {}).get("post_dis", 0)
            last_dis = dis if dis is not None else last_dis
            row = {
                "play_id": e.get("playId"), "game_id": gid, "event_index": idx, "play_index": e.get("index"),
                "pitch_number": e.get("pitchNumber"), "type": e.get("type"),
                "post_balls": _get(e, "count", "balls"), "post_strikes": _get(e, "count", "strikes"),
                "pre_balls": (prev or {}).get("post_balls") or 0, "pre_strikes": (prev or {}).get("post_strikes") or 0,
                "post_dis": last_dis if last_dis is not None else 0, "pre_dis": pre_dis,
                "outs": _get(e, "count", "outs"), "description": _get(e, "details", "description"),
                "pitch_type": _get(e, "details", "type", "code"), "ax": _get(e, "pitchData", "coordinates", "aX"),
                "spin_rate": _get(e, "pitchData", "breaks", "spinRate"), "launch_speed": _get(e, "hitData", "launchSpeed"),
            }
            prev = row
            if row["play_id"] is not None:
                plays.append(row)
            if row["type"] == "pitch":
                pitches.append(row)

    # fielders: starter at the half's first event, else the first substitution at
    # (event, position); carried forward per (half, position) in event order
    by_half = {}
    for ev in events:
        by_half.setdefault(ev["half_inning"], []).append(ev)
    starters = {(h, p): pid for (_, h, p, pid) in lineup_rows}
    for half, evs in by_half.items():
        first = min(e["event_index"] for e in evs)
        for p in POSITIONS:
            carried = None
            for ev in sorted(evs, key=lambda e: e["event_index"]):
                val = None
                if (half, p) in starters:
                    pa = next(x for x in pas if x["about"]["atBatIndex"] == ev["event_index"])
                    subs = sorted(
                        (e["index"], _get(e, "player", "id")) for e in pa.get("playEvents") or []
                        if e.get("isSubstitution") and str(_get(e, "position", "code")) == str(p)
                    )
                    before = starters[(half, p)] if ev["event_index"] == first else None
                    val = before if before is not None else (subs[0][1] if subs else None)
                    carried = val if val is not None else carried
                ev[f"fielder_{p}_id"] = carried if (half, p) in starters else None
    return events, pitches, plays


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    docs = [G.g1(), G.g2(), G.g3()]
    lineups = {d["game_id"]: G.lineup_rows(d["game_id"]) for d in docs}
    lineups["g3"] = [r for r in lineups["g3"] if r[1] == "top"]  # g3: no bottom-half lineup
    d = tmp_path_factory.mktemp("brute")
    feed = read_game_feed(spark, G.write_docs(docs, d))
    lu = spark.createDataFrame([r for rows in lineups.values() for r in rows], LINEUP_DDL)
    out = flatten_games(feed, lineup=lu)
    expected = [brute(doc, lineups[doc["game_id"]]) for doc in docs]
    return out, expected


def _cmp(df, rows, cols):
    got = sorted(tuple(r) for r in df.select(*cols).collect())
    want = sorted(tuple(r[c] for c in cols) for r in rows)
    assert got == want


def test_events_match_bruteforce(both):
    out, expected = both
    rows = [e for ev, _, _ in expected for e in ev]
    cols = ["game_id", "event_index", "inning", "half_inning", "batter_id", "bat_side", "pitcher_id", "pitch_hand",
            "event", "is_out", "runs_on_event", *[f"fielder_{p}_id" for p in POSITIONS]]
    _cmp(out["event"], rows, cols)


def test_pitches_match_bruteforce(both):
    out, expected = both
    rows = [dict(r, balls=r["pre_balls"], strikes=r["pre_strikes"]) for _, pt, _ in expected for r in pt]
    cols = ["play_id", "game_id", "event_index", "play_index", "pitch_number", "outs", "balls", "strikes",
            "description", "pitch_type", "ax", "spin_rate", "launch_speed"]
    _cmp(out["pitch"], rows, cols)


def test_plays_match_bruteforce(both):
    out, expected = both
    rows = [r for _, _, pl in expected for r in pl]
    cols = ["play_id", "game_id", "event_index", "play_index", "pitch_number", "pre_balls", "pre_strikes",
            "post_balls", "post_strikes", "type"]
    _cmp(out["play"], rows, cols)


EMPTIED = object()


def brute_base_out(doc):
    """Our base-out rule as plain loops: per (inning, half), all play events in
    (event, position) order; runner movements belong to the event whose index
    they name and are applied one after the other; a runner stands where his last one
    ends (not out); each half starts empty with no outs, and three outs empty the bases.
    Rows are the events with a play id; steals, pickoffs and runs on events without one
    show on the next that has, or else on the last that had."""
    gid = doc["game_id"]
    rows = []
    for pa in doc["liveData"]["plays"]["allPlays"]:
        for pos, e in enumerate(pa.get("playEvents") or []):
            rows.append((pa, pos, e))
    halves = {}
    for pa, pos, e in rows:
        key = (pa["about"]["inning"], pa["about"]["halfInning"])
        halves.setdefault(key, []).append((pa["about"]["atBatIndex"], pos, pa, e))
    out = []
    for plays in halves.values():
        carried = {"1b": None, "2b": None, "3b": None}
        outs = None
        prev = None
        pending, runs, mine = set(), 0, []
        for idx, _pos, pa, e in sorted(plays, key=lambda t: (t[0], t[1])):
            moves = [r for r in pa.get("runners") or [] if _get(r, "details", "playIndex") == e.get("index")]
            shorts = {"1B": "1b", "2B": "2b", "3B": "3b"}
            stands = {}  # base -> first of the runners who stop there
            for k, r in enumerate(moves):
                rid, end = _get(r, "details", "runner", "id"), _get(r, "movement", "end")
                safe = not (_get(r, "movement", "isOut") or False)
                for code in (_get(r, "movement", "start"), end if safe else None):
                    if code in shorts:
                        carried[shorts[code]] = EMPTIED
                last = rid is None or all(_get(x, "details", "runner", "id") != rid for x in moves[k + 1 :])
                if end in shorts and last and safe:
                    stands.setdefault(end, rid)
            for code, rid in stands.items():
                carried[shorts[code]] = rid if rid is not None else EMPTIED
            if _get(e, "count", "outs") is not None:
                outs = _get(e, "count", "outs")
            post = {s: (None if v is EMPTIED or (outs or 0) >= 3 else v) for s, v in carried.items()}
            etypes = [(_get(r, "details", "eventType") or "") for r in moves]
            row = {
                "game_id": gid, "event_index": idx, "play_index": e.get("index"),
                "runs_on_play": sum(1 for r in moves if _get(r, "movement", "end") == "score"),
                "is_stolen_base": any(t.startswith("stolen_base") for t in etypes),
                "is_caught_stealing": any(t.startswith("caught_stealing") for t in etypes),
                "is_pickoff": e.get("type") == "pickoff" or (_get(e, "details", "eventType") or "").startswith("pickoff"),
                "post_outs": outs if outs is not None else 0,
                "pre_outs": prev["post_outs"] if prev else 0,
            }
            for s in ("1b", "2b", "3b"):
                row[f"post_runner_{s}_id"] = post[s]
                row[f"pre_runner_{s}_id"] = prev[f"post_runner_{s}_id"] if prev else None
            prev = row
            flags = {k for k in ("is_stolen_base", "is_caught_stealing", "is_pickoff") if row[k]}
            runs += row["runs_on_play"]
            if e.get("playId") is None:
                pending |= flags
            else:
                mine.append({**row, "runs_on_play": runs, **{k: True for k in pending}})
                pending, runs = set(), 0
        if mine:
            mine[-1].update({k: True for k in pending})
            mine[-1]["runs_on_play"] += runs
        out += mine
    return out


def test_two_bases_on_one_play_runs_without_id_and_the_third_out(spark, tmp_path):
    doc = G.g1("fold")
    pas = doc["liveData"]["plays"]["allPlays"]
    half = [p for p in pas if (p["about"]["inning"], p["about"]["halfInning"]) == (pas[0]["about"]["inning"], pas[0]["about"]["halfInning"])]
    move = lambda at, who, start, end, out=False: {"details": {"playIndex": at, "runner": {"id": who}}, "movement": {"start": start, "end": end, "isOut": out}}
    first, last = half[0], half[-1]
    first["playEvents"] = [{"index": 80, "type": "action"}, *first["playEvents"]]
    first["runners"] = [*(first.get("runners") or []), move(80, 1, None, "1B"), move(80, 1, "1B", "2B"), move(80, 2, None, "score")]
    last["playEvents"] = [*last["playEvents"], {"index": 95, "type": "action", "count": {"outs": 3}}]
    last["runners"] = [*(last.get("runners") or []), move(95, 9, None, "3B"), move(95, 8, "3B", "score")]
    out = flatten_games(read_game_feed(spark, G.write_docs([doc], tmp_path)))
    cols = ["game_id", "event_index", "play_index", "runs_on_play", "pre_runner_1b_id", "pre_runner_2b_id", "post_runner_3b_id", "post_outs"]
    want = brute_base_out(doc)
    _cmp(out["play"].fillna(-1), [{k: -1 if v is None else v for k, v in r.items()} for r in want], cols)
    rows = out["play"].where(F.col("event_index") == first["about"]["atBatIndex"]).orderBy("play_index").collect()
    assert rows[0].pre_runner_1b_id is None and rows[0].pre_runner_2b_id == 1 and rows[0].runs_on_play >= 1
    halves = out["event"].groupBy("inning", "half_inning").agg(F.sum("runs_on_event").alias("n")).agg(F.sum("n")).first()[0]
    assert out["play"].agg(F.sum("runs_on_play")).first()[0] == halves


def test_steal_on_an_event_without_play_id(spark, tmp_path):
    doc = G.g1("steal")
    pa = doc["liveData"]["plays"]["allPlays"][1]
    runner = {"details": {"playIndex": 90, "eventType": "stolen_base_2b", "runner": {"id": 777}}, "movement": {"start": "1B", "end": "2B", "isOut": False}}
    pa["runners"] = [*(pa.get("runners") or []), runner]
    pa["playEvents"] = [{"index": 90, "type": "action", "details": {"eventType": "stolen_base_2b"}}, *pa["playEvents"]]
    out = flatten_games(read_game_feed(spark, G.write_docs([doc], tmp_path)))["play"]
    rows = [r for r in out.where(F.col("event_index") == pa["about"]["atBatIndex"]).orderBy("play_index").collect()]
    assert all(r.play_id for r in rows) and rows[0].pre_runner_2b_id == 777 and rows[0].is_stolen_base
    cols = ["game_id", "event_index", "play_index", "is_stolen_base", "pre_runner_1b_id", "pre_runner_2b_id", "post_runner_2b_id"]
    _cmp(out.fillna(-1), [{k: -1 if v is None else v for k, v in r.items()} for r in brute_base_out(doc)], cols)


def test_base_out_matches_bruteforce(spark, tmp_path):
    docs = [G.g1(), G.g2(), G.g3()]
    feed = read_game_feed(spark, G.write_docs(docs, tmp_path / "bo"))
    play = flatten_games(feed)["play"]
    cols = ["game_id", "event_index", "play_index", "runs_on_play", "is_stolen_base", "is_caught_stealing",
            "is_pickoff", "pre_outs", "post_outs", *[f"{w}_runner_{s}_id" for w in ("pre", "post") for s in ("1b", "2b", "3b")]]
    _cmp(play, [r for d in docs for r in brute_base_out(d)], cols)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_random_games_match_bruteforce(spark, tmp_path_factory, seed):
    import random

    rng = random.Random(seed)
    games = [G.random_game(rng, f"r{seed}-{i}") for i in range(6)]
    docs = [d for d, _ in games]
    d = tmp_path_factory.mktemp("rand")
    feed = read_game_feed(spark, G.write_docs(docs, d))
    lu = spark.createDataFrame([r for _, rows in games for r in rows], LINEUP_DDL)
    out = flatten_games(feed, lineup=lu)
    expected = [brute(doc, rows) for doc, rows in games]
    ev_cols = ["game_id", "event_index", "inning", "half_inning", "batter_id", "pitcher_id", "event", "is_out",
               "runs_on_event", *[f"fielder_{p}_id" for p in POSITIONS]]
    _cmp(out["event"], [e for ev, _, _ in expected for e in ev], ev_cols)
    pitch_rows = [dict(r, balls=r["pre_balls"], strikes=r["pre_strikes"]) for _, pt, _ in expected for r in pt]
    _cmp(out["pitch"], pitch_rows, ["play_id", "game_id", "event_index", "play_index", "outs", "balls", "strikes", "ax"])
    bo_cols = ["game_id", "event_index", "play_index", "runs_on_play", "is_stolen_base", "is_caught_stealing",
               "is_pickoff", "pre_outs", "post_outs", *[f"{w}_runner_{s}_id" for w in ("pre", "post") for s in ("1b", "2b", "3b")]]
    _cmp(out["play"], [r for doc in docs for r in brute_base_out(doc)], bo_cols)
