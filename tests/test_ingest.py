"""Ledger-driven ingestion from a landing folder of fixture files."""

import datetime as dt
import json

from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.operators.merge import read_stored
from pitchlake.plans import ingest as I
from pitchlake.plans import ledger as L

D = dt.date


def _land(root, source, part, name, text):
    d = root / source / part
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_text(text)


def _landing(tmp_path, dup_payload=False):
    root = tmp_path / "landing"
    _land(root, "schedule", "level=MLB/date=2024-04-01", "s.json",
          json.dumps({"game_id": "g1", "game_type": "R", "year": 2024, "venue_id": 1, "score_home": 3, "extra": "x"}))
    _land(root, "schedule", "level=AAA/date=2024-04-02", "s.json", json.dumps({"game_id": "g2", "game_type": "R"}))
    _land(root, "statsapi", "level=MLB/date=2024-04-01", "g1.json", json.dumps(G.g1()))
    _land(root, "statsapi", "level=AAA/date=2024-04-02", "g2.json", json.dumps(G.g2()))
    _land(root, "boxscore", "level=MLB/date=2024-04-01", "g1.json", json.dumps(G.boxscore("g1")))
    rows = [{"game_pk": 1, "at_bat_number": 1, "pitch_number": i, "game_year": 2024, "pitcher_id": 21,
             "pitch_type": "FF", "release_speed": 95.0 + i} for i in range(1, 5)]
    if dup_payload:
        rows.append(rows[0])
    _land(root, "statcast", "date=2024-04-01", "p.json", "\n".join(json.dumps(r) for r in rows))
    return root


def test_backfill_then_skip(spark, tmp_path):
    landing, wh = str(_landing(tmp_path)), str(tmp_path / "wh")
    s = I.run(spark, landing, wh, D(2024, 4, 1), D(2024, 4, 7), levels=["MLB", "AAA"])
    assert s["planned"] == 5 and s["succeeded"] == 5 and s["failed"] == 0
    sched = read_stored(spark, f"{wh}/schedule")
    assert {(r.game_id, r.level, r.year, r.date) for r in sched.collect()} == {
        ("g1", "MLB", 2024, D(2024, 4, 1)), ("g2", "AAA", 2024, D(2024, 4, 2))}
    ev = read_stored(spark, f"{wh}/statsapi_event")
    assert ev.count() == 16 and ev.filter("game_id = 'g1' and event_index = 0").collect()[0].fielder_6_id == 100
    assert read_stored(spark, f"{wh}/statsapi_pitch").count() == 30
    mv = read_stored(spark, f"{wh}/mv_statcast")
    assert mv.count() == 4 and len(mv.columns) == 113
    assert sorted(r.release_speed for r in mv.collect()) == [96.0, 97.0, 98.0, 99.0]
    # everything done: nothing planned again
    again = I.run(spark, landing, wh, D(2024, 4, 1), D(2024, 4, 7), levels=["MLB", "AAA"])
    assert again["planned"] == 0
    # daily run of the next day plans one unit per source and level
    assert len(I.plan(spark, wh, D(2024, 4, 8), D(2024, 4, 8), levels=["MLB", "AAA"])) == 5


def test_failure_reaches_ledger_and_retry(spark, tmp_path):
    root = _landing(tmp_path, dup_payload=True)
    wh = str(tmp_path / "wh")
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statcast", "schedule"], levels=["MLB"])
    assert s["failed"] == 1 and s["succeeded"] == 1
    led = L.read_ledger(spark, f"{wh}/scrape_log")
    failed = L.failed_runs(led).collect()
    assert len(failed) == 1 and failed[0].data_source == "statcast" and "duplicate" in failed[0].error_message
    # the failed unit is planned again; the successful one is not
    assert [u["data_source"] for u in I.plan(spark, wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statcast", "schedule"], levels=["MLB"])] == ["statcast"]
    # fix the landed file, retry the failed run
    root2 = _landing(tmp_path / "fixed")
    r = I.retry(spark, str(root2), wh, failed[0].run_id)
    assert r["succeeded"] == 1 and r["was_status"] == "failed"
    led = L.read_ledger(spark, f"{wh}/scrape_log")
    cur = L.latest_state(led).filter(F.col("retry_of") == failed[0].run_id).collect()
    assert len(cur) == 1 and cur[0].status == "success"
    assert read_stored(spark, f"{wh}/statcast").count() == 4


def test_players_and_season_summary(spark, tmp_path):
    root = tmp_path / "landing"
    players = [
        {"player_id": 21, "name_full": "Starter Twentyone", "birth_date": "1990-05-01", "weight": 210, "throw_hand": "L"},
        {"player_id": 41, "name_full": "Ace Fortyone", "birth_date": "1988-01-02", "weight": "195", "throw_hand": "R"},
    ]
    _land(root, "players", "year=2024/level=MLB", "p.json", "\n".join(json.dumps(p) for p in players))
    _land(root, "players", "year=2024/level=AAA", "p.json", json.dumps(players[0]))
    _land(root, "season_summary", "position=hitting/year=2024", "h.json",
          "\n".join(json.dumps({"level": "MLB", "player_id": i, "avg": 0.3}) for i in (1, 2)))
    _land(root, "season_summary", "position=pitching/year=2024", "p.json", json.dumps({"level": "MLB", "player_id": 41, "era": 3.1}))
    wh = str(tmp_path / "wh")
    r = I.load_players(spark, str(root), wh, 2024, ["MLB", "AAA"])
    assert r["status"] == "success" and r["rows"] == 2
    pl = {p.player_id: (p.name_full, p.birth_date, p.weight) for p in read_stored(spark, f"{wh}/player").collect()}
    assert pl == {21: ("Starter Twentyone", D(1990, 5, 1), 210), 41: ("Ace Fortyone", D(1988, 1, 2), 195)}
    runs = I.load_season_summary(spark, str(root), wh, 2024)
    assert [x["status"] for x in runs] == ["success", "success"]
    ss = read_stored(spark, f"{wh}/season_summary")
    assert ss.count() == 3 and json.loads(ss.filter("player_id = 41").collect()[0].data)["era"] == 3.1
    led = L.latest_state(L.read_ledger(spark, f"{wh}/scrape_log"))
    assert {(x.data_source, x.level) for x in led.collect()} == {
        ("players", "MLB,AAA"), ("season_summary", "hitting"), ("season_summary", "pitching")}
    # retry of the players run goes through the same loader
    pid = led.filter("data_source = 'players'").collect()[0].run_id
    again = I.retry(spark, str(root), wh, pid)
    assert again["status"] == "success" and again["was_status"] == "success"


def test_game_types_filter(spark, tmp_path):
    root = _landing(tmp_path)
    # g2 is a spring game ('S'); keep regular-season games only
    _land(root, "schedule", "level=AAA/date=2024-04-02", "s.json", json.dumps({"game_id": "g2", "game_type": "S"}))
    wh = str(tmp_path / "wh")
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["schedule", "statsapi"],
              levels=["MLB", "AAA"], game_types=["R"])
    assert s["failed"] == 0
    assert {r.game_id for r in read_stored(spark, f"{wh}/schedule").collect()} == {"g1"}
    assert {r.game_id for r in read_stored(spark, f"{wh}/statsapi_event").select("game_id").distinct().collect()} == {"g1"}


def test_malformed_document_fails_its_unit(spark, tmp_path):
    root = _landing(tmp_path)
    _land(root, "statsapi", "level=AAA/date=2024-04-02", "g9.json", '{"game_id": "g9", "liveData": {"plays": ')
    wh = str(tmp_path / "wh")
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statsapi"], levels=["MLB", "AAA"])
    # one job set: the bad file fails its own unit, MLB succeeds
    assert s["succeeded"] == 1 and s["failed"] == 1
    led = L.read_ledger(spark, f"{wh}/scrape_log")
    assert [(r.data_source, r.level) for r in L.failed_runs(led).collect()] == [("statsapi", "AAA")]
    assert L.latest_state(led).filter("status = 'split'").count() == 0  # no second attempt unit by unit
    bad = L.failed_runs(led).collect()[0]
    assert (bad.games_total, bad.games_success, bad.games_failed, bad.rows_written) == (2, 0, 1, 0) and "g9.json" in bad.error_message
    assert {r.game_id for r in read_stored(spark, f"{wh}/statsapi_event").select("game_id").distinct().collect()} == {"g1"}


def test_variant_payload_storage(spark, tmp_path):
    root = _landing(tmp_path)
    wh = str(tmp_path / "wh")
    units = I.plan(spark, wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statcast"], levels=["MLB"])
    assert I.load_statcast(spark, str(root), wh, units, payload="variant") == 4
    sc = read_stored(spark, f"{wh}/statcast")
    assert dict(sc.dtypes)["data"] == "variant"
    I.refresh_view(spark, wh)
    mv = read_stored(spark, f"{wh}/mv_statcast")
    assert sorted(r.release_speed for r in mv.collect()) == [96.0, 97.0, 98.0, 99.0]
    assert {r.pitch_type for r in mv.collect()} == {"FF"}
    from pitchlake.plans import diagnostics as Q
    t = Q.stored_tables(spark, wh)
    assert dict(t["statcast"].dtypes)["data"] == "variant"
    assert Q.rows_by_year(t["statcast"], "statcast_pitches").collect()[0].statcast_pitches == 4


def test_stored_tables_helper(spark, tmp_path):
    from pitchlake.plans import diagnostics as Q

    root = _landing(tmp_path)
    wh = str(tmp_path / "wh")
    I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), levels=["MLB"])
    t = Q.stored_tables(spark, wh)
    assert {"schedule", "event", "pitch", "play", "statcast", "player", "season_summary", "ledger", "view"} <= set(t)
    assert t["event"].count() == 8 and t["player"].count() == 0
    assert Q.orphaned_pitches(t["pitch"], t["event"]).collect()[0][0] == 0
    assert Q.pitcher_year_counts(t["view"], 21).collect()[0].pitches == 4


def test_units_account_for_their_own_rows(spark, tmp_path):
    root = _landing(tmp_path)
    for i, text in enumerate(("nonsense", '{"game_id": 12, "liveData": ', "{{", json.dumps(G.g1("778")))):
        _land(root, "statsapi", f"level=MLB/date=2024-04-{10 + i}", f"77{5 + i}.json", text)
    wh = str(tmp_path / "wh")
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 20), sources=["statsapi"], levels=["MLB", "AAA"], chunk_days=1, refresh=False)
    cur = {(r.level, r.date_start): r for r in L.latest_state(L.read_ledger(spark, f"{wh}/scrape_log")).collect()}
    assert len(cur) == 40 and s["failed"] == 3 and s["succeeded"] == 37
    first, second = cur["MLB", D(2024, 4, 1)], cur["AAA", D(2024, 4, 2)]
    stored = lambda g: sum(read_stored(spark, f"{wh}/{t}").where(F.col("game_id") == g).count() for t in ("statsapi_event", "statsapi_pitch", "statsapi_play"))
    assert first.rows_written == stored("g1") > 0 and second.rows_written == stored("g2") > 0
    assert (first.games_total, first.games_success, first.games_failed, first.error_message) == (1, 1, 0, None)
    assert second.error_message == "1 game(s) without a boxscore: no fielders"
    for day, ids in ((10, [775]), (11, [776]), (12, [777])):
        bad = cur["MLB", D(2024, 4, day)]
        assert (bad.status, bad.games_total, bad.games_success, bad.games_failed, bad.failed_game_ids, bad.rows_written) == ("failed", 1, 0, 1, ids, 0)
    assert cur["MLB", D(2024, 4, 13)].rows_written == stored("778") > 0
    quiet = cur["AAA", D(2024, 4, 9)]
    assert (quiet.status, quiet.rows_written) == ("success", 0)
    assert s["rows"] == sum(r.rows_written for r in cur.values())


def test_a_bad_boxscore_fails_its_unit(spark, tmp_path):
    root = _landing(tmp_path)
    _land(root, "boxscore", "level=MLB/date=2024-04-01", "g1.json", "{")
    wh = str(tmp_path / "wh")
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statsapi"], levels=["MLB", "AAA"])
    assert (s["succeeded"], s["failed"]) == (1, 1)
    assert {r.game_id for r in read_stored(spark, f"{wh}/statsapi_event").collect()} == {"g2"}


def test_retry_asks_for_what_the_run_asked_for(spark, tmp_path):
    root = _landing(tmp_path)
    wh = str(tmp_path / "wh")
    rows = [{"game_pk": 2, "at_bat_number": 1, "pitch_number": 1, "game_year": 2024, "game_type": "S"}]
    _land(root, "statcast", "date=2024-04-02", "p.json", "\n".join(map(json.dumps, 2 * rows)))
    s = I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statcast"], levels=["MLB"], payload="variant", game_types=["R", "S"])
    assert s["failed"] == 1
    failed = L.failed_runs(L.read_ledger(spark, f"{wh}/scrape_log")).collect()[0]
    root2 = _landing(tmp_path / "fixed")
    _land(root2, "statcast", "date=2024-04-02", "p.json", "\n".join(map(json.dumps, rows)))
    assert I.retry(spark, str(root2), wh, failed.run_id)["succeeded"] == 1
    got = read_stored(spark, f"{wh}/statcast")
    assert dict(got.dtypes)["data"] == "variant" and [r.game_pk for r in got.select("game_pk").collect()] == [2]


def test_a_player_load_renames_view_rows(spark, tmp_path):
    root = _landing(tmp_path)
    wh = str(tmp_path / "wh")
    I.run(spark, str(root), wh, D(2024, 4, 1), D(2024, 4, 7), sources=["statcast"], levels=["MLB"])
    names = lambda: {r.pitcher_name for r in read_stored(spark, f"{wh}/mv_statcast").collect()}
    assert names() == {None}
    for name in ("First Name", "Other Name"):
        _land(root, "players", "year=2024/level=MLB", "p.json", json.dumps({"player_id": 21, "name_full": name}))
        assert I.load_players(spark, str(root), wh, 2024, ["MLB"])["status"] == "success"
        assert names() == {name}


def test_reversed_window_plans_nothing(spark, tmp_path):
    units = [{"data_source": "schedule", "level": "MLB", "date_start": D(2024, 4, 2), "date_end": D(2024, 4, 1)}]
    assert I._pending_days(spark, units).isEmpty()
