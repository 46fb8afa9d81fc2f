"""The audit query set on stored tables built from the game fixtures.

Self-audit: built consistent, the integrity checks return 0; built broken (a game
missing from the schedule, pitchers missing from the player table, a payload load
that stopped early) they return the exact damage."""

import datetime as dt

import pytest
from fixtures.stored import build_stored
from pitchlake.plans import diagnostics as Q
from pitchlake.plans import ledger as L


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    return build_stored(spark, tmp_path_factory.mktemp("diag"))


def one(df):
    return tuple(df.collect()[0])


def test_integrity_checks(db):
    assert one(Q.orphaned_pitches(db["pitch"], db["event"])) == (0,)
    assert one(Q.events_missing_schedule(db["event"], db["schedule"])) == (3,)
    assert one(Q.pitches_missing_schedule(db["pitch"], db["schedule"])) == (2,)
    assert [r.pitcher_id for r in Q.pitchers_missing_from_player(db["event"], db["player"]).collect()] == [22, 42]


def test_lookup_and_activity(db):
    assert [r.player_id for r in Q.find_player(db["player"], "ACE").collect()] == [41]
    top = [tuple(r) for r in Q.most_active_pitchers(db["event"], db["schedule"], 2024, "MLB").collect()]
    assert top == [(41, 3), (21, 2), (22, 2), (42, 1)]


def test_counts_by_year(db):
    assert [tuple(r) for r in Q.games_by_year(db["schedule"], "MLB").collect()] == [(2024, 1)]
    assert [tuple(r) for r in Q.rows_by_year(db["event"], "events").collect()] == [(2024, 8 + 8 + 3)]


def test_pitcher_breakdown(db):
    rows = [tuple(r) for r in Q.pitcher_game_breakdown(db["schedule"], db["event"], db["pitch"], 41, 2024, "MLB").collect()]
    assert rows == [("g1", dt.date(2024, 4, 1), 3, 6)]
    yc = [tuple(r) for r in Q.pitcher_year_counts(db["view"], 21).collect()]
    assert yc == [(2024, 6, 1)]


def test_coverage_and_null_rates(db):
    cov = one(Q.statcast_coverage(db["pitch"], db["schedule"], db["statcast"]))
    assert cov == (2024, 15, 12, 80.0, True)
    nr = one(Q.view_null_rates(db["view"]))
    # 12 payload rows, all with velocity; pitcher 21 and 41 named, 22 not
    assert nr[0] == 2024 and nr[1] == 12 and nr[2] == 100.0


def test_arsenal_and_pitch_log(db):
    ars = Q.pitcher_arsenal(db["view"], 21, 2024).collect()
    assert ars[0].pitch_type == "FF" and ars[0].pitches == 6 and ars[0].usage_pct == 100.0
    log = Q.pitch_log(db["view"], "Starter Twentyone", 2024, "FF")
    assert log.count() == 6 and log.columns == ["game_date", "batter_name", "release_speed", "pfx_x", "pfx_z", "events"]


def test_metrics(db):
    ev = Q.exit_velocity_by_pitch_type(db["view"]).collect()
    assert ev[0].pitch_type == "FF" and ev[0].batted_balls > 0
    assert Q.xwoba_trend(db["view"]).collect()[0].avg_xwoba == 0.4
    so = {r.pitcher_id: r.strikeouts for r in Q.strikeout_rate(db["event"]).collect()}
    assert so[41] == 2  # g1 and g2 each have one strikeout by pitcher 41


def test_ledger_queries(spark, tmp_path):
    path = str(tmp_path / "ledger")
    r1 = L.open_run(spark, path, "statsapi", "MLB", dt.date(2024, 3, 4), dt.date(2024, 3, 10))
    L.close_run(spark, path, r1, "success")
    r2 = L.open_run(spark, path, "statsapi", "MLB", dt.date(2023, 3, 4), dt.date(2023, 3, 10))
    L.close_run(spark, path, r2, "failed", error_message="boom")
    led = spark.read.parquet(path)
    assert [r.run_id for r in Q.ledger_since(led, "2024-01-01").collect()] == [r1]
    assert [r.run_id for r in Q.failed_runs(led).collect()] == [r2]
    gaps = [r.week_start for r in Q.ledger_week_gaps(led, "statsapi", "MLB", "2024-03-01", "2024-03-31").collect()]
    assert dt.date(2024, 3, 4) not in gaps and dt.date(2024, 2, 26) in gaps
