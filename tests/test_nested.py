"""Golden tests for the play-by-play flattening (fixtures in fixtures/games.py)."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.operators import nested as N
from pitchlake.schemas import LINEUP_DDL, EVENT, PITCH, PLAY
from pitchlake.sources.landed import read_boxscore, read_game_feed


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("feeds")
    G.write_docs([G.g1(), G.g2(), G.g3()], d / "feed")
    G.write_docs([G.boxscore("g1")], d / "box")
    feed = read_game_feed(spark, str(d / "feed"))
    lineup = spark.createDataFrame(G.lineup_rows("g1") + G.lineup_rows("g2") + G.lineup_rows("g3"), LINEUP_DDL)
    sched = spark.createDataFrame([("g1", 2024), ("g2", 2024), ("g3", 2023)], "game_id string, year int")
    out = N.flatten_games(feed, lineup=lineup, schedule=sched)
    return {"feed": feed, "out": out, "lineup": lineup, "box": read_boxscore(spark, str(d / "box"))}


def _rows(df, *cols, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    return [tuple(r) for r in df.orderBy(*[c for c in ("game_id", "event_index", "play_index") if c in df.columns]).select(*cols).collect()]


def test_output_layouts(feeds):
    out = feeds["out"]
    assert out["event"].columns == [c for c in EVENT.columns if c != "scraped_at"]
    assert out["pitch"].columns == [c for c in PITCH.columns if c != "scraped_at"]
    assert out["play"].columns == [c for c in PLAY.columns if c != "scraped_at"]


def test_pre_count_golden(feeds):
    # FIXTURES worked example: pitches at pos 0,2,3,4 -> pre 0-0, 1-0, 1-1, 0-0
    got = _rows(feeds["out"]["pitch"], "play_index", "balls", "strikes", game_id="g1", event_index=0)
    assert got == [(0, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 0)]


def test_pickoff_not_a_pitch_but_a_predecessor(feeds):
    plays = feeds["out"]["play"]
    got = _rows(plays, "play_index", "type", "pre_balls", "pre_strikes", "is_pickoff", game_id="g1", event_index=0)
    assert got[1] == (1, "pickoff", 1, 0, True)
    assert all(r[4] is False for i, r in enumerate(got) if i != 1)


def test_disengagements_filled(spark, feeds):
    pa = N.plate_appearances(N.prepare_games(feeds["feed"]))
    plays = N.play_rows(pa).filter((F.col("game_id") == "g1") & (F.col("event_index") == 0)).orderBy("pos")
    got = [(r.post_disengagements, r.pre_disengagements) for r in plays.collect()]
    assert got == [(0, 0), (0, 0), (1, 0), (1, 1), (2, 1)]


def test_runs_and_first_fielder(spark, feeds):
    ev = feeds["out"]["event"]
    assert _rows(ev, "runs_on_event", game_id="g1", event_index=2) == [(2,)]
    pa = N.plate_appearances(N.prepare_games(feeds["feed"]))
    ff = N.event_rows(pa).filter(F.col("game_id") == "g1").orderBy("event_index").select("first_fielder").collect()
    assert [r[0] for r in ff] == [None, "6", None, None, None, "8", None, "2"]


def test_lineup_fill_golden(feeds):
    # top half events 0, 1, 5, 6: shortstop 100, 100, then 200 from event 5
    ev = feeds["out"]["event"].filter((F.col("game_id") == "g1") & (F.col("half_inning") == "top"))
    got = _rows(ev, "event_index", "fielder_6_id", "fielder_2_id")
    assert got == [(0, 100, 102), (1, 100, 102), (5, 200, 102), (6, 200, 102)]
    bottom = feeds["out"]["event"].filter((F.col("game_id") == "g1") & (F.col("half_inning") == "bottom"))
    assert {r.fielder_10_id for r in bottom.collect()} == {210}


def test_starter_wins_in_first_event(feeds):
    # g3: substitution at the half's first event, position 2 -> starter stays
    got = _rows(feeds["out"]["event"], "event_index", "fielder_2_id", game_id="g3", half_inning="top")
    assert got == [(0, 102), (1, 102)]


def test_minor_league_typed_nulls(feeds):
    p = feeds["out"]["pitch"].filter(F.col("game_id") == "g2")
    assert p.count() == feeds["out"]["pitch"].filter(F.col("game_id") == "g1").count()
    nn = p.agg(*[F.count(c).alias(c) for c in ("pitch_type", "ax", "spin_rate", "launch_speed")]).collect()[0]
    assert all(v == 0 for v in nn)
    assert dict(p.dtypes)["ax"] == "double"


def test_edges(feeds):
    ev = feeds["out"]["event"].filter(F.col("game_id") == "g3")
    assert ev.count() == 3
    assert _rows(ev, "event_index", "runs_on_event") == [(0, 0), (1, 0), (2, 0)]
    assert feeds["out"]["pitch"].filter(F.col("game_id") == "g3").count() == 2


def test_year_from_schedule(feeds):
    years = {(r.game_id, r.year) for r in feeds["out"]["event"].select("game_id", "year").distinct().collect()}
    assert years == {("g1", 2024), ("g2", 2024), ("g3", 2023)}


def test_base_out_state(feeds):
    play = feeds["out"]["play"]
    # PA0 single at play 4 -> runner 11 on first afterwards
    r = _rows(play, "play_index", "pre_runner_1b_id", "post_runner_1b_id", game_id="g1", event_index=0)
    assert r[-1] == (4, None, 11)
    # PA1: runner 11 to second on the out; batter out -> 1 out
    r = _rows(play, "play_index", "post_runner_1b_id", "post_runner_2b_id", "pre_outs", "post_outs", game_id="g1", event_index=1)
    assert r[-1] == (1, None, 11, 0, 1)
    # PA2: two runs score on the double
    assert _rows(play, "runs_on_play", game_id="g1", event_index=2) == [(2,)]
    # stolen base and caught stealing flags
    assert _rows(play, "play_index", "is_stolen_base", game_id="g1", event_index=4)[1] == (1, True)
    assert _rows(play, "is_caught_stealing", game_id="g1", event_index=7) == [(True,)]
    # a new half starts with empty bases
    assert _rows(play, "pre_runner_1b_id", "pre_outs", game_id="g1", event_index=5)[0] == (None, 0)


def test_starting_lineup_from_boxscore(feeds):
    sl = N.starting_lineup(feeds["box"])
    rows = {(r.half_inning, r.position, r.player_id) for r in sl.collect()}
    assert ("top", 6, 100) in rows and ("bottom", 6, 206) in rows
    assert len(rows) == 18  # pitcher and the substitute (order 301) are not starters


def test_many_games_isolated_and_order_safe(spark, tmp_path):
    """50 copies of G1 under different ids, landed in shuffled order and
    repartitioned: every copy flattens exactly like G1 (D7)."""
    ids = [f"m{i:02d}" for i in range(50)]
    docs = [G.g1(i) for i in ids]
    random.Random(7).shuffle(docs)
    d = G.write_docs(docs, tmp_path / "many")
    feed = read_game_feed(spark, d).repartition(7)
    lineup = spark.createDataFrame([r for i in ids for r in G.lineup_rows(i)], LINEUP_DDL)
    out = N.flatten_games(feed, lineup=lineup, num_partitions=5)
    single = N.flatten_games(
        read_game_feed(spark, G.write_docs([G.g1("m00")], tmp_path / "one")),
        lineup=spark.createDataFrame(G.lineup_rows("m00"), LINEUP_DDL),
    )
    for name in ("event", "pitch", "play"):
        a = out[name].drop("game_id").groupBy(*out[name].drop("game_id").columns).count()
        b = single[name].drop("game_id").withColumn("count", F.lit(50).cast("long"))
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str), name


def test_duplicate_documents_counted_once(spark, tmp_path):
    d1 = G.write_docs([G.g1("dup")], tmp_path / "a")
    d2 = G.write_docs([G.g1("dup")], tmp_path / "b")
    feed = read_game_feed(spark, d1).unionByName(read_game_feed(spark, d2))
    out = N.flatten_games(feed)
    assert out["event"].count() == 8
