"""Documents of games that landed once stay where they are; copies of a game meet."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.operators import nested as N
from pitchlake.plans import game_queries as Q
from pitchlake.schemas import LINEUP_DDL
from pitchlake.sources.landed import read_game_feed


def _exchanged(df) -> list[str]:
    """The lines of a plan's shuffles with what they move."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Repartition" in line or "Aggregate" in line or "Join" in line]


def test_documents_are_not_shuffled(spark, tmp_path):
    feed = read_game_feed(spark, G.write_docs([G.g1(), G.g2(), G.g3()], tmp_path))
    assert _exchanged(N.prepare_games(feed)) == []
    out = N.flatten_games(feed, lineup=spark.createDataFrame(G.lineup_rows("g1"), LINEUP_DDL))
    assert not any("liveData" in line for frame in out.values() for line in _exchanged(frame))
    assert not any("Join" in line for name in ("pitch", "play") for line in _exchanged(out[name]))


@pytest.mark.parametrize("broadcast", [0, 1, 100])
def test_copies_of_some_games_give_the_last_one(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(N, "_COPIED_GAMES", broadcast)
    short = G.g1("b")
    short["liveData"]["plays"]["allPlays"] = short["liveData"]["plays"]["allPlays"][:2]
    for folder, docs, at in (("1", [G.g1("a"), G.g1("b"), G.g1("c"), short], 1_000_000), ("2", [short], 3_000_000), ("3", [G.g1("c")], 2_000_000)):
        d = G.write_docs(docs[:3], tmp_path / folder)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (at, at))
    games = N.prepare_games(read_game_feed(spark, str(tmp_path / "*")))
    n = len(G.g1()["liveData"]["plays"]["allPlays"])
    rows = games.select("game_id", F.size("liveData.plays.allPlays").alias("n")).collect()
    assert sorted(map(tuple, rows)) == [("a", n), ("b", 2), ("c", n)]


def test_landed_documents_are_compressed(spark, tmp_path, monkeypatch):
    lines = [(o, o * 7 % 5 + 1, o * 3 + i, i, 5.0 * i, 10.0 * o, 0.1, 0.0, "RAN"[i % 3], "OF"[o % 2]) for o in range(1, 6) for i in range(1, 6)]
    cols = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, cols).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(o, o + 10, dt.datetime(1995, 1, o)) for o in range(1, 6)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    landed = []
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: landed.append(str(tmp_path / name)) or landed[-1])
    plays = Q.q_game_plays(spark, str(tmp_path))
    assert plays.count() == 25
    for folder in landed:
        parts = [f for f in os.listdir(folder) if f.startswith("part-")]
        assert parts and all(f.endswith(".json.gz") for f in parts)


@pytest.mark.parametrize("frame", ["event", "play", "pitch"])
def test_a_frame_read_by_its_own_fields_equals_the_whole_read(spark, tmp_path, frame):
    d = G.write_docs([G.g1(), G.g2(), G.g3()], tmp_path)
    lineup = spark.createDataFrame([*G.lineup_rows("g1"), *G.lineup_rows("g3")], LINEUP_DDL)
    whole = N.flatten_games(read_game_feed(spark, d), lineup=lineup)
    own = read_game_feed(spark, d, frame=frame)
    out = N.flatten_games(own, lineup=lineup, prepared=True, frames=[frame])
    assert list(out) == [frame] and out[frame].schema == whole[frame].schema
    rows = sorted(out[frame].collect(), key=repr)
    assert rows and rows == sorted(whole[frame].collect(), key=repr)
    assert ("pitchData" in own.schema.simpleString()) == (frame == "pitch")


def test_fielders_are_carried_in_one_window_of_a_row_for_each_event(spark, tmp_path):
    feed = read_game_feed(spark, G.write_docs([G.g1()], tmp_path))
    event = N.flatten_games(feed, lineup=spark.createDataFrame(G.lineup_rows("g1"), LINEUP_DDL))["event"]
    plan = event._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Generate ") == 1  # of plate appearances


def test_a_listed_position_without_a_starter_takes_its_substitute(spark, tmp_path):
    doc = G.g1()
    plays = doc["liveData"]["plays"]["allPlays"]
    subs = [(p["about"]["atBatIndex"], p["about"]["halfInning"], int(e["position"]["code"]), e["player"]["id"])
            for p in plays for e in p.get("playEvents") or [] if e.get("isSubstitution")]
    at, half, position, player = next(s for s in subs if 2 <= s[2] <= 10)
    fielders, other = {}, 9 if position < 9 else 2
    for name, lineup in (("listed", [("g1", half, position, None)]), ("other", [("g1", half, other, 5)])):
        event = N.flatten_games(read_game_feed(spark, G.write_docs([doc], tmp_path / name)), lineup=spark.createDataFrame(lineup, LINEUP_DDL))["event"]
        fielders[name] = event.where(F.col("event_index") == at).first()[f"fielder_{position}_id"]
    assert fielders == {"listed": player, "other": None}


def test_game_queries_read_their_own_fields(spark, tmp_path, monkeypatch):
    lines = [(o, o * 7 % 5 + 1, o * 3 + i, i, 5.0 * i, 10.0 * o, 0.1, 0.0, "RAN"[i % 3], "OF"[o % 2]) for o in range(1, 6) for i in range(1, 6)]
    cols = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, cols).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(o, o + 10, dt.datetime(1995, 1, o)) for o in range(1, 6)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    for query in (Q.q_game_events, Q.q_half_runs):
        out = query(spark, str(tmp_path))
        scans = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan json" in line and "liveData" in line]
        assert scans and not any("pitchData" in line for line in scans)
    assert out.count() == 10
