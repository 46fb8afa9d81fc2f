"""Incremental daily load: a file stream with availableNow + foreachBatch upsert."""

import json

from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.operators.merge import read_stored
from pitchlake.schemas import LINEUP_DDL, SCHEDULE
from pitchlake.streaming.incremental import stream_games, stream_upsert


def test_stream_games_incremental(spark, tmp_path):
    land = tmp_path / "landing"
    tables = str(tmp_path / "tables")
    ckpt = str(tmp_path / "ckpt")
    lineup = spark.createDataFrame(G.lineup_rows("d1") + G.lineup_rows("d2"), LINEUP_DDL)
    sched = spark.createDataFrame([("d1", 2024), ("d2", 2024)], "game_id string, year int")

    G.write_docs([G.g1("d1")], land)
    c1 = stream_games(spark, str(land), tables, lineup=lineup, schedule=sched, checkpoint=ckpt)
    assert c1["event"]["n_inserted"] == 8 and c1["pitch"]["n_inserted"] > 0

    # next day: a new game lands; the first file is not read again
    G.write_docs([G.g3("d2")], land)
    c2 = stream_games(spark, str(land), tables, lineup=lineup, schedule=sched, checkpoint=ckpt)
    assert c2["event"]["n_inserted"] == 3 and c2["event"]["n_updated"] == 0

    ev = read_stored(spark, f"{tables}/statsapi_event")
    assert ev.count() == 11 and ev.filter(F.col("scraped_at").isNull()).count() == 0
    assert {r.year for r in ev.select("year").distinct().collect()} == {2024}

    # a late correction of game d1 arrives as a newer file: rows update by key
    doc = G.g1("d1")
    doc["liveData"]["plays"]["allPlays"][0]["result"]["event"] = "Double"
    (land / "d1-corrected.json").write_text(json.dumps(doc))
    c3 = stream_games(spark, str(land), tables, lineup=lineup, schedule=sched, checkpoint=ckpt)
    assert c3["event"]["n_updated"] == 8 and c3["event"]["n_inserted"] == 0
    ev = read_stored(spark, f"{tables}/statsapi_event")
    assert ev.count() == 11
    assert ev.filter("game_id = 'd1' and event_index = 0").collect()[0].event == "Double"


def test_stream_upsert_schedule(spark, tmp_path):
    land = tmp_path / "sched"
    land.mkdir()
    rows = [{"game_id": "a", "game_type": "R", "year": 2024, "date": "2024-04-01", "level": "MLB"}]
    (land / "1.json").write_text("\n".join(json.dumps(r) for r in rows))
    path = str(tmp_path / "schedule")
    src_schema = spark.createDataFrame([], "game_id STRING, game_type STRING, year INT, date DATE, level STRING").schema
    c = stream_upsert(spark, str(land), src_schema, path, SCHEDULE, checkpoint=str(tmp_path / "ck"))
    assert c["n_inserted"] == 1
    assert read_stored(spark, path).collect()[0].game_id == "a"
