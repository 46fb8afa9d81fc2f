"""Landed-file readers and sinks."""

import datetime as dt
import json

from pyspark.sql import functions as F

from fixtures import games as G
from conftest import SF001
from pitchlake.plans.ingest import read_statcast_landed
from pitchlake.sources.landed import csv_round_trip, read_game_feed, schedule_window
from pitchlake.session import scratch_path, table


def test_game_id_from_file_name(spark, tmp_path):
    doc = G.g1("ignored")
    doc.pop("game_id")
    (tmp_path / "745123.json").write_text(json.dumps(doc))
    feed = read_game_feed(spark, str(tmp_path))
    assert [r.game_id for r in feed.select("game_id").collect()] == ["745123"]


def test_schedule_window(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 4, 1), "MLB", "R"), ("b", dt.date(2024, 4, 9), "MLB", "R"), ("c", dt.date(2024, 4, 2), "AAA", "S")],
        "game_id string, date date, level string, game_type string",
    )
    got = schedule_window(df, "2024-04-01", "2024-04-07", level="MLB", game_types=["R", "F"])
    assert [r.game_id for r in got.collect()] == ["a"]


def test_csv_round_trip_infer(spark):
    sup = table(spark, SF001, "supplier")
    back = csv_round_trip(sup, scratch_path(spark, "csv-test"), infer=True)
    assert back.count() == sup.count()
    assert dict(back.dtypes)["s_acctbal"] == "double"
    assert sorted(map(tuple, back.select("s_name").collect())) == sorted(map(tuple, sup.select("s_name").collect()))


def test_statcast_csv_landing(spark, tmp_path):
    d = tmp_path / "statcast" / "date=2024-04-01"
    d.mkdir(parents=True)
    (d / "p.csv").write_text("game_id,at_bat_number,pitch_number,game_year,release_speed,pitch_type\n1,1,1,2024, 95.5,FF\n1,1,2,2024,,SL\n")
    df = read_statcast_landed(spark, str(tmp_path / "statcast"), fmt="csv").orderBy("pitch_number")
    rows = df.collect()
    assert [(r.game_pk, r.at_bat_number, r.pitch_number, r.year) for r in rows] == [(1, 1, 1, 2024), (1, 1, 2, 2024)]
    data = json.loads(rows[0].data)
    assert data["pitch_type"] == "FF" and data["release_speed"].strip() == "95.5"
    assert df.select(F.get_json_object("data", "$.release_speed").alias("r")).collect()[1].r is None


def test_statcast_json_keys_as_strings(spark, tmp_path):
    d = tmp_path / "statcast" / "date=2024-04-01"
    d.mkdir(parents=True)
    rows = [{"game_id": "745123", "at_bat_number": 1, "pitch_number": "2", "release_speed": 95.1},
            {"game_pk": 745124, "at_bat_number": " 3", "pitch_number": 1, "game_year": "2024"}]
    (d / "p.json").write_text("\n".join(json.dumps(r) for r in rows))
    got = sorted(tuple(r) for r in read_statcast_landed(spark, str(tmp_path / "statcast"))
                 .select("game_pk", "at_bat_number", "pitch_number", "year").collect())
    assert got == [(745123, 1, 2, 2024), (745124, 3, 1, 2024)]


def test_small_helpers(spark, tmp_path):
    from pitchlake.functions.columns import stamp_front
    from pitchlake.functions.payload import json_text
    from pitchlake.plans.ledger import join_levels, split_levels
    from pitchlake.sources.landed import read_landed

    df = spark.createDataFrame([('{"k": 7, "n": {"a": 1}}', "MLB,AAA")], "data STRING, levels STRING")
    r = df.select(json_text(F.col("data"), "k").alias("k"), json_text(F.col("data"), "missing").alias("m"),
                  split_levels(F.col("levels")).alias("lv")).collect()[0]
    assert (r.k, r.m, r.lv) == ("7", None, ["MLB", "AAA"])
    assert df.select(join_levels(split_levels(F.col("levels"))).alias("j")).collect()[0].j == "MLB,AAA"
    assert stamp_front(df, level="MLB").columns == ["level", "data", "levels"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "p.csv").write_text("player_id,name_full\n1,A B\n")
    got = read_landed(spark, str(tmp_path / "c"), fmt="csv").collect()[0]
    assert (got.player_id, got.name_full) == (1, "A B")
