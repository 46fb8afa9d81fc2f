"""Stored tables keep one row per key, and landed games keep their identity."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.operators.merge import NullKeyError, read_stored, upsert_table
from pitchlake.functions.columns import MissingColumnsError
from pitchlake.operators.nested import prepare_games
from pitchlake.sources.landed import csv_round_trip, read_game_feed
from pitchlake.streaming.incremental import stream_games

SCHEMA = "k string, v int, year int, month int"


def put(spark, path, rows, parts=("year", "month"), **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return upsert_table(spark, path, df, ["k"], df.schema, parts, stamp_col=None, **kw)


def rows_of(spark, path):
    return sorted(tuple(r) for r in read_stored(spark, path).select("k", "v", "year", "month").collect())


def test_a_key_moves_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, 2024, 1), ("b", 1, 2024, 2), ("c", 1, 2023, 2)])
    assert put(spark, path, [("a", 2, 2025, 1)]) == {"n_inserted": 0, "n_updated": 1, "n_affected": 1}
    assert rows_of(spark, path) == [("a", 2, 2025, 1), ("b", 1, 2024, 2), ("c", 1, 2023, 2)]
    put(spark, path, [("c", 3, 2024, 2)])
    assert rows_of(spark, path) == [("a", 2, 2025, 1), ("b", 1, 2024, 2), ("c", 3, 2024, 2)]
    assert not os.path.exists(f"{path}/year=2024/month=1")


def test_null_keys_and_missing_partition_columns_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 1, 2024, 1)])
    for rows, kw in (([(None, 1, 2024, 1)], {}), ([("b", None, 2024, 1)], {"required": ["v"]})):
        with pytest.raises(NullKeyError):
            put(spark, path, rows, **kw)
    with pytest.raises(MissingColumnsError):
        upsert_table(spark, path, spark.createDataFrame([("b", 1)], "k string, v int"), ["k"], spark.createDataFrame([], SCHEMA).schema, ["year"])
    assert rows_of(spark, path) == [("a", 1, 2024, 1)]


def write(folder, name, doc, at):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(doc))
    os.utime(folder / name, (at, at))


def test_games_without_an_id_take_the_file_name_and_the_newest_copy_wins(spark, tmp_path):
    for i in (1, 2, 3):
        doc = G.g1()
        doc.pop("game_id")
        write(tmp_path / "day=1", f"7{i}.json", doc, 1_000_000 + i)
    late = G.g1()
    late.pop("game_id")
    late["liveData"]["plays"]["allPlays"] = late["liveData"]["plays"]["allPlays"][:2]
    write(tmp_path / "day=2", "72.json", late, 2_000_000)
    write(tmp_path / "day=3", "72.json", G.g1("72"), 1_500_000)
    games = prepare_games(read_game_feed(spark, str(tmp_path)))
    plays = games.select("game_id", F.size("liveData.plays.allPlays").alias("n")).collect()
    n = len(G.g1()["liveData"]["plays"]["allPlays"])
    assert sorted(map(tuple, plays)) == [("71", n), ("72", 2), ("73", n)]


def test_stream_reads_a_file_once_and_names_games_by_file(spark, tmp_path):
    land, tables = tmp_path / "land", str(tmp_path / "tables")
    for i in (1, 2):
        doc = G.g1()
        doc.pop("game_id")
        write(land, f"8{i}.json", doc, 1_000_000)
    years = spark.createDataFrame([("81", 2023), ("82", 2024)], "game_id string, year int")
    first = stream_games(spark, str(land), tables, schedule=years)
    assert first["event"]["n_inserted"] == 16
    again = stream_games(spark, str(land), tables, schedule=years)
    assert again["event"]["n_affected"] == 0
    assert sorted(r.year for r in read_stored(spark, f"{tables}/statsapi_event").select("year").distinct().collect()) == [2023, 2024]


def test_csv_keeps_texts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(-1, ' a "quoted", text \n\n\\" and \\ ', None, "", 3), (-2, None, "", " x ", None)], docs.schema)
    both = docs.union(odd)
    out = csv_round_trip(both, str(tmp_path / "csv"))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, both.collect()))
