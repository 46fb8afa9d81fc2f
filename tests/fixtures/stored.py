"""Stored sports tables built from the fixture games, for audit-query tests."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import games as G
from pitchlake.functions.payload import pack_json
from pitchlake.operators.nested import flatten_games
from pitchlake.operators.views import statcast_view
from pitchlake.schemas import LINEUP_DDL, PLAYER, SCHEDULE
from pitchlake.sources.landed import read_game_feed


def build_stored(spark, d):
    """Stored tables built from the fixture games: schedule (g3 missing),
    event, pitch, player (pitchers 22 and 42 missing), statcast payload for 12
    of g1's 15 pitches, and the unpacked view."""
    feed = read_game_feed(spark, G.write_docs([G.g1(), G.g2(), G.g3()], d / "feed"))
    lineup = spark.createDataFrame(G.lineup_rows("g1") + G.lineup_rows("g2"), LINEUP_DDL)
    sched_rows = [
        ("g1", "R", 2024, dt.date(2024, 4, 1), "MLB", 1, 10, 11, "Away", "Home", 2, 3, None),
        ("g2", "R", 2024, dt.date(2024, 4, 2), "AAA", 2, 12, 13, "A2", "H2", 1, 0, None),
    ]
    schedule = spark.createDataFrame(sched_rows, SCHEDULE.ddl)
    years = spark.createDataFrame([("g1", 2024), ("g2", 2024), ("g3", 2024)], "game_id string, year int")
    out = flatten_games(feed, lineup=lineup, schedule=years)
    event, pitch = out["event"], out["pitch"]
    player = spark.createDataFrame(
        [(21, "Starter Twentyone", "Twentyone", "Starter", None, None, None, "L", None, None, "P", None),
         (41, "Ace Fortyone", "Fortyone", "Ace", None, None, None, "R", None, None, "P", None)],
        PLAYER.ddl,
    )
    # payload rows for g1's pitches, except the last three (a load that stopped early)
    p = pitch.filter(F.col("game_id") == "g1").join(event.select("game_id", "event_index", "pitcher_id"), ["game_id", "event_index"])
    p = p.withColumn("rn", F.row_number().over(Window.orderBy("event_index", "play_index")))
    p = p.filter(F.col("rn") <= 12)
    payload = p.select(
        F.lit(1).alias("game_pk"),
        (F.col("event_index") + 1).alias("at_bat_number"),
        F.col("rn").cast("int").alias("pitch_number"),
        F.lit(2024).alias("year"),
        "pitcher_id",
        "pitch_type",
        F.when(F.col("pitch_type") == "FF", "4-Seam Fastball").alias("pitch_name"),
        (F.col("vy0") * -0.68 + F.col("rn")).alias("release_speed"),
        F.col("spin_rate").alias("release_spin_rate"),
        F.lit(-0.5).alias("pfx_x"),
        F.lit(1.25).alias("pfx_z"),
        F.lit("2024-04-01").alias("game_date"),
        F.lit("Some Batter").alias("batter_name"),
        "launch_speed",
        F.when(F.col("launch_speed").isNotNull(), F.lit(0.4)).alias("expected_woba"),
        F.col("description").alias("events"),
    )
    statcast = pack_json(payload, ["game_pk", "at_bat_number", "pitch_number"], ["year"]).withColumn(
        "scraped_at", F.lit(None).cast("timestamp")
    )
    view = statcast_view(statcast, player)
    return dict(schedule=schedule, event=event, pitch=pitch, player=player, statcast=statcast, view=view)
