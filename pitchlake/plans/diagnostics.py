"""The audit query set on the stored sports tables, parameterised.

Each function composes the generic operators in ``operators/audit.py`` with the
stored column names (``schemas.py``). Arguments replace the hand-edited
constants of the original script (pitcher id, year, level, name fragment).

Tables: ``schedule``, ``event`` (statsapi_event), ``pitch`` (statsapi_pitch),
``statcast`` (payload), ``player``, ``ledger`` (scrape_log), ``view`` (the
unpacked payload view, see ``operators/views.statcast_view``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators import audit as A
from pitchlake.operators.merge import read_stored
from pitchlake.plans import ledger as L
from pitchlake.schemas import COVERAGE_ALARM_PCT
from pitchlake.session import path_missing


def stored_tables(spark: SparkSession, warehouse: str, view: str = "mv_statcast") -> dict[str, DataFrame]:
    """The stored tables of a warehouse by short name (``schedule``, ``event``,
    ``pitch``, ``play``, ``statcast``, ``player``, ``season_summary``,
    ``ledger``), read with their registry schemas (a table never written reads
    as empty), plus the materialised ``view`` when it exists."""
    from pitchlake.schemas import TABLES
    from pitchlake.sources.landed import read_table

    short = {"statsapi_event": "event", "statsapi_pitch": "pitch", "statsapi_play": "play", "scrape_log": "ledger"}
    out = {short.get(name, name): read_table(spark, warehouse, name, missing_ok=True) for name in TABLES if name != "statcast"}
    out["statcast"] = spark.createDataFrame([], TABLES["statcast"].schema)
    # The payload table may hold JSON text or VARIANT: read it with its own schema.
    for name, path in (("statcast", "statcast"), ("view", view)):
        try:
            out[name] = read_stored(spark, f"{warehouse.rstrip('/')}/{path}")
        except AnalysisException as e:
            if not path_missing(e):
                raise
    return out


def _eq(col: str, value) -> Column:
    return F.lit(True) if value is None else (F.col(col) == value)


# --- lookups -----------------------------------------------------------

def find_player(player: DataFrame, fragment: str) -> DataFrame:
    """Players whose full name contains ``fragment`` (case-insensitive)."""
    return A.name_lookup(player, "name_full", fragment, ["player_id", "name_full", "primary_position", "throw_hand"])


def most_active_pitchers(event: DataFrame, schedule: DataFrame, year: int | None = None, level: str | None = "MLB", n: int = 30) -> DataFrame:
    """Pitchers by plate appearances faced in games of ``year`` / ``level``, top ``n``."""
    s = schedule.filter(_eq("year", year) & _eq("level", level)).select(F.col("game_id").alias("_gid"))
    j = event.select("game_id", "pitcher_id").join(s, F.col("game_id") == F.col("_gid"))
    return A.top_k_counts(j, "pitcher_id", n, "plate_appearances")


# --- the ledger ------------------------------------------------------------

def ledger_since(ledger: DataFrame, since: dt.date | str, until: dt.date | str | None = None) -> DataFrame:
    """Current state of runs whose window touches ``[since, until]``."""
    cur = L.latest_state(ledger)
    s = F.lit(str(since)).cast("date")
    cond = (F.col("date_start") >= s) | (F.col("date_end") >= s)
    if until is not None:
        cond = cond & (F.col("date_start") <= F.lit(str(until)).cast("date"))
    cols = ["run_id", "data_source", "level", "date_start", "date_end", "status", "games_total",
            "games_success", "games_failed", "rows_written", "error_message", "started_at"]
    return cur.filter(cond).select(*cols).orderBy("data_source", "date_start")


def failed_runs(ledger: DataFrame) -> DataFrame:
    """Runs whose current state is failed, newest first (retry candidates)."""
    return L.failed_runs(ledger).select("run_id", "data_source", "level", "date_start", "date_end", "error_message", "started_at")


def ledger_week_gaps(
    ledger: DataFrame,
    data_source: str,
    level: str,
    start: dt.date | str,
    end: dt.date | str,
    aligned: bool = True,
) -> DataFrame:
    """Weeks of ``[start, end]`` without a successful run of source/level."""
    ok = L.latest_state(ledger).filter(
        (F.col("data_source") == data_source)
        & (F.col("level") == level)
        & (F.col("status") == "success")
        & (F.col("date_start") >= F.lit(str(start)).cast("date"))
        & (F.col("date_end") <= F.date_add(F.lit(str(end)).cast("date"), 1))
    )
    return L.week_gaps(ok, "date_start", start, end, aligned=aligned)


# --- counts by year ------------------------------------------------

def games_by_year(schedule: DataFrame, level: str | None = "MLB") -> DataFrame:
    return A.count_by(schedule.filter(_eq("level", level)), ["year"], "games")


def rows_by_year(table: DataFrame, alias: str) -> DataFrame:
    """``SELECT year, COUNT(*) AS alias GROUP BY year ORDER BY year``."""
    return A.count_by(table, ["year"], alias)


# --- by pitcher ---------------------------------------------------------

def pitcher_year_counts(view: DataFrame, pitcher_id: int) -> DataFrame:
    """Per year: payload pitches and distinct games of one pitcher."""
    v = view.filter(F.col("pitcher_id") == pitcher_id)
    return A.count_and_distinct(v, ["year"], "game_pk", "pitches", "games").orderBy("year")


def pitcher_game_breakdown(
    schedule: DataFrame, event: DataFrame, pitch: DataFrame, pitcher_id: int, year: int | None = None, level: str | None = "MLB"
) -> DataFrame:
    """Per game of one pitcher: plate appearances and pitch rows; zero pitch rows beside
    appearances say that pitches were not loaded. The pitch side is counted
    per plate appearance before the join, so the fan-out is never built."""
    s = schedule.filter(_eq("year", year) & _eq("level", level)).select("game_id", "date")
    e = event.filter(F.col("pitcher_id") == pitcher_id).select(
        F.col("game_id").alias("e_game_id"), F.col("event_index").alias("e_event_index")
    )
    p = pitch.groupBy(F.col("game_id").alias("p_game_id"), F.col("event_index").alias("p_event_index")).agg(
        F.count("play_index").alias("_n")
    )
    ep = e.join(p, (F.col("e_game_id") == F.col("p_game_id")) & (F.col("e_event_index") == F.col("p_event_index")), "left")
    j = s.join(ep, F.col("game_id") == F.col("e_game_id"))
    return (
        j.groupBy("game_id", "date")
        .agg(
            F.count_distinct("e_event_index").alias("plate_appearances"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("pitches_in_statsapi_pitch"),
        )
        .orderBy("date")
    )


# --- orphans ---------------------------------------------------------

def orphaned_pitches(pitch: DataFrame, event: DataFrame) -> DataFrame:
    return A.orphan_count(pitch, event, ["game_id", "event_index"], "orphaned_pitches")


def events_missing_schedule(event: DataFrame, schedule: DataFrame) -> DataFrame:
    return A.orphan_count(event, schedule, ["game_id"], "events_missing_schedule")


def pitches_missing_schedule(pitch: DataFrame, schedule: DataFrame) -> DataFrame:
    return A.orphan_count(pitch, schedule, ["game_id"], "pitches_missing_schedule")


def pitchers_missing_from_player(event: DataFrame, player: DataFrame, n: int | None = 20) -> DataFrame:
    """Pitcher ids absent from the player table (their names are NULL in the view)."""
    return A.missing_dim_ids(event, "pitcher_id", player, "player_id", n)


# --- null rates --------------------------------------------------------

def view_null_rates(view: DataFrame) -> DataFrame:
    return A.null_rates(
        view,
        ["year"],
        {
            "pct_has_velocity": "release_speed",
            "pct_has_spin": "release_spin_rate",
            "pct_has_launch": "launch_speed",
            "pct_has_pitcher_name": "pitcher_name",
        },
        total_alias="total_pitches",
    )


# --- coverage between sources ---------------------------------------------

def statcast_coverage(pitch: DataFrame, schedule: DataFrame, statcast: DataFrame, level: str = "MLB") -> DataFrame:
    """Per year: event-source pitches (games of ``level``), payload pitches, and
    payload coverage in percent; ``below_alarm`` flags coverage under 90 %."""
    s = schedule.filter(F.col("level") == level).select(F.col("game_id").alias("_gid"))
    sp = pitch.select("game_id", "year").join(s, F.col("game_id") == F.col("_gid"))
    out = A.coverage(sp, statcast.select("year"), "year", "statsapi_pitches", "statcast_pitches", "statcast_coverage_pct")
    return out.withColumn("below_alarm", F.col("statcast_coverage_pct") < COVERAGE_ALARM_PCT)


# --- summaries of the view -----------------------------------------

def pitcher_arsenal(view: DataFrame, pitcher_id: int | None = None, year: int | None = None) -> DataFrame:
    """Per pitch type and name: count, usage share, mean velocity (1 decimal),
    spin (0), horizontal and vertical movement (2)."""
    v = view.filter(_eq("pitcher_id", pitcher_id) & _eq("year", year))
    return A.summary_with_share(
        v,
        ["pitch_type", "pitch_name"],
        {
            "avg_velo": ("release_speed", 1),
            "avg_spin": ("release_spin_rate", 0),
            "avg_pfx_x": ("pfx_x", 2),
            "avg_pfx_z": ("pfx_z", 2),
        },
        count_alias="pitches",
        share_alias="usage_pct",
    )


def pitch_log(view: DataFrame, pitcher_name: str, year: int | None = None, pitch_type: str | None = None) -> DataFrame:
    """Pitches of a named pitcher (a filter on the joined name turns the view's
    LEFT join into an inner one)."""
    v = view.filter((F.col("pitcher_name") == pitcher_name) & _eq("year", year) & _eq("pitch_type", pitch_type))
    return v.select("game_date", "batter_name", "release_speed", "pfx_x", "pfx_z", "events").orderBy("game_date")


# Described in the original plans, defined here --------------------------------------

def exit_velocity_by_pitch_type(view: DataFrame, year: int | None = None) -> DataFrame:
    """Mean exit velocity (launch speed) per pitch type, batted balls only."""
    v = view.filter(_eq("year", year) & F.col("launch_speed").isNotNull())
    return (
        v.groupBy("pitch_type")
        .agg(F.count(F.lit(1)).alias("batted_balls"), F.round(F.avg("launch_speed"), 1).alias("avg_exit_velo"))
        .orderBy("pitch_type")
    )


def xwoba_trend(view: DataFrame, by: str = "week") -> DataFrame:
    """Mean expected wOBA per calendar week (or day) of ``game_date``."""
    t = F.trunc("game_date", "week") if by == "week" else F.col("game_date")
    return (
        view.filter(F.col("expected_woba").isNotNull())
        .groupBy(t.alias("period"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("expected_woba"), 3).alias("avg_xwoba"))
        .orderBy("period")
    )


def strikeout_rate(event: DataFrame, by: str = "pitcher_id", strikeout_events: tuple[str, ...] = ("Strikeout", "Strikeout Double Play")) -> DataFrame:
    """Share of plate appearances ending in a strikeout, per pitcher (or batter)."""
    return A.rate_by(event, [by], F.col("event").isin(list(strikeout_events)), "plate_appearances", "strikeouts", "strikeout_rate")
