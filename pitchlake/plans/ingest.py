"""Ledger-driven ingestion of landed files into the stored tables.

Landed layout (downloads are out of scope; files arrive here):

    <landing>/schedule/level=<L>/date=<YYYY-MM-DD>/*.json     one game per line
    <landing>/statsapi/level=<L>/date=<YYYY-MM-DD>/<game>.json one live feed per file
    <landing>/boxscore/level=<L>/date=<YYYY-MM-DD>/<game>.json one boxscore per file
    <landing>/statcast/date=<YYYY-MM-DD>/*.json|*.csv          one pitch per line / row
    <landing>/players/year=<Y>/level=<L>/*.json                 one player per line
    <landing>/season_summary/position=<P>/year=<Y>/*.json       one player season per line

Tables live under ``<warehouse>/<table name>``; the ledger is
``<warehouse>/scrape_log``.

A run plans units (date chunks x sources x levels), drops those already done
(one anti-join against the ledger), opens all remaining units of a source in one
ledger append, and loads them in **one** Spark job set per source: the landed
files are pruned to the pending (level, date) partitions, flattened or packed,
and merged by key. Every row knows its unit: a malformed file fails the unit it belongs
to and no other, and each unit's ledger row has its own rows, games and failed ids.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions.columns import require_columns, select_tolerant
from pitchlake.operators.merge import read_stored, upsert_table
from pitchlake.operators.nested import flatten_games, newest_documents, starting_lineup
from pitchlake.operators.views import materialize, refresh, statcast_view
from pitchlake.plans import ledger as L
from pitchlake.schemas import (
    CHUNK_DAYS, EVENT, LEVELS, PITCH, PLAY, PLAYER, SCHEDULE, SEASON_SUMMARY, STATCAST, STATCAST_VARIANT,
    boxscore_schema, game_feed_schema,
)
from pitchlake.functions.payload import to_variant
from pitchlake.session import delete_path, path_missing, scratch_path
from pitchlake.sources import versions
from pitchlake.sources.landed import identify_documents, read_table

SOURCES = ("schedule", "statsapi", "statcast")
STATCAST_PK = ("game_pk", "at_bat_number", "pitch_number")
VIEW_NAME = "mv_statcast"


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def _pending_days(spark: SparkSession, units: Sequence[dict], with_level: bool = True) -> DataFrame:
    """The (level, date) partitions that the pending units cover (a small plan frame), each
    with the unit whose work it is (``_unit``; the last of units that overlap)."""
    rows = [(u["level"], u["date_start"], u["date_end"], _unit_of(u)) for u in units if u["date_start"] <= u["date_end"]]
    df = spark.createDataFrame(rows, "level string, s date, e date, _unit string")
    days = df.select("level", F.explode(F.sequence("s", "e")).alias("date"), "_unit")
    return days.groupBy(*(["level", "date"] if with_level else ["date"])).agg(F.max("_unit").alias("_unit"))


def _unit_of(unit: dict) -> str:
    return unit.get("run_id") or f"{unit['data_source']}/{unit['level']}/{unit['date_start']}/{unit['date_end']}"


def _prune_landed(spark: SparkSession, df: DataFrame, units: Sequence[dict], with_level: bool = True) -> DataFrame:
    """Landed rows of the pending partitions only, with their ``_unit``: a static filter
    on the plan's date range and levels prunes the file listing; a join on the exact
    (level, date) pairs keeps the result exact."""
    lo = min(u["date_start"] for u in units)
    hi = max(u["date_end"] for u in units)
    cond = F.col("date").between(F.lit(lo), F.lit(hi))
    if with_level:
        cond = cond & F.col("level").isin(sorted({u["level"] for u in units}))
    keys = ["level", "date"] if with_level else ["date"]
    return df.filter(cond).join(_pending_days(spark, units, with_level), keys)


def _read_partitioned(spark: SparkSession, path: str, schema: T.StructType, multiline: bool, units, with_level=True, documents=False) -> DataFrame:
    """Landed files of the pending partitions only. A malformed record is a row like any
    other, with its file's name in ``_bad``: ``_screen`` then fails its unit."""
    bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(bad).option("multiLine", multiline).option("mode", "PERMISSIVE").json(path)
    df = df.withColumn("_bad", F.when(F.col("_corrupt_record").isNotNull(), F.col("_metadata.file_name")))
    df = identify_documents(df) if documents else df
    return _prune_landed(spark, df.drop("_corrupt_record"), units, with_level)


def _screen(df: DataFrame, name: str, id_col: str, outcomes: dict[str, dict]) -> tuple[DataFrame, str]:
    """Write landed rows once, note for each unit how many games it has and which are bad.

    One job parses the files and one small aggregate (a row per unit) does the
    accounting; a unit with a malformed record is failed in ``outcomes`` and its rows
    are not loaded, all others are. Returns the rows of units that have not failed
    (with ``_row``, a number of their own) and the folder to delete afterwards.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, f"ingest-{name}")
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_row", T.LongType())])).parquet(folder)
    bad = F.col("_bad").isNotNull()
    for r in rows.groupBy("_unit").agg(
        F.count_distinct(F.when(~bad, F.col(id_col))).alias("good"), F.count_if(bad).alias("bad"),
        F.sort_array(F.collect_set(F.when(bad, F.col(id_col).try_cast("int")))).alias("ids"), F.sort_array(F.collect_set("_bad")).alias("files"),
    ).collect():
        games = outcomes.setdefault(r["_unit"], {"games_total": 0, "games_success": 0, "games_failed": 0, "rows_written": 0})
        if r["bad"]:
            games.update(status="failed", games_failed=games["games_failed"] + r["bad"], games_success=0, failed_game_ids=sorted({*(games.get("failed_game_ids") or []), *r["ids"]}) or None)
            said = f"{r['bad']} malformed record(s) in {name}: {', '.join(r['files'][:5])}{', ...' if len(r['files']) > 5 else ''}"
            games["error_message"] = "; ".join(filter(None, [games.get("error_message"), said]))
        if name != "boxscore":
            games["games_total"] += r["good"] + r["bad"]
            games["games_success"] = 0 if games.get("status") == "failed" else r["good"]
    return _of_good_units(rows, outcomes).where(~bad).drop("_bad"), folder


def _of_good_units(df: DataFrame, outcomes: dict[str, dict]) -> DataFrame:
    """Rows whose unit has not failed (units are the plan's, a short list)."""
    failed = [u for u, o in outcomes.items() if o.get("status") == "failed"]
    return df.where(~F.col("_unit").isin(failed)) if failed else df


def _account(outcomes: dict[str, dict], counts: dict) -> int:
    """Add a table's rows to the units that sent them; the number of rows."""
    for unit, n in counts["by_unit"].items():
        outcomes.setdefault(unit, {"rows_written": 0})["rows_written"] += n
    return counts["n_affected"]


def _with_partitions(schema: T.StructType, with_level: bool = True) -> T.StructType:
    extra = [T.StructField("level", T.StringType())] if with_level else []
    return T.StructType([*schema.fields, *extra, T.StructField("date", T.DateType())])


def load_schedule(
    spark: SparkSession, landing: str, warehouse: str, units: Sequence[dict], game_types: Sequence[str] | None = None,
    outcomes: dict[str, dict] | None = None,
) -> int:
    """Games of the pending units merged into ``schedule``. ``outcomes`` takes what each unit did."""
    outcomes = {} if outcomes is None else outcomes
    src_fields = [f for f in SCHEDULE.schema.fields if f.name not in ("level", "date", "scraped_at")]
    schema = _with_partitions(T.StructType(src_fields))
    df = _read_partitioned(spark, f"{landing}/schedule", schema, False, units)
    if game_types:
        df = df.filter(F.col("game_type").isin(list(game_types)) | F.col("_bad").isNotNull())
    df, folder = _screen(df, "schedule", "game_id", outcomes)
    df = select_tolerant(df, [*SCHEDULE.columns, "_unit"]).withColumn("year", F.coalesce(F.col("year"), F.year("date")))
    c = upsert_table(
        spark, table_path(warehouse, SCHEDULE.name), df, SCHEDULE.pk, SCHEDULE.schema, SCHEDULE.partition_by, required=SCHEDULE.required, unit_col="_unit")
    delete_path(spark, folder)
    return _account(outcomes, c)


def _games_of_types(spark: SparkSession, warehouse: str, game_types: Sequence[str]) -> DataFrame:
    """Game ids of the stored schedule with one of ``game_types``."""
    from pitchlake.sources.landed import read_table

    sched = read_table(spark, warehouse, SCHEDULE.name)
    return sched.filter(F.col("game_type").isin(list(game_types))).select("game_id")


def load_statsapi(
    spark: SparkSession, landing: str, warehouse: str, units: Sequence[dict], game_types: Sequence[str] | None = None,
    outcomes: dict[str, dict] | None = None,
) -> int:
    """Live feeds of the pending units, flattened and merged into the event, pitch and play
    tables. A malformed feed or boxscore fails its own unit; games without a boxscore
    load with NULL fielders, and their unit's ledger row says how many there were.
    ``outcomes`` takes what each unit did."""
    outcomes = {} if outcomes is None else outcomes
    feed = _read_partitioned(spark, f"{landing}/statsapi", _with_partitions(game_feed_schema()), True, units, documents=True)
    feed = feed.withColumn("year", F.year("date")).drop("level", "date")
    if game_types:
        # the game type lives in the schedule, loaded first in a run
        known = _games_of_types(spark, warehouse, game_types).distinct().withColumn("_known", F.lit(True))
        feed = feed.join(known, "game_id", "left").where("_known OR _bad IS NOT NULL").drop("_known")
    feed, folder = _screen(feed, "statsapi", "game_id", outcomes)
    folders = [folder]
    try:
        box = _read_partitioned(spark, f"{landing}/boxscore", _with_partitions(boxscore_schema()), True, units, documents=True)
        box, folder = _screen(box.drop("level", "date"), "boxscore", "game_id", outcomes)
        folders.append(folder)
        feed = _of_good_units(feed, outcomes)
        lineup = starting_lineup(newest_documents(box, "_row"))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        lineup = None  # no boxscores landed: fielders stay NULL
    games = newest_documents(feed, "_row")
    of = games.select("game_id", "_unit")
    bare = of if lineup is None else of.join(lineup.select("game_id").distinct(), "game_id", "left_anti")
    for r in bare.groupBy("_unit").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per unit
        outcomes[r["_unit"]]["error_message"] = f"{r['n']} game(s) without a boxscore: no fielders"
    # The three outputs are computed from one durable copy of the parsed documents.
    out = flatten_games(games.drop("landed_at", "_unit", "_row"), lineup=lineup, prepared=True)
    total = 0
    for name, spec in (("event", EVENT), ("pitch", PITCH), ("play", PLAY)):
        rows = out[name].join(of, "game_id", "left")
        c = upsert_table(
            spark, table_path(warehouse, spec.name), rows, spec.pk, spec.schema, spec.partition_by, required=spec.required, unit_col="_unit")
        total += _account(outcomes, c)
    for folder in folders:
        delete_path(spark, folder)
    return total


def read_statcast_landed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Pitch payload rows as ``keys + year + data`` without parsing the payload:
    JSON lines keep their text as ``data`` (only the key fields are parsed); CSV
    rows are read as text columns and packed."""
    if fmt == "json":
        raw = spark.read.text(path)  # partition columns (date) are discovered
        # keys read as text and cast, so numbers written as strings still count
        names = ("game_pk", "game_id", "at_bat_number", "pitch_number", "year", "game_year")
        k = F.from_json(F.col("value"), ", ".join(f"{n} STRING" for n in names))
        i = {n: F.trim(k[n]).try_cast("int") for n in names}
        return raw.select(
            F.coalesce(i["game_pk"], i["game_id"]).alias("game_pk"),
            i["at_bat_number"].alias("at_bat_number"),
            i["pitch_number"].alias("pitch_number"),
            F.coalesce(i["year"], i["game_year"], F.year("date")).alias("year"),
            F.col("value").alias("data"),
            "date",
        )
    from pitchlake.functions.payload import pack_json
    from pitchlake.sources.landed import prepare_payload

    df = prepare_payload(spark.read.option("header", True).csv(path))
    if "year" not in df.columns:
        df = df.withColumn("year", F.coalesce(F.col("game_year"), F.year("date")) if "game_year" in df.columns else F.year("date"))
    keys = [F.col(c).try_cast("int").alias(c) for c in (*STATCAST_PK, "year")]
    return pack_json(df, [*STATCAST_PK, "year"], ["date"]).select(*keys, "data", "date")


def load_statcast(
    spark: SparkSession, landing: str, warehouse: str, units: Sequence[dict], game_types: Sequence[str] | None = None,
    fmt: str = "json", payload: str = "text", outcomes: dict[str, dict] | None = None,
) -> int:
    """Pitch payload rows merged into ``statcast``; a row without its key fails its unit. ``payload="variant"`` stores
    the payload as VARIANT (parsed once here; the view then reads fields by path);
    the default keeps JSON text, readable by any engine. Pick one form per table:
    files of both forms cannot be read as one table."""
    outcomes = {} if outcomes is None else outcomes
    df = read_statcast_landed(spark, f"{landing}/statcast", fmt)
    require_columns(df, STATCAST_PK, "pitch payload")
    keyless = functools.reduce(Column.__or__, [F.col(c).isNull() for c in STATCAST_PK])
    df = _prune_landed(spark, df, units, with_level=False).withColumn("_bad", F.when(keyless, F.concat(F.lit("no key, "), F.col("date").cast("string"))))
    if game_types:
        df = df.filter(F.get_json_object("data", "$.game_type").isin(list(game_types)) | keyless)
    df, folder = _screen(df.drop("date"), "statcast", "game_pk", outcomes)
    spec = STATCAST
    if payload == "variant":
        df, spec = df.withColumn("data", to_variant(F.col("data"))), STATCAST_VARIANT
    c = upsert_table(
        spark, table_path(warehouse, spec.name), df.drop("_row"), spec.pk, spec.schema, spec.partition_by, required=spec.required, unit_col="_unit")
    delete_path(spark, folder)
    return _account(outcomes, c)


LOADERS: Mapping[str, Callable[..., int]] = {"schedule": load_schedule, "statsapi": load_statsapi, "statcast": load_statcast}

POSITION_TYPES = ("hitting", "pitching")


def _year_unit(source: str, level: str, year: int) -> dict:
    return {"data_source": source, "level": level, "date_start": dt.date(year, 1, 1), "date_end": dt.date(year, 12, 31)}


def _logged(spark, warehouse: str, unit: dict, work: Callable[[], int], retry_of: str | None = None, options: dict | None = None) -> dict:
    """Run ``work`` as one logged unit; the outcome always reaches the ledger."""
    ledger_path = table_path(warehouse, "scrape_log")
    opened = L.open_runs(spark, ledger_path, [unit], retry_of=retry_of, options=options)
    try:
        n = work()
    except Exception as e:
        L.close_runs(spark, ledger_path, opened, "failed", error_message=f"{type(e).__name__}: {e}")
        return {"run_id": opened[0]["run_id"], "status": "failed", "rows": 0}
    L.close_runs(spark, ledger_path, opened, "success", rows_written=n)
    return {"run_id": opened[0]["run_id"], "status": "success", "rows": n}


def load_players(
    spark: SparkSession, landing: str, warehouse: str, year: int, levels: Sequence[str] = LEVELS, retry_of: str | None = None,
    refresh: bool = True,
) -> dict:
    """Player records landed under ``<landing>/players/year=<Y>/level=<L>/``
    (JSON lines, one full record per player) merged into ``player``. One ledger
    run per call, its level the comma-joined level list. Rows of the materialised
    view whose name changed follow."""

    def work() -> int:
        fields = [T.StructField(f.name, T.StringType()) for f in PLAYER.schema.fields if f.name != "scraped_at"]
        schema = T.StructType([*fields, T.StructField("year", T.IntegerType()), T.StructField("level", T.StringType())])
        df = spark.read.schema(schema).json(f"{landing}/players")
        newest = F.struct("_metadata.file_modification_time", "_metadata.file_path", "level")
        df = df.filter((F.col("year") == year) & F.col("level").isin(list(levels))).withColumn("_landed", newest)
        from pitchlake.sources.landed import prepare_player

        df = prepare_player(df).drop("year", "level")
        # a player listed at several levels is one row: the newest record of an id
        df = df.groupBy("player_id").agg(F.max_by(F.struct(*[c for c in df.columns if c != "player_id"]), "_landed").alias("r"))
        df = df.select("player_id", "r.*").drop("_landed")
        return upsert_table(spark, table_path(warehouse, PLAYER.name), df, PLAYER.pk, PLAYER.schema)["n_affected"]

    out = _logged(spark, warehouse, _year_unit("players", L.LEVEL_SEP.join(levels), year), work, retry_of)
    if refresh and out["status"] == "success":
        refresh_view(spark, warehouse)
    return out


def load_season_summary(
    spark: SparkSession, landing: str, warehouse: str, year: int, positions: Sequence[str] = POSITION_TYPES,
    retry_of: str | None = None,
) -> list[dict]:
    """Season rows landed under ``<landing>/season_summary/position=<P>/year=<Y>/``
    (JSON lines). Keys are parsed; the whole line is kept as the payload. One
    ledger run per position type (its level is the position type)."""
    results = []
    for pos in positions:

        def work(pos: str = pos) -> int:
            raw = spark.read.text(f"{landing}/season_summary").filter(
                (F.col("position") == pos) & (F.col("year") == year)
            )
            k = F.from_json(F.col("value"), "level STRING, player_id INT")
            df = raw.select(
                F.col("year").cast("int").alias("year"),
                k["level"].alias("level"),
                k["player_id"].alias("player_id"),
                F.lit(pos).alias("position_type"),
                F.col("value").alias("data"),
            )
            spec = SEASON_SUMMARY
            return upsert_table(spark, table_path(warehouse, spec.name), df, spec.pk, spec.schema, spec.partition_by, required=spec.required)["n_affected"]

        results.append(_logged(spark, warehouse, _year_unit("season_summary", pos, year), work, retry_of))
    return results


def plan(
    spark: SparkSession,
    warehouse: str,
    start: dt.date,
    end: dt.date,
    sources: Sequence[str] = SOURCES,
    levels: Sequence[str] = LEVELS,
    chunk_days: int = CHUNK_DAYS,
    force: bool = False,
    coverage: str = "exact",
) -> list[dict]:
    """The pending units (statcast is MLB only). Returns the plan rows.

    ``coverage="exact"`` skips a unit only when the very same window finished
    (the source system's rule); ``coverage="days"`` skips it when every one of
    its days lies in some finished window of the same source and level (so a
    finished month covers its weeks)."""
    unknown = set(sources) - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown source(s): {', '.join(sorted(unknown))}")
    one = spark.createDataFrame([(start, end)], "s date, e date")
    chunks = L.chunk_dates(one, "s", "e", chunk_days)
    units = L.plan_units(chunks, sources, levels).filter((F.col("data_source") != "statcast") | (F.col("level") == "MLB"))
    done = L.done_units(L.read_ledger(spark, table_path(warehouse, "scrape_log")))
    if force:
        todo = units
    elif coverage == "days":
        # each uncovered day names its unit by the plan's own tiling (equi-join)
        gaps = L.uncovered_days(units, done).select(
            "data_source", "level", L.chunk_of(F.col("day"), F.lit(start), chunk_days).alias("date_start")
        )
        todo = units.join(gaps.distinct(), ["data_source", "level", "date_start"], "left_semi")
    else:
        todo = L.work_plan(units, done)
    # The plan is metadata (chunks x sources x levels), never data rows.
    return [r.asDict() for r in todo.orderBy("data_source", "level", "date_start").collect()]


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    start: dt.date,
    end: dt.date,
    sources: Sequence[str] = SOURCES,
    levels: Sequence[str] = LEVELS,
    chunk_days: int = CHUNK_DAYS,
    force: bool = False,
    refresh: bool = True,
    retry_of: str | None = None,
    game_types: Sequence[str] | None = None,
    payload: str = "text",
    coverage: str = "exact",
) -> dict:
    """Backfill (or daily run, with ``start == end``): plan, skip done units,
    load each source in one batch, record every unit in the ledger, refresh the
    view for the touched years on success. ``game_types`` keeps only games of
    those types (schedule rows by their type, play-by-play by the stored
    schedule, payload rows by their ``game_type`` key). ``payload="variant"``
    stores the pitch payload as VARIANT (see ``load_statcast``)."""
    ledger_path = table_path(warehouse, "scrape_log")
    todo = plan(spark, warehouse, start, end, sources, levels, chunk_days, force, coverage)
    summary = {"planned": len(todo), "succeeded": 0, "failed": 0, "rows": 0}
    for source in sources:
        units = [u for u in todo if u["data_source"] == source]
        if not units:
            continue
        opts = {"game_types": game_types, **({"payload": payload} if source == "statcast" else {})}
        _run_units(spark, landing, warehouse, ledger_path, source, units, retry_of, summary, opts)
    if refresh and summary["succeeded"] and "statcast" in sources:
        refresh_view(spark, warehouse)  # the rows that this run changed
    return summary


def _run_units(spark, landing, warehouse, ledger_path, source, units, retry_of, summary, opts=None) -> None:
    opts = opts or {}
    asked = {k: list(v) if isinstance(v, (list, tuple)) else v for k, v in opts.items() if v is not None}
    opened = L.open_runs(spark, ledger_path, units, retry_of=retry_of, options=asked)
    outcomes: dict[str, dict] = {}
    try:
        LOADERS[source](spark, landing, warehouse, opened, outcomes=outcomes, **opts)
    except Exception as e:  # the failure reaches the ledger, never a silent success
        if len(units) == 1:
            L.close_runs(spark, ledger_path, opened, "failed", error_message=f"{type(e).__name__}: {e}")
            summary["failed"] += 1
            return
        # Not a bad file (those fail their own units) but rows that can't be merged, as a key
        # that is there twice: the batch ends as 'split' and each unit gets a run of its own.
        L.close_runs(spark, ledger_path, opened, "split", error_message=f"batch failed, retried per unit: {type(e).__name__}")
        for u in units:
            _run_units(spark, landing, warehouse, ledger_path, source, [u], retry_of, summary, opts)
        return
    L.close_runs(spark, ledger_path, opened, "success", rows_written=0, outcomes=outcomes)
    failed = [o for o in outcomes.values() if o.get("status") == "failed"]
    summary["failed"] += len(failed)
    summary["succeeded"] += len(units) - len(failed)
    summary["rows"] += sum(o["rows_written"] for o in outcomes.values())


def daily(spark: SparkSession, landing: str, warehouse: str, day: dt.date | None = None, **kw) -> dict:
    """One day (yesterday by default)."""
    d = day or L.yesterday()
    return run(spark, landing, warehouse, d, d, **kw)


def backfill_season(spark: SparkSession, landing: str, warehouse: str, year: int, **kw) -> dict:
    s, e = L.season_range(year)
    return run(spark, landing, warehouse, s, e, **kw)


def retry(spark: SparkSession, landing: str, warehouse: str, run_id: str, **kw) -> dict:
    """Re-run the unit of a logged run through the same path (a new run with
    ``retry_of``), with the game types and payload form that it was run with; warns
    through the result when the run had not failed."""
    ledger = L.read_ledger(spark, table_path(warehouse, "scrape_log"))
    u = L.plan_from_ledger(ledger, run_id)
    year = u["date_start"].year if u["date_start"] else None
    if u["data_source"] == "players":
        levels = u["level"].split(L.LEVEL_SEP) if u["level"] else list(LEVELS)
        out = load_players(spark, landing, warehouse, year, levels, retry_of=run_id)
        return {**out, "was_status": u["was_status"]}
    if u["data_source"] == "season_summary":
        positions = [u["level"]] if u["level"] else list(POSITION_TYPES)
        out = load_season_summary(spark, landing, warehouse, year, positions, retry_of=run_id)
        return {"runs": out, "was_status": u["was_status"]}
    levels = [u["level"]] if u["level"] else list(LEVELS)
    out = run(spark, landing, warehouse, u["date_start"], u["date_end"], sources=[u["data_source"]], levels=levels,
              chunk_days=(u["date_end"] - u["date_start"]).days + 1, force=True, retry_of=run_id, **{**u["options"], **kw})
    out["was_status"] = u["was_status"]
    return out


def refresh_view(spark: SparkSession, warehouse: str, years: Sequence[int] | None = None, profile: str = "full") -> str | None:
    """Bring the materialised payload view up to its tables: rows loaded since the view's
    version and names changed since then, nothing else. With ``years`` those are built
    anew in whole. None if there are no payload rows yet."""
    source, view = table_path(warehouse, STATCAST.name), table_path(warehouse, VIEW_NAME)
    if versions.latest(spark, source) is None:
        return None

    def build(rows: DataFrame, player: DataFrame | None) -> DataFrame:
        names = player if player is not None else spark.createDataFrame([], PLAYER.schema)
        return statcast_view(rows, names, profile=profile)

    sort = ("pitcher_id", "game_pk")
    if years is not None:
        rows = build(read_stored(spark, source), read_table(spark, warehouse, PLAYER.name, missing_ok=True))
        return materialize(spark, rows, view, ("year",), sort, years, keys=STATCAST_PK, reverse=["pitcher_id"])
    refresh(
        spark, view, source, table_path(warehouse, PLAYER.name), build, STATCAST_PK, "player_id", "pitcher_id", {"pitcher_name": "name_full"},
        ("year",), sort, kind=profile)
    return view
