"""Run ledger, date chunks, work planning, retry and coverage gaps.

The ledger is append-only: opening a run appends a ``running`` row, finishing it
appends the final row; the current state of a run is its latest row
(``max_by`` per ``run_id``, a partial aggregate). A retry is a new run that
records ``retry_of``. Planning is set-based: planned units ``left_anti`` the
finished ones, one join instead of one lookup per unit.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.session import delete_path, path_missing
from pitchlake.schemas import CHUNK_DAYS, LEDGER, SEASON_END, SEASON_START

UNIT_KEYS = ("data_source", "level", "date_start", "date_end")


def _date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, str):
        return F.col(x).cast("date")
    return F.lit(x).cast("date")


def chunk_dates(df: DataFrame, start, end, days: int = CHUNK_DAYS, keep: Sequence[str] = ()) -> DataFrame:
    """Per input row, consecutive ``days``-day windows tiling ``[start, end]``,
    the last one clipped; a row with ``start > end`` yields none.

    A generator (``explode(sequence)``) per row, so it is distributed like its
    input and needs no join.
    """
    s, e = _date(start), _date(end)
    step = F.expr(f"INTERVAL {int(days)} DAYS")
    starts = F.when(s <= e, F.sequence(s, e, step)).otherwise(F.array().cast("array<date>"))
    exploded = df.select(*keep, s.alias("_end_s"), e.alias("_end"), F.explode(starts).alias("chunk_start"))
    return exploded.select(
        *keep,
        "chunk_start",
        F.least(F.date_add("chunk_start", int(days) - 1), F.col("_end")).alias("chunk_end"),
    )


def chunk_of(date_col: Column, origin: Column, days: int = CHUNK_DAYS) -> Column:
    """Start of the chunk that holds ``date_col`` for chunks laid from ``origin``
    (same tiling as ``chunk_dates``); an equi-join key instead of a range join."""
    d = date_col.cast("date")
    return F.date_add(origin, (F.floor(F.datediff(d, origin) / days) * days).cast("int"))


def season_range(year: int) -> tuple[dt.date, dt.date]:
    """The backfill window of a season."""
    return dt.date(year, *SEASON_START), dt.date(year, *SEASON_END)


def season_windows(df: DataFrame, year_col: str) -> DataFrame:
    """The backfill window of each row's season: ``season_range`` as columns."""
    (m1, d1), (m2, d2) = SEASON_START, SEASON_END
    date = lambda m, d: F.make_date(F.col(year_col), F.lit(m), F.lit(d))
    return df.withColumns({"date_start": date(m1, d1), "date_end": date(m2, d2)})


def yesterday(today: dt.date | None = None) -> dt.date:
    return (today or dt.date.today()) - dt.timedelta(days=1)


def plan_units(chunks: DataFrame, sources: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Chunks x sources x levels as generators over literal lists (no join)."""
    return chunks.select(
        F.explode(F.array(*[F.lit(s) for s in sources])).alias("data_source"),
        F.col("chunk_start").alias("date_start"),
        F.col("chunk_end").alias("date_end"),
    ).select(
        "data_source",
        F.explode(F.array(*[F.lit(level) for level in levels])).alias("level"),
        "date_start",
        "date_end",
    )


def latest_state(ledger: DataFrame, key: str = "run_id", at: Sequence[str] = ("recorded_at",)) -> DataFrame:
    """Latest row per ``key`` by ``at`` (ties broken by the later columns of ``at``)."""
    rest = [c for c in ledger.columns if c != key]
    order = F.struct(*[F.col(c) for c in at])
    g = ledger.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_l"))
    return g.select(key, *[F.col("_l").getField(c).alias(c) for c in rest])


def done_units(ledger: DataFrame) -> DataFrame:
    """Distinct units whose current state is ``success``."""
    cur = latest_state(ledger)
    return cur.filter(F.col("status") == "success").select(*UNIT_KEYS).distinct()


def work_plan(units: DataFrame, done: DataFrame, keys: Sequence[str] = UNIT_KEYS, force: bool = False) -> DataFrame:
    """Planned units without a finished twin (exact match on all ``keys``).
    NULL-safe, so a unit without a level still matches its finished twin."""
    if force:
        return units
    d = done.select(*[F.col(k).alias(f"_d_{k}") for k in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys]
    return units.join(d, cond, "left_anti")


def uncovered_days(units: DataFrame, done: DataFrame, keys: Sequence[str] = ("data_source", "level")) -> DataFrame:
    """Interval-aware coverage: the days of each unit not inside any finished
    window of the same source and level (a finished month covers its weeks).
    Both sides are expanded to days and anti-joined on ``keys`` + day."""
    want = units.select(*keys, F.explode(F.sequence(_date("date_start"), _date("date_end"))).alias("day"))
    have = done.select(*keys, F.explode(F.sequence(_date("date_start"), _date("date_end"))).alias("day")).distinct()
    return want.join(have, [*keys, "day"], "left_anti")


def uncovered_windows(units: DataFrame, done: DataFrame, keys: Sequence[str] = ("data_source", "level")) -> DataFrame:
    """Interval-aware coverage without a row per day: (keys, gap_start, gap_end), the runs
    of days of each unit that no finished window of the same keys holds.

    Every window is two steps, up at its first day and down after its last; steps of a
    day are summed per key, and between two days of steps nothing changes. Windows may
    overlap, touch or lie within each other; those that end before they begin count
    for nothing, and keys are matched NULL-safe.
    """
    def steps(df: DataFrame, own: str, other: str) -> DataFrame:
        s, e = _date("date_start"), _date("date_end")
        both = F.explode(F.array(F.struct(s.alias("day"), F.lit(1).alias("d")), F.struct(F.date_add(e, 1).alias("day"), F.lit(-1).alias("d")))).alias("x")
        return df.where(s <= e).select(*keys, both).select(*keys, "x.day", F.col("x.d").alias(own), F.lit(0).alias(other), F.abs("x.d").alias("_u") if own == "unit" else F.lit(0).alias("_u"))

    by_day = steps(units, "unit", "fin").unionByName(steps(done, "fin", "unit")).groupBy(*keys, "day").agg(
        F.sum("unit").alias("unit"), F.sum("fin").alias("fin"), F.max("_u").alias("_u"))
    w = Window.partitionBy(*keys).orderBy("day")
    run = by_day.select(*keys, "day", "_u", F.lead("day").over(w).alias("next"), F.sum("unit").over(w).alias("wanted"), F.sum("fin").over(w).alias("have"))
    bare = run.withColumn("bare", (F.col("wanted") > 0) & (F.col("have") == 0))
    # a gap goes on over a step that changes nothing for it, but not into another unit
    opens = F.col("bare") & ((F.col("_u") > 0) | ~F.coalesce(F.lag("bare").over(w), F.lit(False)))
    gaps = bare.withColumn("gap", F.sum(F.when(opens, 1).otherwise(0)).over(w)).where("bare")
    return gaps.groupBy(*keys, "gap").agg(F.min("day").alias("gap_start"), F.date_sub(F.max("next"), 1).alias("gap_end")).drop("gap")


def week_gaps(
    covered: DataFrame,
    date_col: str,
    series_start: dt.date | str,
    series_end: dt.date | str,
    aligned: bool = True,
    step_days: int = 7,
) -> DataFrame:
    """Calendar weeks from a ``step_days`` series minus the Monday-weeks that hold
    a covered date (``EXCEPT``, distinct).

    ``aligned=False`` keeps the series' own start day, as the source query did:
    when the series does not start on a Monday nothing is ever removed.
    ``aligned=True`` snaps the series start to its Monday first.
    """
    spark = covered.sparkSession
    s = F.lit(str(series_start)).cast("date")
    if aligned:
        s = F.trunc(s, "week")
    e = F.lit(str(series_end)).cast("date")
    cal = spark.range(1).select(F.explode(F.sequence(s, e, F.expr(f"INTERVAL {int(step_days)} DAYS"))).alias("week_start"))
    have = covered.select(F.trunc(F.col(date_col).cast("date"), "week").alias("week_start")).distinct()
    return cal.subtract(have).orderBy("week_start")


def stale_runs(
    ledger: DataFrame,
    now: Column | None = None,
    hours: int = 6,
    key: str = "run_id",
    at: Sequence[str] = ("recorded_at",),
    status_col: str = "status",
    started_col: str = "started_at",
    running: str = "running",
) -> DataFrame:
    """Runs whose latest state is still ``running`` after ``hours`` (a run killed
    midway never writes its final row)."""
    now = now if now is not None else F.current_timestamp()
    cur = latest_state(ledger, key=key, at=at)
    cutoff = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return cur.filter((F.col(status_col) == running) & (F.col(started_col) < cutoff))


# --- writing the ledger -----------------------------------------------------

def _rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    schema = LEDGER.schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def _row(spark: SparkSession, **values) -> DataFrame:
    return _rows(spark, [values])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table, or an empty one when nothing was logged yet."""
    try:
        df = spark.read.schema(LEDGER.schema).parquet(path)  # rows from before a column was added read it as NULL
        df.take(1)  # the path check can be lazy
        return df
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], LEDGER.schema)


def open_run(
    spark: SparkSession,
    path: str,
    data_source: str,
    level: str | None,
    date_start: dt.date | None,
    date_end: dt.date | None,
    retry_of: str | None = None,
    now: dt.datetime | None = None,
) -> str:
    """Append a ``running`` row; returns the new run id (a uuid)."""
    run_id = uuid.uuid4().hex
    ts = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    _row(
        spark, run_id=run_id, data_source=data_source, level=level, date_start=date_start,
        date_end=date_end, status="running", started_at=ts, retry_of=retry_of, recorded_at=ts,
    ).write.mode("append").parquet(path)
    return run_id


def close_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    status: str,
    rows_written: int | None = None,
    games_total: int | None = None,
    games_success: int | None = None,
    games_failed: int | None = 0,
    failed_game_ids: Sequence[int] | None = None,
    error_message: str | None = None,
    now: dt.datetime | None = None,
) -> None:
    """Append the final row of a run, carrying its unit from the open row."""
    ts = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    opened = latest_state(read_ledger(spark, path)).filter(F.col("run_id") == run_id).limit(1).collect()
    if not opened:
        raise KeyError(f"no ledger row for run {run_id}")
    o = opened[0]
    _row(
        spark, run_id=run_id, data_source=o["data_source"], level=o["level"], date_start=o["date_start"],
        date_end=o["date_end"], status=status, games_total=games_total, games_success=games_success,
        games_failed=games_failed, failed_game_ids=list(failed_game_ids) if failed_game_ids else None,
        error_message=error_message, started_at=o["started_at"], completed_at=ts, retry_of=o["retry_of"],
        rows_written=rows_written, recorded_at=ts, options=o["options"],
    ).write.mode("append").parquet(path)


def open_runs(
    spark: SparkSession, path: str, units: Sequence[dict], retry_of: str | None = None, now: dt.datetime | None = None,
    options: dict | None = None,
) -> list[dict]:
    """Open one run per planned unit in a single append; returns the opened rows
    (unit fields + ``run_id``). ``units`` is the work plan, not data: its size is
    chunks x sources x levels. ``options`` (what the loader was asked for) are kept
    as JSON, so a retry can ask for the same."""
    ts = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    opened = [
        {**{k: u.get(k) for k in UNIT_KEYS}, "run_id": uuid.uuid4().hex, "status": "running",
         "started_at": ts, "recorded_at": ts, "retry_of": u.get("retry_of", retry_of),
         "options": json.dumps(options, sort_keys=True) if options else None}
        for u in units
    ]
    if opened:
        _rows(spark, opened).write.mode("append").parquet(path)
    return opened


def close_runs(
    spark: SparkSession,
    path: str,
    opened: Sequence[dict],
    status: str,
    rows_written: int | None = None,
    error_message: str | None = None,
    now: dt.datetime | None = None,
    outcomes: Mapping[str, Mapping] | None = None,
) -> None:
    """Append the final state of several runs in one write. ``outcomes`` gives a run
    (by its id) values of its own: status, rows, games, failed ids, message."""
    ts = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [
        {**o, "status": status, "completed_at": ts, "recorded_at": ts, "rows_written": rows_written,
         "error_message": error_message, "games_failed": 0 if status == "success" else None,
         **((outcomes or {}).get(o["run_id"], {}))}
        for o in opened
    ]
    if rows:
        _rows(spark, rows).write.mode("append").parquet(path)


def compact_ledger(spark: SparkSession, path: str, files: int = 1) -> int:
    """Rewrite the append-only ledger into ``files`` files (each open/close
    appended one small file). The rows are appended once more in few files, then the
    files they came from are deleted by name. A crash in between leaves every row,
    some of them twice, which changes no state; the next run drops the repeats. The
    ledger holds one row per run state (metadata), so a few files suffice. Returns
    the row count."""
    ledger = read_ledger(spark, path)
    old = ledger.inputFiles()
    ledger.dropDuplicates().coalesce(files).write.mode("append").parquet(path)
    for name in old:
        delete_path(spark, name, encoded=True)
    return read_ledger(spark, path).count()


def get_run(ledger: DataFrame, run_id: str) -> DataFrame:
    """Current state of one run (``SELECT * ... WHERE id = ?``)."""
    return latest_state(ledger).filter(F.col("run_id") == run_id)


def failed_runs(ledger: DataFrame) -> DataFrame:
    """Runs whose current state is ``failed``, newest first."""
    return latest_state(ledger).filter(F.col("status") == "failed").orderBy(F.col("started_at").desc())


def plan_from_ledger(ledger: DataFrame, run_id: str) -> dict:
    """The unit of a logged run, to re-run through the same code path.
    Returns ``{data_source, level, date_start, date_end, retry_of, was_status, options}``."""
    rows = get_run(ledger, run_id).limit(1).collect()
    if not rows:
        raise KeyError(f"no ledger entry for run {run_id}")
    r = rows[0]
    return {
        "data_source": r["data_source"], "level": r["level"], "date_start": r["date_start"],
        "date_end": r["date_end"], "retry_of": run_id, "was_status": r["status"],
        "options": json.loads(r["options"]) if r["options"] else {},
    }


LEVEL_SEP = ","


def split_levels(text: Column) -> Column:
    """``'MLB,AAA'`` -> array (the ledger stores a level list as one string)."""
    return F.split(text, LEVEL_SEP)


def join_levels(levels: Column) -> Column:
    return F.concat_ws(LEVEL_SEP, levels)
