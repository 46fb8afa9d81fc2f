"""Date chunks, ledger state, planning, retry and week gaps (FIXTURES section F)."""

import datetime as dt

from pyspark.sql import functions as F

from pitchlake.plans import ledger as L

D = dt.date


def _chunks(spark, start, end, days=7):
    one = spark.createDataFrame([(start, end)], "s date, e date")
    return [(r.chunk_start, r.chunk_end) for r in L.chunk_dates(one, "s", "e", days).orderBy("chunk_start").collect()]


def test_chunks_tile_and_clip(spark):
    assert _chunks(spark, D(2024, 3, 1), D(2024, 3, 17)) == [
        (D(2024, 3, 1), D(2024, 3, 7)),
        (D(2024, 3, 8), D(2024, 3, 14)),
        (D(2024, 3, 15), D(2024, 3, 17)),
    ]
    assert _chunks(spark, D(2024, 3, 1), D(2024, 3, 1)) == [(D(2024, 3, 1), D(2024, 3, 1))]
    assert _chunks(spark, D(2024, 3, 5), D(2024, 3, 1)) == []


def test_chunks_tile_exactly_property(spark):
    start, end = D(2023, 2, 20), D(2023, 10, 31)
    ch = _chunks(spark, start, end, 7)
    assert ch[0][0] == start and ch[-1][1] == end
    for (a, b), (c, _) in zip(ch, ch[1:]):
        assert c == b + dt.timedelta(days=1) and b >= a


def test_chunk_of_matches_chunks(spark):
    df = spark.createDataFrame([(D(2024, 3, 1), D(2024, 3, d)) for d in range(1, 31)], "o date, d date")
    got = {r.d: r.c for r in df.select("d", L.chunk_of(F.col("d"), F.col("o"), 7).alias("c")).collect()}
    for s, e in _chunks(spark, D(2024, 3, 1), D(2024, 3, 30)):
        for i in range((e - s).days + 1):
            assert got[s + dt.timedelta(days=i)] == s


def test_season_and_yesterday():
    assert L.season_range(2024) == (D(2024, 2, 20), D(2024, 10, 31))
    assert L.yesterday(D(2024, 3, 1)) == D(2024, 2, 29)


def test_ledger_cycle_plan_and_retry(spark, tmp_path):
    path = str(tmp_path / "ledger")
    t0 = dt.datetime(2024, 4, 1, 8, 0)
    ok = L.open_run(spark, path, "statsapi", "MLB", D(2024, 3, 1), D(2024, 3, 7), now=t0)
    L.close_run(spark, path, ok, "success", rows_written=10, now=t0 + dt.timedelta(minutes=5))
    bad = L.open_run(spark, path, "statsapi", "MLB", D(2024, 3, 8), D(2024, 3, 14), now=t0)
    L.close_run(spark, path, bad, "failed", error_message="timeout", now=t0 + dt.timedelta(minutes=6))
    hung = L.open_run(spark, path, "statcast", "MLB", D(2024, 3, 1), D(2024, 3, 7), now=t0)
    ledger = spark.read.parquet(path)

    cur = {r.run_id: r.status for r in L.latest_state(ledger).collect()}
    assert cur == {ok: "success", bad: "failed", hung: "running"}
    assert [r.run_id for r in L.failed_runs(ledger).collect()] == [bad]
    assert L.get_run(ledger, ok).collect()[0].rows_written == 10

    chunks = spark.createDataFrame([(D(2024, 3, 1), D(2024, 3, 14))], "s date, e date")
    units = L.plan_units(L.chunk_dates(chunks, "s", "e", 7), ["statsapi", "statcast"], ["MLB"])
    assert units.count() == 4
    todo = {(r.data_source, r.date_start) for r in L.work_plan(units, L.done_units(ledger)).collect()}
    assert todo == {("statsapi", D(2024, 3, 8)), ("statcast", D(2024, 3, 1)), ("statcast", D(2024, 3, 8))}
    assert L.work_plan(units, L.done_units(ledger), force=True).count() == 4

    stale = L.stale_runs(ledger, now=F.lit(dt.datetime(2024, 4, 2, 8, 0)), hours=6)
    assert [r.run_id for r in stale.collect()] == [hung]

    plan = L.plan_from_ledger(ledger, bad)
    assert (plan["data_source"], plan["date_start"], plan["was_status"]) == ("statsapi", D(2024, 3, 8), "failed")
    retry = L.open_run(spark, path, plan["data_source"], plan["level"], plan["date_start"], plan["date_end"], retry_of=bad)
    L.close_run(spark, path, retry, "success")
    ledger = spark.read.parquet(path)
    assert L.work_plan(units, L.done_units(ledger)).filter(F.col("data_source") == "statsapi").count() == 0
    assert L.get_run(ledger, retry).collect()[0].retry_of == bad


def test_uncovered_days(spark):
    units = spark.createDataFrame([("s", "MLB", D(2024, 3, 1), D(2024, 3, 7))], "data_source string, level string, date_start date, date_end date")
    done = spark.createDataFrame([("s", "MLB", D(2024, 2, 1), D(2024, 3, 5))], "data_source string, level string, date_start date, date_end date")
    got = sorted(r.day for r in L.uncovered_days(units, done).collect())
    assert got == [D(2024, 3, 6), D(2024, 3, 7)]


def test_week_gaps_as_written_and_aligned(spark):
    covered = spark.createDataFrame([(D(2024, 3, 4),), (D(2024, 3, 12),), (D(2024, 10, 29),)], "date_start date")
    as_written = L.week_gaps(covered, "date_start", "2024-03-01", "2024-10-31", aligned=False)
    assert as_written.count() == 35  # Friday series vs Monday weeks: nothing removed
    aligned = [r.week_start for r in L.week_gaps(covered, "date_start", "2024-03-01", "2024-10-31").collect()]
    assert aligned[0] == D(2024, 2, 26)
    assert D(2024, 3, 4) not in aligned and D(2024, 3, 11) not in aligned and D(2024, 10, 28) not in aligned
    assert D(2024, 3, 18) in aligned


def test_compact_ledger_keeps_history(spark, tmp_path):
    import os

    path = str(tmp_path / "ledger")
    for i in range(4):
        r = L.open_run(spark, path, "statsapi", "MLB", D(2024, 3, 1 + 7 * i), D(2024, 3, 7 + 7 * i))
        L.close_run(spark, path, r, "success")
    before = L.latest_state(spark.read.parquet(path)).collect()
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) >= 8
    assert L.compact_ledger(spark, path) == 8
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
    after = L.latest_state(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_plan_interval_coverage(spark, tmp_path):
    from pitchlake.plans import ingest as I

    wh = str(tmp_path / "wh")
    ledger = f"{wh}/scrape_log"
    month = L.open_run(spark, ledger, "statsapi", "MLB", D(2024, 3, 1), D(2024, 3, 31))
    L.close_run(spark, ledger, month, "success")
    exact = I.plan(spark, wh, D(2024, 3, 1), D(2024, 4, 7), sources=["statsapi"], levels=["MLB"])
    days = I.plan(spark, wh, D(2024, 3, 1), D(2024, 4, 7), sources=["statsapi"], levels=["MLB"], coverage="days")
    assert len(exact) == 6  # no weekly window matches the monthly run exactly
    # weeks fully inside March are covered; the week spanning Mar 29 - Apr 4 and Apr 5-7 are not
    assert [(u["date_start"], u["date_end"]) for u in days] == [(D(2024, 3, 29), D(2024, 4, 4)), (D(2024, 4, 5), D(2024, 4, 7))]
