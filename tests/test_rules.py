"""Constraints, detected types and window coverage."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pitchlake.operators.audit import constraint_violations, fanout_check
from pitchlake.plans.ledger import uncovered_days, uncovered_windows
from pitchlake.sources.landed import csv_detected, detect_types


def test_constraints(spark):
    rows = [(1, "a", "5", "2024-01-01"), (1, "a", " 7 ", None), (1, "b", "x", "2024-13-01"), (2, None, None, "soon"), (None, "c", "", "2024-02-01"), (None, "c", "1", None)]
    df = spark.createDataFrame(rows, "k int, g string, n string, d string")
    got = {(r.kind, r.column_name): r.n for r in constraint_violations(df, ["k", "g"], ["g", "d"], {"n": "int", "d": "date"}).collect()}
    assert got == {("key", "k,g"): 1, ("not_null", "k"): 2, ("not_null", "g"): 1, ("not_null", "d"): 2, ("type", "n"): 2, ("type", "d"): 2}
    none = constraint_violations(df.where("false"), ["k"], [], {"n": "int"}).collect()
    assert {(r.kind, r.n) for r in none} == {("key", 0), ("not_null", 0), ("type", 0)}


def test_detected_types(spark):
    cols = {
        "flag": ["true", "FALSE", None], "whole": ["1", "-20", "0"], "mixed": ["1", "2.5", "-1e3"], "code": ["007", "1", "2"], "day": ["2024-02-29", "2024-01-01", None],
        "both": ["2024-01-01", "2024-01-01T10:00:00.123", None], "bad_day": ["2024-02-30", "2024-01-01", "2024-01-02"], "empty": [None, None, None], "text": ["1", "x", "true"],
        "one_zero": ["1", "0", "1"], "year": ["2024", "2023", "2022"], "nan": ["NaN", "1", "2"], "huge": ["99999999999999999999", "1", "2"], "dot": [".5", "5.", "+1"],
    }
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} string" for c in cols))
    schema, report = detect_types(df)
    want = {"flag": "boolean", "whole": "bigint", "mixed": "double", "code": "string", "day": "date", "both": "timestamp_ntz", "bad_day": "string", "empty": "string", "text": "string",
            "one_zero": "bigint", "year": "bigint", "nan": "string", "huge": "double", "dot": "double"}
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == want
    assert [r["values"] for r in report][:2] == [2, 3] and not any(r["drift"] for r in report)
    expected = spark.createDataFrame([], "whole int, mixed int, day timestamp, empty date, text double, flag boolean, gone int").schema
    drift = {r["column"]: r["drift"] for r in detect_types(df.select("whole", "mixed", "day", "empty", "text", "flag", "year"), expected)[1]}
    assert drift == {"whole": False, "mixed": True, "day": False, "empty": False, "text": True, "flag": False, "year": True, "gone": True}


def test_csv_detected_keeps_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b",\n c', 2.5, None), (2, "", -1.0, dt.date(2024, 1, 2))], "id long, t string, x double, d date")
    df.write.options(header=True, quote='"', escape='"', nullValue="\\N").csv(str(tmp_path / "c"))
    back, _ = csv_detected(spark, str(tmp_path / "c"))
    assert back.dtypes == df.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_windows_cover_the_same_days(spark):
    rng, day = random.Random(4), lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    units, done = [], []
    for key in ("a", "b", None, "c", "d"):
        units += [(key, day(10 * i), day(10 * i + 9)) for i in range(8)]
        for _ in range({"c": 0, "d": 60}.get(key, 6)):
            s = rng.randint(-5, 80)
            done.append((key, day(s), day(s + rng.choice([-3, 0, 0, 1, 5, 15]))))
    ddl = "k string, date_start date, date_end date"
    u, d = spark.createDataFrame(units, ddl), spark.createDataFrame(done, ddl)
    got = uncovered_windows(u, d, ["k"]).collect()
    days = {(r.k, r.gap_start + dt.timedelta(days=i)) for r in got for i in range((r.gap_end - r.gap_start).days + 1)}
    want = {(r.k, r.day) for r in uncovered_days(u.where("k is not null"), d.where("date_start <= date_end"), ["k"]).collect()}
    held = {day for k, s, e in done if k is None and s <= e for day in (s + dt.timedelta(days=i) for i in range((e - s).days + 1))}
    want |= {(None, day(n)) for n in range(80)} - {(None, x) for x in held}
    assert days == want
    assert sum((r.gap_end - r.gap_start).days + 1 for r in got) == len(days)  # no day twice
    starts = {(k, s): e for k, s, e in units}
    for r in got:  # within one unit, and as long as can be
        unit = max(s for k, s in starts if k == r.k and s <= r.gap_start)
        assert r.gap_end <= starts[r.k, unit]
        assert (r.k, r.gap_end + dt.timedelta(days=1)) not in days or r.gap_end == starts[r.k, unit]


def test_fanout_by_a_composite_key_counts_what_the_join_counts(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    child = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 2, 1), (2, 1, None), (2, 5, 5)], "cp int, a int, b int")
    grand = spark.createDataFrame([(1, 1, 7), (1, 1, None), (1, 1, 8), (2, 1, 9)], "ga int, gb int, x int")
    got = fanout_check(parent, child, grand, "p", "cp", ["a", "b"], ["ga", "gb"], "x", ["p"], "n_child", "n_x")
    flat = parent.join(child, F.col("p") == F.col("cp")).join(grand, (F.col("a") == F.col("ga")) & (F.col("b") == F.col("gb")), "left")
    want = flat.groupBy("p").agg(F.count_distinct("a", "b").alias("n_child"), F.count("x").alias("n_x"))
    assert sorted(got.collect()) == sorted(want.collect()) == [(1, 2, 5), (2, 1, 0)]
