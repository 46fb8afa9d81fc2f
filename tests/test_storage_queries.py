"""Queries over stored tables, on rows of their own, against their SQL."""

import datetime as dt
import random

import duckdb
import pytest

from pitchlake.operators.audit import fanout_check
from pitchlake.plans.storage_queries import STORAGE_SQL, q_ledger_run


@pytest.mark.parametrize("days", [1, 2, 4])
def test_a_backfill_whose_every_window_fails_still_has_its_ledger(spark, tmp_path, days):
    # every day holds a row without a key; with one or four days a window, else none, is left empty at the end
    rows = [(2500 * d + k, dt.datetime(2024, 3, 1 + d, 5), 10 + k, 1.5) for d in range(days) for k in (6, 7, 8)]
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.sql(STORAGE_SQL["ledger_run"])
    got = q_ledger_run(spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
    assert {r.status for r in got if r.games_total} == {"failed"} and not any(r.stored for r in got)


def test_fanout_by_a_key_that_holds_the_parent_joins_no_children(spark):
    rng = random.Random(3)
    maybe = lambda n: rng.choice([None, *range(n)])
    parent = [(1, "a", 0), (1, "a", 1), (1, "b", 2), (2, "a", 3), (3, None, 4), (None, "n", 5), (9, "none", 6)]
    child = [(maybe(5), maybe(5)) for _ in range(200)]
    grand = [(maybe(5), maybe(5), maybe(3)) for _ in range(300)]
    p, c, g = (spark.createDataFrame(rows, cols) for rows, cols in ((parent, "pk long, name string, x int"), (child, "o long, s long"), (grand, "go long, gs long, v int")))
    df = fanout_check(p, c, g, "pk", "s", ["o", "s"], ["go", "gs"], "v", ["pk", "name"], "n", "lines")
    want = {}
    for pk, name, _ in parent:
        for o, s in child:
            if pk is not None and s == pk:
                keys, lines = want.setdefault((pk, name), (set(), []))
                if o is not None:
                    keys.add((o, s))
                    lines += [v for go, gs, v in grand if (go, gs) == (o, s) and v is not None]
    assert {(r.pk, r["name"]): (r.n, r.lines) for r in df.collect()} == {k: (len(keys), len(lines)) for k, (keys, lines) in want.items()}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "distinct" not in plan.lower()
