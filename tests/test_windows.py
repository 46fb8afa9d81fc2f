"""The segmented (skew-spreading) scans give exactly the plain window's result,
including with one hot key holding a third of the rows and NULL runs."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchlake.operators import windows as W


def _events(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rnd.random() < 0.34 else rnd.randint(1, 40)  # one hot key
        day = rnd.randint(0, 20)
        value = None if rnd.random() < 0.6 else round(rnd.uniform(-10, 10), 2)
        rows.append((i, user, day, rnd.randint(0, 5), value))
    df = spark.createDataFrame(rows, "id LONG, user INT, day INT, tick INT, v DOUBLE")
    return df.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))


def _same(a, b, key="id"):
    return sorted(map(tuple, a.orderBy(key).collect())) == sorted(map(tuple, b.orderBy(key).collect()))


def test_fill_down_segmented_equals_plain(spark):
    df = _events(spark).repartition(5)
    order = ["d", "tick", "id"]
    plain = W.fill_down(df, "v", ["user"], order, out="f", default=0.0)
    seg = W.fill_down(df, "v", ["user"], order, out="f", default=0.0, segment=F.col("d"))
    assert _same(plain.select("id", "f"), seg.select("id", "f"))


def test_lag_segmented_equals_plain(spark):
    df = _events(spark).repartition(3)
    order = ["d", "tick", "id"]
    plain = W.lag_default(df, "v", ["user"], order, "p", 0)
    seg = W.lag_default(df, "v", ["user"], order, "p", 0, segment=F.col("d"))
    assert _same(plain.select("id", "p"), seg.select("id", "p"))


def test_first_per_group_and_group_min(spark):
    df = _events(spark)
    first = W.first_per_group(df, ["user"], ["d", "tick", "id"], ["id", "v"])
    rn = df.withColumn("rn", F.row_number().over(W.Window.partitionBy("user").orderBy("d", "tick", "id")))
    want = rn.filter("rn = 1").select("user", "id", "v")
    assert _same(first, want, "user")
    flag = W.keep_on_group_min(df, "v", ["user"], "day", out="fv")
    want = df.withColumn("fv", F.when(F.col("day") == F.min("day").over(W.Window.partitionBy("user")), F.col("v")))
    assert _same(flag.select("id", "fv"), want.select("id", "fv"))


def test_pivot_first_explicit_values(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, 10.0), (1, "a", 0, 11.0), (1, "b", 2, 12.0), (2, "c", 0, 13.0)], "u INT, t STRING, o INT, v DOUBLE"
    )
    wide = W.pivot_first(df, ["u"], "t", ["a", "b"], "v", ["o"], name="first_{}")
    assert wide.columns == ["u", "first_a", "first_b"]
    assert sorted(map(tuple, wide.collect())) == [(1, 11.0, 12.0), (2, None, None)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k STRING, n LONG")
    assert {r.k: r.pct for r in W.share_of_total(df, "n", "pct").collect()} == {"a": 25.0, "b": 75.0}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seed=st.integers(0, 10_000),
    hot=st.floats(0.0, 0.9),
    null_share=st.floats(0.0, 1.0),
    width=st.sampled_from([1, 3, 10]),
)
def test_segmented_equals_plain_property(spark, seed, hot, null_share, width):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        user = 0 if rnd.random() < hot else rnd.randint(1, 6)
        v = None if rnd.random() < null_share else float(rnd.randint(-5, 5))
        rows.append((i, user, rnd.randint(0, 30), v))  # many ties on the day column
    df = spark.createDataFrame(rows, "id LONG, user INT, day INT, v DOUBLE").repartition(4)
    order = ["day", "id"]
    seg = F.floor(F.col("day") / width)
    for fn, kw in ((W.fill_down, {"out": "o", "default": -1.0}), (W.lag_default, {"out": "o", "default": -1.0})):
        plain = fn(df, "v", ["user"], order, **kw)
        segm = fn(df, "v", ["user"], order, segment=seg, **kw)
        assert _same(plain.select("id", "o"), segm.select("id", "o"))
