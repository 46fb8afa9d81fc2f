"""Upsert cases (FIXTURES section E) and properties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchlake.functions.columns import MissingColumnsError
from pitchlake.operators.merge import ACTION, DuplicateKeyError, merge_counts, merge_frames, read_stored, upsert_table

DDL = "k INT, a STRING, b DOUBLE"


def _m(spark, target, source, source_ddl=DDL, **kw):
    t = spark.createDataFrame(target, DDL)
    s = spark.createDataFrame(source, source_ddl)
    out = merge_frames(t, s, ["k"], **kw)
    return sorted(tuple(r) for r in out.drop(ACTION).collect())


def test_update(spark):
    assert _m(spark, [(1, "x", 1.0)], [(1, "y", 2.0)]) == [(1, "y", 2.0)]


def test_insert(spark):
    assert _m(spark, [(1, "x", 1.0)], [(2, "y", 2.0)]) == [(1, "x", 1.0), (2, "y", 2.0)]


def test_partial_columns(spark):
    got = _m(spark, [(1, "x", 1.0)], [(1, "y"), (2, "z")], "k INT, a STRING")
    assert got == [(1, "y", 1.0), (2, "z", None)]


def test_null_overwrites(spark):
    assert _m(spark, [(1, "x", 1.0)], [(1, None, 2.0)]) == [(1, None, 2.0)]


def test_key_only(spark):
    got = _m(spark, [(1, "x", 1.0)], [(1,), (2,)], "k INT")
    assert got == [(1, "x", 1.0), (2, None, None)]


def test_extra_source_column_dropped(spark):
    got = _m(spark, [(1, "x", 1.0)], [(1, "y", 2.0, "junk")], "k INT, a STRING, b DOUBLE, junk STRING")
    assert got == [(1, "y", 2.0)]


def test_no_shared_column(spark):
    with pytest.raises(MissingColumnsError):
        _m(spark, [(1, "x", 1.0)], [("zzz",)], "zzz STRING")


def test_duplicate_keys_raise_or_dedupe(spark):
    src = [(1, "a", 1.0), (1, "b", 2.0)]
    with pytest.raises(DuplicateKeyError, match=r"\(1,\)"):
        _m(spark, [(1, "x", 1.0)], src)
    assert _m(spark, [(1, "x", 1.0)], src, dedupe_by=["b"]) == [(1, "b", 2.0)]


def test_source_types_coerced(spark):
    got = _m(spark, [(1, "x", 1.0)], [("1", "y", "2.5")], "k STRING, a STRING, b STRING")
    assert got == [(1, "y", 2.5)]


def test_actions_and_counts(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], DDL)
    s = spark.createDataFrame([(2, "z", 3.0), (3, "w", 4.0)], DDL)
    m = merge_frames(t, s, ["k"])
    acts = dict((r.k, r[ACTION]) for r in m.collect())
    assert acts == {1: "keep", 2: "update", 3: "insert"}
    c = merge_counts(m).collect()[0]
    assert (c.n_inserted, c.n_updated, c.n_affected, c.n_rows) == (1, 1, 2, 3)
    # insert-only: matched rows untouched, not counted
    ko = merge_frames(t, s.select("k"), ["k"])
    assert merge_counts(ko).collect()[0].n_affected == 1


rows = st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["p", "q", None]), st.floats(-5, 5, allow_nan=False)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_properties(spark, target, source):
    target = list({r[0]: r for r in target}.values())
    source = list({r[0]: r for r in source}.values())
    t = spark.createDataFrame(target, DDL)
    s = spark.createDataFrame(source, DDL)
    once = merge_frames(t, s, ["k"]).drop(ACTION)
    twice = merge_frames(once, s, ["k"]).drop(ACTION)
    a = sorted(map(tuple, once.collect()), key=str)
    assert a == sorted(map(tuple, twice.collect()), key=str)  # idempotent
    assert len(a) == len({r[0] for r in target} | {r[0] for r in source})  # |keys(t) U keys(s)|
    want = {r[0]: r for r in target}
    want.update({r[0]: r for r in source})
    assert sorted(a, key=str) == sorted(want.values(), key=str)


def test_upsert_table_partitions(spark, tmp_path):
    path = str(tmp_path / "tbl")
    ddl = "k INT, year INT, a STRING, scraped_at TIMESTAMP"
    schema = spark.createDataFrame([], ddl).schema
    first = spark.createDataFrame([(1, 2023, "x"), (2, 2024, "y")], "k INT, year INT, a STRING")
    c1 = upsert_table(spark, path, first, ["k"], schema, ["year"])
    assert c1 == {"n_inserted": 2, "n_updated": 0, "n_affected": 2}
    stamp_2023 = read_stored(spark, path).filter("k = 1").collect()[0].scraped_at
    second = spark.createDataFrame([(2, 2024, "y2"), (3, 2024, "z")], "k INT, year INT, a STRING")
    c2 = upsert_table(spark, path, second, ["k"], schema, ["year"])
    assert c2 == {"n_inserted": 1, "n_updated": 1, "n_affected": 2}
    got = sorted((r.k, r.year, r.a) for r in read_stored(spark, path).collect())
    assert got == [(1, 2023, "x"), (2, 2024, "y2"), (3, 2024, "z")]
    # the 2023 partition was not rewritten
    assert read_stored(spark, path).filter("k = 1").collect()[0].scraped_at == stamp_2023
    # empty source: nothing written
    empty = spark.createDataFrame([], "k INT, year INT, a STRING")
    assert upsert_table(spark, path, empty, ["k"], schema, ["year"])["n_affected"] == 0
    # idempotent re-run
    upsert_table(spark, path, second, ["k"], schema, ["year"])
    assert read_stored(spark, path).count() == 3


def test_upsert_on_driver_tables_counts(spark):
    from conftest import SF01
    from pitchlake.plans.catalog import q_upsert, q_upsert_counts

    m = q_upsert(spark, SF01)
    c = q_upsert_counts(spark, SF01).collect()[0]
    assert m.count() == c.n_rows
    assert m.filter(F.col("merge_action") == "update").count() == c.n_updated


def test_upsert_table_string_partition_keeps_type(spark, tmp_path):
    path = str(tmp_path / "tbl")
    ddl = "k INT, level STRING, a STRING"
    schema = spark.createDataFrame([], ddl).schema
    upsert_table(spark, path, spark.createDataFrame([(1, "2024", "x"), (2, "AAA", "y")], ddl), ["k"], schema, ["level"], stamp_col=None)
    upsert_table(spark, path, spark.createDataFrame([(1, "2024", "z")], ddl), ["k"], schema, ["level"], stamp_col=None)
    got = sorted((r.k, r.level, r.a) for r in read_stored(spark, path).collect())
    assert got == [(1, "2024", "z"), (2, "AAA", "y")]


def test_upsert_table_leading_zero_partition_and_new_column(spark, tmp_path):
    path = str(tmp_path / "tbl")
    old = "k INT, level STRING, a STRING"
    upsert_table(spark, path, spark.createDataFrame([(1, "007", "x")], old), ["k"], spark.createDataFrame([], old).schema,
                 ["level"], stamp_col=None)
    # the table gains a column: older files read it as NULL
    new = "k INT, level STRING, a STRING, b DOUBLE"
    schema = spark.createDataFrame([], new).schema
    upsert_table(spark, path, spark.createDataFrame([(2, "007", "y", 1.5)], new), ["k"], schema, ["level"], stamp_col=None)
    got = sorted(tuple(r) for r in read_stored(spark, path).select("k", "level", "a", "b").collect())
    assert got == [(1, "007", "x", None), (2, "007", "y", 1.5)]
