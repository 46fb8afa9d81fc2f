"""Versioned tables: atomic commits, every partition type, the key index, incremental views."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import merge
from pitchlake.operators.merge import read_stored, upsert_table
from pitchlake.operators.views import materialize, refresh, unpack_view
from pitchlake.sources import versions

DDL = "k int, v string, p int"


def put(spark, path, rows, ddl=DDL, parts=("p",), **kw):
    df = spark.createDataFrame(rows, ddl)
    return upsert_table(spark, path, df, ["k"], df.schema, parts, stamp_col=None, **kw)


def rows_of(spark, path):
    return sorted(map(tuple, read_stored(spark, path).collect()), key=repr)


def files_read(df):
    """Files that the scan of ``df`` opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().get("numFiles").get().value()


PARTITIONS = {
    "int": [1, 2, None], "boolean": [True, False, None], "date": [dt.date(2024, 1, 1), dt.date(1, 1, 1), None],
    "timestamp": [dt.datetime(2024, 1, 1, 3, 4, 5, 600), dt.datetime(2024, 1, 1), None], "decimal(10,2)": [decimal.Decimal("1.50"), decimal.Decimal("-2.00"), None],
    "string": ["a:b", "x/../p=keep", "keep", "a%3Ab", "007", "true", " sp ace ", "ü=#", "__x", None],
}


@pytest.mark.parametrize("kind", sorted(PARTITIONS))
def test_keys_move_between_partitions_of_any_type(spark, tmp_path, kind):
    path, values, ddl = str(tmp_path / "t"), PARTITIONS[kind], f"k int, v string, p {kind}"
    first = [(i, "old", v) for i, v in enumerate(values)]
    put(spark, path, first, ddl)
    assert rows_of(spark, path) == sorted(first, key=repr)
    moved = [(i, "new", values[(i + 1) % len(values)]) for i in range(len(values))]
    assert put(spark, path, moved, ddl)["n_updated"] == len(values)
    assert rows_of(spark, path) == sorted(moved, key=repr)
    assert put(spark, path, [(0, "alone", values[-1])], ddl)["n_updated"] == 1
    assert rows_of(spark, path) == sorted([(0, "alone", values[-1]), *moved[1:]], key=repr)


def test_empty_text_is_no_partition(spark, tmp_path):
    with pytest.raises(ValueError, match="empty text"):
        put(spark, str(tmp_path / "t"), [(1, "x", "")], "k int, v string, p string")


@pytest.mark.parametrize("step", ["write", "index", "publish", "forget"])
def test_a_crash_leaves_a_whole_version(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    old = [(i, "old", i % 3) for i in range(30)]
    put(spark, path, old)
    put(spark, path, [(40, "b", None)])
    before = rows_of(spark, path)

    def crash(*a, **kw):
        raise RuntimeError("lost")

    bad = [(1, "new", 2), (2, "new", 0)]
    if step == "write":
        with pytest.raises(Exception):
            df = spark.createDataFrame(bad, DDL)
            upsert_table(spark, path, df, ["k"], df.schema, ["p"], stamp_col=None, dedupe_by=[F.raise_error(F.lit("lost"))])
    else:
        real = {"index": ("_scan", versions._scan), "publish": ("publish", versions.publish), "forget": ("_forget", versions._forget)}[step]
        if step == "index":
            seen = []

            def once(*a, **kw):  # the scan of what was just written
                seen.append(a)
                if len(a[3]) == 1 and a[3][0] not in versions.latest(spark, path).commits:
                    crash()
                return real[1](*a, **kw)

            monkeypatch.setattr(versions, "_scan", once)
        else:
            monkeypatch.setattr(versions, real[0], crash)
        with pytest.raises(RuntimeError, match="lost"):
            put(spark, path, bad)
        monkeypatch.undo()
    now = rows_of(spark, path)
    want = sorted([r for r in before if r[0] not in (1, 2)] + bad, key=repr)
    assert now == (want if step == "forget" else before)
    put(spark, path, bad)
    assert rows_of(spark, path) == want
    left = versions.vacuum(spark, path, older_than_hours=0)
    assert len(left) == (step in ("index", "publish"))
    assert rows_of(spark, path) == want


def test_a_beaten_writer_merges_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, [(1, "a", 0), (2, "a", 0)])
    real, beaten = versions.publish, []

    def publish(spark, path, version):
        if not beaten:
            beaten.append(version.number)
            monkeypatch.setattr(versions, "publish", real)
            put(spark, path, [(1, "other", 1)])
        real(spark, path, version)

    monkeypatch.setattr(versions, "publish", publish)
    assert put(spark, path, [(2, "mine", 1)])["n_updated"] == 1
    assert rows_of(spark, path) == [(1, "other", 1), (2, "mine", 1)]
    assert versions.latest(spark, path).number == 3

    def always(spark, path, version):
        raise versions.ConflictError("again")

    monkeypatch.setattr(versions, "publish", always)
    with pytest.raises(versions.ConflictError):
        put(spark, path, [(2, "late", 1)], attempts=2)
    assert rows_of(spark, path) == [(1, "other", 1), (2, "mine", 1)]


def test_publish_refuses_a_taken_number(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(1, "a", 0)])
    v = versions.latest(spark, path)
    with pytest.raises(versions.ConflictError):
        versions.publish(spark, path, v)
    assert [f for f in os.listdir(f"{path}/_commits") if f.startswith(".draft")] == []


def test_a_version_is_readable_until_the_next_but_one(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, "a", 0) for i in range(50)])
    old = versions.read(spark, path)
    put(spark, path, [(3, "b", 0)])
    assert {r.v for r in old.collect()} == {"a"}
    assert sorted(r.v for r in versions.read(spark, path, version=1).where("k = 3").collect()) == ["a"]
    for i in range(3):
        put(spark, path, [(4, f"c{i}", 0)])
    on_disk = [f for d, _, fs in os.walk(f"{path}/_commits") for f in fs if f.endswith(".parquet") and "_commit=" in d]
    counted = {f for n in versions._numbers(spark, path) for f in versions.index_of(spark, path, versions._load(spark, path, n)).select("file").distinct().toPandas()["file"]}
    assert len(versions._numbers(spark, path)) == 2 and len(on_disk) <= len(counted) + 1


def test_a_small_batch_opens_candidate_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        put(spark, path, [(i, "a", i // 1000) for i in range(8000)])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    v = versions.latest(spark, path)
    names = versions.index_of(spark, path, v).select("file").distinct().count()
    assert names >= 8
    keys = spark.createDataFrame([(10,), (7990,), (9000,)], "k int")
    near = versions.candidates(spark, path, v, keys)
    assert len(near) == 2 and sorted(near) == sorted(versions.holding(spark, path, v, keys))
    assert versions.candidates(spark, path, v, keys.where("k = 9000")) == []
    assert files_read(versions.read(spark, path, files=near)) == 2
    before = {f for f in versions.files_where(spark, path, v, F.lit(True))}
    assert put(spark, path, [(10, "b", 0), (9000, "n", 9)]) == {"n_inserted": 1, "n_updated": 1, "n_affected": 2}
    after = {f for f in versions.files_where(spark, path, versions.latest(spark, path), F.lit(True))}
    assert len(before - after) == 1  # one file was written anew
    got = rows_of(spark, path)
    assert len(got) == 8001 and (10, "b", 0) in got and (9000, "n", 9) in got


def test_partition_filters_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, "a", i % 4) for i in range(100)])
    put(spark, path, [(i, "b", i % 4) for i in range(100, 120)])
    df = read_stored(spark, path).where("p = 2")
    assert files_read(df) < files_read(read_stored(spark, path))
    assert df.count() == 30


def test_a_plain_folder_becomes_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "a:b"), (2, "y", None)], "k int, v string, p string").write.partitionBy("p").parquet(path)
    assert put(spark, path, [(2, "z", "c")], "k int, v string, p string")["n_updated"] == 1
    assert rows_of(spark, path) == [(1, "x", "a:b"), (2, "z", "c")]
    assert not [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_commits" not in d]


def test_counts_by_unit_and_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k int, v string, p int, run string"
    schema = spark.createDataFrame([], DDL).schema
    up = lambda rows: upsert_table(spark, path, spark.createDataFrame(rows, ddl), ["k"], schema, ["p"], stamp_col=None, unit_col="run")
    assert up([(1, "a", 0, "u1"), (2, "a", 0, "u1"), (3, "a", 1, "u2")])["by_unit"] == {"u1": 2, "u2": 1}
    assert up([(1, "b", 0, "u3"), (9, "b", 0, "u4")]) == {"n_inserted": 1, "n_updated": 1, "n_affected": 2, "by_unit": {"u3": 1, "u4": 1}}
    assert up([(3, "c", 0, "u5")])["by_unit"] == {"u5": 1}
    changed = lambda since: sorted(r.k for r in versions.changes(spark, path, since).collect())
    assert changed(0) == [1, 2, 3, 9] and changed(1) == [1, 3, 9] and changed(2) == [3] and changed(3) == []


# --- incremental views --------------------------------------------------------

def view_of(src, dim):
    return unpack_view(src, "data", [("who", "int"), ("x", "double")], ["k", "p"], dim=dim, dim_key="id", dim_cols={"name": "full"}, join_field="who")


def test_refresh_follows_rows_and_names(spark, tmp_path, monkeypatch):
    src, dim, path = (str(tmp_path / n) for n in ("src", "dim", "view"))
    sddl, dddl = "k int, p int, data string", "id int, full string"

    def load(rows):
        upsert_table(spark, src, spark.createDataFrame(rows, sddl), ["k"], spark.createDataFrame([], sddl).schema, ["p"], stamp_col=None)

    def people(rows):
        upsert_table(spark, dim, spark.createDataFrame(rows, dddl), ["id"], spark.createDataFrame([], dddl).schema, stamp_col=None)

    def bring():
        done = refresh(spark, path, src, dim, view_of, ["k"], "id", "who", {"name": "full"}, ["p"], ["who", "k"])
        want = view_of(read_stored(spark, src), read_stored(spark, dim) if versions.latest(spark, dim) else spark.createDataFrame([], dddl))
        assert sorted(map(repr, read_stored(spark, path).collect())) == sorted(map(repr, want.collect()))
        return done

    def row(k, p, who):
        return (k, p, f'{{"who": {who}, "x": {k}.5}}')

    load([row(k, k % 3, k % 5) for k in range(60)])
    people([(i, f"n{i}") for i in range(4)])
    assert bring()["mode"] == "full"
    assert bring() == {"mode": "changes", "n_source": 0, "n_names": 0}
    number = versions.latest(spark, path).number
    load([row(5, 2, 1), row(70, None, 3)])
    assert bring() == {"mode": "changes", "n_source": 2, "n_names": 0}
    # a load that repeats names changes nothing; a new name changes its rows alone
    people([(i, f"n{i}") for i in range(3)])
    assert bring()["n_names"] == 0
    people([(1, "renamed"), (4, "at last"), (99, "nobody")])
    shown = read_stored(spark, path).where("who in (1, 4)").count()
    assert bring() == {"mode": "changes", "n_source": 0, "n_names": shown}
    changed = versions.changes(spark, path, number)
    assert changed.where("who not in (1, 4)").select("k").collect() == [(70,)]
    # both at once, and a partition that vanishes
    load([row(k, 2, 0) for k in range(60) if k % 3 == 1])
    people([(0, "zero")])
    bring()
    assert read_stored(spark, path).where("p = 1").isEmpty()


def test_partial_refresh_of_null_and_boolean_partitions(spark, tmp_path):
    path = str(tmp_path / "v")
    for kind, values in (("boolean", [True, False, None]), ("string", ["a:b", "x/../y", None])):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, p {kind}")
        where = f"{path}-{kind}"
        materialize(spark, rows, where, ["p"])
        for v in values:
            materialize(spark, rows.where("false"), where, ["p"], only_partitions=[v])
            assert not [r for r in read_stored(spark, where).collect() if r.p == v]
        assert read_stored(spark, where).isEmpty()


def test_the_batch_is_read_once(spark, tmp_path):
    """A source that answers differently each time must not be merged half one way, half the other."""
    path = str(tmp_path / "t")
    df = spark.range(200).select(F.col("id").cast("int").alias("k"), F.uuid().alias("v"), (F.rand() * 5).cast("int").alias("p"))
    upsert_table(spark, path, df, ["k"], spark.createDataFrame([], DDL).schema, ["p"], stamp_col=None)
    assert len(rows_of(spark, path)) == 200 and merge.read_stored(spark, path).select("k").distinct().count() == 200


# --- layout upkeep and repeated batches ------------------------------------------

def test_compaction_merges_small_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        put(spark, path, [(10 * i + j, f"v{i}", j % 2) for j in range(10)])
    before, feed = rows_of(spark, path), sorted((r.k, r._changed) for r in versions.changes(spark, path, 0).collect())
    files = lambda: versions.files_where(spark, path, versions.latest(spark, path), F.lit(True))
    many = len(files())
    assert many >= 10 and versions.compact(spark, path, target_rows=1000) == many
    assert len(files()) == 2 and rows_of(spark, path) == before
    assert sorted((r.k, r._changed) for r in versions.changes(spark, path, 0).collect()) == feed
    assert versions.compact(spark, path, target_rows=1000) == 0  # one file a partition: nothing to merge
    assert files_read(read_stored(spark, path).where("p = 1")) == 1
    put(spark, path, [(3, "new", 1)])
    assert (3, "new", 1) in rows_of(spark, path) and len(rows_of(spark, path)) == 50
    put(spark, str(tmp_path / "big"), [(i, "x", 0) for i in range(100)])
    assert versions.compact(spark, str(tmp_path / "big"), target_rows=50) == 0


def test_a_batch_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = put(spark, path, [(1, "a", 0), (2, "a", 0)], once=("s", 0))
    assert put(spark, path, [(1, "a", 0), (2, "a", 0)], once=("s", 0)) == first
    assert versions.latest(spark, path).number == 1
    assert put(spark, path, [(2, "b", 0), (3, "b", 0)], once=("s", 1)) == {"n_inserted": 1, "n_updated": 1, "n_affected": 2}
    assert put(spark, path, [(9, "z", 0)], once=("other", 0))["n_inserted"] == 1
    assert put(spark, path, [(8, "z", 0)], once=("s", 0))["n_affected"] == 2  # an older batch, long taken
    assert [r[0] for r in rows_of(spark, path)] == [1, 2, 3, 9]


def test_a_stream_that_dies_after_its_write_counts_each_row_once(spark, tmp_path, monkeypatch):
    from pitchlake.schemas import TableSpec
    from pitchlake.streaming import incremental

    land, path, spec = tmp_path / "land", str(tmp_path / "t"), TableSpec("t", "k INT, v STRING", ("k",))
    land.mkdir()
    for i in range(3):
        (land / f"{i}.json").write_text("\n".join(f'{{"k": {10 * i + j}, "v": "x"}}' for j in range(5)))
    schema = spark.createDataFrame([], "k int, v string").schema
    real, calls = incremental.upsert_table, []

    def dying(*a, **kw):
        out = real(*a, **kw)
        calls.append(kw["once"])
        if len(calls) == 2:
            raise RuntimeError("executor host lost")
        return out

    monkeypatch.setattr(incremental, "upsert_table", dying)
    with pytest.raises(Exception):
        incremental.stream_upsert(spark, str(land), schema, path, spec, max_files_per_trigger=1)
    monkeypatch.setattr(incremental, "upsert_table", real)
    rest = incremental.stream_upsert(spark, str(land), schema, path, spec, max_files_per_trigger=1)
    # the batch that had arrived is counted by the run that finished it, and is not merged again
    assert rest == {"n_inserted": 10, "n_updated": 0, "n_affected": 10, "batches": 2}
    assert read_stored(spark, path).count() == 15 and versions.latest(spark, path).number == 3
