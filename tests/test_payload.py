"""Pack / unpack and the payload view (FIXTURES section D samples)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.merge import read_stored
from pitchlake.functions.columns import coerce_to_schema, conform, rename_keep, require_columns, select_tolerant, MissingColumnsError
from pitchlake.functions.payload import bad_value_counts, pack_json, unpack
from pitchlake.operators.views import materialize, statcast_view
from pitchlake.schemas import PAYLOAD_SPEC_TEXT, PLAYER, STATCAST, payload_spec
from pitchlake.sources.landed import prepare_payload, season_summaries


def test_spec_sizes():
    full, core = payload_spec("full"), payload_spec("core")
    assert len(full) == 107 and len(core) == 72
    kinds = [t for _, t in full]
    assert (kinds.count("numeric"), kinds.count("int"), kinds.count("date"), kinds.count("text")) == (53, 37, 1, 16)
    assert len(PAYLOAD_SPEC_TEXT.strip().splitlines()) == 107


def _statcast(spark):
    samples = [
        {"pitcher_id": 605, "release_speed": 95.1, "pitch_type": "FF", "balls": 1, "game_date": "2024-04-01"},
        {"pitcher_id": "606", "release_speed": "94.2", "balls": "2"},
        {"pitcher_id": 605, "release_speed": " 95.1", "balls": "  3"},
        {"pitcher_id": 605, "release_speed": None},
        {"pitcher_id": 605},
        {"pitcher_id": 605, "release_speed": "fast"},
        {"pitcher_id": 605, "balls": "5.0"},
    ]
    rows = [(1, 1, i + 1, 2024, json.dumps(s), None) for i, s in enumerate(samples)]
    rows += [(1, 1, 8, 2024, "{bad json", None), (1, 1, 9, 2024, None, None)]
    return spark.createDataFrame(rows, STATCAST.ddl)


def _players(spark):
    return spark.createDataFrame(
        [(605, "Pitcher One", "One", "Pitcher", None, None, None, "L", None, None, "P", None)], PLAYER.ddl
    )


def test_view_widths(spark):
    sc, pl = _statcast(spark), _players(spark)
    full = statcast_view(sc, pl)
    core = statcast_view(sc, pl, profile="core")
    assert len(full.columns) == 113 and len(core.columns) == 78
    assert set(core.columns) < set(full.columns)
    i = full.columns.index("batter_name")
    assert full.columns[i + 1] == "pitcher_name"


def test_lenient_values(spark):
    v = statcast_view(_statcast(spark), _players(spark)).orderBy("pitch_number")
    got = [(r.pitch_number, r.release_speed, r.balls, r.pitcher_id, r.pitcher_name) for r in v.collect()]
    assert got == [
        (1, 95.1, 1, 605, "Pitcher One"),
        (2, 94.2, 2, 606, None),
        (3, 95.1, 3, 605, "Pitcher One"),
        (4, None, None, 605, "Pitcher One"),
        (5, None, None, 605, "Pitcher One"),
        (6, None, None, 605, "Pitcher One"),
        (7, None, None, 605, "Pitcher One"),  # '5.0' is not an integer (lenient: NULL)
        (8, None, None, None, None),
        (9, None, None, None, None),
    ]
    first = v.filter("pitch_number = 1").collect()[0]
    assert first.game_date == dt.date(2024, 4, 1) and first.pitch_type == "FF"


def test_bad_value_counts_and_strict(spark):
    sc = _statcast(spark)
    bad = bad_value_counts(sc, "data", [("release_speed", "numeric"), ("balls", "int")]).collect()[0]
    assert (bad.release_speed, bad.balls) == (1, 1)
    strict = statcast_view(sc, None, cols=["release_speed"], with_names=False, strict=True)
    with pytest.raises(Exception):
        strict.collect()


def test_selected_columns_only(spark):
    v = statcast_view(_statcast(spark), _players(spark), cols=["release_speed", "pitch_type"])
    assert v.columns == ["game_pk", "at_bat_number", "pitch_number", "year", "scraped_at", "pitcher_id", "pitch_type", "release_speed", "pitcher_name"]


def test_pack_unpack_identity(spark):
    df = spark.createDataFrame(
        [(1, 2, "a b", 1.5, dt.date(2024, 1, 2), None), (3, 4, None, -0.25, None, 7)],
        "game_pk INT, pitch_number INT, s STRING, x DOUBLE, d DATE, n INT",
    )
    packed = pack_json(df, ["game_pk", "pitch_number"])
    assert packed.columns == ["game_pk", "pitch_number", "data"]
    assert '"s":null' in packed.orderBy("game_pk").collect()[1].data  # NULLs kept as JSON null
    back = unpack(packed, "data", [("s", "text"), ("x", "numeric"), ("d", "date"), ("n", "int")], keep=["game_pk", "pitch_number"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "game_id INT, name STRING")
    assert select_tolerant(df, ["name", "nope", "game_id"]).columns == ["name", "game_id"]
    assert rename_keep(df, {"game_id": "gid", "zzz": "q"}).columns == ["gid"]
    assert prepare_payload(spark.createDataFrame([(1, 2, 3)], "game_id INT, at_bat_number INT, pitch_number INT")).columns[0] == "game_pk"
    with pytest.raises(MissingColumnsError, match="at_bat_number, pitch_number"):
        require_columns(df, ["game_id", "at_bat_number", "pitch_number"])
    text = spark.createDataFrame([(" 95.1", "  3", "TRUE", "2024-01-02", "oops")], "a STRING, b STRING, c STRING, d STRING, e STRING")
    target = spark.createDataFrame([], "a DOUBLE, b INT, c BOOLEAN, d DATE, e INT").schema
    r = coerce_to_schema(text, target, bad_counts=True).collect()[0]
    assert (r.a, r.b, r.c, r.d, r.e, r._bad_values) == (95.1, 3, True, dt.date(2024, 1, 2), None, 1)
    c = conform(text.select("b", "a"), spark.createDataFrame([], "a DOUBLE, z STRING, b INT").schema)
    assert c.columns == ["a", "z", "b"] and c.collect()[0].z is None


def test_season_summaries_union(spark):
    h = spark.createDataFrame([(2024, "MLB", 1, 0.3)], "year INT, level STRING, player_id INT, avg DOUBLE")
    p = spark.createDataFrame([(2024, "MLB", 2, 3.1)], "year INT, level STRING, player_id INT, era DOUBLE")
    u = season_summaries({"hitting": h, "pitching": p})
    rows = {(r.player_id, r.position_type, r.avg, r.era) for r in u.collect()}
    assert rows == {(1, "hitting", 0.3, None), (2, "pitching", None, 3.1)}


def test_materialize_incremental(spark, tmp_path):
    sc = _statcast(spark).withColumn("year", F.when(F.col("pitch_number") <= 4, 2023).otherwise(2024))
    v = statcast_view(sc, _players(spark), profile="core")
    path = str(tmp_path / "mv")
    materialize(spark, v, path, sort_within=["game_pk", "at_bat_number", "pitch_number"])
    assert read_stored(spark, path).count() == 9
    # refresh only 2024 from a changed source: 2023 stays as it was
    changed = sc.filter(F.col("year") == 2024).filter("pitch_number <= 6")
    materialize(spark, statcast_view(changed, _players(spark), profile="core"), path, only_partitions=[2024])
    out = read_stored(spark, path)
    assert out.filter("year = 2023").count() == 4 and out.filter("year = 2024").count() == 2


def test_materialize_drops_vanished_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(y, m, i) for i, (y, m) in enumerate([(2023, 1), (2023, 2), (2024, 1), (2024, 2)])], "year INT, month INT, n INT")
    path, parts = str(tmp_path / "mv"), ("year", "month")
    read = lambda: sorted(tuple(r) for r in read_stored(spark, path).select("year", "month", "n").collect())
    materialize(spark, rows, path, parts)
    # some years: what they no longer hold goes, other years stay
    materialize(spark, rows.filter("year = 2023 or month = 2").withColumn("n", F.col("n") + 10), path, parts, only_partitions=[2024])
    assert read() == [(2023, 1, 0), (2023, 2, 1), (2024, 2, 13)]
    # a write that fails changes nothing
    with pytest.raises(Exception):
        materialize(spark, rows.withColumn("n", F.raise_error(F.lit("no")).cast("int")), path, parts)
    assert len(read()) == 3
    # in whole, also from the stored view itself
    materialize(spark, read_stored(spark, path).filter("month = 2"), path, parts)
    assert read() == [(2023, 2, 1), (2024, 2, 13)]
    assert [f.name for f in tmp_path.iterdir()] == ["mv"]


def test_variant_payload_matches_text(spark, tmp_path):
    from pitchlake.functions.payload import to_variant

    sc = _statcast(spark)
    path = str(tmp_path / "sc_variant")
    sc.withColumn("data", to_variant(F.col("data"))).write.parquet(path)
    stored = read_stored(spark, path)
    assert dict(stored.dtypes)["data"] == "variant"
    a = statcast_view(sc, _players(spark)).drop("scraped_at")
    b = statcast_view(stored, _players(spark)).drop("scraped_at")
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_table_helpers(spark, tmp_path):
    from pitchlake.schemas import EVENT, TABLES
    from pitchlake.sources.landed import ensure_tables, prepare_player, read_table, register_view, write_table

    wh = str(tmp_path / "wh")
    assert sorted(ensure_tables(spark, wh)) == sorted(TABLES)
    assert ensure_tables(spark, wh) == []  # idempotent
    ev = read_table(spark, wh, "statsapi_event")
    assert ev.count() == 0 and set(ev.columns) == set(EVENT.columns)

    rows = [("g%d" % i, i % 5, 2023 + i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "game_id STRING, event_index INT, year INT")
    write_table(df, EVENT, str(tmp_path / "ev"))
    back = spark.read.parquet(str(tmp_path / "ev"))
    assert back.count() == 40 and {r.year for r in back.select("year").distinct().collect()} == {2023, 2024}

    with pytest.raises(MissingColumnsError):
        prepare_player(spark.createDataFrame([("x",)], "name_full STRING"))
    p = prepare_player(spark.createDataFrame([(1, ["MLB", "AAA"])], "player_id INT, levels ARRAY<STRING>"))
    assert p.collect()[0].levels == "MLB,AAA"

    register_view(df, "ev_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM ev_view").collect()[0].n == 40
