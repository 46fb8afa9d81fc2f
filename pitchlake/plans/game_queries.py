"""Play-by-play, typed payload and view refresh on the driver tables.

An order is a game. Its lines, in a total order, are the play events, two to a
plate appearance; the first two plate appearances are the top half. The nested
documents and boxscores are written as JSON, read back by their readers, lineups
extracted and games flattened; the SQL computes the same rows from the flat tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.payload import bad_value_counts, pack_json, to_variant, unpack
from pitchlake.operators.nested import flatten_games, prepare_games, starting_lineup
from pitchlake.operators.merge import read_stored
from pitchlake.operators.views import materialize, unpack_view
from pitchlake.session import Tables, scratch_path
from pitchlake.sources.landed import read_boxscore, read_game_feed

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
STARTERS = (2, 3, 4)
#: Landed documents are text that repeats its field names, and a compressed file is read by one task.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 100_000}


def _play_event(game: Column, line: Column, i: Column) -> Column:
    """The play event of line ``i`` (from 0) of a game."""
    code = lambda c: F.struct(c.cast("string").alias("code"))
    return F.struct(
        F.when(line.l_quantity <= 40, F.concat_ws("-", game, i)).alias("playId"),
        i.alias("index"),
        (i + 1).alias("pitchNumber"),
        F.when(line.l_returnflag != "N", "pitch").when(line.l_linestatus == "F", "pickoff").otherwise("action").alias("type"),
        (line.l_partkey % 5 == 0).alias("isSubstitution"),
        F.struct(line.l_partkey.alias("id")).alias("player"),
        code(line.l_suppkey % 9 + 2).alias("position"),
        F.struct(
            F.when(line.l_suppkey % 4 != 0, line.l_suppkey % 3).alias("outs"),
            (line.l_partkey % 4).alias("balls"), (line.l_suppkey % 3).alias("strikes"),
        ).alias("count"),
        F.struct(code(line.l_returnflag).alias("type")).alias("details"),
        F.struct(F.struct(line.l_extendedprice.alias("aX")).alias("coordinates")).alias("pitchData"),
        F.struct(line.l_discount.alias("launchSpeed")).alias("hitData"),
    )


def _runner(line: Column, i: Column) -> Column:
    """The runner movement on the play event of line ``i``."""
    return F.struct(
        F.struct(
            F.when(line.l_partkey % 2 == 1, "1B").alias("start"),
            F.element_at(F.array(*map(F.lit, ("1B", "2B", "score", "3B"))), (line.l_suppkey % 4 + 1).cast("int")).alias("end"),
            (line.l_linestatus == "F").alias("isOut"),
        ).alias("movement"),
        F.struct(
            F.when(line.l_quantity < 10, "stolen_base_2b").when(line.l_quantity < 20, "caught_stealing_2b").alias("eventType"),
            F.struct(line.l_partkey.alias("id")).alias("runner"), i.alias("playIndex"),
        ).alias("details"),
    )


def game_documents(lineitem: DataFrame) -> DataFrame:
    """One nested document for each order, from all its lines."""
    lines = lineitem.groupBy(F.col("l_orderkey").cast("string").alias("game_id")).agg(
        F.sort_array(F.collect_list(F.struct(*LINE_ORDER))).alias("lines"))
    both = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 2).cast("int"))

    def own_lines(pa: Column) -> Column:
        return F.transform(F.slice("lines", 2 * pa + 1, 2), lambda x, k: F.struct(x.alias("line"), (2 * pa + k).alias("i")))

    def appearance(own: Column, pa: Column) -> Column:
        first, last = F.get(own, 0)["line"], F.element_at(own, -1)["line"]
        return F.struct(
            F.struct(pa.alias("atBatIndex"), F.lit(1).alias("inning"), F.when(pa < 2, "top").otherwise("bottom").alias("halfInning")).alias("about"),
            F.struct(F.struct(first.l_suppkey.alias("id")).alias("batter"), F.struct(first.l_partkey.alias("id")).alias("pitcher")).alias("matchup"),
            F.struct(last.l_returnflag.alias("event"), (last.l_linestatus == "F").alias("isOut")).alias("result"),
            F.transform(own, lambda x: _runner(x.line, x.i)).alias("runners"),
            F.transform(own, lambda x: _play_event(F.col("game_id"), x.line, x.i)).alias("playEvents"),
        )

    # a lambda's variable is worked out once, an expression in its body at each mention
    plays = F.transform(F.transform(both, own_lines), appearance).alias("allPlays")
    return lines.select("game_id", F.struct(F.struct(plays).alias("plays")).alias("liveData"))


def boxscore_documents(orders: DataFrame) -> DataFrame:
    """One boxscore for each order: both teams start the customer's number plus the
    position at positions 2 to 4; a pitcher and a substitute aren't starters."""
    first = F.col("o_custkey").cast("int")

    def player(who: Column, order: str | None, *positions: int) -> Column:
        listed = F.array(*[F.struct(F.lit(str(p)).alias("code")) for p in positions])
        return F.struct(F.struct(who.alias("id")).alias("person"), F.lit(order).cast("string").alias("battingOrder"), listed.alias("allPositions"))

    people = {f"ID{q}": player(first + q, f"{q}00", q, 10) for q in STARTERS}
    people |= {"ID1": player(first + 1, None, 1), "ID77": player(first + 77, "301", 2), "ID78": player(first + 78, "900", 11)}
    team = F.struct(F.create_map(*[x for k, p in people.items() for x in (F.lit(k), p)]).alias("players"))
    return orders.select(F.col("o_orderkey").cast("string").alias("game_id"), F.struct(team.alias("home"), team.alias("away")).alias("teams"))


def _flattened(spark: SparkSession, sf: str, *frames: str) -> dict[str, DataFrame]:
    t = Tables(spark, sf)
    landed = scratch_path(spark, "game-documents")
    game_documents(t.lineitem).write.options(**LANDED).json(landed)
    years = t.orders.select(F.col("o_orderkey").cast("string").alias("game_id"), F.year("o_orderdate").alias("year"))
    boxes = scratch_path(spark, "game-boxscores")
    boxscore_documents(t.orders).write.options(**LANDED).json(boxes)
    lineup = starting_lineup(prepare_games(read_boxscore(spark, boxes, multiline=False)))
    feed = read_game_feed(spark, landed, multiline=False)
    games, out = prepare_games(feed), {}
    for frame in frames:  # where no game has copies, each frame reads its own fields only
        own = read_game_feed(spark, landed, multiline=False, frame=frame) if games is feed else games
        out |= flatten_games(own, lineup, years, prepared=True, frames=[frame])
    return out


def q_game_events(spark, sf):
    return _flattened(spark, sf, "event")["event"].drop("bat_side", "pitch_hand")


def q_game_pitches(spark, sf):
    return _flattened(spark, sf, "pitch")["pitch"].select(
        "play_id", "game_id", "event_index", "play_index", "year", "pitch_number", "outs", "balls", "strikes", "pitch_type", "ax", "launch_speed")


PLAY_COLUMNS = [
    "play_id", "game_id", "event_index", "play_index", "year", "pitch_number", *[f"{w}_runner_{b}_id" for w in ("pre", "post") for b in ("1b", "2b", "3b")],
    "pre_outs", "pre_balls", "pre_strikes", "post_outs", "post_balls", "post_strikes", "runs_on_play", "type",
    "is_stolen_base", "is_caught_stealing", "is_pickoff",
]


def q_game_plays(spark, sf):
    return _flattened(spark, sf, "play")["play"].select(*PLAY_COLUMNS)


def q_half_runs(spark, sf):
    """Runs of each half-inning by its events and by its identified plays."""
    out = _flattened(spark, sf, "event", "play")
    plays = out["play"].groupBy("game_id", "event_index").agg(F.sum("runs_on_play").alias("p"), F.count(F.lit(1)).alias("n"))
    both = out["event"].select("game_id", "event_index", "half_inning", "runs_on_event").join(plays, ["game_id", "event_index"], "left")
    return both.groupBy("game_id", "half_inning").agg(
        F.sum("runs_on_event").alias("event_runs"), F.sum("p").alias("play_runs"), F.coalesce(F.sum("n"), F.lit(0)).alias("plays"))


# --- typed payload ------------------------------------------------------------

WIDE_SPEC = [("qty", "numeric"), ("line", "int"), ("ship", "date"), ("flag", "text"), ("part", "bigint"), ("price", "numeric"), ("open", "boolean")]


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their part, packed; some values padded, null or wrong by rule."""
    t = Tables(spark, sf)
    li = t.lineitem.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"), "left")
    number = F.col("l_quantity").cast("string")
    return pack_json(li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("  "), number, F.lit(" "))).when(F.col("l_linenumber") != 2, number).alias("qty"),
        F.when(F.col("l_quantity") > 40, "5.0").otherwise(F.col("l_linenumber").cast("string")).alias("line"),
        F.when(F.col("l_partkey") % 7 == 0, "1997-02-30").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship"),
        F.col("l_returnflag").alias("flag"), F.col("l_partkey").alias("part"), F.col("p_retailprice").alias("price"),
        (F.col("l_linestatus") == "O").alias("open"),
    ), ["l_orderkey", "l_linenumber"])


def q_payload_typed(spark, sf):
    return unpack(_wide(spark, sf), "data", WIDE_SPEC, ["l_orderkey", "l_linenumber"])


def q_payload_typed_variant(spark, sf):
    wide = _wide(spark, sf).withColumn("data", to_variant(F.col("data")))
    return unpack(wide, "data", WIDE_SPEC, ["l_orderkey", "l_linenumber"])


def q_payload_bad_values(spark, sf):
    return bad_value_counts(_wide(spark, sf), "data", WIDE_SPEC)


# --- view refresh ---------------------------------------------------------------

def q_view_refresh(spark, sf):
    """A stored view, refreshed in whole after one partition has gone and some
    names have changed, then read back."""
    t = Tables(spark, sf)
    renamed = t.customer.withColumn("c_name", F.when(F.col("c_custkey") % 10 == 0, F.upper("c_name")).otherwise(F.col("c_name")))
    path = scratch_path(spark, "view-refresh")
    for events, names in ((t.events, t.customer), (t.events.filter(F.col("event_type") != "error"), renamed)):
        view = unpack_view(events, "props", [("k", "int")], ["event_id", "event_type", "user_id"], dim=names,
                           dim_key="c_custkey", dim_cols={"customer_name": "c_name"}, join_field="k")
        materialize(spark, view, path, partition_by=("event_type",), sort_within=("user_id", "event_id"))
    return read_stored(spark, path)


GAME_QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_")}

# --- the same rows in SQL -------------------------------------------------------

_LINES = f"""
WITH numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) - 1 AS INTEGER) AS i FROM lineitem),
plays AS (
  SELECT l.*, CAST(l_orderkey AS VARCHAR) AS game_id, i // 2 AS pa, CASE WHEN i < 4 THEN 'top' ELSE 'bottom' END AS half,
         CAST(l_partkey AS INTEGER) AS player, CAST(l_suppkey AS INTEGER) AS supplier,
         CASE WHEN l_quantity <= 40 THEN concat(l_orderkey, '-', i) END AS play_id,
         CASE WHEN l_returnflag <> 'N' THEN 'pitch' WHEN l_linestatus = 'F' THEN 'pickoff' ELSE 'action' END AS type,
         CASE WHEN l_suppkey % 4 <> 0 THEN CAST(l_suppkey % 3 AS INTEGER) END AS outs,
         CAST(l_partkey % 4 AS INTEGER) AS balls, CAST(l_suppkey % 3 AS INTEGER) AS strikes,
         CAST(o_custkey AS INTEGER) AS custkey, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM numbered l LEFT JOIN orders ON o_orderkey = l_orderkey)"""

_EVENTS = ", ".join(
    f"""CASE WHEN pa = min(pa) OVER (PARTITION BY game_id, half) AND custkey IS NOT NULL THEN custkey + {q} ELSE sub_{q} END AS merged_{q}""" for q in STARTERS)
_SUBS = ", ".join(f"min_by(player, i) FILTER (WHERE l_partkey % 5 = 0 AND l_suppkey % 9 + 2 = {q}) AS sub_{q}" for q in STARTERS)
_FIELDERS = ", ".join(
    f"""last_value(merged_{q} IGNORE NULLS) OVER (PARTITION BY game_id, half ORDER BY pa ROWS UNBOUNDED PRECEDING) AS fielder_{q}_id"""
    if q in STARTERS else f"CAST(NULL AS INTEGER) AS fielder_{q}_id" for q in range(2, 11))

_BASE_CHANGE = ", ".join(
    f"""CASE WHEN l_suppkey % 4 = {end} AND l_linestatus <> 'F' THEN player{" WHEN l_partkey % 2 = 1 THEN -1" if base == "1b" else ""} END AS chg_{base}"""
    for base, end in (("1b", 0), ("2b", 1), ("3b", 3)))
_HALF = "OVER (PARTITION BY game_id, half ORDER BY i ROWS UNBOUNDED PRECEDING)"
_POST = ", ".join(f"nullif(last_value(chg_{b} IGNORE NULLS) {_HALF}, -1) AS post_runner_{b}_id" for b in ("1b", "2b", "3b"))
_PRE = ", ".join(f"lag(post_runner_{b}_id) OVER (PARTITION BY game_id, half ORDER BY i) AS pre_runner_{b}_id" for b in ("1b", "2b", "3b"))

GAME_SQL = {
    "game_events": f"""{_LINES},
grouped AS (
  SELECT game_id, half, pa, any_value(year) AS year, any_value(custkey) AS custkey, min_by(supplier, i) AS batter_id, min_by(player, i) AS pitcher_id,
         max_by(l_returnflag, i) AS event, max_by(l_linestatus, i) = 'F' AS is_out,
         CAST(count(*) FILTER (WHERE l_suppkey % 4 = 2) AS INTEGER) AS runs_on_event, {_SUBS}
  FROM plays GROUP BY game_id, half, pa),
merged AS (SELECT *, {_EVENTS} FROM grouped)
SELECT game_id, pa AS event_index, year, 1 AS inning, half AS half_inning, batter_id, pitcher_id, event, is_out, runs_on_event, {_FIELDERS}
FROM merged""",
    "game_pitches": f"""{_LINES},
counted AS (
  SELECT *, lag(balls, 1, 0) OVER w AS pre_balls, lag(strikes, 1, 0) OVER w AS pre_strikes FROM plays WINDOW w AS (PARTITION BY game_id, pa ORDER BY i))
SELECT play_id, game_id, pa AS event_index, i AS play_index, year, i + 1 AS pitch_number, outs, pre_balls AS balls, pre_strikes AS strikes,
       l_returnflag AS pitch_type, l_extendedprice AS ax, l_discount AS launch_speed
FROM counted WHERE type = 'pitch'""",
    "game_plays": f"""{_LINES},
changed AS (
  SELECT *, {_BASE_CHANGE}, lag(balls, 1, 0) OVER w AS pre_balls, lag(strikes, 1, 0) OVER w AS pre_strikes,
         CAST(l_suppkey % 4 = 2 AS INTEGER) AS runs_on_play
  FROM plays WINDOW w AS (PARTITION BY game_id, pa ORDER BY i)),
after AS (SELECT *, {_POST}, coalesce(last_value(outs IGNORE NULLS) {_HALF}, 0) AS post_outs,
                 least(count(play_id) OVER (PARTITION BY game_id, half ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       count(play_id) OVER (PARTITION BY game_id, half) - 1) AS nxt FROM changed),
states AS (
  SELECT * REPLACE (CAST(sum(runs_on_play) OVER n AS INTEGER) AS runs_on_play), {_PRE}, lag(post_outs, 1, 0) OVER (PARTITION BY game_id, half ORDER BY i) AS pre_outs, balls AS post_balls, strikes AS post_strikes,
         bool_or(l_quantity < 10) OVER n AS is_stolen_base, bool_or(l_quantity >= 10 AND l_quantity < 20) OVER n AS is_caught_stealing,
         bool_or(type = 'pickoff') OVER n AS is_pickoff, pa AS event_index, i AS play_index, i + 1 AS pitch_number
  FROM after WINDOW n AS (PARTITION BY game_id, half, nxt))
SELECT {", ".join(PLAY_COLUMNS)} FROM states WHERE play_id IS NOT NULL""",
    # from the lines alone: no plate appearances, movements or play ids in between
    "half_runs": """
SELECT CAST(l_orderkey AS VARCHAR) AS game_id, CASE WHEN i < 4 THEN 'top' ELSE 'bottom' END AS half_inning,
       count(*) FILTER (WHERE l_suppkey % 4 = 2) AS event_runs,
       CASE WHEN count(*) FILTER (WHERE l_quantity <= 40) > 0 THEN count(*) FILTER (WHERE l_suppkey % 4 = 2) END AS play_runs,
       count(*) FILTER (WHERE l_quantity <= 40) AS plays
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus) - 1 AS i
      FROM lineitem)
GROUP BY 1, 2""",
    "payload_typed": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 2 THEN l_quantity END AS qty,
       CASE WHEN l_quantity <= 40 THEN l_linenumber END AS line,
       CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END AS ship,
       l_returnflag AS flag, l_partkey AS part, p_retailprice AS price, l_linestatus = 'O' AS open
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "payload_bad_values": """
SELECT CAST(0 AS BIGINT) AS qty, count(*) FILTER (WHERE l_quantity > 40) AS line, count(*) FILTER (WHERE l_partkey % 7 = 0) AS ship,
       CAST(0 AS BIGINT) AS flag, CAST(0 AS BIGINT) AS part, CAST(0 AS BIGINT) AS price, CAST(0 AS BIGINT) AS open
FROM lineitem""",
    "view_refresh": """
SELECT event_id, event_type, user_id, TRY_CAST(props->>'k' AS INTEGER) AS k,
       CASE WHEN c_custkey % 10 = 0 THEN upper(c_name) ELSE c_name END AS customer_name
FROM events LEFT JOIN customer ON c_custkey = TRY_CAST(props->>'k' AS INTEGER)
WHERE event_type <> 'error'""",
}
GAME_SQL["payload_typed_variant"] = GAME_SQL["payload_typed"]
