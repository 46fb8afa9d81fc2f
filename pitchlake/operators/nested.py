"""Play-by-play flattening: one live-feed document per game -> event, pitch and
play tables, plus fielding lineups and base-out state.

Physical plan
-------------
* Documents are deduplicated on ``game_id`` first (a game landed twice must not
  double its rows). That compares ids only: a document whose game landed once stays
  where it is, and no document is shuffled. What travels is one compact row for each
  plate appearance or play event, hash-partitioned on ``game_id`` once; later windows,
  aggregates and joins are keyed by ``game_id`` (plus more columns) and reuse that. With
  ``cut_lineage`` the documents are checkpointed once for all three outputs.
* A plate appearance arrives as one row holding its ``playEvents`` array, so the
  per-plate-appearance steps (fill down the disengagement count, previous
  balls/strikes, first fielder credited) are higher-order array functions on that
  row: no shuffle and no window at all.
* The starting lineup is one row per game with a column for each half and position, joined
  to the compact rows of plate appearances, which bring the substitutions among their own
  play events: all positions are carried forward in one window per (game, half), a row for
  each event, on the game partitioning. Base-out state
  runs as a window per game half. Both groups are bounded by a game's length.

Output columns follow the stored table layouts in ``schemas.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions.columns import select_tolerant
from pitchlake.schemas import EVENT, FIELDING_POSITIONS, PITCH, PLAY
from pitchlake.session import checkpoint_dir

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow

# --- Fixed values: feed codes used by the flattening ---
PITCH_TYPE = "pitch"
PICKOFF_TYPE = "pickoff"
TOP, BOTTOM = "top", "bottom"
SCORE = "score"
BASES = (("1b", "1B"), ("2b", "2B"), ("3b", "3B"))
OUTS_OF_HALF = 3
STOLEN_BASE_PREFIX = "stolen_base"
CAUGHT_STEALING_PREFIX = "caught_stealing"
PICKOFF_PREFIX = "pickoff"
# Sentinel for "base emptied" while carrying runner ids forward.
_EMPTIED = -1
# Ids of games with several copies that are broadcast.
_COPIED_GAMES = 100_000


def prepare_games(feed: DataFrame) -> DataFrame:
    """One document per ``game_id`` (the last landed copy wins when a
    ``landed_at`` column exists, otherwise any copy).

    Ids are counted first. Documents of games that landed once stay where they are; only
    copies of a game meet (all documents do where very many games have copies)."""
    many = feed.groupBy("game_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("game_id").alias("_g"))
    n = many.limit(_COPIED_GAMES + 1).count()
    if not n:
        return feed
    if n > _COPIED_GAMES:
        return _last_copies(feed)
    copied = F.col("game_id").eqNullSafe(F.col("_g"))
    many = F.broadcast(many)
    return feed.join(many, copied, "left_anti").unionByName(_last_copies(feed.join(many, copied, "left_semi")))


def _last_copies(feed: DataFrame) -> DataFrame:
    if "landed_at" not in feed.columns:
        return feed.dropDuplicates(["game_id"])
    rest = [c for c in feed.columns if c != "game_id"]
    return feed.groupBy("game_id").agg(F.max_by(F.struct(*rest), F.col("landed_at")).alias("_d")).select(
        "game_id", *[F.col("_d").getField(c).alias(c) for c in rest]
    )


def _by_game(df: DataFrame, num_partitions: int | None) -> DataFrame:
    return df.repartition(num_partitions, "game_id") if num_partitions else df.repartition("game_id")


def newest_documents(docs: DataFrame, row_col: str) -> DataFrame:
    """The last landed copy of each game (``landed_at``, then ``row_col``, a number of
    its own per row). The choice is made on those columns alone: documents stay
    where they are, and where every game has one copy, nothing else is read."""
    copies = docs.groupBy("game_id").agg(F.max(F.struct("landed_at", row_col)).alias("_l"), F.count(F.lit(1)).alias("_n"))
    if copies.where("_n > 1").isEmpty():
        return docs
    return docs.join(copies.select(F.col(f"_l.{row_col}").alias(row_col)), row_col, "left_semi")


def _carry(df: DataFrame) -> list[str]:
    """Per-game columns carried onto every row when present (``year`` from the
    landed partition or schedule)."""
    return [c for c in ("year",) if c in df.columns]


def plate_appearances(games: DataFrame, first_of_half: bool = False) -> DataFrame:
    """One row per ``allPlays`` element, keeping the element as struct ``p``.

    With ``first_of_half`` each row also gets the index of the first event of each
    half, computed from the game's own play array (no window)."""
    plays = F.col("liveData.plays.allPlays")
    extra = [
        F.array_min(
            F.transform(F.filter(plays, _in_half(h)), lambda q: q["about"]["atBatIndex"])
        ).alias(f"_first_{h}")
        for h in (TOP, BOTTOM)
    ]
    return games.select("game_id", *_carry(games), *(extra if first_of_half else []), F.posexplode(plays).alias("pa_pos", "p"))


def _in_half(half: str):
    def pred(q: Column) -> Column:
        return q["about"]["halfInning"] == half

    return pred


def _runners(p: Column) -> Column:
    return F.coalesce(p["runners"], F.array())


def event_rows(pa: DataFrame, for_fielders: bool = False) -> DataFrame:
    """Per plate appearance: identifiers, matchup, result, runs scored (runners
    whose movement ends at home) and the first fielder credited (not stored).
    ``for_fielders`` adds the columns ``with_fielders`` needs."""
    p = F.col("p")
    credits = F.flatten(F.transform(_runners(p), lambda r: F.coalesce(r["credit"], F.array())))
    half = p["about"]["halfInning"]
    fielder_cols = [
        _substitutions(F.coalesce(p["playEvents"], F.array())).alias("_subs"),
        (p["about"]["atBatIndex"] == F.when(half == TOP, F.col(f"_first_{TOP}")).when(half == BOTTOM, F.col(f"_first_{BOTTOM}"))).alias("_starts"),
    ] if for_fielders else []
    return pa.select(
        *fielder_cols,
        "game_id",
        *_carry(pa),
        p["about"]["atBatIndex"].alias("event_index"),
        p["about"]["inning"].alias("inning"),
        p["about"]["halfInning"].alias("half_inning"),
        p["matchup"]["batter"]["id"].alias("batter_id"),
        p["matchup"]["batSide"]["code"].alias("bat_side"),
        p["matchup"]["pitcher"]["id"].alias("pitcher_id"),
        p["matchup"]["pitchHand"]["code"].alias("pitch_hand"),
        p["result"]["event"].alias("event"),
        p["result"]["isOut"].alias("is_out"),
        F.size(F.filter(_runners(p), lambda r: F.coalesce(r["movement"]["end"], F.lit("")) == SCORE)).alias("runs_on_event"),
        F.get(credits, 0)["position"]["code"].alias("first_fielder"),
    )


def play_rows(pa: DataFrame) -> DataFrame:
    """Every play event with its pre-count, in array order (``pos``).

    Within one plate appearance, in array order:
    ``post_disengagements`` = last non-NULL disengagement number so far, else 0;
    ``pre_x = coalesce(previous post_x, 0)`` for balls, strikes, disengagements.
    Non-pitch events take part (a pickoff between pitches is a predecessor). Fields that the
    documents were read without (``game_feed_schema``) have no columns.
    """
    p = F.col("p")
    pe = F.coalesce(p["playEvents"], F.array())
    event_type = pa.schema["p"].dataType["playEvents"].dataType.elementType
    counted = _has(event_type, "details.disengagementNum")
    dis = F.transform(pe, lambda x: x["details"]["disengagementNum"]) if counted else F.lit(None)
    step1 = pa.select(
        "game_id",
        *_carry(pa),
        "pa_pos",
        p["about"]["atBatIndex"].alias("event_index"),
        p["about"]["inning"].alias("inning"),
        p["about"]["halfInning"].alias("half_inning"),
        _runners(p).alias("runners"),
        pe.alias("pe"),
        *([F.transform(
            dis,
            lambda d, i: F.coalesce(
                F.try_element_at(F.filter(F.slice(dis, 1, i + 1), lambda v: v.isNotNull()), F.lit(-1)), F.lit(0)
            ),
        ).alias("dis_filled")] if counted else []),
    )
    pe_c, dis_f = F.col("pe"), F.col("dis_filled")

    def prev(i: Column, field: str) -> Column:
        return F.coalesce(F.get(pe_c, i - 1)["count"][field], F.lit(0))

    enriched = F.transform(
        pe_c,
        lambda x, i: F.struct(
            x.alias("e"),
            prev(i, "balls").alias("pre_balls"),
            prev(i, "strikes").alias("pre_strikes"),
            *([
                F.get(dis_f, i).alias("post_disengagements"),
                F.coalesce(F.get(dis_f, i - 1), F.lit(0)).alias("pre_disengagements"),
            ] if counted else []),
        ),
    )
    ex = step1.select(
        "game_id", *_carry(step1), "pa_pos", "event_index", "inning", "half_inning", "runners",
        F.posexplode(enriched).alias("pos", "s"),
    )
    e = F.col("s")["e"]

    def of_event(path: str, name: str) -> list[Column]:
        col = e
        for part in path.split("."):
            col = col[part]
        return [col.alias(name)] if _has(event_type, path) else []

    return ex.select(
        *of_event("playId", "play_id"),
        *of_event("actionPlayId", "action_play_id"),
        "game_id",
        *_carry(ex),
        "event_index",
        "inning",
        "half_inning",
        "pa_pos",
        "pos",
        *of_event("index", "play_index"),
        *of_event("pitchNumber", "pitch_number"),
        *of_event("type", "type"),
        *of_event("isSubstitution", "is_substitution"),
        *of_event("player.id", "player_id"),
        *of_event("position.code", "position"),
        *of_event("count.outs", "outs"),
        *of_event("count.balls", "post_balls"),
        *of_event("count.strikes", "post_strikes"),
        *([F.col("s")["post_disengagements"].alias("post_disengagements")] if counted else []),
        F.col("s")["pre_balls"].alias("pre_balls"),
        F.col("s")["pre_strikes"].alias("pre_strikes"),
        *([F.col("s")["pre_disengagements"].alias("pre_disengagements")] if counted else []),
        *of_event("details.description", "description"),
        *of_event("details.event", "event"),
        *of_event("details.eventType", "event_type"),
        *of_event("details.fromCatcher", "from_catcher"),
        *of_event("details.runnerGoing", "runner_going"),
        *of_event("details.isOut", "is_out"),
        *of_event("details.type.code", "pitch_type"),
        *of_event("pitchData.coordinates.aX", "ax"),
        *of_event("pitchData.coordinates.aY", "ay"),
        *of_event("pitchData.coordinates.aZ", "az"),
        *of_event("pitchData.coordinates.vX0", "vx0"),
        *of_event("pitchData.coordinates.vY0", "vy0"),
        *of_event("pitchData.coordinates.vZ0", "vz0"),
        *of_event("pitchData.coordinates.x0", "x0"),
        *of_event("pitchData.coordinates.z0", "z0"),
        *of_event("pitchData.extension", "extension"),
        *of_event("pitchData.breaks.spinRate", "spin_rate"),
        *of_event("pitchData.strikeZoneTop", "strike_zone_top"),
        *of_event("pitchData.strikeZoneBottom", "strike_zone_bottom"),
        *of_event("hitData.launchSpeed", "launch_speed"),
        *of_event("hitData.launchAngle", "launch_angle"),
        *of_event("hitData.coordinates.coordX", "hit_coord_x"),
        *of_event("hitData.coordinates.coordY", "hit_coord_y"),
        "runners",
    )


def _has(kind: T.DataType, path: str) -> bool:
    """A struct type has a field at ``path``."""
    for part in path.split("."):
        if part not in kind.fieldNames():
            return False
        kind = kind[part].dataType
    return True


def pitch_rows(plays: DataFrame) -> DataFrame:
    """Pitches only, with the pre-pitch count as ``balls`` / ``strikes``. The
    pre-count was computed over all play events before this filter."""
    p = plays.filter(F.col("type") == PITCH_TYPE)
    return p.withColumnsRenamed({"pre_balls": "balls", "pre_strikes": "strikes"})


# --- lineups ----------------------------------------------------------------

def starting_lineup(boxscore: DataFrame) -> DataFrame:
    """Starting fielders per game and half from boxscore players.

    Our rule (the source's extractor is not visible): a starter has a batting
    order ending in ``00``; the first position listed is the starting position;
    only positions 2-10 are kept. Home fields in the top half, away in the
    bottom half."""

    def side(team: str, half: str) -> Column:
        players = F.map_values(F.col(f"teams.{team}.players"))
        return F.transform(players, lambda x: F.struct(F.lit(half).alias("half_inning"), x.alias("pl")))

    # both sides from one scan
    sides = F.array(*[F.coalesce(side(t, h), F.array()) for t, h in (("home", TOP), ("away", BOTTOM))])
    x = F.col("s.pl")
    return boxscore.select("game_id", F.explode(F.flatten(sides)).alias("s")).filter(x["battingOrder"].endswith("00")).select(
        "game_id",
        "s.half_inning",
        F.get(x["allPositions"], 0)["code"].try_cast("int").alias("position"),
        x["person"]["id"].alias("player_id"),
    ).filter(F.col("position").isin(list(FIELDING_POSITIONS)))


def attach_lineup(rows: DataFrame, lineup: DataFrame) -> DataFrame:
    """Give every row its game's starting lineup: ``_<half>_<position>`` is the starter and
    ``_listed`` has a bit for each half and position that the lineup lists (its starter may
    be NULL).

    One aggregate per game over positions 2-10 and halves top/bottom; its partial step
    collapses a game's rows (copies too) before they are shuffled. Both sides of the join
    are hash-partitioned on ``game_id``."""
    half, position = F.col("half_inning"), F.col("position")
    lu = lineup.filter(position.isin(list(FIELDING_POSITIONS)) & half.isin(TOP, BOTTOM))
    listed = [F.when((half == h) & (position == q), F.lit(1 << _bit(h, q))) for h in (TOP, BOTTOM) for q in FIELDING_POSITIONS]
    starters = [F.min(F.when((half == h) & (position == q), F.col("player_id"))).alias(f"_{h}_{q}") for h in (TOP, BOTTOM) for q in FIELDING_POSITIONS]
    per_game = lu.groupBy("game_id").agg(F.bit_or(F.coalesce(*listed)).alias("_listed"), *starters)
    return rows.join(per_game, "game_id", "left")


def _bit(half: str, position: int) -> int:
    return position + (16 if half == BOTTOM else 0)


def _substitutions(pe: Column) -> Column:
    """(i, id, position) of the substitutions among a plate appearance's play events,
    by play index."""
    subs = F.filter(pe, lambda x: F.coalesce(x["isSubstitution"], F.lit(False)))
    return F.sort_array(F.transform(subs, lambda x: F.struct(
        x["index"].alias("i"), x["player"]["id"].alias("id"), x["position"]["code"].try_cast("int").alias("position"))))


def with_fielders(events: DataFrame, lineup: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Add ``fielder_2_id`` ... ``fielder_10_id`` to event rows that carry ``_subs`` and
    ``_starts`` (see ``event_rows``).

    Per plate appearance and position that the lineup lists for its half: the starter counts
    only at the half's first event, a substitution at (event, position) only where the
    starter is NULL (so the starter wins in the first event, and substitutions
    match on event and position only); the id is then carried forward per
    (game, half, position) in event order. The rows are hash-partitioned on ``game_id``
    once; the lineup's join, the carry-forward window and the aggregate reuse that.
    """
    event_cols = [c for c in events.columns if c not in ("_subs", "_starts")]
    half = F.col("half_inning")

    def merged(q: int) -> Column:
        starter, bit = (F.when(half == TOP, top).when(half == BOTTOM, bottom) for top, bottom in (
            (F.col(f"_{TOP}_{q}"), F.col(f"_{BOTTOM}_{q}")), (F.lit(1 << _bit(TOP, q)), F.lit(1 << _bit(BOTTOM, q)))))
        sub = F.get(F.filter(F.col("_subs"), lambda x: x["position"] == q), 0)["id"]
        return F.when(F.col("_listed").bitwiseAND(bit) != 0, F.coalesce(F.when(F.col("_starts"), starter), sub))

    given = attach_lineup(_by_game(events, num_partitions), lineup)
    rows = given.select(*event_cols, *[merged(q).alias(f"_merged_{q}") for q in FIELDING_POSITIONS])
    w_fill = Window.partitionBy("game_id", "half_inning").orderBy("event_index").rowsBetween(_UNB, _CUR)
    rows = rows.withColumns({f"_player_{q}": F.last(f"_merged_{q}", ignorenulls=True).over(w_fill) for q in FIELDING_POSITIONS})
    # Event columns are functions of (game_id, event_index), so grouping by all
    # of them keeps one row per event.
    return rows.groupBy(*event_cols).agg(*[F.max(f"_player_{q}").alias(f"fielder_{q}_id") for q in FIELDING_POSITIONS])


# --- base-out state per play ------------------------------------------------

def _ends_safe_at(base: str, moves: Column):
    """The movement ends there, not out, and is the runner's last one of the play: a
    runner who takes two bases on one play stands on the second only."""
    def pred(r: Column, i: Column) -> Column:
        again = F.exists(F.slice(moves, i + 2, F.size(moves)), lambda x: x["details"]["runner"]["id"] == r["details"]["runner"]["id"])
        return (r["movement"]["end"] == base) & ~F.coalesce(r["movement"]["isOut"], F.lit(False)) & ~F.coalesce(again, F.lit(False))

    return pred


def _leaves(base: str):
    """The movement starts there, or reached it safely only to go on."""
    def pred(r: Column) -> Column:
        m = r["movement"]
        return (m["start"] == base) | ((m["end"] == base) & ~F.coalesce(m["isOut"], F.lit(False)))

    return pred


def base_out_state(plays: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Runners on base and outs before and after every play event.

    Our rule (the source's tracker is not visible): the runner movements of a
    plate appearance are assigned to play events by ``details.playIndex``. After a
    play, a base holds the runner whose last movement of the play ended there (not
    out), is empty if a runner left or passed it, else keeps its previous occupant;
    each half-inning starts with empty bases and no outs, and nobody is on base once
    three are out. Carried forward per (game, inning, half) in (event, position) order,
    on rows that are hash-partitioned on ``game_id``; what a play's movements change is
    worked out before, so the movements themselves don't travel unless they are asked for.
    """
    moves = F.filter(F.col("runners"), lambda r: r["details"]["playIndex"] == F.col("play_index"))
    cols = {
        "runs_on_play": F.size(F.filter(moves, lambda r: r["movement"]["end"] == SCORE)),
        "is_stolen_base": F.exists(moves, lambda r: F.coalesce(r["details"]["eventType"], F.lit("")).startswith(STOLEN_BASE_PREFIX)),
        "is_caught_stealing": F.exists(moves, lambda r: F.coalesce(r["details"]["eventType"], F.lit("")).startswith(CAUGHT_STEALING_PREFIX)),
        "is_pickoff": (F.col("type") == PICKOFF_TYPE) | F.coalesce(F.col("event_type"), F.lit("")).startswith(PICKOFF_PREFIX),
    }
    for short, code in BASES:
        arrive = F.get(F.filter(moves, _ends_safe_at(code, moves)), 0)["details"]["runner"]["id"]
        leave = F.exists(moves, _leaves(code))
        cols[f"_chg_{short}"] = F.when(arrive.isNotNull(), arrive).when(leave, F.lit(_EMPTIED))
    d = _by_game(plays.withColumns(cols), num_partitions)

    half = Window.partitionBy("game_id", "inning", "half_inning").orderBy("event_index", "pos")
    run = half.rowsBetween(_UNB, _CUR)
    out = {}
    for short, _ in BASES:
        carried = F.last(F.col(f"_chg_{short}"), ignorenulls=True).over(run)
        out[f"post_runner_{short}_id"] = F.when(carried != _EMPTIED, carried)
    out["post_outs"] = F.coalesce(F.last(F.col("outs"), ignorenulls=True).over(run), F.lit(0))
    d = d.withColumns(out)
    d = d.withColumns({f"post_runner_{s}_id": F.when(F.col("post_outs") < OUTS_OF_HALF, F.col(f"post_runner_{s}_id")) for s, _ in BASES})
    pre = {f"pre_runner_{s}_id": F.lag(f"post_runner_{s}_id", 1).over(half) for s, _ in BASES}
    pre["pre_outs"] = F.coalesce(F.lag("post_outs", 1).over(half), F.lit(0))
    return d.withColumns(pre).drop(*[f"_chg_{s}" for s, _ in BASES])


_RUNNING_FLAGS = ("is_stolen_base", "is_caught_stealing", "is_pickoff")


def identified_plays(plays: DataFrame) -> DataFrame:
    """Rows with a ``play_id`` of ``base_out_state``'s result. The state was
    carried over all rows; what happened on rows without an id (a steal on an
    action row, a run on it) counts on the next row of the half-inning that has one, and
    after the last such row on that one: a half's plays have all its runs."""
    half = Window.partitionBy("game_id", "inning", "half_inning")
    order = half.orderBy("event_index", "pos")
    before = F.count("play_id").over(order.rowsBetween(_UNB, -1))
    placed = plays.withColumns({"_next": before, "_ids": F.count("play_id").over(half)})
    group = Window.partitionBy("game_id", "inning", "half_inning", F.least(F.col("_next"), F.col("_ids") - 1))
    flags = {c: F.max(F.coalesce(F.col(c), F.lit(False))).over(group) for c in _RUNNING_FLAGS}
    runs = F.sum("runs_on_play").over(group).cast("int")
    return placed.withColumns({**flags, "runs_on_play": runs}).filter(F.col("play_id").isNotNull()).drop("_next", "_ids")


# --- the three stored outputs -----------------------------------------------

FRAMES = ("event", "pitch", "play")


def flatten_games(
    feed: DataFrame,
    lineup: DataFrame | None = None,
    schedule: DataFrame | None = None,
    num_partitions: int | None = None,
    cut_lineage: bool = False,
    prepared: bool = False,
    frames: Sequence[str] = FRAMES,
) -> dict[str, DataFrame]:
    """``{'event', 'pitch', 'play'}`` DataFrames in the stored layouts, or those in ``frames``
    only (documents read for one frame have no more than that frame's fields).

    ``lineup`` is the extracted starting lineup (``game_id, half_inning,
    position, player_id``; see ``starting_lineup``). ``schedule`` supplies
    ``year`` per ``game_id``; without it ``year`` is NULL. With ``prepared``, ``feed``
    holds one document per game already (``newest_documents`` of a written table).
    """
    games = feed if prepared else prepare_games(feed)
    if cut_lineage:
        # One durable copy (in the shared checkpoint folder) of the parsed,
        # deduplicated documents feeds all three outputs.
        checkpoint_dir(games.sparkSession)
        games = games.checkpoint(eager=True)
    out = {}
    if "event" in frames:
        if lineup is not None:
            events = with_fielders(event_rows(plate_appearances(games, first_of_half=True), for_fielders=True), lineup, num_partitions)
        else:
            events = event_rows(plate_appearances(games))
        out["event"] = events, EVENT
    if "pitch" in frames:
        out["pitch"] = pitch_rows(play_rows(plate_appearances(games))), PITCH
    if "play" in frames:
        out["play"] = identified_plays(base_out_state(play_rows(plate_appearances(games)), num_partitions)), PLAY

    years = None
    if schedule is not None and "year" not in games.columns:
        years = schedule.select("game_id", F.col("year").cast("int").alias("year"))
    return {
        name: _conform(df if years is None else df.join(years, "game_id", "left"), [c.name for c in spec.schema.fields])
        for name, (df, spec) in out.items()
    }


def _conform(df: DataFrame, cols: list[str]) -> DataFrame:
    """The stored column list, tolerant of absent columns (no ``scraped_at`` here;
    that is stamped by the upsert)."""
    return select_tolerant(df, [c for c in cols if c != "scraped_at"])
