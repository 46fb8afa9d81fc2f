"""Schema registry: stored tables, their keys and layout, the raw game-feed
schema, and the payload view spec.

Sports names live here and in ``operators/nested.py`` only; every operator takes
column names as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    pk: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    required: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# --- Fixed values: stored table layouts (must match the source data model) ---
SCHEDULE = TableSpec(
    "schedule",
    "game_id STRING, game_type STRING, year INT, date DATE, level STRING, venue_id INT, "
    "team_id_away INT, team_id_home INT, team_name_away STRING, team_name_home STRING, "
    "score_away INT, score_home INT, scraped_at TIMESTAMP",
    pk=("game_id",),
    partition_by=("year",),
    sort_by=("date",),
    required=("game_id", "year", "date"),
)
EVENT = TableSpec(
    "statsapi_event",
    "game_id STRING, event_index INT, year INT, inning INT, half_inning STRING, batter_id INT, "
    "bat_side STRING, pitcher_id INT, pitch_hand STRING, event STRING, is_out BOOLEAN, "
    "runs_on_event INT, fielder_2_id INT, fielder_3_id INT, fielder_4_id INT, fielder_5_id INT, "
    "fielder_6_id INT, fielder_7_id INT, fielder_8_id INT, fielder_9_id INT, fielder_10_id INT, "
    "scraped_at TIMESTAMP",
    pk=("game_id", "event_index"),
    partition_by=("year",),
    sort_by=("game_id",),
    required=("game_id", "event_index"),
)
PITCH = TableSpec(
    "statsapi_pitch",
    "play_id STRING, game_id STRING, event_index INT, play_index INT, year INT, "
    "pitch_number INT, outs INT, balls INT, strikes INT, description STRING, pitch_type STRING, "
    "ax DOUBLE, ay DOUBLE, az DOUBLE, vx0 DOUBLE, vy0 DOUBLE, vz0 DOUBLE, x0 DOUBLE, z0 DOUBLE, "
    "extension DOUBLE, spin_rate DOUBLE, strike_zone_top DOUBLE, strike_zone_bottom DOUBLE, "
    "launch_speed DOUBLE, launch_angle DOUBLE, hit_coord_x DOUBLE, hit_coord_y DOUBLE, "
    "scraped_at TIMESTAMP",
    pk=("game_id", "event_index", "play_index"),
    partition_by=("year",),
    sort_by=("game_id",),
    required=("game_id", "event_index", "play_index"),
)
PLAY = TableSpec(
    "statsapi_play",
    "play_id STRING, game_id STRING, event_index INT, play_index INT, year INT, pitch_number INT, "
    "pre_runner_1b_id INT, pre_runner_2b_id INT, pre_runner_3b_id INT, post_runner_1b_id INT, "
    "post_runner_2b_id INT, post_runner_3b_id INT, pre_outs INT, pre_balls INT, pre_strikes INT, "
    "post_outs INT, post_balls INT, post_strikes INT, runs_on_play INT, type STRING, "
    "is_pickoff BOOLEAN, is_stolen_base BOOLEAN, is_caught_stealing BOOLEAN, scraped_at TIMESTAMP",
    pk=("game_id", "event_index", "play_index"),
    partition_by=("year",),
    sort_by=("game_id",),
    required=("game_id", "event_index", "play_index"),
)
STATCAST = TableSpec(
    "statcast",
    "game_pk INT, at_bat_number INT, pitch_number INT, year INT, data STRING, scraped_at TIMESTAMP",
    pk=("game_pk", "at_bat_number", "pitch_number"),
    partition_by=("year",),
    sort_by=("game_pk",),
    required=("game_pk", "at_bat_number", "pitch_number"),
)
# The same payload table with the payload stored as VARIANT (parsed once on load).
STATCAST_VARIANT = TableSpec(
    "statcast",
    "game_pk INT, at_bat_number INT, pitch_number INT, year INT, data VARIANT, scraped_at TIMESTAMP",
    pk=("game_pk", "at_bat_number", "pitch_number"),
    partition_by=("year",),
    sort_by=("game_pk",),
    required=("game_pk", "at_bat_number", "pitch_number"),
)
PLAYER = TableSpec(
    "player",
    "player_id INT, name_full STRING, name_last STRING, name_first STRING, birth_date DATE, "
    "birth_country STRING, bat_side STRING, throw_hand STRING, height STRING, weight INT, "
    "primary_position STRING, scraped_at TIMESTAMP",
    pk=("player_id",),
    sort_by=("player_id",),
    required=("player_id",),
)
SEASON_SUMMARY = TableSpec(
    "season_summary",
    "year INT, level STRING, player_id INT, position_type STRING, data STRING, scraped_at TIMESTAMP",
    pk=("year", "level", "player_id", "position_type"),
    partition_by=("year",),
    sort_by=("player_id",),
    required=("year", "level", "player_id", "position_type"),
)
LEDGER = TableSpec(
    "scrape_log",
    "run_id STRING, data_source STRING, level STRING, date_start DATE, date_end DATE, "
    "status STRING, games_total INT, games_success INT, games_failed INT, "
    "failed_game_ids ARRAY<INT>, error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, "
    "retry_of STRING, rows_written BIGINT, recorded_at TIMESTAMP, options STRING",
    pk=("run_id", "recorded_at"),
    required=("run_id", "data_source", "status"),
)

TABLES = {t.name: t for t in (SCHEDULE, EVENT, PITCH, PLAY, STATCAST, PLAYER, SEASON_SUMMARY, LEDGER)}

# Stamped at write time, never sent by callers.
AUTO_COLUMNS = ("scraped_at",)

# --- Fixed values: ingest defaults ---
LEVELS = ("MLB", "AAA", "AA", "A+", "A")
GAME_TYPES = ("S", "E", "A", "R", "F", "D", "L", "W", "C")
CHUNK_DAYS = 7
SEASON_START = (2, 20)  # month, day
SEASON_END = (10, 31)
COVERAGE_ALARM_PCT = 90.0
FIELDING_POSITIONS = tuple(range(2, 11))

# --- Fixed values: raw live-feed document schema (one document per game) ---
GAME_FEED_DDL = """
game_id STRING,
liveData STRUCT<plays: STRUCT<allPlays: ARRAY<STRUCT<
  about: STRUCT<atBatIndex: INT, inning: INT, halfInning: STRING>,
  matchup: STRUCT<batter: STRUCT<id: INT>, batSide: STRUCT<code: STRING>,
                  pitcher: STRUCT<id: INT>, pitchHand: STRUCT<code: STRING>>,
  result: STRUCT<event: STRING, isOut: BOOLEAN>,
  runners: ARRAY<STRUCT<
    movement: STRUCT<start: STRING, end: STRING, isOut: BOOLEAN, outBase: STRING, outNumber: INT>,
    details: STRUCT<event: STRING, eventType: STRING, runner: STRUCT<id: INT>, playIndex: INT,
                    isScoringEvent: BOOLEAN>,
    credit: ARRAY<STRUCT<position: STRUCT<code: STRING>>>>>,
  playEvents: ARRAY<STRUCT<
    playId: STRING, actionPlayId: STRING, index: INT, pitchNumber: INT, type: STRING,
    isSubstitution: BOOLEAN, player: STRUCT<id: INT>, position: STRUCT<code: STRING>,
    count: STRUCT<outs: INT, balls: INT, strikes: INT>,
    details: STRUCT<disengagementNum: INT, description: STRING, event: STRING, eventType: STRING,
                    fromCatcher: BOOLEAN, runnerGoing: BOOLEAN, isOut: BOOLEAN,
                    type: STRUCT<code: STRING>>,
    pitchData: STRUCT<
      coordinates: STRUCT<aX: DOUBLE, aY: DOUBLE, aZ: DOUBLE, vX0: DOUBLE, vY0: DOUBLE,
                          vZ0: DOUBLE, x0: DOUBLE, z0: DOUBLE>,
      extension: DOUBLE, breaks: STRUCT<spinRate: DOUBLE>,
      strikeZoneTop: DOUBLE, strikeZoneBottom: DOUBLE>,
    hitData: STRUCT<launchSpeed: DOUBLE, launchAngle: DOUBLE,
                    coordinates: STRUCT<coordX: DOUBLE, coordY: DOUBLE>>>>>>>>
"""

# What a frame reads of allPlays; a frame that isn't listed reads all of it.
FEED_FIELDS = {
    "event": (
        "about", "matchup", "result", "runners.movement.end", "runners.credit",
        "playEvents.index", "playEvents.isSubstitution", "playEvents.player", "playEvents.position",
    ),
    "play": (
        "about", "runners.movement.start", "runners.movement.end", "runners.movement.isOut",
        "runners.details.eventType", "runners.details.runner", "runners.details.playIndex",
        "playEvents.playId", "playEvents.index", "playEvents.pitchNumber", "playEvents.type",
        "playEvents.count", "playEvents.details.eventType",
    ),
}

# Extracted starting lineup per game and half: home fields in the top half.
LINEUP_DDL = "game_id STRING, half_inning STRING, position INT, player_id INT"

# Boxscore player entry (players keyed by "ID<n>").
BOXSCORE_DDL = """
game_id STRING,
teams STRUCT<
  home: STRUCT<players: MAP<STRING, STRUCT<person: STRUCT<id: INT>,
        allPositions: ARRAY<STRUCT<code: STRING>>, battingOrder: STRING>>>,
  away: STRUCT<players: MAP<STRING, STRUCT<person: STRUCT<id: INT>,
        allPositions: ARRAY<STRUCT<code: STRING>>, battingOrder: STRING>>>>
"""


def game_feed_schema(frame: str | None = None) -> T.StructType:
    """The schema of a document; with ``frame`` (event, pitch, play) only what that frame reads of it."""
    whole = T.StructType.fromDDL(" ".join(GAME_FEED_DDL.split()))
    if frame not in FEED_FIELDS:
        return whole
    return only_fields(whole, ["game_id", *(f"liveData.plays.allPlays.{f}" for f in FEED_FIELDS[frame])])


def only_fields(kind: T.DataType, paths: list[str]) -> T.DataType:
    """``kind`` with the fields at ``paths`` only, each with all that it holds."""
    if "" in paths:
        return kind
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(only_fields(kind.elementType, paths), kind.containsNull)
    below = {}
    for p in paths:
        name, _, rest = p.partition(".")
        below.setdefault(name, []).append(rest)
    return T.StructType([T.StructField(f.name, only_fields(f.dataType, below[f.name]), f.nullable) for f in kind.fields if f.name in below])


def boxscore_schema() -> T.StructType:
    return T.StructType.fromDDL(" ".join(BOXSCORE_DDL.split()))


# --- Fixed values: pitch-payload view spec, in view order -------------------
# key, type (text | int | numeric | date), profile (core = also in the narrow view)
PAYLOAD_SPEC_TEXT = """
game_date date core
game_type text core
home_team text core
away_team text core
event_index int core
batter_id int core
pitcher_id int core
batter_name text core
bat_side text core
pitch_hand text core
age_pit numeric core
age_bat numeric core
age_pit_legacy numeric extra
age_bat_legacy numeric extra
fielder_2_id int extra
fielder_3_id int extra
fielder_4_id int extra
fielder_5_id int extra
fielder_6_id int extra
fielder_7_id int extra
fielder_8_id int extra
fielder_9_id int extra
pre_runner_1b_id int extra
pre_runner_2b_id int extra
pre_runner_3b_id int extra
inning int core
half_inning text core
outs int core
balls int core
strikes int core
if_fielding_alignment text core
of_fielding_alignment text core
pitch_type text core
pitch_name text core
arm_angle numeric core
release_speed numeric core
effective_speed numeric core
release_pos_x numeric core
release_pos_y numeric core
release_pos_z numeric core
extension numeric core
release_spin_rate numeric core
spin_axis numeric core
pfx_x numeric core
pfx_z numeric core
plate_x numeric core
plate_z numeric core
ax numeric core
ay numeric core
az numeric core
vx0 numeric core
vy0 numeric core
vz0 numeric core
strike_zone_top numeric core
strike_zone_bottom numeric core
zone int core
api_break_z_with_gravity numeric core
api_break_x_arm numeric core
api_break_x_batter_in numeric core
bat_speed numeric core
swing_length numeric core
attack_angle numeric core
attack_direction numeric extra
swing_path_tilt numeric extra
intercept_ball_minus_batter_pos_x_inches numeric extra
intercept_ball_minus_batter_pos_y_inches numeric extra
hyper_speed numeric core
launch_speed numeric core
launch_angle numeric core
hit_coord_x numeric core
hit_coord_y numeric core
hit_distance_sc numeric core
bb_type text core
hit_location int core
launch_speed_angle int extra
type text core
description text core
events text core
des text core
home_score int core
away_score int core
bat_score int extra
fld_score int extra
post_home_score int core
post_away_score int core
post_bat_score int extra
post_fld_score int extra
home_score_diff int extra
bat_score_diff int extra
expected_woba numeric core
expected_babip numeric extra
woba_value numeric core
woba_denom numeric core
babip_value numeric extra
iso_value numeric extra
estimated_slg_using_speedangle numeric extra
delta_run_exp numeric core
delta_pitcher_run_exp numeric extra
delta_home_win_exp numeric core
home_win_exp numeric core
bat_win_exp numeric core
n_thruorder_pitcher int extra
n_priorpa_thisgame_player_at_bat int extra
pitcher_days_since_prev_game int extra
batter_days_since_prev_game int extra
pitcher_days_until_next_game int extra
batter_days_until_next_game int extra
"""

# The joined dimension name sits right after this payload key in the view.
PAYLOAD_NAME_AFTER = "batter_name"
PAYLOAD_KEY_COLUMNS = ("game_pk", "at_bat_number", "pitch_number", "year", "scraped_at")


def payload_spec(profile: str = "full") -> list[tuple[str, str]]:
    """``[(key, type)]`` in view order; ``profile='core'`` for the narrow view."""
    out = []
    for line in PAYLOAD_SPEC_TEXT.strip().splitlines():
        key, typ, prof = line.split()
        if profile == "full" or prof == "core":
            out.append((key, typ))
    return out
