"""The audit query set on the stored sports tables against plain Python over the
tables' rows."""

import datetime as dt
import json
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from fixtures.stored import build_stored
from pitchlake.plans import diagnostics as Q


def rounded(x, digits):
    return None if x is None else float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def percent(part, whole):
    return rounded(100.0 * part / whole, 1) if whole else None


def mean(values, digits):
    known = [v for v in values if v is not None]
    return rounded(sum(known) / len(known), digits) if known else None


def grouped(rows, *keys):
    out = defaultdict(list)
    for r in rows:
        out[tuple(r[k] for k in keys)].append(r)
    return out


class Stored:
    """Rows of every table as dicts; ``view`` unpacked from the payload here."""

    def __init__(self, tables):
        for name in ("schedule", "event", "pitch", "player", "statcast"):
            setattr(self, name, [r.asDict() for r in tables[name].collect()])
        names = {p["player_id"]: p["name_full"] for p in self.player}
        self.games = {g["game_id"]: g for g in self.schedule}
        self.view = []
        for r in self.statcast:
            data = defaultdict(lambda: None, json.loads(r["data"]))
            data |= {"game_pk": r["game_pk"], "year": r["year"], "pitcher_name": names.get(data["pitcher_id"])}
            self.view.append(data)

    def level(self, game_id):
        return self.games[game_id]["level"] if game_id in self.games else None


def by_year(rows, name):
    return [{"year": y, name: n} for y, n in Counter(r["year"] for r in rows).items()]


def active(s):
    n = Counter(e["pitcher_id"] for e in s.event if s.level(e["game_id"]) == "MLB" and s.games[e["game_id"]]["year"] == 2024)
    return [{"pitcher_id": p, "plate_appearances": k} for p, k in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:30]]


def breakdown(s, pitcher):
    out = []
    for (game,), events in grouped([e for e in s.event if e["pitcher_id"] == pitcher], "game_id").items():
        if s.level(game) == "MLB" and s.games[game]["year"] == 2024:
            keys = {e["event_index"] for e in events}
            thrown = sum(p["game_id"] == game and p["event_index"] in keys and p["play_index"] is not None for p in s.pitch)
            out.append({"game_id": game, "date": s.games[game]["date"], "plate_appearances": len(keys), "pitches_in_statsapi_pitch": thrown})
    return out


def completeness(s):
    fields = {"pct_has_velocity": "release_speed", "pct_has_spin": "release_spin_rate", "pct_has_launch": "launch_speed", "pct_has_pitcher_name": "pitcher_name"}
    return [
        {"year": y, "total_pitches": len(rows)} | {out: percent(sum(r[f] is not None for r in rows), len(rows)) for out, f in fields.items()}
        for (y,), rows in grouped(s.view, "year").items()
    ]


def coverage(s):
    there, other = Counter(p["year"] for p in s.pitch if s.level(p["game_id"]) == "MLB"), Counter(r["year"] for r in s.statcast)
    out = []
    for year, n in there.items():
        share = percent(other[year], n) if year in other else None
        out.append({"year": year, "statsapi_pitches": n, "statcast_pitches": other.get(year), "statcast_coverage_pct": share, "below_alarm": None if share is None else share < 90})
    return out


def arsenal(s, pitcher):
    mine = [r for r in s.view if r["pitcher_id"] == pitcher and r["year"] == 2024]
    digits = {"avg_velo": ("release_speed", 1), "avg_spin": ("release_spin_rate", 0), "avg_pfx_x": ("pfx_x", 2), "avg_pfx_z": ("pfx_z", 2)}
    return [
        {"pitch_type": kind, "pitch_name": name, "pitches": len(rows), "usage_pct": percent(len(rows), len(mine))}
        | {out: mean([r[f] for r in rows], d) for out, (f, d) in digits.items()}
        for (kind, name), rows in grouped(mine, "pitch_type", "pitch_name").items()
    ]


def trend(s):
    out = defaultdict(list)
    for r in s.view:
        if r["expected_woba"] is not None:
            day = dt.date.fromisoformat(r["game_date"])
            out[day - dt.timedelta(days=day.weekday())].append(r["expected_woba"])
    return [{"period": week, "n": len(v), "avg_xwoba": mean(v, 3)} for week, v in out.items()]


def strikeouts(s):
    out = []
    for (pitcher,), rows in grouped(s.event, "pitcher_id").items():
        k = sum(r["event"] in ("Strikeout", "Strikeout Double Play") for r in rows)
        out.append({"pitcher_id": pitcher, "plate_appearances": len(rows), "strikeouts": k, "strikeout_rate": rounded(k / len(rows), 3)})
    return out


def orphans(s):
    keys = {(e["game_id"], e["event_index"]) for e in s.event}
    return sum((p["game_id"], p["event_index"]) not in keys for p in s.pitch)


PLAYER_FIELDS = ("player_id", "name_full", "primary_position", "throw_hand")
LOG_FIELDS = ("game_date", "batter_name", "release_speed", "pfx_x", "pfx_z", "events")

CASES = {
    "find_player": (lambda t: Q.find_player(t["player"], "ACE"),
                    lambda s: [{k: p[k] for k in PLAYER_FIELDS} for p in s.player if "ace" in p["name_full"].lower()]),
    "most_active_pitchers": (lambda t: Q.most_active_pitchers(t["event"], t["schedule"], 2024, "MLB"), active),
    "games_by_year": (lambda t: Q.games_by_year(t["schedule"], "MLB"), lambda s: by_year([g for g in s.schedule if g["level"] == "MLB"], "games")),
    "events_by_year": (lambda t: Q.rows_by_year(t["event"], "events"), lambda s: by_year(s.event, "events")),
    "statcast_by_year": (lambda t: Q.rows_by_year(t["statcast"], "statcast_pitches"), lambda s: by_year(s.statcast, "statcast_pitches")),
    "pitcher_year_counts": (lambda t: Q.pitcher_year_counts(t["view"], 21), lambda s: [
        {"year": y, "pitches": len(r), "games": len({x["game_pk"] for x in r})} for (y,), r in grouped([v for v in s.view if v["pitcher_id"] == 21], "year").items()]),
    "pitcher_game_breakdown": (lambda t: Q.pitcher_game_breakdown(t["schedule"], t["event"], t["pitch"], 41, 2024, "MLB"), lambda s: breakdown(s, 41)),
    "orphaned_pitches": (lambda t: Q.orphaned_pitches(t["pitch"], t["event"]), lambda s: [{"orphaned_pitches": orphans(s)}]),
    "events_missing_schedule": (lambda t: Q.events_missing_schedule(t["event"], t["schedule"]),
                                lambda s: [{"events_missing_schedule": sum(e["game_id"] not in s.games for e in s.event)}]),
    "pitches_missing_schedule": (lambda t: Q.pitches_missing_schedule(t["pitch"], t["schedule"]),
                                 lambda s: [{"pitches_missing_schedule": sum(p["game_id"] not in s.games for p in s.pitch)}]),
    "pitchers_missing_from_player": (lambda t: Q.pitchers_missing_from_player(t["event"], t["player"]), lambda s: [
        {"pitcher_id": p} for p in sorted({e["pitcher_id"] for e in s.event} - {p["player_id"] for p in s.player})[:20]]),
    "view_null_rates": (lambda t: Q.view_null_rates(t["view"]), completeness),
    "statcast_coverage": (lambda t: Q.statcast_coverage(t["pitch"], t["schedule"], t["statcast"]), coverage),
    "pitcher_arsenal": (lambda t: Q.pitcher_arsenal(t["view"], 21, 2024), lambda s: arsenal(s, 21)),
    "pitch_log": (lambda t: Q.pitch_log(t["view"], "Starter Twentyone", 2024, "FF"), lambda s: [
        {k: dt.date.fromisoformat(r[k]) if k == "game_date" else r[k] for k in LOG_FIELDS}
        for r in s.view if r["pitcher_name"] == "Starter Twentyone" and r["year"] == 2024 and r["pitch_type"] == "FF"]),
    "exit_velocity_by_pitch_type": (lambda t: Q.exit_velocity_by_pitch_type(t["view"]), lambda s: [
        {"pitch_type": k, "batted_balls": len(r), "avg_exit_velo": mean([x["launch_speed"] for x in r], 1)}
        for (k,), r in grouped([v for v in s.view if v["launch_speed"] is not None], "pitch_type").items()]),
    "xwoba_trend": (lambda t: Q.xwoba_trend(t["view"]), trend),
    "strikeout_rate": (lambda t: Q.strikeout_rate(t["event"]), strikeouts),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("stored")
    tables, kept = build_stored(spark, d), {}
    for name, df in tables.items():
        df.write.parquet(str(d / f"{name}.parquet"))
        kept[name] = spark.read.schema(df.schema).parquet(str(d / f"{name}.parquet"))
    return kept, Stored(kept)


def comparable(rows):
    plain = [{k: float(v) if isinstance(v, (Decimal, float)) else v for k, v in r.items()} for r in rows]
    return sorted((sorted(r.items()) for r in plain), key=repr)


@pytest.mark.parametrize("name", sorted(CASES))
def test_diagnostic_matches_plain_python(stored, name):
    tables, rows = stored
    query, expected = CASES[name]
    got = comparable(r.asDict() for r in query(tables).collect())
    assert got == comparable(expected(rows)) and got
