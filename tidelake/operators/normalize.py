"""Provider payloads to snapshots.

Input of every normaliser: ``payload`` (one JSON object as text) and
``observed_at``; other columns pass through.  Output: the snapshot columns plus
``reject_reason``, null for usable rows, so that a malformed item never loses
the rest of its batch.  ``accepted`` and ``quarantine`` split the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.payload import (
    canonical_json,
    field_or_none_text,
    is_set,
    payload_hash,
)
from tidelake.functions.status import game_status, match_status, schedule_status
from tidelake.functions.text import (
    not_blank,
    optional_text,
    slug,
    split_away_at_home,
    strip,
    team_name,
    versus_name,
)
from tidelake.functions.times import game_time, iso_timestamp, schedule_time
from tidelake.schemas import EVENT_SNAPSHOT, GAME_SPORTS, ODDS_SNAPSHOT, ODDS_SPORTS

# Provider field names, all read as text so that numbers keep their spelling.
_SCHEDULE_FIELDS = (
    "idEvent string, strEvent string, strSport string, idLeague string, strLeague string, "
    "strSeason string, dateEvent string, strTimestamp string, strTime string, strHomeTeam string, "
    "strAwayTeam string, intHomeScore string, intAwayScore string, strStatus string, "
    "strVenue string, strCountry string"
)
_MATCH_FIELDS = (
    "id string, utcDate string, status string, venue string, area struct<name:string>, "
    "competition struct<id:string,name:string>, season struct<startDate:string>, "
    "homeTeam struct<name:string>, awayTeam struct<name:string>, "
    "score struct<fullTime:struct<home:string,away:string>>"
)
_GAME_FIELDS = (
    "id string, datetime string, date string, season string, status string, status_detail string, "
    "postponed string, name string, home_team_name string, away_team_name string, "
    "home_team string, visitor_team string, away_team string, home_score string, "
    "away_score string, home_team_score string, visitor_team_score string, "
    "home_team_data struct<runs:string>, away_team_data struct<runs:string>, "
    "venue string, venue_name string"
)
_TEAM_FIELDS = "full_name string, display_name string, city string, name string"
_ODDS_FIELDS = (
    "id string, sport_title string, commence_time string, home_team string, away_team string"
)


def parsed_once(items: DataFrame, name: str, json_text: Column, fields: str) -> DataFrame:
    """Add the parsed JSON as a struct column.

    Going through a one-element explode keeps the parse a step of its own:
    otherwise each of the many field lookups above it would parse the text anew.
    """
    return items.select("*", F.explode(F.array(F.from_json(json_text, fields))).alias(name))


def _parsed(items: DataFrame, fields: str) -> DataFrame:
    return parsed_once(items, "_item", F.col("payload"), fields)


def _reason(*checks: tuple[Column, str]) -> Column:
    """The first failed check, null when all hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(why)) for ok, why in checks])


def _finish(items: DataFrame, values: dict[str, Column], shape, reason: Column) -> DataFrame:
    """Canonical payload, its hash, and the columns in the order of the contract."""
    passed = [c for c in items.columns if c not in ("payload", "observed_at", "_item")]
    built = items.select(
        *passed,
        "observed_at",
        *[column.alias(name) for name, column in values.items()],
        reason.alias("reject_reason"),
        canonical_json(F.col("payload")).alias("payload_json"),
    ).withColumn("payload_hash", payload_hash(F.col("payload_json")))
    unreadable = F.when(F.col("payload_json").isNull(), "payload is not JSON")
    built = built.withColumn("reject_reason", F.coalesce(unreadable, "reject_reason"))
    return built.select(*passed, *[f.name for f in shape.fields], "reject_reason")


def finalize_snapshot(items: DataFrame, values: dict[str, Column], reason: Column) -> DataFrame:
    """The common last step of event normalisers: trim, default the sport, hash."""
    values = dict(values)
    for name in ("source", "external_id", "event_name"):
        values[name] = strip(values[name])
    values["sport"] = F.coalesce(not_blank(strip(values["sport"])), F.lit("unknown"))
    nothing = F.lit(None).cast("string")
    for field in EVENT_SNAPSHOT.fields:
        if field.name not in ("observed_at", "payload_hash", "payload_json"):
            values.setdefault(field.name, nothing)
    blank = _reason(
        (values["source"] != "", "blank source"),
        (values["external_id"] != "", "blank external id"),
        (values["event_name"] != "", "blank event name"),
        (values["event_ts"].isNotNull(), "unreadable event time"),
    )
    return _finish(items, values, EVENT_SNAPSHOT, F.coalesce(reason, blank))


def normalize_thesportsdb(items: DataFrame) -> DataFrame:
    """Schedule and result items of all sports."""
    item = F.col("_item")
    at, precision = schedule_time(item.strTimestamp, item.dateEvent, item.strTime)
    reason = _reason(
        (strip(item.idEvent) != "", "missing idEvent"),
        (strip(item.strEvent) != "", "missing strEvent"),
        (item.dateEvent != "", "missing dateEvent"),
    )
    values = {
        "source": F.lit("thesportsdb"),
        "external_id": item.idEvent,
        "event_ts": at,
        "time_precision": precision,
        "sport": F.coalesce(not_blank(item.strSport), F.lit("unknown")),
        "league_external_id": optional_text(item.idLeague),
        "league_name": optional_text(item.strLeague),
        "season": optional_text(item.strSeason),
        "event_name": item.strEvent,
        "home_team": optional_text(item.strHomeTeam),
        "away_team": optional_text(item.strAwayTeam),
        "home_score": optional_text(item.intHomeScore),
        "away_score": optional_text(item.intAwayScore),
        "status": schedule_status(item.strStatus, item.intHomeScore, item.intAwayScore),
        "venue": optional_text(item.strVenue),
        "country": optional_text(item.strCountry),
    }
    return finalize_snapshot(_parsed(items, _SCHEDULE_FIELDS), values, reason)


def normalize_football_data(items: DataFrame) -> DataFrame:
    """Soccer matches with nested competition, season, area and score."""
    item = F.col("_item")
    home, away = optional_text(item.homeTeam["name"]), optional_text(item.awayTeam["name"])
    external = field_or_none_text(F.col("payload"), item.id, "id")
    values = {
        "source": F.lit("football-data.org"),
        "external_id": external,
        "event_ts": iso_timestamp(item.utcDate),
        "time_precision": F.lit("timestamp"),
        "sport": F.lit("Soccer"),
        "league_external_id": optional_text(item.competition["id"]),
        "league_name": optional_text(item.competition["name"]),
        "season": optional_text(item.season["startDate"]),
        "event_name": versus_name(home, away),
        "home_team": home,
        "away_team": away,
        "home_score": optional_text(item.score["fullTime"]["home"]),
        "away_score": optional_text(item.score["fullTime"]["away"]),
        "status": match_status(item.status),
        "venue": optional_text(item.venue),
        "country": optional_text(item.area["name"]),
    }
    reason = _reason(
        (item.utcDate.isNotNull(), "missing utcDate"), (external.isNotNull(), "missing id")
    )
    return finalize_snapshot(_parsed(items, _MATCH_FIELDS), values, reason)


def _constant_by(key: Column, choices: dict[str, str]) -> Column:
    pairs = [F.lit(text) for pair in choices.items() for text in pair]
    return F.element_at(F.create_map(*pairs), key)


def normalize_balldontlie(items: DataFrame) -> DataFrame:
    """Games of four sports; the row's ``sport_code`` picks the constants and the layout."""
    parsed = _parsed(items, _GAME_FIELDS)
    visitor, away_team = F.col("_item.visitor_team"), F.col("_item.away_team")
    parsed = parsed_once(parsed, "_home", F.col("_item.home_team"), _TEAM_FIELDS)
    parsed = parsed_once(
        parsed, "_away", F.when(is_set(visitor), visitor).otherwise(away_team), _TEAM_FIELDS
    )
    item, code = F.col("_item"), F.col("sport_code")
    league_matches = code == "epl"

    named = optional_text(item["name"])
    given_home, given_away = optional_text(item.home_team_name), optional_text(item.away_team_name)
    name_home, name_away = split_away_at_home(named)
    unnamed = given_home.isNull() & given_away.isNull()
    home_a = F.when(unnamed, name_home).otherwise(given_home)
    away_a = F.when(unnamed, name_away).otherwise(given_away)

    def assembled(team: str) -> Column:
        fields = F.col(team)
        return team_name(fields.full_name, fields.display_name, fields.city, fields["name"])

    home = F.when(league_matches, home_a).otherwise(assembled("_home"))
    away = F.when(league_matches, away_a).otherwise(assembled("_away"))
    home_points = F.coalesce(item.home_team_score, item.home_score, item.home_team_data["runs"])
    away_points = F.coalesce(item.visitor_team_score, item.away_score, item.away_team_data["runs"])
    at, precision = game_time(item.datetime, item.date)
    known = code.isin(list(GAME_SPORTS))
    external = field_or_none_text(F.col("payload"), item.id, "id")
    values = {
        "source": F.concat(F.lit("balldontlie-"), code),
        "external_id": external,
        "event_ts": at,
        "time_precision": precision,
        "sport": _constant_by(code, {k: v[0] for k, v in GAME_SPORTS.items()}),
        "league_name": _constant_by(code, {k: v[1] for k, v in GAME_SPORTS.items()}),
        "season": optional_text(item.season),
        "event_name": F.when(league_matches, F.coalesce(named, versus_name(home, away))).otherwise(
            versus_name(home, away)
        ),
        "home_team": home,
        "away_team": away,
        "home_score": optional_text(F.when(league_matches, item.home_score).otherwise(home_points)),
        "away_score": optional_text(F.when(league_matches, item.away_score).otherwise(away_points)),
        "status": F.when(
            league_matches,
            game_status(F.coalesce(not_blank(item.status_detail), item.status), F.lit(False)),
        ).otherwise(game_status(item.status, is_set(item.postponed))),
        "venue": F.when(league_matches, optional_text(item.venue_name)).otherwise(
            optional_text(F.coalesce(not_blank(item.venue), item.venue_name))
        ),
        "country": _constant_by(code, {k: v[2] for k, v in GAME_SPORTS.items()}),
    }
    reason = _reason(
        (known, "unsupported sport"),
        (F.coalesce(not_blank(item.datetime), not_blank(item.date)).isNotNull(), "missing date"),
        (external.isNotNull(), "missing id"),
    )
    return finalize_snapshot(parsed, values, reason).drop("_home", "_away")


def normalize_odds(items: DataFrame) -> DataFrame:
    """Moneyline quotes of one event; the row's ``sport_key`` names the feed."""
    item = F.col("_item")
    home, away = optional_text(item.home_team), optional_text(item.away_team)
    external = strip(item.id)
    at = iso_timestamp(item.commence_time)
    values = {
        "source": F.lit("the-odds-api"),
        "external_id": external,
        "event_ts": at,
        "sport": _constant_by(F.col("sport_key"), ODDS_SPORTS),
        "league_name": optional_text(item.sport_title),
        "event_name": versus_name(home, away),
        "home_team": home,
        "away_team": away,
        "market": F.lit("h2h"),
    }
    reason = _reason(
        (F.col("sport_key").isin(list(ODDS_SPORTS)), "unsupported sport"),
        (external != "", "missing id"),
        (item.commence_time != "", "missing commence_time"),
        (at.isNotNull(), "unreadable event time"),
    )
    return _finish(_parsed(items, _ODDS_FIELDS), values, ODDS_SNAPSHOT, reason)


#: Normalisers by provider name; add an entry to support a further feed.
NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "thesportsdb": normalize_thesportsdb,
    "football-data": normalize_football_data,
    "balldontlie": normalize_balldontlie,
    "odds": normalize_odds,
}


def accepted(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("reject_reason").isNotNull())


def supported_sports(items: DataFrame, column: str, sports: list[str]) -> DataFrame:
    """Rows of the supported sports; the list is a setting of a few names."""
    return items.where(F.col(column).isin(sports))


def provider_scope(
    snapshots: DataFrame,
    day: Column | None = None,
    sport: str | None = None,
    league: str | None = None,
) -> DataFrame:
    """Optional day, sport and league restriction; blank means no restriction.

    On an archive scan the day and the sport become partition filters.
    """
    scoped = snapshots
    if day is not None:
        partitioned = "event_date" in snapshots.columns
        scoped = scoped.where((F.col("event_date") if partitioned else F.to_date("event_ts")) == day)
    if sport and sport.strip():
        scoped = scoped.where(F.col("sport") == sport.strip())
        if "sport_slug" in snapshots.columns:
            scoped = scoped.where(F.col("sport_slug") == slug(F.lit(sport.strip())))
    if league and league.strip():
        scoped = scoped.where(F.col("league_name") == league.strip())
    return scoped
