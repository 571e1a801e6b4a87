"""Work lists: which files an import asks for.  Arrays are exploded, nothing is cross-joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import ordered_distinct_codes, season_code, season_problem
from tidelake.functions.times import inclusive_days, inclusive_range
from tidelake.schemas import (
    FOOTBALL_SEASON_URL,
    OPEN_DATA_URL,
    PLAY_BY_PLAY_URL,
    SHOTS_URL,
    TEAM_GAMES_URL,
)


def _filled(template: str, **values: Column) -> Column:
    """A URL template with its named places filled in."""
    url = F.lit(template)
    for name, value in values.items():
        url = F.replace(url, F.lit("{" + name + "}"), value.cast("string"))
    return url


def season_league_worklist(requests: DataFrame) -> DataFrame:
    """Seasons x leagues of each request: from_year, to_year, leagues (comma-separated).

    Years ascend, leagues keep the order of the request, each once.  A year without a season code
    keeps its rows, with the reason in ``reject_reason`` and neither partition nor address.
    """
    codes = ordered_distinct_codes(F.split("leagues", ","))
    leagues = F.when(F.size(codes) > 0, codes).otherwise(
        F.raise_error(F.lit("at least one league code is required"))
    )
    return (
        requests.withColumn("start_year", F.explode(inclusive_range(F.col("from_year"), F.col("to_year"))))
        .withColumns({"season": season_code("start_year"), "reject_reason": season_problem("start_year")})
        .select("*", F.posexplode(leagues).alias("position", "league"))
        .drop("leagues", "from_year", "to_year")
        .withColumns(
            {
                "dataset": F.lit("football_data_uk_matches"),
                "partition": F.concat(F.lit("league="), "league", F.lit("/season="), "season"),
                "url": _filled(FOOTBALL_SEASON_URL, season=F.col("season"), league=F.col("league")),
            }
        )
    )


_SEASON_DUMPS = {
    "nflverse_play_by_play": PLAY_BY_PLAY_URL,
    "moneypuck_shots": SHOTS_URL,
}


def season_worklist(requests: DataFrame, dataset: str) -> DataFrame:
    """One file per season of each request: from_year, to_year."""
    years = inclusive_range(F.col("from_year"), F.col("to_year"))
    return (
        requests.withColumn("season", F.explode(years))
        .drop("from_year", "to_year")
        .withColumns(
            {
                "dataset": F.lit(dataset),
                "partition": F.concat(F.lit("season="), F.col("season").cast("string")),
                "url": _filled(_SEASON_DUMPS[dataset], season=F.col("season")),
            }
        )
    )


def team_games_worklist(requests: DataFrame) -> DataFrame:
    """The one file that holds all seasons."""
    return requests.withColumns(
        {
            "dataset": F.lit("moneypuck_team_games"),
            "partition": F.lit("scope=all-seasons"),
            "url": F.lit(TEAM_GAMES_URL),
        }
    )


def competition_worklist(targets: DataFrame) -> DataFrame:
    """The match list of each target: competition_id, season_id."""
    return targets.withColumns(
        {
            "dataset": F.lit("statsbomb_matches"),
            "partition": F.concat(
                F.lit("competition_id="), "competition_id", F.lit("/season_id="), "season_id"
            ),
            "url": F.concat(
                F.lit(f"{OPEN_DATA_URL}/matches/"), "competition_id", F.lit("/"), "season_id", F.lit(".json")
            ),
        }
    )


def limit_matches(matches: DataFrame, max_matches: int | None) -> DataFrame:
    """The first matches of each list, by their position in it."""
    return matches if max_matches is None else matches.where(F.col("position") < max_matches)


def match_event_worklist(matches: DataFrame, max_matches: int | None = None) -> DataFrame:
    """The event file of each match: competition_id, season_id, position, match_id."""
    return limit_matches(matches, max_matches).withColumns(
        {
            "dataset": F.lit("statsbomb_events"),
            "partition": F.concat(
                F.lit("competition_id="), "competition_id",
                F.lit("/season_id="), "season_id",
                F.lit("/match_id="), "match_id",
            ),
            "url": F.concat(F.lit(f"{OPEN_DATA_URL}/events/"), "match_id", F.lit(".json")),
        }
    )


def day_worklist(requests: DataFrame, max_days: int | None = None) -> DataFrame:
    """One row per day of each request: from_day, to_day, both included.

    ``max_days`` (off by default) refuses longer requests, each on its own: one row without a day
    and with the reason in ``reject_reason``.
    """
    start, end = F.col("from_day"), F.col("to_day")
    too_long = F.lit(False) if max_days is None else F.datediff(end, start) >= max_days
    reason = F.concat(F.lit("more days than "), F.lit(max_days).cast("string"))
    return (
        requests.withColumn("reject_reason", F.when(too_long, reason))
        .withColumn("day", F.explode(F.when(too_long, F.array(F.lit(None).cast("date"))).otherwise(inclusive_days(start, end))))
        .drop("from_day", "to_day")
    )
