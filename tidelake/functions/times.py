"""Instants and calendar rules.  The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.functions.text import not_blank, strip
from tidelake.schemas import SEASON_START_MONTH

_DATE = r"^(\d{4}-\d{2}-\d{2}|\d{8})$"
_INSTANT = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8})"
    r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to an instant; zone-less text is UTC, anything else is null.

    Most spellings go straight to Spark's cast.  Only those it does not take (no
    seconds before a zone, no separators, decimal comma) are spelled out first.
    """
    spelled = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    spelled = F.regexp_replace(spelled, r"^(.{10}[T ]\d{2})(\d{2})", "$1:$2")
    spelled = F.regexp_replace(spelled, r"^(.{10}[T ]\d{2}:\d{2})(\d{2})", "$1:$2")
    spelled = F.regexp_replace(spelled, r"^(.{10}[T ]\d{2})(?=$|[Z+-])", "$1:00")
    spelled = F.regexp_replace(spelled, r"^(.{10}[T ]\d{2}:\d{2})(?=$|[Z+-])", "$1:00")
    spelled = F.regexp_replace(spelled, ",", ".")
    read = F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(spelled))
    return F.when(text.rlike(_INSTANT), read)


def schedule_time(timestamp: Column, day: Column, clock: Column) -> tuple[Column, Column]:
    """(instant, precision) from a full timestamp, else day and clock, else the day alone.

    A field that is present but unreadable makes the instant null: the row is
    rejected rather than quietly degraded to a coarser precision.
    """
    stamp = not_blank(strip(timestamp))
    time = not_blank(F.regexp_replace(strip(clock), "Z$", ""))
    scheduled = F.when(day.rlike(_DATE), F.concat_ws("T", day, time))
    precision = (
        F.when(stamp.isNotNull(), "timestamp")
        .when(time.isNotNull(), "provider_utc_time")
        .otherwise("date_only")
    )
    return iso_timestamp(F.coalesce(stamp, scheduled)), precision


def game_time(instant: Column, day: Column) -> tuple[Column, Column]:
    """(instant, precision) where a ``T`` in the text marks a clock time."""
    text = F.coalesce(not_blank(instant), not_blank(day))
    timed = F.contains(text, F.lit("T"))
    at = iso_timestamp(F.when(timed, text).otherwise(F.substring(text, 1, 10)))
    return at, F.when(timed, "timestamp").otherwise("date_only")


def season_start_year(day: Column, sport: str) -> Column:
    """The year in which the season running on that day began."""
    return F.when(F.month(day) >= SEASON_START_MONTH[sport], F.year(day)).otherwise(F.year(day) - 1)


def inclusive_range(start: Column, end: Column) -> Column:
    """Array of whole numbers from start to end, both included; fails if reversed."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(
        F.raise_error(F.lit("range start is after its end"))
    )


def inclusive_days(start: Column, end: Column) -> Column:
    """Array of days, both ends included; fails if reversed."""
    return F.when(start > end, F.raise_error(F.lit("range of days: the start is after the end"))).otherwise(
        F.sequence(start, end, F.expr("interval 1 day"))
    )


def collection_days(today: Column) -> Column:
    """Yesterday and today."""
    return F.sequence(F.date_sub(today, 1), today, F.expr("interval 1 day"))


def elapsed_seconds(since: Column, now: Column) -> Column:
    """Whole seconds, cut off towards zero."""
    return F.call_function("div", F.unix_micros(now) - F.unix_micros(since), F.lit(1_000_000))


def age_text(since: Column, now: Column, given: Column | None = None) -> Column:
    """How long ago, in the largest whole unit.

    ``given`` is the text the instant was read from; where it is present but
    could not be read the age is ``unknown``.
    """
    age = elapsed_seconds(since, now)

    def unit(size: int, mark: str) -> Column:
        whole = F.call_function("div", age, F.lit(size))
        return F.concat(whole.cast("string"), F.lit(f"{mark} ago"))

    missing = F.lit("never")
    if given is not None:
        missing = F.when(not_blank(given).isNull(), "never").otherwise("unknown")
    return (
        F.when(since.isNull(), missing)
        .when(age < 0, "just now")
        .when(age >= 86400, unit(86400, "d"))
        .when(age >= 3600, unit(3600, "h"))
        .when(age >= 60, unit(60, "m"))
        .otherwise(unit(1, "s"))
    )
