"""Provider status texts and job health verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.functions.text import strip
from tidelake.schemas import IDLE_RUN_THRESHOLD, STALE_INTERVAL_FACTOR, STATUS_ORDER


def _mentions(text: Column, *markers: str) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(marker)) for marker in markers])


def schedule_status(text: Column, home_score: Column, away_score: Column) -> Column:
    """Free status text; two known scores make an unmarked event final."""
    raw = F.coalesce(F.lower(strip(text)), F.lit(""))
    return (
        F.when(_mentions(raw, "finished", "final", "full time") | (raw == "ft"), "final")
        .when(_mentions(raw, "cancel"), "cancelled")
        .when(_mentions(raw, "postpon"), "postponed")
        .when(_mentions(raw, "live", "progress", "half time"), "live")
        .when(home_score.isNotNull() & away_score.isNotNull(), "final")
        .otherwise("scheduled")
    )


def match_status(text: Column) -> Column:
    """Exact status codes; unknown codes mean scheduled."""
    raw = F.lower(text)
    return (
        F.when(raw == "finished", "final")
        .when(raw.isin("in_play", "paused"), "live")
        .when(raw == "cancelled", "cancelled")
        .when(raw.isin("postponed", "suspended"), "postponed")
        .otherwise("scheduled")
    )


def game_status(text: Column, postponed: Column) -> Column:
    """Free status text of game feeds; a postponement outranks every other marker."""
    raw = F.coalesce(F.lower(text), F.lit(""))
    return (
        F.when(postponed | _mentions(raw, "postpon"), "postponed")
        .when(_mentions(raw, "final", "full_time", "full time") | (raw == "ft"), "final")
        .when(_mentions(raw, "quarter", "half", "inning", "progress", "live"), "live")
        .when(_mentions(raw, "cancel"), "cancelled")
        .otherwise("scheduled")
    )


def is_stale(last_success: Column, interval_seconds: Column, now: Column) -> Column:
    """More than 2.5 promised intervals without a success; no interval, never stale."""
    waited = F.unix_micros(now) - F.unix_micros(last_success)
    return F.coalesce(
        (interval_seconds > 0) & (waited > interval_seconds * (STALE_INTERVAL_FACTOR * 1_000_000)),
        F.lit(False),
    )


def health_status(now: Column) -> Column:
    """Verdict over the columns of a health entry."""
    return (
        F.when(F.col("consecutive_failures") > 0, "failing")
        .when(
            F.col("runs") == 0,
            F.when(F.coalesce(F.col("skip_reason"), F.lit("")) != "", "skipped").otherwise("never-run"),
        )
        .when(F.col("last_success").isNull(), "never-run")
        .when(is_stale(F.col("last_success"), F.col("interval_seconds"), now), "stale")
        .when(F.col("last_status") == "partial", "degraded")
        .when(F.col("writeless_successes") >= IDLE_RUN_THRESHOLD, "idle")
        .otherwise("ok")
    )


def status_rank(status: Column) -> Column:
    """0 for the worst verdict; statuses outside the list come last."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), status)
    return F.when(place > 0, place - 1).otherwise(9).cast("int")
