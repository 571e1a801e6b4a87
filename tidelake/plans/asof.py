"""Matching two archives in time: for each row of one, the last row of the other known by then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.skew import segmented, so_far
from tidelake.plans.reads import HOUR


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def as_of_merge(
    facts: DataFrame,
    quotes: DataFrame,
    keys: Sequence[str],
    at: str,
    observed: str,
    tie: Sequence[str],
    taken: Sequence[str],
    how: str = "left",
    same_instant: bool = True,
    within: int | None = None,
    span: int = HOUR,
) -> DataFrame:
    """Each fact with the columns ``taken`` of the last quote of its key observed by its time ``at``.

    Both sides are put in one order of time and the last quote is carried forward, so no pair of rows
    is formed and neither side need be small.  Histories of heavy keys are cut into spans of ``span``
    microseconds, and only the last quote of each span crosses to the next.  Among quotes of one instant the greatest by ``tie`` counts; quotes equal in that too are a
    choice of any.  With ``same_instant`` false a quote counts only after its own instant.  ``within``
    (microseconds) leaves out quotes older than that.

    Null keys match null keys, as elsewhere.  A fact without a time, or with no quote before it, has nulls
    (``how="left"``) or is left out (``how="inner"``); a quote without a time is never taken.  Names in
    ``taken`` must not be columns of the facts.  Repeated facts stay repeated.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    clash = sorted(set(taken) & set(facts.columns))
    if clash:
        raise ValueError(f"the facts have columns named {clash}")
    shown = F.struct(*[F.col(name) for name in taken], F.col(observed).alias("_seen_at"))
    order = F.struct(*[F.col(name) for name in tie])
    # Quotes come before the facts of their instant, or after them.
    of_quotes, of_facts = (0, 1) if same_instant else (1, 0)
    given = facts.select(
        *[F.col(k) for k in keys], F.col(at).cast("timestamp").alias("_at"), F.lit(of_facts).alias("_side"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"),
    )
    known = quotes.where(F.col(observed).isNotNull()).select(
        *[F.col(k) for k in keys], F.col(observed).cast("timestamp").alias("_at"), F.lit(of_quotes).alias("_side"),
        order.alias("_tie"), shown.alias("_quote"),
    )
    place = ["_at", "_side", "_tie"]
    carried = segmented(
        given.unionByName(known, allowMissingColumns=True),
        keys,
        place,
        F.call_function("div", _micros(F.col("_at")), F.lit(span)),
        local=lambda run: {"_near": F.last("_quote", ignorenulls=True).over(so_far(run))},
        summary={"_latest": F.max_by("_quote", F.when(F.col("_quote").isNotNull(), F.struct(*place)))},
        carry=lambda before: [{"_earlier": F.last("_latest", ignorenulls=True).over(before)}],
    )
    found = F.coalesce("_near", "_earlier")
    if within is not None:
        young = _micros(F.col("_at")) - _micros(found["_seen_at"]) <= within
        found = F.when(young, found)
    matched = carried.where(F.col("_fact").isNotNull()).withColumn("_found", found)
    if how == "inner":
        matched = matched.where(F.col("_found").isNotNull())
    return matched.select(
        *[F.col("_fact")[c].alias(c) for c in facts.columns], *[F.col("_found")[c].alias(c) for c in taken]
    )


def odds_before_events(
    events: DataFrame, odds: DataFrame, keys: Sequence[str] = ("source", "external_id"), cutoff: str = "event_ts",
    how: str = "left", within: int | None = None,
) -> DataFrame:
    """Snapshots of the event archive with the odds archive's last snapshot observed by their start.

    Its columns come as ``odds_market``, ``odds_payload_json``, ``odds_payload_hash`` and ``odds_observed_at``.
    """
    named = {name: f"odds_{name}" for name in ("market", "payload_json", "payload_hash", "observed_at")}
    quotes = odds.select(*keys, *[F.col(name).alias(new) for name, new in named.items()])
    return as_of_merge(
        events, quotes, keys, cutoff, "odds_observed_at", ["odds_payload_hash"], list(named.values()), how, within=within
    )
