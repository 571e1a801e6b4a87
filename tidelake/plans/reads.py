"""Questions asked of the lake: latest state, history, line movement, quotes known in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.skew import first_per_key, segmented, so_far

HOUR = 3_600_000_000  # microseconds


def latest_snapshot(snapshots: DataFrame, keys: Sequence[str] = ("source", "external_id")) -> DataFrame:
    """The last observation of every event; ties go to the greater payload hash."""
    return first_per_key(snapshots, keys, [F.col("observed_at").desc(), F.col("payload_hash").desc()])


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    version: str,
    previous: str,
    span: int = HOUR,
) -> DataFrame:
    """Number the rows of each key and give each the value of the row before it.

    ``order`` starts with a timestamp; the histories of heavy keys are cut by time
    into spans, so the length of a history does not matter.
    """
    return segmented(
        rows,
        keys,
        order,
        F.call_function("div", _micros(order[0]), F.lit(span)),
        local=lambda run: {
            "_n": F.count("*").over(so_far(run)),
            "_before": F.lag(F.struct(value)).over(run),
        },
        summary={"_rows": F.count("*"), "_last": F.max_by(F.struct(value), F.struct(*order))},
        carry=lambda before: [
            {
                "_ahead": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
                "_carried": F.last("_last").over(before),
            }
        ],
    ).withColumns(
        {
            version: F.coalesce("_ahead", F.lit(0)) + F.col("_n"),
            previous: F.coalesce("_before", "_carried")[value],
        }
    ).drop("_n", "_before", "_ahead", "_carried")


def snapshot_history(snapshots: DataFrame, span: int = HOUR) -> DataFrame:
    """Every observation of an event, numbered, with the status it replaced."""
    return with_previous(
        snapshots,
        ["source", "external_id"],
        ["observed_at", "payload_hash"],
        "status",
        "version",
        "previous_status",
        span,
    )


def line_movement(
    quotes: DataFrame, keys: Sequence[str], order: Sequence[str], price: str = "price", span: int = HOUR
) -> DataFrame:
    """Each quote with the price before it and the change; null for a first quote."""
    moved = with_previous(quotes, keys, order, price, "quote", "previous_price", span)
    return moved.withColumn("movement", F.col(price) - F.col("previous_price"))


def odds_as_of(
    odds: DataFrame, keys: Sequence[str] = ("source", "external_id", "market"), cutoff: str = "event_ts"
) -> DataFrame:
    """The last quote observed no later than the cutoff; later quotes never leak in."""
    known = odds.where(F.col("observed_at") <= F.col(cutoff))
    return first_per_key(known, keys, [F.col("observed_at").desc(), F.col("payload_hash").desc()])


_BOOKMAKERS = (
    "bookmakers array<struct<key:string, price:double, markets:array<struct<key:string, "
    "outcomes:array<struct<name:string, price:double>>>>>>"
)


def explode_bookmakers(odds: DataFrame) -> DataFrame:
    """One row per bookmaker, market and outcome of each odds payload.

    A bookmaker that quotes a bare price gives one row without market and outcome.
    """
    passed = [c for c in odds.columns if c not in ("payload_json", "market")]
    books = odds.select(
        *passed, F.explode(F.from_json("payload_json", _BOOKMAKERS)["bookmakers"]).alias("book")
    )
    markets = books.select(
        *passed,
        F.col("book.key").alias("bookmaker"),
        F.col("book.price").alias("_price"),
        F.explode_outer("book.markets").alias("m"),
    )
    return markets.select(
        *passed, "bookmaker", "_price", F.col("m.key").alias("market"), F.explode_outer("m.outcomes").alias("o")
    ).select(
        *passed, "bookmaker", "market", F.col("o.name").alias("outcome"),
        F.coalesce("o.price", "_price").alias("price"),
    )
