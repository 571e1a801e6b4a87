"""Request budgets and pacing, checked over an append-only request log.

Log columns: provider, seq (bigint, arrival order), ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.skew import SEGMENT_ROWS, first_k_per_key, segment, segmented, so_far


def quota_usage(requests: DataFrame) -> DataFrame:
    """Requests per provider and UTC day."""
    return requests.groupBy("provider", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("requests")
    )


def quota_admission(requests: DataFrame, daily_limit: int) -> DataFrame:
    """Every request with its claim number, null where the day's budget was spent.

    Only the first ``daily_limit`` rows of a provider's day reach the ranking
    shuffle; they are matched back on their unique sequence number, so a busy
    provider's refused requests spread over all tasks.
    """
    if daily_limit < 1:
        raise ValueError("daily_limit must be positive")
    dated = requests.withColumn("day", F.to_date("ts"))
    first = first_k_per_key(
        dated.select("provider", "day", "seq"), ["provider", "day"], ["seq"], daily_limit, "claim"
    )
    return (
        dated.join(first, ["provider", "day", "seq"], "left")
        .withColumn("admitted", F.col("claim").isNotNull())
    )


def pacing_schedule(requests: DataFrame, spacing: Column, rows: int = SEGMENT_ROWS) -> DataFrame:
    """When each request may be sent if a provider's requests keep ``spacing`` seconds apart.

    A request waits for its own arrival and for the previous release plus the
    spacing.  With the i-th arrival a_i that is d*i + max over j<=i of
    (a_j - d*j): a running maximum, carried across segments.
    """
    step = F.col("_step")
    asked = requests.select("provider", "seq", "ts").withColumns(
        {
            "_at": F.unix_micros(F.col("ts").cast("timestamp")),
            "_step": (spacing.cast("double") * 1_000_000).cast("bigint"),
        }
    )
    paced = segmented(
        asked,
        ["provider"],
        ["seq"],
        segment("seq", rows),
        local=lambda run: {
            "_i": F.count("*").over(so_far(run)),
            "_lead": F.max(F.col("_at") - step * F.col("_i")).over(so_far(run)),
        },
        summary={"_n": F.count("*"), "_top": F.max("_lead"), "_d": F.max("_step")},
        carry=lambda before: [
            {"_ahead": F.coalesce(F.sum("_n").over(before), F.lit(0))},
            {"_top_before": F.max(F.col("_top") - F.col("_d") * F.col("_ahead")).over(before)},
        ],
    )
    ahead = F.coalesce("_ahead", F.lit(0))
    released = step * (ahead + F.col("_i")) + F.greatest(
        F.col("_top_before"), F.col("_lead") - step * ahead
    )
    return paced.select(
        "provider",
        "seq",
        "ts",
        F.timestamp_micros(released).alias("released_at"),
        (released - F.col("_at")).alias("wait_micros"),
    )
