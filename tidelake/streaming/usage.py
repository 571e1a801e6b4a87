"""A live view of request budgets: usage per provider and day, published once a day is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.quota import quota_usage
from tidelake.operators.skew import join_by_keys

_DAY = "1 day"


def usage_by_day(requests: DataFrame, delay: str = _DAY) -> DataFrame:
    """(provider, day, requests) of a stream of requests, a row once its UTC day is closed.

    A day closes when a request is seen that is ``delay`` beyond its end.  State is one count for each provider
    and open day, folded ahead of the shuffle, however many requests there are.  Later requests of a closed
    day, and those without a time, are not in the view; ``late_usage`` finds them in the log.
    """
    windows = requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    counted = windows.groupBy("provider", F.window("ts", _DAY)).agg(F.count("*").alias("requests"))
    return counted.select("provider", F.to_date("window.start").alias("day"), "requests")


def stream_usage(
    requests: DataFrame, usage_path: str, checkpoint: str, delay: str = _DAY, every: str | None = None
) -> StreamingQuery:
    """Append the closed days of a request stream to a Parquet table, each exactly once.

    The table's own log of batches decides which files count, so it is read with Spark by its folder.
    """
    writer = (
        usage_by_day(requests, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", usage_path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def usage_so_far(usage: DataFrame, log: DataFrame) -> DataFrame:
    """(provider, day, requests, published): usage of the whole log, and what the view says of a day.

    ``published`` is null while a day is open.
    """
    shown = usage.withColumnRenamed("requests", "published")
    return join_by_keys(quota_usage(log), shown, ["provider", "day"], "left").select(
        "provider", "day", "requests", "published"
    )


def late_usage(usage: DataFrame, log: DataFrame) -> DataFrame:
    """The days of ``usage_so_far`` to which the log has requests that came after the day was closed."""
    return usage_so_far(usage, log).where(F.col("requests") > F.col("published"))
