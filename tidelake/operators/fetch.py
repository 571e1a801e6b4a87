"""Rules for accepting landed downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_audit(
    fetches: DataFrame, staged: DataFrame, max_bytes: int | None = None
) -> DataFrame:
    """Classify every landed fetch.

    ``fetches``: url, status_code, offset (bytes already staged), content_length,
    received (bytes), content_type.  ``staged``: url, sha256 of files known from
    earlier runs, one row per url.  ``max_bytes`` (off by default) rejects larger files.
    """
    code = F.col("status_code")
    appended = (code == 206) & (F.col("offset") > 0)
    base = F.when(appended, F.col("offset")).otherwise(0)
    announced = base + F.coalesce("content_length", F.lit(0))
    total = base + F.coalesce("received", F.lit(0))
    media_type = F.substring_index(
        F.coalesce("content_type", F.lit("application/octet-stream")), ";", 1
    )
    known = F.col("sha256").isNotNull()
    decision = (
        F.when((code == 304) & known, "reuse")
        .when((code < 200) | (code >= 300), "reject-status")
        .when(F.lit(False) if max_bytes is None else F.greatest(announced, total) > max_bytes, "reject-size")
        .when(media_type == "text/html", "reject-html")
        .when(appended, "append")
        .otherwise("accept")
    )
    joined = fetches.join(staged.select("url", "sha256"), "url", "left")
    return joined.select(
        *[c for c in fetches.columns],
        F.when(decision == "reuse", F.col("sha256")).alias("reused_sha256"),
        media_type.alias("media_type"),
        decision.alias("decision"),
    )
