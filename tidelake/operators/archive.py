"""Writing the snapshot archive.

An archive is a Parquet folder partitioned by source_slug, sport_slug and
event_date.  Because stored rows always win a merge, a write only ever appends
the missing rows: nothing stored is rewritten, and a run repeated after a crash
adds nothing twice.  One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidelake.operators.merge import add_partition_columns, keep_first
from tidelake.schemas import (
    EVENT_SNAPSHOT,
    EVENTS_DATASET,
    MERGE_KEY,
    NATURAL_KEY,
    ODDS_SNAPSHOT,
    PARTITION_COLUMNS,
)
from tidelake.session import pin_utc, scratch_path
from tidelake.sources.lake import archive_path, path_exists, read_archive


class VerificationError(RuntimeError):
    """What was read back is not what was written."""


@dataclass(frozen=True)
class WriteResult:
    """What a write did; ``touched`` has a row for each partition it fell on: the partition columns,
    ``arrived`` (different snapshots) and ``added`` (those not stored before)."""

    received: int
    added: int
    touched: DataFrame | None = None


def sort_events(snapshots: DataFrame) -> DataFrame:
    """File order of events: by natural key within each partition."""
    return snapshots.sortWithinPartitions(*PARTITION_COLUMNS, *NATURAL_KEY)


def sort_odds(snapshots: DataFrame) -> DataFrame:
    """File order of odds: by event time, then natural key, within each partition."""
    return snapshots.sortWithinPartitions(*PARTITION_COLUMNS, "event_ts", *NATURAL_KEY)


#: Ranges of days that a merge reads, at most, besides one for each source and sport.
MOST_RANGES = 500


def near_partitions(parts: DataFrame, most: int = MOST_RANGES) -> Column:
    """A partition filter that holds all the partitions of ``parts`` and little else.

    Days of a source and sport are joined to ranges; where there are more than ``most`` gaps, the widest
    stay out.  One outlier date so costs one more range, not the whole span.  Sources and sports
    are settings, so the driver sees a bounded number of rows.
    """
    keys = ["source_slug", "sport_slug"]
    spans = parts.groupBy(*keys).agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).collect()
    before = F.lag("event_date").over(W.partitionBy(*keys).orderBy("event_date"))
    gap = F.datediff("event_date", "before")
    gaps = parts.select(*keys, "event_date").distinct().withColumn("before", before).where(gap > 1)
    cuts: dict[tuple[str, str], list] = {}
    for row in gaps.orderBy(gap.desc(), *keys, "event_date").limit(most).collect():
        cuts.setdefault((row.source_slug, row.sport_slug), []).append((row.before, row.event_date))
    near = []
    for span in spans:
        here = sorted(cuts.get((span.source_slug, span.sport_slug), []))
        starts, ends = [span.first, *(c[1] for c in here)], [*(c[0] for c in here), span.last]
        days = " OR ".join(f"event_date BETWEEN DATE'{a}' AND DATE'{b}'" for a, b in zip(starts, ends, strict=True))
        # Slugs hold letters, digits and dashes only.
        near.append(f"(source_slug = '{span.source_slug}' AND sport_slug = '{span.sport_slug}' AND ({days}))")
    return F.expr(" OR ".join(near) or "false")


def _by_shuffle(stored: DataFrame) -> DataFrame:
    """Stored keys that a join must not broadcast: their files are small, but in memory they are many times as large."""
    return stored.hint("merge")


def _write(
    snapshots: DataFrame, root: str, dataset: str, shape, order: Sequence[Column | str], sort
) -> WriteResult:
    """One copy of the first arrivals is kept, so that parsing and hashing run once; besides it only
    keys travel.  Lost blocks are recomputed."""
    spark = pin_utc(snapshots.sparkSession)
    path = archive_path(root, dataset)
    columns = [*shape.fieldNames(), *PARTITION_COLUMNS]
    arrived = Observation()
    dated = add_partition_columns(snapshots).observe(arrived, F.count("*").alias("n"))
    first = keep_first(dated, order).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = first.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("_first")).persist()
        if parts.count() == 0:
            return WriteResult(0, 0)
        received = arrived.get["n"]
        near = near_partitions(parts)
        delta = first
        new = first.select(*MERGE_KEY)
        if path_exists(spark, path):
            stored = _by_shuffle(read_archive(spark, root, dataset).where(near).select(*MERGE_KEY))
            new = new.join(stored, MERGE_KEY, "left_anti")
            delta = first.join(stored, MERGE_KEY, "left_anti")
        counts = new.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("added"))
        touched = parts.join(counts, PARTITION_COLUMNS, "left").select(
            *PARTITION_COLUMNS, F.col("_first").alias("arrived"), F.coalesce("added", F.lit(0)).cast("bigint").alias("added")
        )
        noted = scratch_path(spark, "touched")
        touched.write.parquet(noted)
        touched = spark.read.schema(touched.schema).parquet(noted)
        added = touched.agg(F.sum("added")).first()[0]
        if added:
            # Rebalancing gathers a partition's rows into few files and splits a
            # partition that is too large for one task.
            spread = delta.hint("rebalance", *PARTITION_COLUMNS)
            sort(spread).write.mode("append").partitionBy(*PARTITION_COLUMNS).option(
                "compression", "zstd"
            ).parquet(path)
        verify_stored(first, read_archive(spark, root, dataset).where(near))
        return WriteResult(received, added, touched)
    finally:
        first.unpersist()


def verify_stored(expected: DataFrame, archive: DataFrame) -> None:
    """Fail unless every expected key is stored, and stored exactly once."""
    stored = archive.groupBy(*MERGE_KEY).agg(F.count("*").alias("copies"))
    checked = expected.select(*MERGE_KEY).join(_by_shuffle(stored), MERGE_KEY, "left")
    verdict = checked.agg(
        F.count_if(F.col("copies").isNull()).alias("missing"),
        F.count_if(F.col("copies") > 1).alias("repeated"),
    ).first()
    if verdict.missing or verdict.repeated:
        raise VerificationError(
            f"archive verification failed: {verdict.missing} keys missing, "
            f"{verdict.repeated} stored more than once"
        )


def write_event_archive(
    snapshots: DataFrame, root: str, order: Sequence[Column | str] = ("observed_at",)
) -> WriteResult:
    """Merge event snapshots into the lake; an empty input writes nothing."""
    return _write(snapshots, root, "sports_events", EVENT_SNAPSHOT, order, sort_events)


def write_odds_archive(
    snapshots: DataFrame, root: str, order: Sequence[Column | str] = ("observed_at",)
) -> WriteResult:
    """Merge odds snapshots into the lake; an empty input writes nothing."""
    return _write(snapshots, root, "sports_odds", ODDS_SNAPSHOT, order, sort_odds)


def compact_archive(spark: SparkSession, root: str, dataset: str, min_files: int = 8) -> int:
    """Write partitions of at least ``min_files`` files anew, in file order; returns how many there were.

    The rows are complete in the scratch folder, and counted, before they replace a partition's files;
    a run that dies before leaves the archive as it was.  One writer at a time.
    """
    path = archive_path(root, dataset)
    archive = read_archive(spark, root, dataset)
    files = archive.select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file"))
    many = files.groupBy(*PARTITION_COLUMNS).agg(F.count_distinct("file").alias("n"), F.count("*").alias("rows"))
    many = many.where(F.col("n") >= min_files).persist()
    try:
        count = many.count()
        if not count:
            return 0
        chosen = archive.where(near_partitions(many)).join(many.select(*PARTITION_COLUMNS), PARTITION_COLUMNS, "left_semi")
        staged = scratch_path(spark, "compact")
        _sorted(chosen.hint("rebalance", *PARTITION_COLUMNS), dataset).write.partitionBy(*PARTITION_COLUMNS).option("compression", "zstd").parquet(staged)
        rows = spark.read.schema(archive.schema).parquet(staged)
        if rows.count() != many.agg(F.sum("rows")).first()[0]:
            raise VerificationError(f"{dataset}: staged rows differ from the stored ones")
        _sorted(rows.hint("rebalance", *PARTITION_COLUMNS), dataset).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*PARTITION_COLUMNS).option("compression", "zstd").parquet(path)
        return count
    finally:
        many.unpersist()


def _sorted(snapshots: DataFrame, dataset: str) -> DataFrame:
    return sort_events(snapshots) if dataset == EVENTS_DATASET else sort_odds(snapshots)
