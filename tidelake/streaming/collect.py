"""Streams that keep the lake, health and budgets up to date.

Late observations are always accepted, so no watermark drops anything: the
archive itself is the state to deduplicate against.  Every batch is idempotent,
because a batch replayed after a failure finds its rows already stored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidelake.operators.archive import WriteResult, write_event_archive, write_odds_archive
from tidelake.operators.bulk import add_provenance
from tidelake.operators.bulk_archive import refresh_snapshot_manifest, write_bulk_version
from tidelake.operators.health import health_fold, resume_health
from tidelake.operators.normalize import NORMALIZERS, accepted, quarantine
from tidelake.operators.quota import quota_admission
from tidelake.operators.skew import join_by_keys
from tidelake.schemas import EVENTS_DATASET, ODDS_DATASET
from tidelake.sources import commits
from tidelake.sources.dumps import read_csv_source, read_json_list_source, read_parquet_source, read_zip_csv_source, zip_headers
from tidelake.sources.envelopes import envelope_items, refused_envelopes, stream_landed
from tidelake.sources.lake import digest_files


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def _refuse(rows: DataFrame, path: str, batch: int) -> None:
    """Keep refused rows by batch number, so that a replayed batch replaces its own."""
    rows.write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch}")


def _stream_id(spark: SparkSession) -> str:
    """The running query's id.  It lives in the checkpoint: a new checkpoint is another stream."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _run_number(spark: SparkSession, path: str, number: int) -> int:
    """A number that orders the runs of a job over restarts and new checkpoints.

    It counts from the instant (microseconds) of the stream's first batch, which stays with the log, so a
    replayed batch has its number again, and a stream begun later goes on behind all earlier ones.
    """
    stream = f"{path.rstrip('/')}/stream={_stream_id(spark)}"
    begun = commits.commit_note(spark, stream)
    if begun is None:
        begun = str(spark.sql("SELECT unix_micros(current_timestamp())").first()[0])
        commits.commit(spark, stream, begun)
    return int(begun) + number


def _log_outcome(spark: SparkSession, path: str, job: str, number: int, result: WriteResult, refused: int) -> None:
    """One run-log row for a batch; a replayed batch replaces its own."""
    if refused == 0:
        status = "ok"
    else:
        status = "partial" if result.received else "error"
    row = spark.range(1).select(
        F.lit(job).alias("job"),
        F.lit(_run_number(spark, path, number)).cast("bigint").alias("seq"),
        F.current_timestamp().alias("ts"),
        F.lit(status).alias("status"),
        F.lit(result.received).cast("bigint").alias("fetched"),
        F.lit(result.added).cast("bigint").alias("added"),
        F.lit(f"{refused} refused" if refused else "").alias("detail"),
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/stream={_stream_id(spark)}/batch={number}")


def _stream_archive(
    landed: DataFrame,
    provider: str,
    unit: str | None,
    root: str,
    checkpoint: str,
    write: Callable,
    dataset: str,
    constants: dict[str, Column],
    quarantine_path: str | None,
    run_log: str | None,
    every: str | None,
) -> StreamingQuery:
    """Merge every batch, refresh the manifest entries of the partitions it touched, note its outcome.

    The job in the run log is the provider and, where it has streams of several, the unit collected.
    """
    job = "-".join(["collect", provider, *([unit] if unit else [])])

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        items = envelope_items(batch, provider).withColumns(constants)
        # Kept, so that accepted and refused items come from one parse.
        normalised = NORMALIZERS[provider](items).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            result = write(accepted(normalised), root, ["observed_at", "path", "position"])
            if result.touched is not None:
                refresh_snapshot_manifest(spark, root, dataset, result.touched, F.current_timestamp())
            refused = 0
            if quarantine_path or run_log:
                reasons = quarantine(normalised).select("path", "position", "reject_reason")
                whole = refused_envelopes(batch, provider).select(
                    "path", F.lit(None).cast("int").alias("position"), F.col("reason").alias("reject_reason")
                )
                every_reason = reasons.unionByName(whole).persist(StorageLevel.MEMORY_AND_DISK)
                refused = every_reason.count()
                if quarantine_path:
                    _refuse(every_reason, quarantine_path, number)
                every_reason.unpersist()
            if run_log:
                _log_outcome(spark, run_log, job, number, result, refused)
        finally:
            normalised.unpersist()

    return _start(landed, each, checkpoint, every)


def stream_event_archive(
    spark: SparkSession,
    landing: str,
    provider: str,
    root: str,
    checkpoint: str,
    sport_code: str | None = None,
    quarantine_path: str | None = None,
    every: str | None = None,
    per_line: bool = False,
    files_per_batch: int = 1000,
    run_log: str | None = None,
) -> StreamingQuery:
    """Landed responses of one event feed into the event archive.

    Without ``every`` all files present are taken and the query ends.  ``run_log`` collects one
    outcome per batch, in the shape that ``stream_job_health`` reads.
    """
    constants = {"sport_code": F.lit(sport_code)} if sport_code else {}
    landed = stream_landed(spark, landing, per_line, files_per_batch)
    return _stream_archive(
        landed, provider, sport_code, root, checkpoint, write_event_archive, EVENTS_DATASET, constants, quarantine_path, run_log, every
    )


def stream_odds_archive(
    spark: SparkSession,
    landing: str,
    sport_key: str,
    root: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    every: str | None = None,
    per_line: bool = False,
    files_per_batch: int = 1000,
    run_log: str | None = None,
) -> StreamingQuery:
    """Landed odds responses of one sport; every sport is its own query, so one failing leaves the others."""
    landed = stream_landed(spark, landing, per_line, files_per_batch)
    constants = {"sport_key": F.lit(sport_key)}
    return _stream_archive(
        landed, "odds", sport_key, root, checkpoint, write_odds_archive, ODDS_DATASET, constants, quarantine_path, run_log, every
    )


def _json_lists(spark: SparkSession, paths: Sequence[str], id_column: str | None) -> DataFrame:
    if id_column is None:
        raise ValueError("JSON lists need the name of their id")
    return read_json_list_source(spark, paths, id_column)


#: Reader of each landed format: paths and the id's name to rows with their place.
BULK_READERS = {
    "json": _json_lists,
    "csv": lambda spark, paths, _: read_csv_source(spark, paths, "*"),
    "zip": lambda spark, paths, _: read_zip_csv_source(spark, paths, "*"),
    "parquet": lambda spark, paths, _: read_parquet_source(spark, paths),
}
_MEDIA_TYPES = {"json": "application/json", "csv": "text/csv", "zip": "application/zip", "parquet": "application/vnd.apache.parquet"}


def stream_bulk_import(
    spark: SparkSession,
    landing: str,
    id_column: str | None,
    root: str,
    dataset: str,
    partition: str,
    checkpoint: str,
    license_name: str = "",
    license_url: str = "",
    every: str | None = None,
    files_per_batch: int = 200,
    file_format: str = "json",
    quarantine_path: str | None = None,
    keep_sources: bool = True,
) -> StreamingQuery:
    """Landed dumps (JSON lists, CSV, zipped CSV, Parquet) into immutable versions.

    A changed file becomes a new version.  The stream carries names only; tasks digest the
    files in chunks, and the batch readers read them, at most ``files_per_batch`` at a time.  Archives
    are unpacked to their end before anything is read from them; one that is refused or damaged leaves
    no record, goes to ``quarantine_path`` with the reason, and is imported once landed repaired.
    ``keep_sources`` keeps a copy of every imported file beside its rows.
    """
    read = BULK_READERS[file_format]
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path", "modificationTime")
    )

    def each(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        named = batch.select(F.col("path"), F.col("modificationTime").alias("fetched")).persist()
        try:
            paths = [row.path for row in named.select("path").orderBy("path").collect()]
            refused = _refused_archives(own, paths, number, quarantine_path) if file_format == "zip" else []
            paths = sorted(set(paths) - set(refused))
            if not paths:
                return
            named = named.where(~F.col("path").isin(refused)) if refused else named
            digests = digest_files(named.select("path")).persist()
            landed = named.join(digests, "path").select(
                F.col("path").alias("source_path"), F.col("digest").alias("sha256"), "fetched"
            )
            described = landed.select(
                F.col("source_path").alias("seq"),
                F.lit(dataset).alias("dataset"),
                F.lit(partition).alias("partition"),
                F.col("sha256").alias("source_sha256"),
                F.col("source_path").alias("source_url"),
                F.lit(_MEDIA_TYPES[file_format]).alias("source_media_type"),
                F.element_at(F.split("source_path", "/"), -1).alias("source_filename"),
                F.date_format("fetched", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
                F.lit(license_name).alias("license_name"),
                F.lit(license_url).alias("license_url"),
                "source_path",
            )
            # Spark spells a file's path with one slash or three, depending on who asks.
            place = F.regexp_replace("source_path", "^file:/+", "file:/")
            known = landed.select(place.alias("_place"), F.col("source_path").alias("_path"), "sha256", "fetched")
            rows = read(own, paths, id_column).withColumn("_place", place).join(F.broadcast(known), "_place")
            rows = rows.withColumn("source_path", F.col("_path")).drop("_place", "_path")
            rows = add_provenance(rows, F.col("sha256"), F.col("source_row_number"), F.col("fetched"))
            write_bulk_version(described, rows.drop("sha256", "fetched"), root, dataset, keep_sources=keep_sources)
            digests.unpersist()
        finally:
            named.unpersist()

    return _start(files, each, checkpoint, every)


def _refused_archives(spark: SparkSession, paths: list[str], number: int, quarantine_path: str | None) -> list[str]:
    """Paths, as given, of the archives that cannot be read whole; their reasons go to the quarantine."""
    plain = {re.sub("^file:/+", "file:/", path): path for path in paths}
    bad = zip_headers(spark, paths, "*", whole=True).where(F.col("reason").isNotNull()).select("path", "reason").persist()
    try:
        found = [plain[re.sub("^file:/+", "file:/", row.path if "://" in row.path or row.path.startswith("file:") else f"file:{row.path}")] for row in bad.collect()]
        if found and quarantine_path:
            _refuse(bad, quarantine_path, number)
        return found
    finally:
        bad.unpersist()


def _daily_log(log: DataFrame, path: str, number: int) -> None:
    """Append a batch to a log kept by day, stream and batch; a replay replaces its own part."""
    part = f"{_stream_id(log.sparkSession)}-{number}"
    log.withColumns({"day": F.to_date("ts"), "batch": F.lit(part)}).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day", "batch").parquet(path)


def _registries(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete registries, in order; a torn one counts as none."""
    names = [name for name in commits.child_folders(spark, path) if name.startswith("version=")]
    return sorted(int(n.partition("=")[2]) for n in names if commits.commit_note(spark, f"{path}/{n}") is not None)


def stream_job_health(
    run_log: DataFrame, log_path: str, health_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append run outcomes to the log and keep the health registry up to date.

    Each batch writes the whole registry, one row per job, as the next version; the version before
    it stays for readers, older ones go.  Jobs whose new runs all follow their last known run are
    carried forward at the cost of the batch alone; only where jobs have late runs is the log read,
    and those jobs folded again, so late rows, replays and new checkpoints count every row once.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _daily_log(batch, log_path, number)
            latest = batch.groupBy("job").agg(
                F.min("seq").alias("first_seq"), F.max("seq").alias("batch_seq")
            )
            versions = _registries(spark, health_path)
            if not versions:
                log = spark.read.parquet(log_path)
                newest = log.groupBy("job").agg(F.max("seq").alias("last_seq"))
                registry = join_by_keys(health_fold(log), newest, ["job"])
            else:
                prior = spark.read.parquet(f"{health_path}/version={versions[-1]}")
                known = join_by_keys(prior.select("job", "last_seq"), latest, ["job"], "full").persist()
                late = known.where(F.col("first_seq") <= F.col("last_seq")).select("job")
                if late.isEmpty():
                    registry = resume_health(prior, health_fold(batch))
                else:
                    log = spark.read.parquet(log_path)
                    redone = health_fold(join_by_keys(log, late, ["job"], "left_semi"))
                    carried = resume_health(
                        join_by_keys(prior, late, ["job"], "left_anti"),
                        health_fold(join_by_keys(batch, late, ["job"], "left_anti")),
                    )
                    registry = carried.unionByName(redone)
                newest = known.select("job", F.greatest("last_seq", "batch_seq").alias("last_seq"))
                registry = join_by_keys(registry, newest, ["job"])
            written = versions[-1] + 1 if versions else 0
            # A torn registry of an earlier attempt is overwritten, and none counts before its mark.
            registry.write.mode("overwrite").parquet(f"{health_path}/version={written}")
            commits.commit(spark, f"{health_path}/version={written}")
            for old in versions[:-1]:
                commits.forget(spark, f"{health_path}/version={old}")
        finally:
            batch.unpersist()

    return _start(run_log, each, checkpoint, every)


def current_health(spark: SparkSession, health_path: str) -> DataFrame:
    """The newest registry written by ``stream_job_health``."""
    newest = _registries(spark, health_path)[-1]
    return spark.read.parquet(f"{health_path}/version={newest}").drop("last_seq")


def stream_quota(
    requests: DataFrame, log_path: str, admission_path: str, daily_limit: int, checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append requests to the log and decide the days they fall on anew.

    The budget survives restarts because it is read from the log, and a request
    that arrives late takes its place in the order of its day.  Both tables are
    kept by day, so a batch reads and replaces only the days it touches.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _daily_log(batch, log_path, number)
            # Days are a bounded list; each names its folder, so the log of no other day is read.
            days = [row.day for row in batch.select(F.to_date("ts").alias("day")).distinct().collect()]
            log = spark.read.parquet(log_path)
            touched = reduce(Column.__or__, [F.col("day").eqNullSafe(F.lit(d).cast("date")) for d in days], F.lit(False))
            decided = quota_admission(log.where(touched).drop("batch", "day"), daily_limit)
            decided.hint("rebalance", "day").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("day").parquet(admission_path)
        finally:
            batch.unpersist()

    return _start(requests, each, checkpoint, every)
