"""Writing imported dumps and the lake's derived records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.storagelevel import StorageLevel

from tidelake.functions.text import safe_component
from tidelake.operators import manifest_log
from tidelake.operators.archive import VerificationError, near_partitions
from tidelake.operators.bulk import ARTIFACT_KEY, new_artifacts, row_count_mismatches
from tidelake.operators.catalog import (
    iso_text,
    manifest_lines,
    manifest_partitions,
    partition_key,
    schema_union,
)
from tidelake.operators.transfer import copy_files
from tidelake.schemas import (
    ARTIFACT,
    BULK_KEY,
    CATALOG_DIR,
    DATA_FILES,
    EVENT_SNAPSHOT,
    EVENTS_DATASET,
    NATURAL_KEY,
    ODDS_DATASET,
    ODDS_SNAPSHOT,
    PARTITION_COLUMNS,
    PROVENANCE_FILE,
    SOURCE_FILE_PREFIX,
)
from tidelake.session import spread
from tidelake.sources import commits
from tidelake.sources.dumps import parquet_columns
from tidelake.sources.footers import footer_stats
from tidelake.sources.lake import archive_path, path_exists, relative_key, scan_files
from tidelake.sources.paths import write_in_task

ARTIFACTS_TABLE = f"{CATALOG_DIR}/artifacts"


@dataclass(frozen=True)
class BulkResult:
    attempted: int
    added: int
    rows: int
    refused: int = 0


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Recorded artifact versions of all datasets, every generation."""
    path = f"{root.rstrip('/')}/{ARTIFACTS_TABLE}"
    shape = T.StructType([*ARTIFACT.fields, T.StructField("generation", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(path)


def version_of(sha256: Column) -> Column:
    return F.substring(sha256, 1, 16)


def folder_columns(partition: str) -> list[str]:
    """Folder columns of a partition ``name=value/...``, named apart from the publisher's columns.

    A part without a name is called by its place.
    """
    parts = [part.partition("=") for part in partition.split("/") if part]
    return [f"part_{name if found else number}" for number, (name, found, _) in enumerate(parts, 1)]


def _folder_values(partition: Column, count: int) -> list[Column]:
    parts = F.filter(F.split(partition, "/"), lambda part: part != "")
    values = F.transform(parts, lambda part: F.when(F.contains(part, F.lit("=")), F.regexp_replace(part, "^[^=]*=", "")).otherwise(part))
    return [safe_component(F.get(values, F.lit(i))) for i in range(count)]


def _layout(partition: Column) -> Column:
    """Names of a partition's parts, without values: artifacts of one layout are written together."""
    return F.regexp_replace(F.regexp_replace(partition, "=[^/]*", "="), "(^|/)[^=/]+(?=/|$)", "$1_")


def version_folder(artifacts: DataFrame, columns: Sequence[str]) -> Column:
    """Folder below the lake root that holds an artifact's rows."""
    values = _folder_values(F.col("partition"), len(columns))
    named = [F.concat(F.lit(f"{name}="), value) for name, value in zip(columns, values, strict=True)]
    return F.concat_ws("/", "dataset", *named, F.concat(F.lit("version="), version_of(F.col("source_sha256"))))


def stored_folders(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(data_file): folders of a dataset, relative to the lake root, in which Parquet files lie."""
    if not path_exists(spark, archive_path(root, dataset)):
        return spark.createDataFrame([], "data_file string")
    name = F.element_at(F.split("path", "/"), -1)
    files = scan_files(spark, archive_path(root, dataset)).where(name.endswith(".parquet") & ~name.startswith(SOURCE_FILE_PREFIX))
    return files.select(F.regexp_replace(relative_key(F.col("path"), root), "/[^/]*$", "").alias("data_file")).distinct()


def present_artifacts(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Recorded artifacts of a dataset that are still there: the newest record of each, if its folder holds files.

    A file without rows leaves no folder and is there as long as its record is.
    """
    records = current_artifacts(read_artifacts(spark, root).where(F.col("dataset") == dataset))
    held = records.join(stored_folders(spark, root, dataset), "data_file", "left_semi")
    return held.unionByName(records.where(F.col("rows") == 0))


def current_artifacts(records: DataFrame) -> DataFrame:
    """The newest record of every artifact; a later record, as a prune leaves, replaces the earlier."""
    newest = records.groupBy(*ARTIFACT_KEY).agg(
        F.max_by(F.struct(*[c for c in ARTIFACT.fieldNames() if c not in ARTIFACT_KEY]), "generation").alias("r")
    )
    return newest.select(*[c if c in ARTIFACT_KEY else F.col(f"r.{c}") for c in ARTIFACT.fieldNames()])


def _refuse_shared_folders(new: DataFrame, records: DataFrame) -> None:
    """A version folder is named by part of a hash; two contents under one name must never meet."""
    named = ["dataset", "partition", "_version"]
    every = new.select(*ARTIFACT_KEY).unionByName(records.select(*ARTIFACT_KEY)).withColumn("_version", version_of(F.col("source_sha256")))
    clash = every.groupBy(*named).agg(F.min("source_sha256").alias("one"), F.max("source_sha256").alias("other"))
    found = clash.where(F.col("one") != F.col("other")).first()
    if found:
        raise VerificationError(f"{found.dataset}/{found.partition}: {found.one} and {found.other} share a version folder")


def write_bulk_version(
    files: DataFrame, rows: DataFrame, root: str, dataset: str, refused: DataFrame | None = None, keep_sources: bool = False
) -> BulkResult:
    """Import dump files as immutable versions below ``root/dataset``.

    ``files``: seq, dataset, partition, source_sha256, source_url,
    source_media_type, source_filename, fetched_at (text), license_name,
    license_url, source_path.  ``rows``: publisher columns, source_path and the
    provenance columns.  The folders follow from each file's ``partition``
    (``part_<name>``, so that they never shadow a publisher's column) and its hash.
    Content that a partition already holds is skipped if its folder is still there.  Files named in
    ``refused`` (source_path) are not imported and get no record, so they are tried again; a file
    that was read and has no rows is recorded with none.

    With ``keep_sources`` every file is copied, as it is, beside its rows (``source-<name>``), the digest
    checked on the way; the record's ``source_file`` is then that key below the root, which the
    audits of the mirror go by.

    Data lands before its record.  A run that dies in between leaves a version
    without a record; the next run writes exactly that version folder anew, so
    nothing is ever stored twice.
    """
    spark = files.sparkSession
    base = root.rstrip("/")
    attempted, readable = files.count(), files
    if refused is not None:
        readable = files.join(refused.select("source_path").distinct(), "source_path", "left_anti").select(*files.columns)
    failed = attempted - readable.count() if refused is not None else 0
    new = new_artifacts(readable, present_artifacts(spark, root, dataset)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        added = new.count()
        if added == 0:
            return BulkResult(attempted, 0, 0, failed)
        _refuse_shared_folders(new, read_artifacts(spark, root).where(F.col("dataset") == dataset))
        total = 0
        # One pass for each layout of partitions, which are settings of a dataset: mostly one.
        for row in new.groupBy(_layout(F.col("partition")).alias("layout")).agg(F.min("partition").alias("partition")).collect():
            chosen = new.where(_layout(F.col("partition")) == row.layout)
            total += _write_layout(chosen, rows, base, dataset, folder_columns(row.partition), keep_sources)
        return BulkResult(attempted, added, total, failed)
    finally:
        new.unpersist()


def source_key(files: DataFrame, columns: Sequence[str]) -> Column:
    """Key below the lake root of the copy of an imported file."""
    return F.concat(version_folder(files, columns), F.lit(f"/{SOURCE_FILE_PREFIX}"), safe_component("source_filename"))


def _copy_sources(new: DataFrame, base: str, columns: Sequence[str]) -> None:
    key = source_key(new, columns)
    target = F.concat(F.lit(f"{base}/"), key)
    wanted = new.select(key.alias("key"), F.col("source_path").alias("path"), target.alias("target"), F.col("source_sha256").alias("digest"))
    # Few tasks copy many files each otherwise: the list of files is short, the files are long.
    bad = copy_files(spread(wanted)).where(F.col("status") != "copied").first()
    if bad:
        raise VerificationError(f"{bad.key}: {bad.detail}")


def _write_layout(
    new: DataFrame, rows: DataFrame, base: str, dataset: str, columns: Sequence[str], keep_sources: bool
) -> int:
    spark, path = new.sparkSession, archive_path(base, dataset)
    values = dict(zip(columns, _folder_values(F.col("partition"), len(columns)), strict=True))
    chosen = new.withColumns({**values, "version": version_of(F.col("source_sha256"))})
    layout = [*columns, "version"]
    # One row per new file; adaptive execution sees its size before choosing the join.
    data = rows.join(chosen.select("source_path", *layout), "source_path")
    written = data.drop("source_path")
    (
        written.hint("rebalance", *layout)
        .sortWithinPartitions(*layout, "source_row_number")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*layout)
        .parquet(path)
    )
    announced = data.groupBy("source_path", *layout).agg(F.count("*").alias("rows")).persist()
    try:
        stored = spark.read.schema(written.schema).option("pathGlobFilter", DATA_FILES).parquet(path)
        again = stored.join(announced.select(*layout).distinct(), layout, "left_semi")
        if not row_count_mismatches(announced, again, layout).isEmpty():
            raise VerificationError(f"row counts of {dataset} differ after writing")
        total = announced.agg(F.sum("rows")).first()[0] or 0
        if keep_sources:
            _copy_sources(new, base, columns)
        # Last: once the records are written, asking for new artifacts finds none.
        write_provenance(_records(new, announced, columns, keep_sources), base)
    finally:
        announced.unpersist()
    return total


def _records(new: DataFrame, counted: DataFrame, columns: Sequence[str], keep_sources: bool) -> DataFrame:
    """Provenance of imported files; ``data_file`` is the folder of the rows, ``source_file`` the key of the
    copy or, without one, where the file was read from.  A file without rows counts zero."""
    source = source_key(new, columns) if keep_sources else F.col("source_path")
    return new.join(counted.select("source_path", "rows"), "source_path", "left").select(
        "dataset",
        "partition",
        "source_url",
        "source_sha256",
        "source_media_type",
        source.alias("source_file"),
        version_folder(new, columns).alias("data_file"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        "fetched_at",
        "license_name",
        "license_url",
        F.lit(None).cast("boolean").alias("source_pruned"),
        F.lit(None).cast("string").alias("source_remote_key"),
    )


def write_provenance(records: DataFrame, root: str) -> None:
    """Append artifact records; they are never changed in place.

    A record written again (a prune, a restore, a lost version imported anew) is a new generation,
    and ``current_artifacts`` takes the newest.  The same records go beside the data, one
    ``provenance.json`` in each version folder that holds rows.
    """
    stamped = records.select(*ARTIFACT.fieldNames()).withColumn("generation", F.unix_micros(F.current_timestamp()))
    stamped = stamped.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stamped.write.mode("append").parquet(f"{root.rstrip('/')}/{ARTIFACTS_TABLE}")
        _write_beside(stamped.drop("generation"), root.rstrip("/"))
    finally:
        stamped.unpersist()


def _write_beside(records: DataFrame, root: str) -> None:
    """Tasks write one small document per version folder; a repeated write leaves the same bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, body in zip(batch["folder"].to_pylist(), batch["body"].to_pylist(), strict=True):
                write_in_task(f"{root}/{folder}/{PROVENANCE_FILE}", body.encode())
            yield pa.RecordBatch.from_pydict({"done": pa.array([batch.num_rows], pa.int64())})

    held = records.where((F.col("rows") > 0) & F.col("data_file").isNotNull())
    bodies = held.select(F.col("data_file").alias("folder"), F.to_json(F.struct("*")).alias("body"))
    bodies.mapInArrow(write, "done bigint").count()


def write_flags(artifacts: DataFrame, root: str) -> int:
    """Store changed prune and restore flags: a new generation of the records that differ."""
    known = current_artifacts(read_artifacts(artifacts.sparkSession, root))
    flags = F.struct("source_pruned", "source_remote_key")
    before = known.select(*ARTIFACT_KEY, flags.alias("_before"))
    changed = artifacts.join(before, ARTIFACT_KEY).where(~flags.eqNullSafe(F.col("_before"))).drop("_before")
    changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = changed.count()
        if count:
            write_provenance(changed, root)
        return count
    finally:
        changed.unpersist()


# ------------------------------------------------------------------- manifests


def _known(spark: SparkSession, root: str, dataset: str) -> list[commits.Generation]:
    """The generations that a manifest derived from now on takes the place of."""
    return commits.generations(spark, manifest_log.log_path(root, dataset))


def _schema_map(spark: SparkSession, root: str, dataset: str) -> dict[str, str]:
    """Column to Arrow type name, as the first file (by path) that has the column gives it.

    Footers are read in tasks; what returns is one row for each column.
    """
    union = schema_union(parquet_columns(spark, archive_path(root, dataset), DATA_FILES))
    return {row.name: row.type for row in union.orderBy("name").collect()}


def _snapshot_types(dataset: str) -> dict[str, str]:
    """Column to Arrow type name of a snapshot archive; its shape is the contract, no file is looked at."""
    shape = EVENT_SNAPSHOT if dataset == EVENTS_DATASET else ODDS_SNAPSHOT
    return {field.name: str(field.type) for field in to_arrow_schema(shape)}


def write_snapshot_manifest(spark: SparkSession, root: str, dataset: str, now: Column) -> None:
    """Derive and publish the manifest of an event or odds archive, from the footers of its files."""
    known = _known(spark, root, dataset)
    entries = manifest_partitions(footer_stats(spark, root, dataset), partition_key(dataset), now)
    lines = manifest_lines(entries, _snapshot_types(dataset), dataset, "event_ts", NATURAL_KEY, now)
    manifest_log.replace_entries(lines, root, dataset, known)


def refresh_snapshot_manifest(spark: SparkSession, root: str, dataset: str, touched: DataFrame, now: Column) -> None:
    """Renew the manifest entries of the partitions that a write touched; the others stay as they are.

    Only the footers of touched partitions are read, and only their entries are written.  Without a
    manifest all of it is derived.
    """
    if not _known(spark, root, dataset):
        write_snapshot_manifest(spark, root, dataset, now)
        return
    near = footer_stats(spark, root, dataset, where=near_partitions(touched))
    fresh = near.join(touched.select(*PARTITION_COLUMNS), PARTITION_COLUMNS, "left_semi")
    entries = manifest_partitions(fresh, partition_key(dataset), now)
    lines = manifest_lines(entries, _snapshot_types(dataset), dataset, "event_ts", NATURAL_KEY, now)
    manifest_log.append_entries(lines, root, dataset)


def write_bulk_manifest(spark: SparkSession, root: str, dataset: str, now: Column) -> None:
    """Derive and publish the manifest of an imported dataset from its records and data."""
    known = _known(spark, root, dataset)
    records = current_artifacts(read_artifacts(spark, root).where(F.col("dataset") == dataset))
    entries = records.select(
        F.col("data_file").alias("partition"),
        "rows",
        F.col("fetched_at").alias("min_ts"),
        F.col("fetched_at").alias("max_ts"),
        iso_text(now).alias("updated_at"),
        F.struct(*ARTIFACT.fieldNames()).alias("artifact"),
    )
    columns = _schema_map(spark, root, dataset)
    lines = manifest_lines(
        entries, columns, dataset, "source_fetched_at", BULK_KEY, now, F.col("artifact")
    )
    manifest_log.replace_entries(lines, root, dataset, known)


def rebuild_catalogs(spark: SparkSession, root: str, now: Column) -> list[str]:
    """Derive every manifest anew: events, odds, then imported datasets by name.

    Safe to repeat.  The driver loops over dataset names, a handful of settings;
    each manifest is one distributed job.
    """
    rebuilt = []
    for dataset in (EVENTS_DATASET, ODDS_DATASET):
        if path_exists(spark, archive_path(root, dataset)):
            write_snapshot_manifest(spark, root, dataset, now)
            rebuilt.append(dataset)
    names = read_artifacts(spark, root).select("dataset").distinct().orderBy("dataset").collect()
    for (dataset,) in names:
        if dataset not in rebuilt:
            write_bulk_manifest(spark, root, dataset, now)
            rebuilt.append(dataset)
    return rebuilt


def write_health(entries: DataFrame, path: str, now: Column) -> None:
    """Publish health entries, stamped with the time of writing."""
    entries.withColumn("written_at", now).write.mode("overwrite").parquet(path)
