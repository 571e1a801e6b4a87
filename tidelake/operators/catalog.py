"""Catalog manifests, derived from the data they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import (
    CATALOG_DIR,
    CATALOG_SCHEMA_VERSION,
    PARTITION_COLUMNS,
    REQUIRED_MANIFEST_KEYS,
    REQUIRED_PARTITION_KEYS,
    STAGING_DIR,
)


def iso_text(instant: Column) -> Column:
    """An instant as ISO-8601 text in UTC; the fraction appears only where there is one."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(instant, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(whole, fraction, F.lit("+00:00"))


def partition_key(dataset: str) -> Column:
    """Directory of a partition below the lake root."""
    parts = [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in PARTITION_COLUMNS]
    return F.concat_ws("/", F.lit(dataset), *parts)


def partition_stats(
    snapshots: DataFrame, partitions: Sequence[str] = PARTITION_COLUMNS, ts: str = "event_ts"
) -> DataFrame:
    """Rows and time span per partition.

    The partial aggregates run before the shuffle, so a partition holding a
    third of the archive still reaches its reducer as one row per map task.
    """
    return snapshots.groupBy(*partitions).agg(
        F.count("*").alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )


def refresh_partition_stats(
    stored: DataFrame, touched: DataFrame, partitions: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    """Replace the entries of touched partitions and keep the others as they are."""
    kept = stored.join(touched.select(*partitions), list(partitions), "left_anti")
    return kept.unionByName(touched)


def manifest_partitions(stats: DataFrame, key: Column, updated_at: Column) -> DataFrame:
    """Partition entries in the shape of the manifest."""
    return stats.select(
        key.alias("partition"),
        "rows",
        iso_text(F.col("min_ts")).alias("min_ts"),
        iso_text(F.col("max_ts")).alias("max_ts"),
        iso_text(updated_at).alias("updated_at"),
    )


def manifest_lines(
    entries: DataFrame,
    schema: dict[str, str],
    dataset: str,
    ts_column: str,
    key_columns: Sequence[str],
    updated_at: Column,
    extra: Column | None = None,
) -> DataFrame:
    """The manifest as JSON lines, one per partition, each with the dataset header.

    One line per partition keeps the manifest a distributed table: no task ever
    holds the whole catalog.  ``extra`` is a struct column of further keys.
    """
    columns = F.create_map(*[F.lit(v) for pair in schema.items() for v in pair])
    fields = [
        F.lit(dataset).alias("dataset"),
        F.lit(CATALOG_SCHEMA_VERSION).alias("schema_version"),
        F.lit(ts_column).alias("ts_column"),
        F.array(*[F.lit(k) for k in key_columns]).alias("key_columns"),
        columns.alias("schema"),
        F.create_map(
            F.col("partition"),
            F.struct(*[F.col(name) for name in ("max_ts", "min_ts", "rows", "updated_at")]),
        ).alias("partitions"),
        iso_text(updated_at).alias("updated_at"),
    ]
    if extra is not None:
        fields.append(extra.alias("artifact"))
    return entries.select(F.to_json(F.struct(*fields)).alias("value"))


def schema_union(columns: DataFrame) -> DataFrame:
    """Column name to the type the first file gives it.

    Input: ``file``, ``name``, ``type``.  The minimum is taken over (file, type)
    pairs with partial aggregation, one row per column name leaves each task.
    """
    return columns.groupBy("name").agg(F.min(F.struct("file", "type")).alias("first")).select(
        "name", F.col("first.type").alias("type")
    )


def missing_keys(required: Sequence[str], present: Column) -> Column:
    """Required names that an array of names lacks, in order."""
    return F.array_except(F.array(*[F.lit(name) for name in required]), present)


def _keys_or_none(json_text: Column) -> Column:
    return F.coalesce(F.json_object_keys(json_text), F.array().cast("array<string>"))


def validate_manifest(manifests: DataFrame, body: str = "body") -> DataFrame:
    """Violations of the manifest contract, one row each; none for a readable manifest.

    Input: one JSON manifest per row in ``body``.  Violations carry the dataset,
    the partition (null at the top level) and the missing keys.  Partitions are
    checked as exploded rows, so a manifest may hold any number of them.
    """
    text = F.col(body)
    parsed = manifests.select(
        F.coalesce(F.get_json_object(text, "$.dataset"), F.lit("<unnamed>")).alias("dataset"),
        missing_keys(REQUIRED_MANIFEST_KEYS, _keys_or_none(text)).alias("absent"),
        F.from_json(text, "partitions string")["partitions"].alias("partitions"),
    )
    top = parsed.where(F.size("absent") > 0).select(
        "dataset",
        F.lit(None).cast("string").alias("partition"),
        F.lit("missing manifest keys").alias("problem"),
        F.array_join("absent", ",").alias("keys"),
    )
    complete = parsed.where(F.size("absent") == 0)
    entries = F.from_json("partitions", "map<string,string>")
    unmapped = complete.where(entries.isNull()).select(
        "dataset",
        F.lit(None).cast("string").alias("partition"),
        F.lit("partitions is not a mapping").alias("problem"),
        F.lit("partitions").alias("keys"),
    )
    each = complete.select("dataset", F.explode(entries).alias("partition", "entry")).select(
        "dataset",
        "partition",
        F.json_object_keys("entry").isNull().alias("unmapped"),
        missing_keys(REQUIRED_PARTITION_KEYS, _keys_or_none(F.col("entry"))).alias("absent"),
    )
    partial = each.where(F.size("absent") > 0).select(
        "dataset",
        "partition",
        F.when(F.col("unmapped"), "partition is not a mapping")
        .otherwise("missing partition keys")
        .alias("problem"),
        F.array_join("absent", ",").alias("keys"),
    )
    return top.unionByName(unmapped).unionByName(partial)


def bulk_datasets(provenance_files: DataFrame, key: str = "key") -> DataFrame:
    """Datasets that hold at least one provenance record, from lake-relative paths."""
    parts = F.split(F.col(key), "/")
    return (
        provenance_files.where(F.size(parts) > 1)
        .select(parts[0].alias("dataset"))
        .where(~F.col("dataset").isin(CATALOG_DIR, STAGING_DIR))
        .distinct()
        .orderBy("dataset")
    )


def bulk_manifest(artifacts: DataFrame) -> DataFrame:
    """Per dataset: artifacts, rows and the span of fetch times (null without artifacts)."""
    fetched = F.try_to_timestamp("fetched_at")
    return artifacts.groupBy("dataset").agg(
        F.count("*").alias("artifacts"),
        F.sum("rows").alias("rows"),
        F.min(fetched).alias("min_ts"),
        F.max(fetched).alias("max_ts"),
    )
