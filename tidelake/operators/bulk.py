"""Immutable imports of historical dumps: provenance, new versions and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import artifact_directory, safe_component
from tidelake.operators.skew import first_per_key

ARTIFACT_KEY = ["dataset", "partition", "source_sha256"]


def add_provenance(
    rows: DataFrame, sha256: Column, row_number: Column, fetched_at: Column
) -> DataFrame:
    """The publisher's columns plus which file and which row of it they came from, and when."""
    return rows.withColumns(
        {
            "source_sha256": sha256,
            "source_row_number": row_number.cast("bigint"),
            "source_fetched_at": fetched_at.cast("timestamp"),
        }
    )


def artifact_paths(artifacts: DataFrame) -> DataFrame:
    """Where an artifact version lives; ``partition`` holds its parts joined by slashes."""
    directory = artifact_directory(
        F.col("dataset"), F.split("partition", "/"), F.col("source_sha256")
    )
    return artifacts.withColumn("_dir", directory).withColumns(
        {
            "source_file": F.concat(
                F.col("_dir"), F.lit("/source-"), safe_component("source_filename")
            ),
            "data_file": F.concat(F.col("_dir"), F.lit("/data.parquet")),
        }
    ).drop("_dir")


def stored_artifacts(artifacts: DataFrame, inventory: DataFrame) -> DataFrame:
    """Recorded artifacts whose data file is really there."""
    files = inventory.select(F.col("key").alias("data_file"))
    return artifacts.join(files, "data_file", "left_semi")


def new_artifacts(incoming: DataFrame, stored: DataFrame, arrival: str = "seq") -> DataFrame:
    """Artifacts to import: first arrivals whose content this partition does not hold yet."""
    known = stored.select(*ARTIFACT_KEY).distinct()
    return first_per_key(incoming, ARTIFACT_KEY, [arrival]).join(known, ARTIFACT_KEY, "left_anti")


def import_results(incoming: DataFrame, stored: DataFrame, arrival: str = "seq") -> DataFrame:
    """Every attempted artifact with whether it was added, and its rows if so."""
    new = new_artifacts(incoming, stored, arrival).select(arrival, F.lit(True).alias("added"))
    marked = incoming.join(new, arrival, "left")
    added = F.coalesce("added", F.lit(False))
    return marked.select(
        arrival,
        "source",
        *ARTIFACT_KEY,
        F.when(added, F.col("rows")).otherwise(0).alias("rows"),
        added.alias("added"),
    )


def import_summary(results: DataFrame) -> DataFrame:
    """Per import source: artifacts attempted and added, rows of the added ones."""
    return results.groupBy("source").agg(
        F.count("*").alias("attempted"),
        F.count_if("added").alias("added"),
        F.coalesce(F.sum(F.when(F.col("added"), F.col("rows"))), F.lit(0)).alias("rows"),
    )


def refresh_outcome(summaries: DataFrame) -> DataFrame:
    """Outcome of a refresh run over import summaries.  Counts artifacts, not rows."""
    return summaries.agg(
        F.lit("ok").alias("status"),
        F.coalesce(F.sum("attempted"), F.lit(0)).alias("fetched"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("added"),
        F.concat(F.count("*").cast("string"), F.lit(" datasets")).alias("detail"),
    )


def row_count_mismatches(
    announced: DataFrame, stored_rows: DataFrame, keys: Sequence[str] = ("version",)
) -> DataFrame:
    """Versions whose stored row count differs from what the import wrote.

    ``announced``: the keys of a version and its rows.  ``stored_rows`` are counted
    with partial aggregates.
    """
    keys = list(keys)
    found = stored_rows.groupBy(*keys).agg(F.count("*").alias("stored"))
    return (
        announced.join(found, keys, "left")
        .withColumn("stored", F.coalesce("stored", F.lit(0)))
        .where(F.col("stored") != F.col("rows"))
    )
