"""Totals over ingestion runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.catalog import partition_key


def ingest_rows(touched: DataFrame, dataset: str, day: Column) -> DataFrame:
    """What a write touched, as rows of ``ingest_summary``: day, partition, fetched, added."""
    return touched.select(
        day.alias("day"), partition_key(dataset).alias("partition"), F.col("arrived").alias("fetched"), "added"
    )


def ingest_summary(writes: DataFrame) -> DataFrame:
    """One row: days, snapshots fetched and added, partitions touched.

    Input: one row per (day, partition) write with fetched and added.  The
    touched partitions themselves are rows of ``touched_partitions``.
    """
    return writes.agg(
        F.countDistinct("day").alias("days"),
        F.coalesce(F.sum("fetched"), F.lit(0)).alias("snapshots_fetched"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("snapshots_added"),
        F.countDistinct("partition").alias("partitions"),
    )


def touched_partitions(*writes: DataFrame) -> DataFrame:
    """Distinct partitions over any number of writes, sorted."""
    every = reduce(DataFrame.union, [w.select("partition") for w in writes])
    return every.distinct().orderBy("partition")
