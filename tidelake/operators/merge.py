"""Idempotent, keep-first merging of content-addressed snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.text import slug
from tidelake.operators.skew import first_per_key
from tidelake.schemas import MERGE_KEY


def add_partition_columns(snapshots: DataFrame) -> DataFrame:
    """Directory columns, named apart from the data columns they are made of."""
    return snapshots.withColumns(
        {
            "source_slug": slug("source"),
            "sport_slug": slug("sport"),
            "event_date": F.to_date("event_ts"),
        }
    )


def keep_first(
    snapshots: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = MERGE_KEY
) -> DataFrame:
    """The first-arrived row of every key; ``order`` is the arrival order."""
    return first_per_key(snapshots, keys, order)


def new_snapshots(
    incoming: DataFrame,
    existing: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = MERGE_KEY,
) -> DataFrame:
    """The rows a merge adds: first arrivals whose key is not stored yet.

    Copies are folded before the join, so both sides hold a key once and no key
    can be hot.  The join reuses the partitioning the fold left behind.
    """
    return keep_first(incoming, order, keys).join(existing.select(*keys), list(keys), "left_anti")


def merge_keep_first(
    existing: DataFrame,
    incoming: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = MERGE_KEY,
) -> DataFrame:
    """The merged archive: stored rows always win, then the first arrival."""
    return union_archive(existing, new_snapshots(incoming, existing, order, keys))


def union_archive(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Stored and added rows by column name; a column one side lacks is null there."""
    return existing.unionByName(added, allowMissingColumns=True)


def added_counts(
    incoming: DataFrame,
    existing: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = MERGE_KEY,
) -> DataFrame:
    """One row: how many snapshots arrived and how many of them are new."""
    received = incoming.agg(F.count("*").alias("received"))
    added = new_snapshots(incoming, existing, order, keys).agg(F.count("*").alias("added"))
    return received.select("received", added.scalar().alias("added"))


def key_differences(
    expected: DataFrame, stored: DataFrame, keys: Sequence[str] = MERGE_KEY
) -> DataFrame:
    """Keys held by one side only, marked ``missing`` or ``unexpected``; none when equal."""
    keys = list(keys)
    wanted, found = expected.select(*keys).distinct(), stored.select(*keys).distinct()
    missing = wanted.join(found, keys, "left_anti").withColumn("problem", F.lit("missing"))
    extra = found.join(wanted, keys, "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


def key_sets_equal(
    expected: DataFrame, stored: DataFrame, keys: Sequence[str] = MERGE_KEY
) -> DataFrame:
    """One row: whether both sides hold exactly the same keys."""
    return key_differences(expected, stored, keys).agg((F.count("*") == 0).alias("equal"))
