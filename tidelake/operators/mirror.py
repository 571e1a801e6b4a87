"""Auditing a lake against its mirror: what to copy, prune, refresh and restore.

Inventory columns: key, size, dataset, is_source, is_parquet, and where content
was read digest and rows.  Mirror columns: key, digest, rows.  Keys are unique
on both sides, so every join here is balanced by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import READBACK_DATASETS


def prunable(inventory: DataFrame) -> Column:
    """Source files, except of datasets whose sources a later run reads back."""
    return inventory["is_source"] & ~inventory["dataset"].isin(READBACK_DATASETS)


def prunable_files(inventory: DataFrame) -> DataFrame:
    return inventory.where(prunable(inventory))


def oversize_files(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    """Files above a size limit; there is none unless the mirror's store sets one."""
    return inventory.where(F.lit(False) if limit is None else F.col("size") > limit)


def mirror_presence(inventory: DataFrame, mirror: DataFrame) -> DataFrame:
    """Every local file with whether the mirror already holds its key."""
    held = mirror.select("key", F.lit(True).alias("present"))
    return inventory.join(held, "key", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def verify_mirror(inventory: DataFrame, mirror: DataFrame) -> DataFrame:
    """Files held on both sides with a verdict on digest and, for Parquet, rows.

    ``problem`` is null where the copy is proven equal.
    """
    theirs = mirror.select(
        "key", F.col("digest").alias("mirror_digest"), F.col("rows").alias("mirror_rows")
    )
    pairs = inventory.join(theirs, "key")
    differs = ~F.col("digest").eqNullSafe(F.col("mirror_digest"))
    miscounted = F.col("is_parquet") & ~F.col("rows").eqNullSafe(F.col("mirror_rows"))
    return pairs.withColumn(
        "problem",
        F.when(
            differs,
            F.concat(
                F.lit("digests differ: local "),
                F.coalesce("digest", F.lit("none")),
                F.lit(", mirror "),
                F.coalesce("mirror_digest", F.lit("none")),
            ),
        ).when(
            miscounted,
            F.concat(
                F.lit("row counts differ: local "),
                F.coalesce(F.col("rows").cast("string"), F.lit("none")),
                F.lit(", mirror "),
                F.coalesce(F.col("mirror_rows").cast("string"), F.lit("none")),
            ),
        ),
    )


def sync_outcomes(
    inventory: DataFrame,
    held_before: DataFrame,
    held_after: DataFrame,
    prune: bool = False,
    dry_run: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """One decision per local file.

    ``held_before`` is the mirror before the run, ``held_after`` its read-back
    once missing files were copied.  An object held before is trusted unless it
    is to be pruned: a local file is only given up against a copy that was read
    back equal.  ``limit`` (off by default) refuses larger files, for stores that
    take objects up to some size only.
    """
    files = mirror_presence(inventory, held_before)
    if not dry_run:
        # A plan reads nothing back.
        checked = verify_mirror(inventory, held_after).select("key", "problem", F.lit(True).alias("read"))
        files = files.join(checked, "key", "left")
    size, present = F.col("size"), F.col("present")
    wanted = prunable(inventory) if prune else F.lit(False)
    trusted = present & ~wanted
    too_large = F.lit(False) if limit is None else size > limit
    oversize = F.concat(size.cast("string"), F.lit(f" bytes, over the limit of {limit}"))
    if dry_run:
        action = F.when(wanted, "would-prune").otherwise("would-upload")
        note = F.when(present, "present").otherwise("absent")
        freed = F.when(wanted, size).otherwise(0)
    else:
        problem = F.coalesce(F.col("problem"), F.when(F.col("read").isNull(), "no copy in the mirror"))
        action = F.when(problem.isNotNull(), "failed").when(wanted, "pruned").otherwise("uploaded")
        note = (
            F.when(problem.isNotNull(), problem)
            .when(~wanted, "")
            .when(present, "already-present")
            .otherwise("uploaded")
        )
        freed = F.when(problem.isNull() & wanted, size).otherwise(0)
    return files.select(
        "key",
        "dataset",
        F.when(too_large, "oversize").when(trusted, "present").otherwise(action).alias("status"),
        F.when(too_large, oversize).when(trusted, "").otherwise(note).alias("detail"),
        F.when(too_large | trusted, 0).otherwise(freed).cast("bigint").alias("freed_bytes"),
    )


def sync_summary(outcomes: DataFrame) -> DataFrame:
    """One row of totals over the decisions."""
    status, detail = F.col("status"), F.col("detail")
    pruned = status == "pruned"
    failed = status.isin("failed", "oversize")
    return outcomes.agg(
        (F.count_if(failed) == 0).alias("ok"),
        F.count("*").alias("scanned"),
        F.count_if((status == "uploaded") | (pruned & (detail == "uploaded"))).alias("uploaded"),
        F.count_if(status == "present").alias("already_present"),
        F.count_if((status == "uploaded") | pruned).alias("verified"),
        F.count_if(pruned).alias("pruned"),
        F.count_if(status.isin("would-upload", "would-prune")).alias("planned"),
        F.coalesce(F.sum(F.when(pruned, F.col("freed_bytes"))), F.lit(0)).alias("freed_bytes"),
        F.count_if(failed).alias("failures"),
    )


def top_failures(outcomes: DataFrame, shown: int = 10) -> DataFrame:
    """The first failures by key for a status report, each with how many are left out.

    The number shown is the report's feature; all failures are the ``failed`` and ``oversize``
    rows of the outcomes.
    """
    failed = outcomes.where(F.col("status").isin("failed", "oversize"))
    count = failed.agg(F.count("*").alias("n")).scalar()
    more = F.greatest(count - F.lit(shown), F.lit(0)).cast("bigint")
    return (
        failed.orderBy("key")
        .limit(shown)
        .select("key", "status", "detail", more.alias("more"))
    )


def mark_pruned(artifacts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Artifacts with the prune flag and mirror key set where this run pruned the source."""
    gone = outcomes.where(F.col("status") == "pruned").select(
        F.col("key").alias("source_file"), F.lit(True).alias("_gone")
    ).distinct()
    marked = artifacts.join(gone, "source_file", "left")
    return marked.withColumns(
        {
            "source_pruned": F.coalesce("_gone", "source_pruned"),
            "source_remote_key": F.when(F.col("_gone"), F.col("source_file")).otherwise(
                F.col("source_remote_key")
            ),
        }
    ).select(*artifacts.columns)


def stale_copies(artifacts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Mirror keys to write again after a prune: the records and catalogs that now changed."""
    pruned = outcomes.where(F.col("status") == "pruned")
    records = pruned.select(
        F.concat(F.regexp_replace("key", "[^/]*$", ""), F.lit("provenance.json")).alias("key")
    )
    sources = artifacts.select(F.col("source_file").alias("key"))
    catalogs = pruned.join(sources, "key", "left_semi").select(
        F.concat(F.lit("_catalog/"), F.col("dataset"), F.lit(".json")).alias("key")
    )
    return records.unionByName(catalogs).distinct().withColumn("status", F.lit("refreshed"))


def pruned_records(artifacts: DataFrame) -> DataFrame:
    return artifacts.where(F.coalesce("source_pruned", F.lit(False)))


def restore_plan(artifacts: DataFrame, mirror: DataFrame) -> DataFrame:
    """For every pruned artifact: restore it, or why that is refused.

    Artifacts may share a mirror object (copies of one file), so the digest is
    matched per key; the mirror side holds each key once.
    """
    wanted = pruned_records(artifacts).withColumn(
        "key", F.coalesce(F.nullif("source_remote_key", F.lit("")), "source_file")
    )
    plan = wanted.join(mirror.select("key", F.col("digest").alias("mirror_digest")), "key", "left")
    expected = F.coalesce("source_sha256", F.lit(""))
    detail = F.when(F.col("mirror_digest").isNull(), "no copy in the mirror").when(
        (expected != "") & (F.col("mirror_digest") != expected),
        F.concat(
            F.lit("the copy's digest "),
            F.col("mirror_digest"),
            F.lit(" is not the recorded "),
            expected,
        ),
    )
    return plan.select(
        "key",
        "dataset",
        "partition",
        "source_file",
        F.when(detail.isNull(), "restored").otherwise("failed").alias("status"),
        F.coalesce(detail, F.lit("")).alias("detail"),
    )


def clear_restored(artifacts: DataFrame, plan: DataFrame) -> DataFrame:
    """Artifacts with the prune flags removed where the source was restored."""
    back = plan.where(F.col("status") == "restored").select(
        "source_file", F.lit(True).alias("_back")
    ).distinct()
    joined = artifacts.join(back, "source_file", "left")
    return joined.withColumns(
        {
            "source_pruned": F.when(F.col("_back").isNull(), F.col("source_pruned")),
            "source_remote_key": F.when(F.col("_back").isNull(), F.col("source_remote_key")),
        }
    ).select(*artifacts.columns)


def source_state(catalogued: DataFrame, provenance: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per catalogued artifact: source present, pruned (and where to), or missing.

    The catalog copy may be older than the record beside the data, so a prune
    noted in either counts.
    """
    files = inventory.select(F.col("key").alias("source_file"), F.lit(True).alias("_here"))
    beside = provenance.groupBy("source_file").agg(
        F.max("source_pruned").alias("_pruned"), F.max("source_remote_key").alias("_remote")
    )
    joined = catalogued.join(files, "source_file", "left").join(beside, "source_file", "left")
    pruned = F.coalesce("source_pruned", F.lit(False)) | F.coalesce("_pruned", F.lit(False))
    remote = F.coalesce(
        F.nullif("source_remote_key", F.lit("")), F.nullif("_remote", F.lit("")), F.lit("the mirror")
    )
    state = F.when(F.col("_here"), "present").when(pruned, "pruned").otherwise("missing")
    return joined.select(
        "dataset",
        "partition",
        "source_file",
        state.alias("state"),
        F.when(state == "pruned", remote).alias("restore_from"),
    )


def file_digests(files: DataFrame) -> DataFrame:
    """SHA-256 of each file's ``content``."""
    return files.select("key", F.sha2("content", 256).alias("digest"))
