"""Copying, pruning and restoring files of a lake in tasks, a chunk at a time, with the digest taken on the way."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.sources.paths import copy_in_task, delete_in_task, digest_in_task


def _each(files: DataFrame, act: Callable[[dict], tuple[str, str]]) -> DataFrame:
    """(key, status, detail): what became of every file; one that fails leaves the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, done = batch["key"].to_pylist(), []
            for row in batch.to_pylist():
                try:
                    done.append(act(row))
                except (OSError, pa.ArrowInvalid) as problem:
                    done.append(("failed", str(problem)))
            columns = [pa.array(c, pa.string()) for c in (keys, [s for s, _ in done], [d for _, d in done])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "status", "detail"])

    return files.mapInArrow(run, "key string, status string, detail string")


def copy_files(files: DataFrame) -> DataFrame:
    """(key, status, detail) of copies from ``path`` to ``target``; ``digest`` is what the content must have.

    A target appears under its name only when it is complete and its digest is right; one that is there is
    replaced.
    """

    def act(row: dict) -> tuple[str, str]:
        found = copy_in_task(row["path"], row["target"], row["digest"])
        if found == row["digest"]:
            return "copied", ""
        return "failed", f"the digest {found} is not the recorded {row['digest']}"

    return _each(files.select("key", "path", "target", "digest"), act)


def _below(root: str, key: str) -> Column:
    return F.concat(F.lit(f"{root.rstrip('/')}/"), F.col(key))


def mirror_files(inventory: DataFrame, root: str, mirror_root: str) -> DataFrame:
    """Copy the files of an inventory (key, digest) to the mirror."""
    return copy_files(inventory.select("key", _below(root, "key").alias("path"), _below(mirror_root, "key").alias("target"), "digest"))


def prune_sources(candidates: DataFrame, root: str, mirror_root: str) -> DataFrame:
    """Delete each candidate (key, digest) from the lake once its copy in the mirror is read back and equal.

    Outcomes are ``pruned``, or ``failed`` with the reason; a file that is gone already and whose copy is
    equal counts as pruned, so a run that died is repeated without harm.
    """
    base, store = root.rstrip("/"), mirror_root.rstrip("/")

    def act(row: dict) -> tuple[str, str]:
        held = digest_in_task(f"{store}/{row['key']}")
        if held is None:
            return "failed", "no copy in the mirror"
        if held != row["digest"]:
            return "failed", f"digests differ: local {row['digest']}, mirror {held}"
        delete_in_task(f"{base}/{row['key']}")
        return "pruned", ""

    return _each(candidates.select("key", "digest"), act)


def restore_sources(plan: DataFrame, artifacts: DataFrame, root: str, mirror_root: str) -> DataFrame:
    """The plan with what became of its copies back from the mirror; what the plan refuses stays refused.

    Plan columns as of ``restore_plan``; the recorded digest decides whether a copy is right.
    """
    digests = artifacts.select("source_file", F.col("source_sha256").alias("digest")).distinct()
    wanted = plan.where(F.col("status") == "restored").join(digests, "source_file")
    copied = copy_files(
        wanted.select(F.col("source_file").alias("key"), _below(mirror_root, "key").alias("path"), _below(root, "source_file").alias("target"), "digest")
    ).select(F.col("key").alias("source_file"), F.col("status").alias("_done"), F.col("detail").alias("_why"))
    failed = F.col("_done") == "failed"
    return plan.join(copied, "source_file", "left").select(
        "key", "dataset", "partition", "source_file",
        F.when(failed, "failed").otherwise(F.col("status")).alias("status"),
        F.when(failed, F.col("_why")).otherwise(F.col("detail")).alias("detail"),
    )
