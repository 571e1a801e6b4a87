"""Manifests as logs of entries.

A dataset's manifest is a log of generations below ``_catalog/<dataset>.log``.  A batch appends the entries of
the partitions it touched, and the newest entry of a partition counts.  From time to time the
entries are folded into a base.  A generation counts once it is complete, so a write that dies at any
point leaves every partition listed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.schemas import CATALOG_DIR
from tidelake.sources import commits

#: Generations after which a log is folded.
FOLD_AFTER = 24


def log_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{CATALOG_DIR}/{dataset}.log"


def entry_partition(body: Column) -> Column:
    """The partition that a line of a manifest describes."""
    return F.map_keys(F.from_json(body, "partitions map<string,string>")["partitions"])[0]


def read_entries(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """(body): the newest line of every partition, each a manifest on its own; None without a log.

    Where two generations share a number, as those of two writers may, the entry derived later counts.
    """
    path = log_path(root, dataset)
    held = commits.generations(spark, path)
    if not held:
        return None
    if len(held) == 1:
        return spark.read.text(f"{path}/{held[0].name}").select(F.col("value").alias("body"))
    return _newest(spark, path, held)


def _newest(spark: SparkSession, path: str, held: list[commits.Generation]) -> DataFrame:
    lines = spark.read.text([f"{path}/{g.name}" for g in held])
    name = F.element_at(F.split("_metadata.file_path", "/"), -2)
    number = F.split(name, "-")[1].cast("bigint")
    derived = F.get_json_object("value", "$.updated_at")
    order = F.struct(number, derived, name)
    newest = lines.groupBy(entry_partition(F.col("value")).alias("partition")).agg(F.max_by("value", order).alias("body"))
    return newest.select("body")


def _write(lines: DataFrame, path: str, name: str, replaces: list[str]) -> None:
    spark = lines.sparkSession
    lines.write.text(f"{path}/{name}")
    commits.commit(spark, f"{path}/{name}", "\n".join(replaces))


def generation_name(kind: str, number: int) -> str:
    return f"{kind}-{number:012d}-{uuid.uuid4().hex[:12]}"


def append_entries(lines: DataFrame, root: str, dataset: str, fold_after: int = FOLD_AFTER) -> None:
    """Add the entries (value) of the partitions that a write touched.

    Writers need not wait for one another: each adds a generation of its own.
    """
    spark, path = lines.sparkSession, log_path(root, dataset)
    _write(lines, path, generation_name("part", commits.next_number(spark, path)), [])
    held = commits.generations(spark, path)
    if len(held) > fold_after:
        fold(spark, root, dataset, held)


def replace_entries(lines: DataFrame, root: str, dataset: str, known: list[commits.Generation]) -> None:
    """Publish a whole manifest in place of the generations ``known`` before it was derived."""
    spark, path = lines.sparkSession, log_path(root, dataset)
    _write(lines, path, generation_name("base", commits.next_number(spark, path)), [g.name for g in known])
    sweep(spark, path)


def fold(spark: SparkSession, root: str, dataset: str, held: list[commits.Generation] | None = None) -> None:
    """Write the newest entries of the given generations, by default of all, as a base in their place."""
    path = log_path(root, dataset)
    held = commits.generations(spark, path) if held is None else held
    if len(held) < 2:
        return
    # It takes the number of the newest generation it holds: one that comes meanwhile has a later entry.
    _write(_newest(spark, path, held).select(F.col("body").alias("value")), path, generation_name("base", held[-1].number), [g.name for g in held])
    sweep(spark, path)


def sweep(spark: SparkSession, path: str) -> None:
    """Delete what the base before the newest one stood for: readers may still be at the generations of that one.

    A base keeps naming what it replaced, also after a run died between its mark and this.
    """
    names = set(commits.child_folders(spark, path))
    bases = [name for name in sorted(names) if name.startswith("base-") and commits.commit_note(spark, f"{path}/{name}") is not None]
    for base in bases[:-1]:
        for gone in (commits.commit_note(spark, f"{path}/{base}") or "").split():
            if gone in names:
                commits.forget(spark, f"{path}/{gone}")
