"""Digests kept between inventories, so that files which have not changed are not read again.

The ledger is a log of generations (``manifest_log``) below the lake's catalog.  A digest is used again for a
file of the same key, size and modification time that had been still for a while when it was digested:
a file written in the very instant of its listing could change once more without showing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.manifest_log import FOLD_AFTER, generation_name, sweep
from tidelake.operators.skew import join_by_keys
from tidelake.schemas import CATALOG_DIR
from tidelake.session import pin_utc, scratch_path, spread
from tidelake.sources import commits
from tidelake.sources.lake import digest_files, inventory, scan_files

_ENTRY = "key string, size bigint, modified timestamp, digest string, rows bigint, listed_at timestamp"
_SAME = ["key", "size", "modified"]


def ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}/{CATALOG_DIR}/digests.log"


def _entries(spark: SparkSession, path: str, held: list[commits.Generation]) -> DataFrame:
    """The newest entry of every key in the given generations."""
    if not held:
        return spark.createDataFrame([], _ENTRY)
    rows = spark.read.schema(_ENTRY).parquet(*[f"{path}/{g.name}" for g in held])
    newest = F.max_by(F.struct("size", "modified", "digest", "rows", "listed_at"), F.struct("listed_at", "digest"))
    return rows.groupBy("key").agg(newest.alias("e")).select("key", "e.*")


def ledger_inventory(
    spark: SparkSession, root: str, ledger: str | None = None, still_seconds: float = 2.0, fold_after: int = FOLD_AFTER
) -> DataFrame:
    """``lake_inventory`` that reads only files the ledger does not know; ``reread`` tells which those were.

    The files read are added to the ledger as one generation that counts once it is complete, so a run that
    dies leaves the ledger as it was.  After ``fold_after`` generations they are folded into a base without
    the files that are gone.  ``ledger`` is by default in the lake's catalog; it names keys of one lake.
    """
    pin_utc(spark)
    path = ledger or ledger_path(root)
    held = commits.generations(spark, path)
    files = scan_files(spark, root).select("path", "key", "length", F.col("modificationTime").alias("modified"))
    listed = inventory(files).join(files.select("key", "path", "modified"), "key")
    quiet = F.col("modified") < F.col("listed_at") - F.make_dt_interval(secs=F.lit(still_seconds).cast("decimal(18,6)"))
    known = _entries(spark, path, held).where(quiet).select(*_SAME, "digest", "rows")
    noted = scratch_path(spark, "listing")
    matched = join_by_keys(listed, known, _SAME, "left").withColumn("listed_at", F.current_timestamp())
    matched.write.parquet(noted)
    matched = spark.read.schema(matched.schema).parquet(noted)
    unread = F.col("digest").isNull()
    fresh = spread(matched.where(unread).select("path"))
    name = generation_name("part", commits.next_number(spark, path))
    digests = digest_files(fresh).join(matched.where(unread).drop("digest", "rows"), "path")
    fields = _entries(spark, path, []).columns
    digests.select(fields).write.parquet(f"{path}/{name}")
    commits.commit(spark, f"{path}/{name}")
    read = spark.read.schema(_ENTRY).parquet(f"{path}/{name}").select("key", "digest", "rows", F.lit(True).alias("reread"))
    held = commits.generations(spark, path)
    if len(held) > fold_after:
        base = generation_name("base", held[-1].number)
        there = _entries(spark, path, held).join(matched.select("key"), "key", "left_semi")
        there.write.parquet(f"{path}/{base}")
        commits.commit(spark, f"{path}/{base}", "\n".join(g.name for g in held))
        # Generations go one fold later: the result of this call still reads its own.
        sweep(spark, path)
    shape = ["key", "size", "dataset", "is_source", "is_parquet", "digest", "rows", "reread"]
    old = matched.where(~unread).withColumn("reread", F.lit(False))
    new = matched.where(unread).drop("digest", "rows").join(read, "key")
    return old.select(shape).unionByName(new.select(shape))
