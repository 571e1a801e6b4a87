"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Every instant in the lake is UTC: zone-less text is read as UTC.

    Parquet files hold instants as microseconds, not in Spark's default form, which has no
    statistics: filters on times then skip row groups, and footers give time spans.
    """
    pinned = {"spark.sql.session.timeZone": "UTC", "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
    for name, value in pinned.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a session on one machine (master ``local``) may leave it unset; a temporary folder is
    then chosen and set, once per session.  Elsewhere executors would not see one another's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidelake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder; it goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    # The file system only notes paths that exist.
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    files.delete(hadoop, False)
    return path


def spread(rows: DataFrame) -> DataFrame:
    """Small rows that each stand for much work (files, byte ranges), dealt evenly over all shuffle partitions.

    With the number given, adaptive execution does not gather them in one task for being few bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
