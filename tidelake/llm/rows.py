"""What the operators share: row signatures, ASCII case, written intermediate tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import scratch_path


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays.

    Where all characters are ASCII that is what ``lower`` does, at a fraction of the cost.
    """
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, sig): nothing else of the input is read, so clashing names do no harm.

    A null text is empty.  ``sig`` tells apart rows that repeat an id with another text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("sig"))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once below the shared folder and read back.

    Cuts the lineage and saves a second evaluation; an executor lost later costs nothing.  The shuffle
    files of the write go with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)
