"""Exact de-duplication of lines across documents, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import ascii_lower, texts

#: What a key loses at both ends: space and the five ASCII blanks from tab to return.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(stripped: Column) -> Column:
    """Two 64-bit hashes of a line without blanks at its ends, A-Z in lower case."""
    key = ascii_lower(stripped)
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def without_lines(lines: Column, dropped: Column) -> Column:
    """The lines whose zero-based numbers are not in the sorted array ``dropped``, joined by newlines.

    The stretches between dropped lines are sliced out, so the work follows the number of lines.
    """
    begins = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda x: x + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    stretches = F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, e - b))
    return F.array_join(F.flatten(stretches), "\n")


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, sig, dropped): the sorted zero-based numbers of the lines that each row loses; rows that lose none are missing.

    Keys travel as two 64-bit hashes under different seeds.  The smallest id of a key is folded before the
    shuffle; the join back is one row per key on one side, which adaptive execution splits where
    one line fills a partition.
    """
    split = texts(docs, id_col, text_col).select("id", "sig", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = (
        # Lower case changes no length, so short lines go before the costly part.
        split.withColumn("line", F.btrim("line", F.lit(BLANKS)))
        .where((F.char_length("line") >= min_chars) & F.col("id").isNotNull())
        .select("id", "sig", "pos", line_key(F.col("line")).alias("key"))
        .select("id", "sig", "pos", "key.a", "key.b")
    )
    spread = keyed.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Joined by the pair as one value, the fold and the join are dealt apart: adaptive execution
    # splits a join's partitions only where both sides come straight from a shuffle.
    shared = spread.where(F.col("first") < F.col("last")).select(F.struct("a", "b").alias("key"), "first")
    late = keyed.withColumn("key", F.struct("a", "b")).join(shared, "key").where(F.col("id") > F.col("first"))
    return late.groupBy("id", "sig").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
) -> DataFrame:
    """(id, sig, text, n_lines, n_dropped, kept): each document without lines held by a smaller id.

    Lines are what newlines part; a null or empty text is one empty line.  A line goes when its
    key has at least ``min_chars`` code points and also occurs in a document with a smaller id.

    * A repeated line inside its first document stays, however often it occurs.
    * A row without an id loses nothing, and takes nothing from others.
    * Rows that repeat an id count as one document; each row has its own result.
    * An empty table gives an empty table; further columns are not read.
    * ``kept`` is the unchanged text (null gives the empty text) where nothing was dropped.

    Only line numbers travel to the documents.
    """
    rows = texts(docs, id_col, text_col)
    joined = rows.join(dropped_lines(docs, id_col, text_col, min_chars), ["id", "sig"], "left")
    lines = F.split("text", "\n", -1)
    return joined.select(
        "id",
        "sig",
        "text",
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(without_lines(lines, F.col("dropped"))).alias("kept"),
    )


def with_lines_dropped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """The rows with all their columns, the text without the lines that ``dedup_lines`` drops."""
    gone = dropped_lines(docs, id_col, text_col, min_chars).toDF("__id", "__sig", "__dropped")
    sig = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.withColumn("__row", sig).join(gone, (F.col(id_col) == F.col("__id")) & (F.col("__row") == F.col("__sig")), "left")
    kept = F.when(F.col("__dropped").isNull(), F.col(text_col)).otherwise(
        without_lines(F.split(text_col, "\n", -1), F.col("__dropped"))
    )
    return joined.withColumn(text_col, kept).select(*docs.columns)
