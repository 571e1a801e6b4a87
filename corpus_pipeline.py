"""A corpus pipeline over ``documents``: each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.decontaminate import without_contaminated
from tidelake.llm.line_dedup import with_lines_dropped
from tidelake.llm.packing import pack_best_fit
from tidelake.llm.queries import word_count
from tidelake.llm.rows import table, written
from tidelake.llm.simhash import one_of_each
from tidelake.llm.toxicity import fit_toxicity, without_toxic
from tidelake.session import pin_utc


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels outside the held-out fold."""
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds go; ``n_chars`` follows the text."""
    shorter = with_lines_dropped(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every remaining document's pieces in training sequences, counted in words."""
    return pack_best_fit(docs, word_count(F.col("text"))).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: A learnt classifier and connected components are beyond SQL; tests hold a brute-force version against ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    pin_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
