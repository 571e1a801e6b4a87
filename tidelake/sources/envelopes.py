"""Landed provider responses: one JSON document per row, unwrapped to items.

Works on any table with a ``body`` column, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# provider -> (field that holds the list, whether a missing list means "no items")
ENVELOPES = {
    "thesportsdb": ("events", True),
    "football-data": ("matches", False),
    "balldontlie": ("data", False),
    "odds": (None, False),
}


def read_landed(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Landed responses, observed when their file was written.

    One response per file, or with ``per_line`` one per line, which keeps a busy
    landing area free of tiny files.
    """
    return _landed(spark.read.text(path, wholetext=not per_line))


def stream_landed(
    spark: SparkSession, path: str, per_line: bool = False, files_per_batch: int = 1000
) -> DataFrame:
    return _landed(
        spark.readStream.format("text")
        .option("wholetext", not per_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def _landed(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_replace("value", "^\ufeff", "").alias("body"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("observed_at"),
    )


def _list_kind(provider: str) -> tuple[Column, Column, Column]:
    """(document, the list as a variant, the type of what stands in its place)."""
    field, _ = ENVELOPES[provider]
    document = F.try_parse_json("body")
    target = "$" if field is None else f"$.{field}"
    value = F.try_variant_get(document, target, "variant")
    return document, F.try_variant_get(document, target, "array<variant>"), F.schema_of_variant(value)


def envelope_state(provider: str) -> Column:
    """``rows``, ``empty`` or the reason the response is refused, over ``body``."""
    _, missing_is_empty = ENVELOPES[provider]
    document, _, kind = _list_kind(provider)
    absent = kind.isNull() | (kind == "VOID")
    whole = F.schema_of_variant(document)
    if missing_is_empty:
        otherwise = F.when(absent | ~F.startswith(whole, F.lit("OBJECT")), "empty")
    else:
        otherwise = F.when(absent, "list is missing")
    return (
        F.when(document.isNull(), "response is not JSON")
        .when(F.startswith(kind, F.lit("ARRAY")), "rows")
        .otherwise(F.coalesce(otherwise, F.lit("list is of another type")))
    )


def envelope_items(landed: DataFrame, provider: str) -> DataFrame:
    """One row per object in the response's list; other members are dropped.

    Adds ``position`` in the list and ``payload``, the member's text.  The text
    comes from the document itself rather than from a parsed value, so numbers
    keep their spelling and payload hashes stay exact.
    """
    field, _ = ENVELOPES[provider]
    texts = (
        F.from_json("body", "array<string>")
        if field is None
        else F.from_json("body", f"{field} array<string>")[field]
    )
    _, members, _ = _list_kind(provider)
    passed = [c for c in landed.columns if c != "body"]
    # A one-element explode keeps the parse a step of its own, done once per response.
    listed = landed.select(*passed, "body", F.explode(F.array(members)).alias("_members"))
    kinds = F.transform("_members", F.schema_of_variant)
    zipped = F.arrays_zip(texts.alias("text"), kinds.alias("kind"))
    return (
        listed.where(F.col("_members").isNotNull())
        .select(*passed, F.posexplode(zipped))
        .where(F.startswith("col.kind", F.lit("OBJECT")))
        .select(*passed, F.col("pos").alias("position"), F.col("col.text").alias("payload"))
    )


def refused_envelopes(landed: DataFrame, provider: str) -> DataFrame:
    """Responses that hold no usable list, with the reason."""
    return landed.withColumn("reason", envelope_state(provider)).where(
        ~F.col("reason").isin("rows", "empty")
    )
