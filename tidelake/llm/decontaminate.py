"""Benchmark decontamination by a prefix-filtered join of item windows with document words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidelake.llm.rows import texts, written

#: Words of the contract, on UTF-8 bytes: ASCII letters and digits, and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
SHINGLE = 3
SIEVE_BITS = 22


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case; none for null."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _mark(words: list[bytes]) -> int:
    """Key of a shingle: a signed 64-bit hash of its words and their number."""
    return xxhash.xxh64_intdigest(b" ".join(words), len(words)) - (1 << 63)


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, window, size, shingles): every run of ``window`` words of an item, or the whole shorter item.

    ``window`` is the words joined by spaces, ``shingles`` the keys of its shingles in order.
    """
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {"item": [], "window": [], "size": [], "shingles": []}
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                for at in range(max(len(words) - window + 1, 1 if words else 0)):
                    part = words[at : at + window]
                    width = min(shingle, len(part))
                    found["item"].append(item)
                    found["window"].append(b" ".join(part).decode("utf-8", "surrogatepass"))
                    found["size"].append(len(part))
                    found["shingles"].append([_mark(part[i : i + width]) for i in range(len(part) - width + 1)])
            yield pa.RecordBatch.from_pydict(found, schema=kind)

    kind = pa.schema([("item", pa.string()), ("window", pa.string()), ("size", pa.int32()), ("shingles", pa.list_(pa.int64()))])
    return rows.mapInArrow(cut, "item string, window string, size int, shingles array<bigint>")


def _sieve_of(keys: DataFrame, name: str) -> np.ndarray:
    """2**SIEVE_BITS bits set at the keys, as bytes: 512 KB, however many keys there are."""
    slot = F.pmod(F.col(name), F.lit(1 << SIEVE_BITS))
    words = keys.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))).alias("mask")
    )
    dense = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for batch in words.toArrow().to_batches():  # at most 2**(SIEVE_BITS - 6) rows
        dense[batch["word"].to_numpy()] = batch["mask"].to_numpy()
    return dense.astype("<i8").view(np.uint8)


def shingle_hits(docs: DataFrame, widths: list[int], sieve: np.ndarray, size: int) -> DataFrame:
    """(id, sig, n_words, hits): per row, the shingles that pass the sieve.

    A hit is (key, at, before, after): the shingle's key, its place, and the words around it that a
    window through it can reach, so that the check needs no second look at the text.
    """
    id_type = docs.schema["id"].dataType.simpleString()
    sieved = docs.sparkSession.sparkContext.broadcast(sieve)
    mask = (1 << SIEVE_BITS) - 1

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, digest = np.unpackbits(sieved.value, bitorder="little"), xxhash.xxh64_intdigest
        for batch in batches:
            counts, hits = [], []
            for text in batch["text"]:
                words = words_of(text.as_py())
                counts.append(len(words))
                mine = []
                flat = b" ".join(words)
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                ends = np.cumsum(sizes + 1) - 1
                starts = ends - sizes
                for width in widths:
                    n = len(words) - width + 1
                    if n <= 0:
                        continue
                    keys = np.fromiter(
                        (digest(flat[b:e], width) for b, e in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)),
                        np.uint64, n,
                    )
                    for at in np.flatnonzero(table[(keys & np.uint64(mask)).astype(np.int64)]).tolist():
                        near = words[max(at - size, 0) : at + size]
                        mine.append(
                            {
                                "key": int(keys[at]) - (1 << 63),
                                "at": at,
                                "first": max(at - size, 0),
                                "near": [w.decode("utf-8", "surrogatepass") for w in near],
                            }
                        )
                hits.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["sig"], pa.array(counts, pa.int64()), pa.array(hits, kind)],
                names=["id", "sig", "n_words", "hits"],
            )

    kind = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("near", pa.list_(pa.string()))]))
    return docs.mapInArrow(
        sought,
        f"id {id_type}, sig bigint, n_words bigint, hits array<struct<key:bigint,at:int,first:int,near:array<string>>>",
    )


def contaminated_words(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(id, sig, n_words, n_hit, items): per row, how many words lie in item windows, and whose.

    A window is contained whole or not at all, so its necessary prefix is one shingle: the rarest,
    by the number of windows that hold it.  Documents offer only shingles that pass a sieve of
    those (fixed size), and the join is on the shingle.  Positional bounds (the window must begin
    and end inside the document) and the window's length come before the words are compared.

    * Null texts and texts without words have n_words 0 and no hits; such items have no windows.
    * Items with the same id count once; a null item id never enters ``items``.
    * Rows without an id, and rows that repeat one, are judged one by one.
    * An empty table on either side gives no hits; further columns are not read.
    * ``items`` is the sorted array of the item ids, as strings, with a window in the row.
    """
    windows = item_windows(items, item_col, item_text_col, window, shingle)
    places = windows.select("window", F.posexplode("shingles").alias("offset", "key")).distinct()
    common = places.groupBy("key").agg(F.count_distinct("window").alias("windows"))
    order = W.partitionBy("window").orderBy("windows", "offset")
    chosen = places.join(common, "key").withColumn("_r", F.row_number().over(order)).where("_r = 1")
    held = windows.groupBy("window", "size").agg(F.collect_set("item").alias("item_ids"))
    prefixes = chosen.join(held, "window").select("key", "offset", "window", "size", "item_ids")
    # One of the windows that share a key stands for it where rows are counted.
    first = F.row_number().over(W.partitionBy("key").orderBy("window")) == 1
    prefixes = written(prefixes.withColumn("first", first), "prefixes")
    widths = sorted(r[0] for r in prefixes.select(F.least("size", F.lit(shingle))).distinct().collect())
    rows = texts(docs, id_col, text_col)
    found = shingle_hits(rows, widths, _sieve_of(prefixes, "key"), window)
    each = found.select("id", "sig", "n_words", F.posexplode_outer("hits").alias("number", "hit"))
    # Rows without hits get a key of their own each, or they would all meet in one task.
    each = each.withColumn("sought", F.coalesce("hit.key", F.xxhash64("id", "sig", F.lit("none"))))
    joined = each.join(prefixes, each["sought"] == prefixes["key"], "left")
    begin = F.col("hit.at") - F.col("offset")
    bounded = (begin >= 0) & (begin + F.col("size") <= F.col("n_words"))
    there = F.slice("hit.near", F.greatest(begin - F.col("hit.first"), F.lit(0)) + 1, F.coalesce("size", F.lit(0)))
    match = F.coalesce(bounded & (F.array_join(there, " ") == F.col("window")), F.lit(False))
    spans = joined.select(
        "id", "sig", "n_words",
        F.when(match, F.struct(begin.alias("b"), (begin + F.col("size")).alias("e"))).alias("span"),
        F.when(match, F.col("item_ids")).alias("item_ids"),
        ((F.coalesce("number", F.lit(0)) == 0) & F.coalesce("first", F.lit(True))).alias("counts"),
    )
    grouped = spans.groupBy("id", "sig", "n_words").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("items"),
        F.count_if("counts").alias("copies"),
    )
    # Rows of one id and text have one result; it stands as often as they do.
    grouped = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda done, s: F.struct(
            (done["n"] + F.greatest(s["e"] - F.greatest(s["b"], done["upto"]), F.lit(0))).cast("bigint").alias("n"),
            F.greatest(done["upto"], s["e"]).alias("upto"),
        ),
        lambda done: done["n"],
    )
    return grouped.select("id", "sig", "n_words", covered.alias("n_hit"), "items")


def without_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """The rows, all columns unchanged, without a word in any item's window."""
    found = contaminated_words(docs, items, id_col, text_col, **settings)
    hit = found.where(F.col("n_hit") > 0).select(F.col("id").alias("__id"), F.col("sig").alias("__sig")).distinct()
    sig = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__sig"))
    return docs.withColumn("__row", sig).join(hit, same, "left_anti").select(*docs.columns)
