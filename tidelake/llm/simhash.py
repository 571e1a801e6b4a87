"""SimHash near-duplicates: pigeonring candidates, full Hamming check, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.components import min_reachable, star_edges
from tidelake.llm.rows import texts, written

SEED = 42  # of XXH64, fixed
SEGMENTS = 8  # of 8 bits, on a ring
#: Fingerprints in one candidate bucket beyond which it is cut by a further segment.
HOT_BUCKET = 8192


def fingerprint(text: str, width: int = 3) -> int:
    """A bit is 1 if it is set in over half the hashes of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, six ASCII blanks
    if not words:
        return 0
    flat = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()
    n = max(len(words) - width + 1, 1)
    last = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[b:e], SEED) for b, e in zip(starts, last)), np.uint64, n)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, sig, fp): the fingerprint of every row as a signed long."""
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["sig"], pa.array(found.view(np.int64))], names=["id", "sig", "fp"]
            )

    return rows.mapInArrow(marked, f"id {id_type}, sig bigint, fp bigint")


def _segment(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (number % SEGMENTS)).bitwiseAND(F.lit(255))


def chain_keys(fp: Column) -> Column:
    """Array of (chain, key): fingerprints within three bits share at least one.

    With a budget of 3 bits over 8 segments on a ring, the strong pigeonring principle gives a
    start from which every chain of l segments differs in at most 3 l / 8 bits: chains of one and
    two segments not at all, chains of three to five segments in one bit.  So the first two
    segments are equal, and of the next three at least two are: three keys of 32 bits a start.
    """
    keys = []
    for begin in range(SEGMENTS):
        for skipped in range(3):
            chosen = [0, 1, *(2 + k for k in range(3) if k != skipped)]
            key = F.lit(0).cast("bigint")
            for segment in chosen:
                key = F.shiftleft(key, 8).bitwiseOR(_segment(fp, begin + segment))
            keys.append(F.struct(F.lit(begin * 3 + skipped).alias("chain"), key.alias("key")))
    return F.array(*keys)


def chain_within(difference: np.ndarray, begin: np.ndarray, budget: int) -> np.ndarray:
    """Whether the chains from segment ``begin`` on keep within budget * length / 8 at every length.

    Counts and running sums of the eight segments live in the eight bytes of one word.
    """
    turn = (begin * SEGMENTS).astype(np.uint64)
    x = (difference >> turn) | np.where(turn == 0, np.uint64(0), difference << ((np.uint64(64) - turn) & np.uint64(63)))
    x = x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))
    x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
    x = (x + (x >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)
    running = x * np.uint64(0x0101010101010101)
    bounds = sum((128 + budget * (k + 1) // SEGMENTS) << (8 * k) for k in range(SEGMENTS))
    tops = np.uint64(0x8080808080808080)
    return ((np.uint64(bounds) - running) & tops) == tops


def linked_within(fps: np.ndarray, groups: np.ndarray, chains: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links among fingerprints of equal group, found within ``budget`` bits.

    ``groups`` is sorted.  Pairs are looked at shift by shift and links folded to one edge a
    fingerprint as they gather, so memory follows the rows; a pair goes to the full check only if
    the chain that brought it together keeps within its proportional budget at every length.
    """
    none = np.zeros(0, fps.dtype)
    n, a, b, shift = len(fps), none, none, 1
    alive = np.arange(max(n - 1, 0))
    while True:
        alive = alive[alive + shift < n]
        alive = alive[groups[alive] == groups[alive + shift]]
        if not len(alive):
            return star_edges(a, b)
        difference = fps[alive] ^ fps[alive + shift]
        within = chain_within(difference, chains[alive] // 3, budget)
        close, difference = alive[within], difference[within]
        close = close[np.bitwise_count(difference) <= budget]
        a, b = np.concatenate([a, fps[close]]), np.concatenate([b, fps[close + shift]])
        if len(a) > 500_000:
            a, b = star_edges(a, b)
        shift += 1


def candidate_links(distinct: DataFrame, budget: int = 3, hot: int = HOT_BUCKET) -> DataFrame:
    """(a, b): links among distinct fingerprints, a spanning set of them for each partition.

    Rows are dealt by their keys; a bucket that holds more than ``hot`` fingerprints is cut by one
    more segment: of the four segments outside its key at least one is equal too, as three bits
    differ at most.  Pairs never leave their task; what leaves is one edge for each
    fingerprint that has a link there, to the smallest fingerprint reachable inside the task.
    """
    keyed = distinct.select("fp", F.explode(chain_keys(F.col("fp"))).alias("k")).select("fp", "k.chain", "k.key")
    heavy = keyed.groupBy("chain", "key").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("chain", "key", F.lit(True).alias("hot"))
    marked = keyed.join(heavy, ["chain", "key"], "left")
    begin, skipped = F.floor(F.col("chain") / 3), F.col("chain") % 3

    def rest(which: int) -> Column:
        # The segments outside the key: the skipped one and the last three on the ring.
        number = (begin + (F.lit(2) + skipped if which == 0 else F.lit(4 + which))) % SEGMENTS
        byte = F.call_function("shiftrightunsigned", F.col("fp"), (number * 8).cast("int")).bitwiseAND(F.lit(255))
        return F.concat(F.lit(which + 1), F.lit(":"), byte)

    cut = F.when(F.col("hot"), F.array(*[rest(i) for i in range(4)])).otherwise(F.array(F.lit("")))
    dealt = marked.select("fp", "chain", "key", F.explode(cut).alias("cut"))
    dealt = dealt.withColumn("bucket", F.xxhash64("chain", "key", "cut")).select("fp", "chain", "bucket")
    spread = dealt.repartition("bucket")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b["fp"].to_numpy(), b["chain"].to_numpy(), b["bucket"].to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        fps, chains, buckets = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((fps, buckets))
        fps, chains, buckets = fps[order], chains[order], buckets[order]
        shared = np.zeros(len(fps), bool)
        same = buckets[1:] == buckets[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        fps, chains, buckets = fps[shared], chains[shared], buckets[shared]
        a, b = linked_within(fps.view(np.uint64), buckets, chains, budget)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return spread.mapInArrow(linked, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    budget: int = 3,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """(id, sig, fp, component): the fingerprint of every row and the smallest id reachable over links.

    Two rows are linked when their fingerprints differ in at most ``budget`` (three) bits; the
    pigeonring keys hold for that budget and smaller ones.

    * No words give the fingerprint zero, which links like any other; fewer words than ``width``
      are one shingle.
    * Rows of equal fingerprints (copies, rows that repeat an id) are one node, so a group of copies
      of any size costs one row.
    * A row without an id has a fingerprint and gets its component, null if no linked row has an id.
    * An empty table gives an empty table; further columns are not read.
    """
    if budget > 3:
        raise ValueError("the candidate keys are complete for at most three bits")
    marks = written(fingerprints(docs, id_col, text_col, width), "simhash")
    distinct = marks.groupBy("fp").agg(F.min("id").alias("least"))
    edges = written(candidate_links(distinct.select("fp"), budget, hot).distinct(), "links")
    roots = min_reachable(edges)
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = classes.groupBy("root").agg(F.min("least").alias("component"))
    component = classes.join(named, "root").select("fp", "component")
    return marks.join(component, "fp").select("id", "sig", "fp", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows, all columns unchanged, of which one stays for each near-duplicate class: the smallest id.

    Of rows that repeat that id, the one whose text has the least signature stays.  A row without an
    id goes if its class has a row with one, and stays otherwise.
    """
    marks = written(near_duplicates(docs, id_col, text_col, **settings), "classes")
    winners = marks.where(F.col("id").isNotNull()).groupBy("component").agg(F.min(F.struct("id", "sig")).alias("w"))
    copies = marks.groupBy("id", "sig").agg(F.count("*").alias("__copies"))
    nameless = marks.where(F.col("component").isNull()).select("id", "sig").distinct()
    kept = winners.select("w.id", "w.sig").join(copies, ["id", "sig"])
    kept = kept.unionByName(nameless.withColumn("__copies", F.lit(1).cast("bigint"))).toDF("__id", "__sig", "__copies")
    sig = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__sig"))
    joined = docs.withColumn("__row", sig).join(kept, same)
    single = joined.where(F.col("__copies") == 1)
    repeated = joined.where(F.col("__copies") > 1).dropDuplicates(["__id", "__sig"])
    return single.unionAll(repeated).select(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
