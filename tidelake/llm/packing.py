"""Best-fit packing of documents into training sequences of several permitted lengths."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (256, 512, 1024, 2048, 4096)
#: Tokens that one packing task receives on average; the tail bins of a task are its only waste.
SHARD_TOKENS = 500_000
#: What a sequence costs besides its tokens, and the length at which attention doubles a token's cost.
SEQUENCE_COST, ATTENTION_LENGTH = 64, 16_384


def bin_cost(capacity: int) -> float:
    """What a sequence of that length costs, full or not: a fixed part, its tokens, and attention among them."""
    return SEQUENCE_COST + capacity + capacity * capacity / ATTENTION_LENGTH


def pack(lengths: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float] = bin_cost):
    """(bin, offset) of every piece and the final capacity of every bin.

    Pieces go in order of falling length, ties in the given order.  Each takes the open bin with
    the least room that still holds it, ties to the oldest.  Where none holds it, a bin is opened:
    for every permitted size that holds the piece, the pieces still to come are laid greedily into
    the rest, longest first, and the size with the least cost per token so filled wins, ties to
    the smaller one.  At the end each bin shrinks to the least permitted size that holds it.
    """
    sizes = sorted(set(capacities))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    left = [0] * (sizes[-1] + 1)  # how many pieces of each length are still to come
    for n in lengths:
        left[n] += 1
    present = 0  # bit n is set while pieces of length n are to come
    for n, count in enumerate(left):
        present |= (count > 0) << n
    room: dict[int, list[int]] = {}  # room left -> bins, oldest first
    rooms = 0  # bit r is set while a bin has room r
    place, used = [(0, 0)] * len(lengths), []

    def filled(capacity: int, piece: int) -> int:
        """Tokens that a new bin would come to hold."""
        rest, taken = capacity - piece, {}
        while rest > 0:
            mask = present & ((1 << (rest + 1)) - 1)
            while mask and left[n := mask.bit_length() - 1] <= taken.get(n, 0):
                mask ^= 1 << n
            if not mask or n == 0:
                break
            count = min(rest // n, left[n] - taken.get(n, 0))
            taken[n] = taken.get(n, 0) + count
            rest -= n * count
        return capacity - rest

    for i in order:
        n = lengths[i]
        left[n] -= 1
        if not left[n]:
            present &= ~(1 << n)
        fitting = rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop(0)
            if not room[r]:
                rooms ^= 1 << r
        else:
            fits = [c for c in sizes if c >= n]
            r = min(fits, key=lambda c: (cost(c) / max(filled(c, n), 1), c))
            b = len(used)
            used.append(0)
        place[i] = (b, used[b])
        used[b] += n
        room.setdefault(r - n, []).append(b)
        room[r - n].sort()
        rooms |= 1 << (r - n)
    final = [next(c for c in sizes if c >= u) for u in used]
    return place, final


def pieces_of(lengths: DataFrame, id_col: str, length: Column, most: int) -> DataFrame:
    """(id, piece, start, n): a document longer than the largest sequence is cut into whole sequences and a rest."""
    cut = lengths.select(F.col(id_col).alias("id"), F.coalesce(length, F.lit(0)).cast("bigint").alias("total"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("total") - 1, F.lit(0)), F.lit(most).cast("bigint"))
    exploded = cut.select("id", "total", F.posexplode(starts).alias("piece", "start"))
    return exploded.select("id", "piece", "start", F.least(F.col("total") - F.col("start"), F.lit(most)).alias("n"))


def pack_best_fit(
    docs: DataFrame,
    length: Column,
    id_col: str = "doc_id",
    capacities: Sequence[int] = CAPACITIES,
    shard_tokens: int = SHARD_TOKENS,
    cost: Callable[[int], float] = bin_cost,
) -> DataFrame:
    """(id, piece, start, n_tokens, shard, bin, capacity, bin_offset): the place of every piece.

    ``length`` counts the tokens of a row.  Pieces are dealt by a hash of their place into shards of
    ``shard_tokens`` on average, and each shard is packed on its own by ``pack``; only numbers
    travel.  A shard's size does not depend on the input's, nor on any key.

    * A row of no tokens (null or empty text) is one piece of length 0 and stays in some bin.
    * Rows without an id, and rows that repeat one, are pieces like any other.
    * An empty table gives an empty table; further columns are not read.
    """
    most = max(capacities)
    pieces = pieces_of(docs, id_col, length, most)
    # Pieces of full length fill a bin each; they need no search but go the same way.
    total = docs.agg(F.sum(length.cast("bigint"))).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", F.lit(7)), F.lit(shards)).cast("int"))
    sizes = tuple(capacities)

    def packed(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("n", "descending"), ("id", "ascending"), ("piece", "ascending")])
        place, final = pack(shard["n"].to_pylist(), sizes, cost)
        bins = [b for b, _ in place]
        added = {"bin": bins, "capacity": [final[b] for b in bins], "bin_offset": [o for _, o in place]}
        named = shard.select(["id", "piece", "start", "n", "shard"]).rename_columns(
            ["id", "piece", "start", "n_tokens", "shard"]
        )
        for name, values in added.items():
            named = named.append_column(name, pa.array(values, pa.int64()))
        return named

    id_type = pieces.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, piece int, start bigint, n_tokens bigint, shard int, bin bigint, capacity bigint, bin_offset bigint"
    return dealt.groupBy("shard").applyInArrow(packed, schema)
