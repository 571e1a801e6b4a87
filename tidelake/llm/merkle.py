"""A hash tree over the rows of a dataset, with a proof for every row.

Rows are ordered and numbered within their group, the tree is built a thousand nodes at a time, and proofs
come by pointer jumping: a node holds the siblings on its way to an ancestor, and joining the nodes
with themselves doubles the way until it ends at the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.rows import written

#: A block of the tree has 2**BLOCK_BITS nodes at its foot; no task meets more nodes of one key.
BLOCK_BITS = 10


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(*parts: Column) -> Column:
    """The SHA-256 of texts, one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def record(*values: Column) -> Column:
    """A row as text: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def numbered(rows: DataFrame, group: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """The rows with ``idx``, their number within the group in the given order, and (group, n).

    Sorted by ranges and written, so that every later reader sees one order.  A range counts its rows; the
    counts, one row for each range and group, make the offsets.
    """
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    stored = written(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    stored = stored.withColumn("_range", F.shiftright("_at", 33))
    ranges = stored.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = written(ranges.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ranges")
    sizes = ranges.groupBy(group).agg(F.sum("_n").alias("n"))
    placed = stored.join(ranges.drop("_n"), [group, "_range"])
    return placed.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_range", "_first", "_before"), sizes


def _block_nodes(nodes: DataFrame, level: int, bits: int) -> DataFrame:
    """(g, h, level, idx, digest, sibling) of all nodes over ``nodes``, which stand at ``level``, up to ``bits`` levels higher.

    ``sibling`` is null where a node has none, and for the topmost nodes, whose siblings are in other blocks.
    """
    block = nodes.groupBy("g", "h", F.shiftright("idx", bits).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda n: n["digest"]).alias("l0")
    )
    for k in range(bits):
        block = block.withColumn(f"l{k + 1}", _parents(F.col(f"l{k}")))

    def described(k: int) -> Column:
        own = F.col(f"l{k}")

        def node(digest: Column, at: Column) -> Column:
            sibling = F.get(own, at.bitwiseXOR(F.lit(1))) if k < bits else F.lit(None).cast("binary")
            idx = F.shiftleft("block", bits - k) + at
            return F.struct(F.lit(level + k).alias("level"), idx.alias("idx"), digest.alias("digest"), sibling.alias("sibling"))

        return F.transform(own, node)

    every = block.select("g", "h", F.explode(F.concat(*[described(k) for k in range(bits + 1)])).alias("node"))
    # A block goes on beyond the root of a small group: one node, hashed alone.
    return every.where(F.col("node.level") <= F.col("h")).select("g", "h", "node.*")


def _parents(below: Column) -> Column:
    """The hash of every two neighbours, or of a last one alone."""
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(below) - 1, 1)),
        lambda i: hashed(hex_of(F.get(below, 2 * i)), F.coalesce(hex_of(F.get(below, 2 * i + 1)), F.lit(""))),
    )


def tree(leaves: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame, int]:
    """(g, h, level, idx, siblings) of all nodes below their roots, (g, digest) of the roots, and the greatest height.

    ``leaves`` holds (g, h, idx, digest), h being the height of the group's tree.
    """
    tallest = leaves.agg(F.max("h")).first()[0] or 0
    base, parts, level = leaves, [], 0
    while True:
        nodes = written(_block_nodes(base, level, bits), "nodes")
        parts.append(nodes.where(F.col("level") < level + bits))
        level += bits
        if level > tallest:
            break
        base = nodes.where(F.col("level") == level).select("g", "h", "idx", "digest")
    every = reduce(DataFrame.unionAll, parts)
    hop = F.array(F.coalesce("sibling", F.lit(b"")))
    below = every.where(F.col("level") < F.col("h")).select("g", "h", "level", "idx", hop.alias("siblings"))
    return below, every.where(F.col("level") == F.col("h")).select("g", "digest"), tallest


def proofs(leaves: DataFrame, sizes: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """(g, idx, siblings) of every leaf below a root, and (g, digest) of the roots.

    ``siblings`` holds one entry for each level, empty where the node has no sibling.  Every node starts with its
    own sibling, a way of one level.  A round joins each node with the ancestor that its way ends at
    and appends what that holds, so ways double; after it only nodes at multiples of the new length are
    still ends of ways.  An ancestor with many descendants stands once for each block of them.
    """
    heights = sizes.select("g", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).alias("h"))
    ways, roots, tallest = tree(leaves.join(heights, "g"), bits)
    length = 1
    while length < tallest:
        shift, spread = min(length, 62), max(min(length, 62) - bits, 0)
        ends = ways.where(F.col("level") >= length).select(
            "g",
            (F.col("level") - length).alias("level"),
            F.explode(F.transform(F.sequence(F.lit(0), F.lit((1 << spread) - 1)), lambda s: F.shiftleft(F.col("idx"), spread) + s)).alias("block"),
            F.col("siblings").alias("onward"),
        )
        block = F.shiftright("idx", shift - spread)
        joined = ways.where(F.col("level") % (2 * length) == 0).withColumn("block", block).join(ends, ["g", "level", "block"], "left")
        longer = F.concat("siblings", F.coalesce("onward", F.array().cast("array<binary>")))
        ways = written(joined.select("g", "h", "level", "idx", longer.alias("siblings")), "ways")
        length *= 2
    return ways.where(F.col("level") == 0).select("g", "idx", "siblings"), roots


def folded(leaf: Column, idx: Column, siblings: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    start = F.struct(leaf.alias("digest"), idx.alias("idx"))

    def step(state: Column, sibling: Column) -> Column:
        own, other = hex_of(state["digest"]), hex_of(sibling)
        right = state["idx"].bitwiseAND(F.lit(1)) == 1
        # An empty sibling adds nothing on either side.
        return F.struct(hashed(F.when(right, other).otherwise(F.lit("")), own, F.when(right, F.lit("")).otherwise(other)).alias("digest"), F.shiftright(state["idx"], 1).alias("idx"))

    return F.aggregate(siblings, start, step, lambda state: state["digest"])


def manifest(rows: DataFrame, id_: Column, group: Column, leaf: Column, claimed: Column | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded): a proof for every row, and the root that its claimed leaf leads to.

    Per group, leaves ascend by id; every two neighbouring nodes, or a last one alone, become the hash of
    their digests as lower-case hex texts, until one remains, the group's subroot.  Subroots, in
    order of their groups, lead to ``root`` in the same way.  ``siblings`` are the digests beside the
    way from leaf to root, without empty places.  ``claimed`` is what the proof is tried on, ``leaf`` where null.

    * The null group comes first, null ids come first in their group; rows of one id are ordered by their leaves.
    * Equal rows are leaves of their own, next to each other.
    * A lone leaf is its group's subroot, a lone subroot the root; then there are no siblings.
    * An empty table gives an empty table; columns that the expressions don't name are not read.

    A row's text is hashed where it is read; only digests and numbers travel.
    """
    # '' sorts before what a text with a mark in front becomes.
    named = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    claim = F.lit(None).cast("binary") if claimed is None else claimed
    # Written first: finding the ranges reads the rows once more than sorting them.
    hashed_rows = written(rows.select(named.alias("g"), id_.alias("id"), leaf.alias("digest"), claim.alias("claimed")), "digests")
    leaves, sizes = numbered(hashed_rows, "g", "id", "digest")
    leaves, sizes = written(leaves, "leaves"), written(sizes, "sizes")
    ways, subroots = proofs(leaves.select("g", "idx", "digest"), sizes, bits)
    tops, count = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "g", "name")
    tops = written(tops, "tops")
    top_ways, root = proofs(tops.select("g", "idx", "digest"), count, bits)
    above = (
        tops.join(top_ways, ["g", "idx"], "left")
        .join(root.withColumnRenamed("digest", "root"), "g")
        .select(F.col("name").alias("g"), F.col("idx").alias("rank"), F.col("digest").alias("subroot"), F.col("siblings").alias("top"), "root")
    )
    # What all leaves of a group share stands once for each block of them.
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("n") - 1, bits))).alias("block")
    shared = above.join(sizes, "g").select("g", blocks, "rank", "subroot", "top", "root")
    none = F.array().cast("array<binary>")
    joined = (
        leaves.join(ways, ["g", "idx"], "left")
        .withColumn("block", F.shiftright("idx", bits))
        .join(shared, ["g", "block"])
        .select(
            "id", F.col("digest").alias("leaf"), F.coalesce("claimed", "digest").alias("claimed"), "idx", "rank", "subroot", "root",
            F.coalesce("siblings", none).alias("own"), F.coalesce("top", none).alias("top"),
        )
    )
    reached = folded(F.col("claimed"), F.col("idx"), F.col("own"))
    return joined.select(
        "id",
        "leaf",
        "subroot",
        "root",
        F.filter(F.concat("own", "top"), lambda s: F.octet_length(s) > 0).alias("siblings"),
        folded(reached, F.col("rank"), F.col("top")).alias("folded"),
    )
