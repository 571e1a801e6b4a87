"""Building blocks that stay balanced when one key holds a large share of the rows.

* ``first_per_key`` / ``first_k_per_key`` keep only the needed rows on the map
  side, before the shuffle.
* ``heavy_keys`` finds the keys that hold more than 1/HEAVY_SHARE of all rows.
  There can be at most HEAVY_SHARE of them, which proves the size of the list
  that is broadcast; any other key is small next to one task's share.
* ``join_per_key`` spreads the rows of heavy keys over many tasks.
* ``segmented`` evaluates running values; heavy keys are cut into segments and
  the totals carried across them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEAVY_SHARE = 10_000
SALTS = 256
SEGMENT_ROWS = 1_000_000
_MAP_SIDE_LIMIT = 1000  # largest k for which Spark prunes ranked rows before the shuffle


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key.

    Spark turns the rank filter into a per-task limit ahead of the exchange, so a
    key with many copies ships at most one row per map task.
    """
    return first_k_per_key(df, keys, order, 1, "_rank").drop("_rank")


def first_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str
) -> DataFrame:
    """The first k rows of every key, numbered from 1 in column ``rank`` (bigint)."""
    if k > _MAP_SIDE_LIMIT:
        # Beyond the map-side limit, rank within hash slices of the key first.
        slices = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        ahead = W.partitionBy(*keys, "_slice").orderBy(*order)
        df = (
            slices.withColumn("_ahead", F.row_number().over(ahead))
            .where(F.col("_ahead") <= k)
            .drop("_slice", "_ahead")
        )
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy: str) -> DataFrame:
    """Broadcast list of the keys above the share, each with a true column ``heavy``.

    Reads the key columns only, with partial counts.  Null is a key like any other.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    total = sizes.agg(F.sum("_size").alias("n")).scalar()
    above = sizes.where(F.col("_size") * HEAVY_SHARE > total)
    return F.broadcast(above.select(*keys, F.lit(True).alias(heavy)))


def join_by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the keys, null equal to null, with each key once in the result."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(renamed, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    return joined.drop(*[f"_right_{k}" for k in keys])


def join_per_key(
    facts: DataFrame, per_key: DataFrame, keys: Sequence[str], spread: Column
) -> DataFrame:
    """Inner join of many fact rows with one row per key, with no task owning a heavy key.

    ``spread`` is any fact column that varies within a key.  Where ``per_key`` is
    small, adaptive execution measures it and broadcasts it.
    """
    keys = list(keys)
    heavy = heavy_keys(facts, keys, "_heavy")
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0))
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = join_by_keys(facts, heavy, keys, "left").withColumn("_salt", salt.cast("int")).drop("_heavy")
    right = join_by_keys(per_key, heavy, keys, "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return join_by_keys(left, right, [*keys, "_salt"]).drop("_salt")


def segment(seq: Column | str, rows: int = SEGMENT_ROWS) -> Column:
    """Segment number of a bigint arrival sequence; holds at most ``rows`` distinct numbers."""
    return F.call_function("div", F.col(seq) if isinstance(seq, str) else seq, F.lit(rows))


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment_number: Column,
    local: Callable[[W], dict[str, Column]],
    summary: dict[str, Column],
    carry: Callable[[W], list[dict[str, Column]]],
) -> DataFrame:
    """Running values over groups of any length.

    ``segment_number`` must grow with ``order``; it cuts heavy keys, while any
    other key is one segment.  ``local(window)`` gives columns over the ordered
    rows of one segment, ``summary`` folds a segment to one row, and
    ``carry(window)`` gives, step by step, what each segment inherits from those
    before it; these columns are null where nothing is inherited.  Only the
    summaries of heavy keys, one row per key and segment, are ever ordered over
    a whole group.
    """
    keys = list(keys)
    number = F.when(F.col("_heavy"), segment_number).otherwise(F.lit(0)).cast("bigint")
    cut = join_by_keys(df, heavy_keys(df, keys, "_heavy"), keys, "left").withColumn("_segment", number)

    def marked(rows: DataFrame) -> DataFrame:
        for name, column in local(W.partitionBy(*keys, "_segment").orderBy(*order)).items():
            rows = rows.withColumn(name, column)
        return rows

    folded = marked(cut.where("_heavy")).groupBy(*keys, "_segment")
    carried = folded.agg(*[c.alias(n) for n, c in summary.items()])
    before = W.partitionBy(*keys).orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    inherited: list[str] = []
    for step in carry(before):
        carried = carried.withColumns(step)
        inherited.extend(step)
    handed_on = carried.select(*keys, "_segment", *inherited)
    return join_by_keys(marked(cut), handed_on, [*keys, "_segment"], "left").drop("_segment", "_heavy")


def so_far(window: W) -> W:
    """From the start of the window's group to the current row."""
    return window.rowsBetween(W.unboundedPreceding, 0)
