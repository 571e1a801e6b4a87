"""Approximate nearest neighbours by multiprobe p-stable hashing, for the largest inner product."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidelake.llm.rows import written

TABLES = 4
#: Rows that widths are fitted on, and queries that the number of probes is fitted on, at most.
FIT_ROWS, FIT_QUERIES = 10_000, 64
#: Share of the true neighbours of the fitted queries that the probes must reach.
TARGET_RECALL = 0.96
#: Vectors and queries that one task holds at once, on average at most.
CELL_ROWS, CELL_QUERIES = 65_536, 65_536
WIDTH = 2.0  # of a hash interval, in standard deviations of its projection
MOST_PROBES = 20_000
#: Functions up to which all cells one interval away are scored at once; beyond, they come one by one from a heap.
ENUMERATED = 13
#: Rows and queries that are scored at once, so that the scores stay in the processor's cache.
TILE = 512
#: Cells, visits or candidates that are worked on at once.
BLOCK = 2_000_000


@dataclass
class Index:
    """Hash functions of all tables of one range of norms: floor((a . x + b) / w), and how many buckets a query visits.

    Without functions its one table has a single bucket, so that a query meets every row.
    """

    norm: float  # the largest norm of the range's rows, as a logarithm to base 2
    a: np.ndarray  # tables x functions x (dimensions + 1)
    b: np.ndarray  # tables x functions
    w: np.ndarray
    probes: int = 1

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One more dimension turns the largest inner product into the least distance."""
        unit, norms = unit_rows(x)
        if query:
            return np.hstack([unit, np.zeros((len(x), 1))])
        share = np.exp2(np.minimum(norms - self.norm, 0.0))[:, None]
        return np.hstack([unit * share, np.sqrt(1 - share**2)])

    def places(self, lifted: np.ndarray, table: int) -> np.ndarray:
        """Unrounded places of the rows on the table's functions."""
        return (lifted @ self.a[table].T + self.b[table]) / self.w[table]


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of norm 1, and the norms as logarithms to base 2.

    Scaled by the largest component first: squares of very large or small components leave the range of doubles.
    """
    largest = np.abs(x).max(axis=1, keepdims=True, initial=0.0)
    largest[largest == 0] = 1.0
    # Dividing by a subnormal number could overflow; twice by its root cannot.
    root = np.sqrt(largest)
    scaled = x / root / root
    rest = np.linalg.norm(scaled, axis=1, keepdims=True)
    return scaled / rest, (np.log2(largest) + np.log2(rest))[:, 0]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision; one beyond the range of doubles counts as the end of that range."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = queries @ rows.T
    ends = np.finfo(np.float64)
    return np.nan_to_num(scores, copy=False, nan=0.0, posinf=ends.max, neginf=ends.min)


def ranges_of(x: np.ndarray, ranges: list[Index]) -> np.ndarray:
    """The number of each row's range; they come in falling order of their norms."""
    norms = np.array([-own.norm for own in ranges])
    return np.maximum(np.searchsorted(norms, -unit_rows(x)[1], side="right") - 1, 0)


def first_tables(ranges: list[Index]) -> list[int]:
    """The number that each range's first table has among the tables of all."""
    return np.cumsum([0, *(len(own.a) for own in ranges[:-1])]).tolist()


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over all of 64 bits."""
    out = numbers.astype(np.int64).view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(31))


@dataclass
class Layout:
    """Where a table's buckets lie: one of more than a cell's rows has its own, in parts, the others share cells by hash."""

    shards: int
    large: np.ndarray  # in rising order
    parts: np.ndarray

    def of(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, whether the bucket is large, parts) of buckets, there or not."""
        at = np.searchsorted(self.large, bucket)
        own, parts = np.zeros(len(bucket), bool), np.ones(len(bucket), np.int32)
        inside = np.flatnonzero(at < len(self.large))
        own[inside] = self.large[at[inside]] == bucket[inside]
        parts[own] = self.parts[at[own]]
        return np.where(own, bucket, (mixed(bucket) % np.uint64(self.shards)).astype(np.int64)), own, parts

    def everywhere(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, whether it is of a large bucket, part) of all cells."""
        cell = np.concatenate([np.arange(self.shards), np.repeat(self.large, self.parts)])
        part = np.concatenate([np.zeros(self.shards, np.int32), *(np.arange(n, dtype=np.int32) for n in self.parts)])
        return cell, np.arange(len(cell)) >= self.shards, part.astype(np.int32)


def codes(cells: np.ndarray) -> np.ndarray:
    """One long for each row of whole numbers; a table of no functions has a single bucket."""
    out = np.zeros(len(cells), np.int64)
    for column in cells.T:
        out = out * np.int64(1_000_003) + column
    return out


def probe_order(place: np.ndarray, most: int) -> np.ndarray:
    """Cells in falling order of estimated success, the own cell first, at most ``most``.

    A step to a neighbouring interval scores the squared distance to its border, in intervals; the
    score of a cell is the sum over its steps.  Sets of steps come from a heap by shift and expand.
    """
    home = np.floor(place).astype(np.int64)
    n = len(home)
    down = place - home
    scores = np.concatenate([down**2, (1 - down) ** 2])
    order = np.argsort(scores, kind="stable")
    ranked = scores[order]
    axis, move = (order % n if n else order), np.where(order < n, -1, 1)
    found, heap = [home], [(ranked[0], (0,))] if n else []
    while heap and len(found) < most:
        score, steps = heapq.heappop(heap)
        axes = [axis[s] for s in steps]
        if len(set(axes)) == len(axes):
            cell = home.copy()
            cell[axes] += move[list(steps)]
            found.append(cell)
        last = steps[-1]
        if last + 1 < 2 * n:
            grown = score + ranked[last + 1]
            heapq.heappush(heap, (grown, (*steps, last + 1)))
            heapq.heappush(heap, (grown - ranked[last], (*steps[:-1], last + 1)))
    return np.array(found, np.int64).reshape(len(found), n)


def cell_scores(places: np.ndarray) -> np.ndarray:
    """Scores, as in ``probe_order``, of all cells at most one interval away, in the order of ``cell_steps``."""
    steps = _step_scores(places)
    out = np.zeros((len(places), 1))
    for axis in range(places.shape[1]):
        out = (out[:, :, None] + steps[:, axis, None, :]).reshape(len(places), -1)
    return out


def cell_steps(n: int) -> np.ndarray:
    """What the code of each cell one interval away differs by from that of the own cell."""
    out = np.zeros(1, np.int64)
    for _ in range(n):
        out = (out[:, None] * np.int64(1_000_003) + np.array([0, 1, -1])).reshape(-1)
    return out


def _step_scores(places: np.ndarray) -> np.ndarray:
    """rows x functions x 3: the score of staying and of a step up and down."""
    down = places - np.floor(places)
    return np.stack([np.zeros_like(down), (1 - down) ** 2, down**2], axis=2)


def probed_codes(places: np.ndarray, most: int) -> np.ndarray:
    """Codes of the ``most`` cells of best score (all, if fewer) of every row; in no order."""
    n = places.shape[1]
    if n > ENUMERATED:
        return np.array([codes(probe_order(place, most)) for place in places], np.int64).reshape(len(places), -1)
    home, steps = codes(np.floor(places).astype(np.int64)), cell_steps(n)
    if most >= len(steps):
        return home[:, None] + steps
    out, block = np.empty((len(places), most), np.int64), max(1, BLOCK // len(steps))
    for at in range(0, len(places), block):
        first = np.argpartition(cell_scores(places[at : at + block]), most - 1, axis=1)[:, :most]
        out[at : at + block] = home[at : at + block, None] + steps[first]
    return out


def probe_ranks(place: np.ndarray, homes: np.ndarray, most: int) -> np.ndarray:
    """How many cells come before each of the given ones in the order of probes; ``most`` if that many do or it is out of reach."""
    if len(place) > ENUMERATED:
        order = {int(c): r for r, c in reversed(list(enumerate(codes(probe_order(place, most)))))}
        return np.array([order.get(int(c), most) for c in codes(homes)], np.int64)
    moved = homes - np.floor(place).astype(np.int64)
    steps, score = _step_scores(place[None])[0], np.zeros(len(homes))
    for axis in range(len(place)):
        score += steps[axis, moved[:, axis] % 3]
    rank = np.searchsorted(np.sort(cell_scores(place[None])[0]), score)
    return np.where((np.abs(moved) <= 1).all(axis=1), np.minimum(rank, most), most)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that is worked out once a row, however often the body, or a function of array members in it, uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def log_norm() -> Column:
    """The logarithm to base 2 of the norm of ``v``.

    Scaled by the largest component: no finite vector is too long or too short.
    """

    def scaled(top: Column, root: Column) -> Column:
        return F.log2(top) + F.log2(F.aggregate("v", F.lit(0.0), lambda t, x: t + F.pow(x / root / root, F.lit(2)))) / 2

    return let(F.array_max(F.transform("v", F.abs)).cast("double"), lambda top: let(F.sqrt(top), lambda root: scaled(top, root)))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors that take part, of floats if they came so, else of doubles; of differing lengths, the commonest one does."""
    kind = rows.select(vector_col).schema[0].dataType.simpleString()
    v = F.col(vector_col).cast(kind if kind == "array<float>" else "array<double>")
    clean = rows.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = clean.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return clean.where(F.size("v") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest finite scores of every row, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    scores = scores[:, order]
    if scores.shape[1] > k:
        # The k-th score cuts; ties at the cut are settled by the sort below.
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        rows, columns = np.nonzero((scores >= edge[:, None]) & (scores > -np.inf))
    else:
        rows, columns = np.nonzero(scores > -np.inf)
    sort = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[sort], columns[sort]
    starts = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - starts < k
    return rows[keep], order[columns[keep]]


def first_of_each(who: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k best of each, in order, ties to the smaller id; and their ranks from 0."""
    order = np.argsort(-scores)
    order = order[np.argsort(who[order].astype(np.uint16) if who.max(initial=0) < 2**16 else who[order], kind="stable")]
    if ((who[order][1:] == who[order][:-1]) & (scores[order][1:] == scores[order][:-1])).any():
        order = np.lexsort((ids, -scores, who))
    who = who[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    return order[rank < k], rank[rank < k]


def cell_best(
    query: np.ndarray, y: np.ndarray, asked: tuple[np.ndarray, np.ndarray] | None, ids: np.ndarray, x: np.ndarray, bucket: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, id, score) of a cell's k best rows in the buckets that each query asks, the queries in order.

    ``asked`` are pairs of a query's place and a bucket; without, all buckets are asked.  Only these
    pairs are scored.  The k-th score that a query has so far cuts what follows.
    """
    order = np.argsort(bucket, kind="stable")
    ids, x = ids[order], x[order]
    buckets, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(ids))
    if asked:
        who, wanted = asked
        where = np.searchsorted(buckets, wanted)
        there = np.flatnonzero(where < len(buckets))
        there = there[buckets[where[there]] == wanted[there]]
        there = there[np.argsort(where[there], kind="stable")]
        who, edges = who[there], np.searchsorted(where[there], np.arange(len(buckets) + 1))
    # Components so large that a product may leave the range of doubles take the longer way.
    tame = float(np.abs(y).max(initial=0.0)) * float(np.abs(x).max(initial=0.0)) * x.shape[1] < np.finfo(np.float64).max / 2
    least, held, kept = np.full(len(query), -np.inf), 0, []

    def cut() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        who, at, score = (np.concatenate(c) for c in zip(*kept, strict=True)) if kept else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order, rank = first_of_each(who, score, ids[at], k)
        last = order[rank == k - 1]
        least[who[last]] = np.maximum(least[who[last]], score[last])
        return who[order], at[order], score[order]

    for number in np.argsort(starts - ends, kind="stable"):  # the largest first: they cut best
        visitors = who[edges[number] : edges[number + 1]] if asked else np.arange(len(query))
        b = starts[number]
        while b < ends[number]:
            # More rows where queries have no score to cut by yet.
            a, b = b, min(b + TILE * (8 if (least[visitors] == -np.inf).any() else 1), ends[number])
            for at in range(0, len(visitors), block := TILE * max(1, TILE // (b - a))):
                mine = visitors[at : at + block]
                scores = y[mine] @ x[a:b].T if tame else products(y[mine], x[a:b])
                new = np.flatnonzero(least[mine] == -np.inf)
                if len(new) and b - a > k:
                    part = scores[new]
                    part[query[mine[new]][:, None] == ids[None, a:b]] = -np.inf
                    least[mine[new]] = np.partition(part, b - a - k, axis=1)[:, b - a - k]
                over = np.flatnonzero(scores >= least[mine][:, None])
                row, column = np.divmod(over, b - a)
                score, row, column = scores.ravel()[over], mine[row], a + column
                other = query[row] != ids[column]
                kept.append((row[other], column[other], score[other]))
                held += len(kept[-1][0])
                if held > 2 * k * len(query) + TILE**2:
                    kept = [cut()]
                    held = len(kept[0][0])
    row, column, score = cut()
    return row, ids[column], score


def exact_neighbours(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query, id, score, v) by looking at every row, for a bounded number of queries."""
    shared = vectors.sparkSession.sparkContext.broadcast((ids, queries))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, q = shared.value
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            mine = batch["id"].to_numpy()
            scores = products(q, _matrix(batch["v"]))
            scores[asked[:, None] == mine[None, :]] = -np.inf
            rows, columns = best(scores, mine, k)
            part = pa.table([pa.array(rows), pa.array(mine[columns]), pa.array(scores[rows, columns]), batch["v"].take(pa.array(columns))], ["row", "id", "score", "v"])
            held = pa.concat_tables([held, part]) if held else part
            rows, mine, score = (held[n].to_numpy() for n in ("row", "id", "score"))
            order = np.lexsort((mine, -score, rows))
            rows = rows[order]
            held = held.take(pa.array(order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]))
        if held:
            yield from held.set_column(0, "query", pa.array(asked[held["row"].to_numpy()])).combine_chunks().to_batches()

    found = vectors.mapInArrow(scan, f"query bigint, id bigint, score double, v {dict(vectors.dtypes)['v']}")
    order = W.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def fit_sample(vectors: DataFrame, band: Column, sizes: dict[int, int], seed: int) -> np.ndarray:
    """``FIT_ROWS`` vectors, even over the ranges.

    The draw is uniform by hash times the rows of the range, so the least come evenly from all.  Rows
    whose draw can hardly be among those are left where they are, so that only about as many rows as
    are asked for are sorted; should too few be left, all are sorted.
    """
    total, wanted = sum(sizes.values()), FIT_ROWS + 10 * FIT_ROWS**0.5
    rest, left = wanted, len(sizes)
    for n in sorted(sizes.values()):  # the rows that a range gives, if each gives as many or all of its own
        each = rest / left
        if n >= each:
            break
        rest, left = rest - n, left - 1
    per_band = F.element_at(F.create_map(*[F.lit(x) for b, n in sizes.items() for x in (b, float(n))]), band)
    draw = (F.xxhash64("id", F.lit(seed)).cast("double") + 2.0**63) * per_band
    # As a column: an expression to sort by would be worked out anew for every comparison.
    drawn = vectors.select(draw.alias("draw"), "id", "v")
    for few in [drawn.where(F.col("draw") <= each * 2.0**64)] * (total > wanted) + [drawn]:
        found = few.orderBy("draw", "id").limit(FIT_ROWS).select("v").toArrow()["v"]
        if len(found) >= min(FIT_ROWS, total):
            break
    return _matrix(found.combine_chunks())


def fit_index(
    vectors: DataFrame, is_query: Column, k: int, tables: int = TABLES, target: float = TARGET_RECALL, seed: int = 5
) -> list[Index]:
    """Hash functions for the rows, and the number of probes that reaches the target, for each range of norms.

    A range holds norms within a factor of the square root of two and has a scale of its own, so that
    no row lies far from all queries just for being short.  One function for every fourfold of a
    range's rows beyond 64 keeps buckets of a steady size.  Widths come from ``FIT_ROWS`` rows,
    even over the ranges; probes from the true neighbours of ``FIT_QUERIES`` queries: the rank of a
    neighbour's bucket in its query's order tells how many probes find it.  A range where
    ``MOST_PROBES`` miss the target has no functions: its rows are all looked at.
    """
    largest = vectors.agg(F.max("norm")).first()[0]
    if largest is None:
        return []
    band = F.floor(2 * (F.lit(largest) - F.col("norm"))).cast("int")
    stats = vectors.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.max("norm").alias("norm")).orderBy("band").collect()
    sample = fit_sample(vectors, band, {row["band"]: row["n"] for row in stats}, seed)
    random = np.random.default_rng(seed)
    ranges = []
    for row in stats:
        functions = max(0, round(np.log(row["n"] / 64) / np.log(4)))
        held = tables if functions else 1
        a = random.normal(size=(held, functions, sample.shape[1] + 1))
        ranges.append(Index(float(row["norm"]), a, np.zeros((held, functions)), np.ones((held, functions))))
    of = ranges_of(sample, ranges)
    for number, own in enumerate(ranges):
        mine = sample[of == number]
        if own.a.shape[1] and len(mine):
            spread = np.einsum("tfd,nd->tfn", own.a, own.lifted(mine, query=False)).std(axis=2)
            own.w = np.where(spread > 0, WIDTH * spread, 1.0)
        own.b = random.uniform(0, 1, own.w.shape) * own.w
    asked = vectors.where(is_query).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(FIT_QUERIES).toArrow()
    if not any(own.a.shape[1] for own in ranges) or not asked.num_rows:
        return ranges
    ids, queries = asked["id"].to_numpy(), _matrix(asked["v"].combine_chunks())
    true = exact_neighbours(vectors, ids, queries, k).toArrow()
    row_of = {int(q): i for i, q in enumerate(ids)}
    owner = np.array([row_of[int(q)] for q in true["query"].to_numpy()], np.int64)
    near = _matrix(true["v"].combine_chunks()) if true.num_rows else np.zeros((0, sample.shape[1]))
    of = ranges_of(near, ranges)
    for number, own in enumerate(ranges):
        here = of == number
        if not own.a.shape[1] or not here.any():
            continue
        lifted, up, owners = own.lifted(near[here], query=False), own.lifted(queries, query=True), owner[here]
        rank = np.full(len(owners), MOST_PROBES)
        for t in range(len(own.a)):
            homes = np.floor(own.places(lifted, t)).astype(np.int64)
            places = own.places(up, t)
            for i in np.unique(owners):
                his = np.flatnonzero(owners == i)
                rank[his] = np.minimum(rank[his], probe_ranks(places[i], homes[his], MOST_PROBES))
        reach = np.sort(rank)
        needed = int(reach[min(len(reach) - 1, int(np.ceil(target * len(reach))))])
        if needed < MOST_PROBES:
            own.probes = needed + 1
        elif (rank < MOST_PROBES).mean() >= target:
            own.probes = MOST_PROBES
        else:
            ranges[number] = Index(own.norm, own.a[:1, :0], own.b[:1, :0], own.w[:1, :0])
    return ranges


def nearest(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    tables: int = TABLES,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """(query_id, rank, id, score): the k rows of largest inner product found for every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own.  Every row is hashed into each table of its range of norms; a query visits buckets of every
    range in order of estimated success, or all of a range where that misses the target.
    Rows and visits meet by bucket: small buckets share cells of bounded size, a bucket above that
    size is dealt over several cells and its visits go to all of them, and many queries to a cell
    are dealt over several copies of it.  A cell scores its own visited buckets exactly and
    returns k rows a query; the tables' candidates are merged and ranked.  Queries with fewer than
    k found are asked again of all buckets, so nothing is cut short.

    * Vectors that are null, zero, or hold null or non-finite components, rows without an id, and
      vectors of another length than the commonest take no part.
    * Rows that repeat an id are one candidate with the best of their scores, and never their own.
    * Equal scores go to the smaller id; ranks start at 1.  A score beyond the range of doubles is the end of
      that range, one that isn't a number (endless parts of both signs) is 0.
    * An empty table, or one of a single row, gives no rows; further columns are not read.
    """
    # Written once: each of the reads below would judge all components anew.
    vectors = written(usable(rows, id_col, vector_col).select("id", log_norm().alias("norm"), "v"), "vectors")
    is_query = F.col("id") % every == 0
    ranges = fit_index(vectors, is_query, k, tables, target)
    result = "query_id bigint, rank int, id bigint, score double"
    if not ranges:
        return rows.sparkSession.createDataFrame([], result)
    spark = rows.sparkSession
    kind = dict(vectors.dtypes)["v"]
    firsts = first_tables(ranges)
    shared = spark.sparkContext.broadcast([(own.norm, own.a, own.b, own.w, own.probes) for own in ranges])

    def hashed(batch: pa.RecordBatch, held: list[Index]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(table, places of rows in the batch, their buckets)."""
        x = _matrix(batch["v"])
        of = ranges_of(x, held)
        for number in np.unique(of):
            own, mine = held[number], np.flatnonzero(of == number)
            up = own.lifted(x[mine], query=False)
            for t in range(len(own.a)):
                yield firsts[number] + t, mine, codes(np.floor(own.places(up, t)).astype(np.int64))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Index(*values) for values in shared.value]
        for batch in batches:
            for t, _, bucket in hashed(batch, held):
                different, n = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), t, np.int32)), pa.array(different), pa.array(n)], names=["t", "bucket", "n"])

    sizes = vectors.select("v").mapInArrow(counted, "t int, bucket bigint, n bigint").groupBy("t", "bucket").agg(F.sum("n").alias("n"))
    sizes = written(sizes, "buckets")
    # One row for each table, and one for each bucket of more than a cell's rows.
    shards = {r["t"]: r["shards"] for r in sizes.groupBy("t").agg(F.ceil(F.sum("n") / CELL_ROWS).alias("shards")).collect()}
    large = sizes.where(F.col("n") > CELL_ROWS).select("t", "bucket", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts")).collect()
    layout = {}
    for t, n in shards.items():
        own = sorted((r["bucket"], r["parts"]) for r in large if r["t"] == t)
        layout[t] = Layout(n, np.array([b for b, _ in own], np.int64), np.array([p for _, p in own], np.int32))
    cells = spark.sparkContext.broadcast(layout)
    queries, key = vectors.where(is_query).select("id", "v"), ["t", "cell", "large", "part"]
    key_kind = "t int, cell bigint, large boolean, part int"

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the cells of their buckets."""
        held = [Index(*values) for values in shared.value]
        for batch in batches:
            ids = batch["id"].to_numpy()
            for t, mine, bucket in hashed(batch, held):
                cell, own, parts = cells.value[t].of(bucket)
                part = np.where(own, mixed(ids[mine]) % parts.astype(np.uint64), 0).astype(np.int32)
                there, at = [pa.array(np.full(len(mine), t, np.int32)), pa.array(cell), pa.array(own), pa.array(part)], pa.array(mine)
                yield pa.RecordBatch.from_arrays([*there, pa.array(bucket), batch["id"].take(at), batch["v"].take(at)], names=[*key, "bucket", "id", "v"])

    def visits(batch: pa.RecordBatch, held: list[Index], whole: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
        """(table, rows of the batch, their cells by number, whether large, and part, the buckets there; null for all)."""
        x = _matrix(batch["v"])
        for own, first in zip(held, firsts, strict=True):
            up = None if whole else own.lifted(x, query=True)
            for t in range(first, first + (1 if whole else len(own.a))):
                if t not in cells.value:
                    continue
                if whole:
                    # The first table of every range: together they hold each row once.
                    cell, big, part = cells.value[t].everywhere()
                    who = np.repeat(np.arange(len(x)), len(cell))
                    yield t, who, *(np.tile(c, len(x)) for c in (cell, big, part)), pa.nulls(len(who), pa.list_(pa.int64()))
                    continue
                places = own.places(up, t - first)
                block = max(1, BLOCK // min(own.probes, 3 ** min(places.shape[1], ENUMERATED)))
                for at in range(0, len(x), block):
                    asked = probed_codes(places[at : at + block], own.probes)
                    who, bucket = np.repeat(np.arange(at, at + len(asked)), asked.shape[1]), asked.ravel()
                    cell, big, parts = cells.value[t].of(bucket)
                    order = np.lexsort((cell, big, who))
                    who, bucket, cell, big, parts = (c[order] for c in (who, bucket, cell, big, parts))
                    new = np.ones(len(who), bool)
                    new[1:] = (who[1:] != who[:-1]) | (cell[1:] != cell[:-1]) | (big[1:] != big[:-1])
                    starts = np.flatnonzero(new)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(who)).astype(np.int32)), pa.array(bucket))
                    # A large bucket is asked in each of its parts.
                    times = np.where(big[starts], parts[starts], 1)
                    each = np.repeat(np.arange(len(starts)), times)
                    part = (np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)).astype(np.int32)
                    yield t, who[starts][each], cell[starts][each], big[starts][each], part, lists if len(each) == len(starts) else lists.take(pa.array(each))

    def search(asking: DataFrame, whole: bool = False) -> DataFrame:
        """The k best of the visited buckets for every query; of all buckets, if ``whole``."""

        def crowd(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [Index(*values) for values in shared.value]
            for batch in batches:
                for t, _, cell, big, part, _ in visits(batch, held, whole):
                    there, n = np.unique(np.stack([cell, big.astype(np.int64), part.astype(np.int64)]), axis=1, return_counts=True)
                    own = [pa.array(np.full(len(n), t, np.int32)), pa.array(there[0]), pa.array(there[1].astype(bool)), pa.array(there[2].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(n)], names=[*key, "n"])

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [Index(*values) for values in shared.value]
            for batch in batches:
                for t, who, cell, big, part, lists in visits(batch, held, whole):
                    for at in range(0, len(who), 10_000):
                        own, span = pa.array(who[at : at + 10_000]), slice(at, at + 10_000)
                        there = [pa.array(np.full(len(own), t, np.int32)), pa.array(cell[span]), pa.array(big[span]), pa.array(part[span])]
                        yield pa.RecordBatch.from_arrays([*there, batch["id"].take(own), lists[span], batch["v"].take(own)], names=[*key, "query", "buckets", "v"])

        left = asking.mapInArrow(asked, f"{key_kind}, query bigint, buckets array<bigint>, v {kind}").withColumn("turn", F.lit(0))
        right = vectors.select("id", "v").mapInArrow(filed, f"{key_kind}, bucket bigint, id bigint, v {kind}").withColumn("turn", F.lit(0))
        if asking.count() > CELL_QUERIES:
            # Few rows: each stands for more than a cell's queries.
            crowds = asking.mapInArrow(crowd, f"{key_kind}, n bigint").groupBy(*key).agg(F.sum("n").alias("n")).where(F.col("n") > CELL_QUERIES)
            crowds = written(crowds.select(*key, F.ceil(F.col("n") / CELL_QUERIES).cast("int").alias("turns")), "crowds")
            turns = F.coalesce("turns", F.lit(1))
            left = left.join(F.broadcast(crowds), key, "left").withColumn("turn", F.pmod(F.xxhash64("query"), turns).cast("int")).drop("turns")
            right = right.join(F.broadcast(crowds.toDF(*crowds.columns)), key, "left").withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1))).drop("turns")

        def scored(left: pa.Table, right: pa.Table) -> pa.Table:
            ids, scores, owners = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            if left.num_rows and right.num_rows:
                lists = left["buckets"].combine_chunks()
                asked = None if whole else (np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy())
                y, x = (_matrix(side["v"].combine_chunks()) for side in (left, right))
                found = cell_best(left["query"].to_numpy(), y, asked, right["id"].to_numpy(), x, right["bucket"].to_numpy(), k)
                owners, ids, scores = ([c] for c in found)
            who = np.concatenate(owners)
            at, starts = np.unique(who, return_index=True)
            edges = pa.array(np.append(starts, len(who)).astype(np.int32))
            query = left["query"].to_numpy()[at] if len(at) else np.zeros(0, np.int64)
            packed = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(c))) for c in (ids, scores)]
            return pa.table([pa.array(query), *packed], names=["query", "ids", "scores"])

        cell = [*key, "turn"]
        found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(scored, "query bigint, ids array<bigint>, scores array<double>")
        merged = found.groupBy("query").agg(F.collect_list(F.struct("ids", "scores")).alias("c"))
        merged = merged.select("query", F.flatten("c.ids").alias("ids"), F.flatten("c.scores").alias("scores"))

        def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    who = np.repeat(np.arange(part.num_rows), np.diff(part["ids"].offsets.to_numpy()))
                    ids, score = part["ids"].flatten().to_numpy(), part["scores"].flatten().to_numpy()
                    order = np.lexsort((-score, ids, who))
                    who, ids, score = who[order], ids[order], score[order]
                    new = np.ones(len(who), bool)
                    new[1:] = (who[1:] != who[:-1]) | (ids[1:] != ids[:-1])
                    who, ids, score = who[new], ids[new], score[new]
                    order, rank = first_of_each(who, score, ids, k)
                    yield pa.RecordBatch.from_arrays(
                        [part["query"].take(pa.array(who[order])), pa.array((rank + 1).astype(np.int32)), pa.array(ids[order]), pa.array(score[order])],
                        names=["query", "rank", "id", "score"],
                    )

        return merged.mapInArrow(ranked, "query bigint, rank int, id bigint, score double")

    found = written(search(queries), "neighbours")
    counts = found.groupBy("query").agg(F.count("*").alias("n"))
    others = vectors.select("id").distinct().count() - 1
    short = queries.select(F.col("id").alias("query")).distinct().join(counts, "query", "left")
    short = written(short.where(F.coalesce("n", F.lit(0)) < min(k, others)).select("query"), "short")
    if others > 0 and not short.isEmpty():
        again = search(queries.join(short, queries["id"] == short["query"], "left_semi"), whole=True)
        found = found.join(short, "query", "left_anti").unionByName(again)
    return found.select(F.col("query").alias("query_id"), "rank", "id", "score")
