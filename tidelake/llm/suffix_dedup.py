"""Removal of long byte strings that also start in an earlier document.

Suffixes are compared by prefix polynomial hashes: a binary search over hash equality finds
how far two suffixes agree, and a mergesort on that comparison brings equal ones together,
verified byte by byte.  To sort only suffixes that can have a partner, the windows of ``span`` bytes of a document are cut into runs of one
minimizer.  Equal windows share their minimizer, so each meets its partners under that key,
and inside a copied passage whole runs are equal and need a single comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import texts, written

SPAN = 50
#: Bytes of a minimizer; each window of SPAN bytes holds SPAN - MARK + 1 of them.
MARK = 16
#: Text that one group of documents holds on average, and windows that a run holds at most.
GROUP_BYTES, RUN_WINDOWS = 8_000_000, 64
#: A minimizer is hot if it starts this many different runs in every eighth batch of GROUP_BYTES.
HOT_RUNS, HOT_SHARE = 64, 8
#: Runs that a bucket of minimizers holds on average.
BUCKET_RUNS = 100_000
CHUNK = 1 << 20

_U = np.uint64
_BYTES = np.random.default_rng(9).integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    size = max(CHUNK + 4096, 1 << max(n - 1, 1).bit_length())
    if size not in _POWERS:
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(size, base, _U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums: those of any two places give the hash of what lies between."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums


def hashes_of(sums: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Hashes of the strings that start there, equal for equal strings wherever they stand."""
    _, down = powers(len(sums))
    return (sums[starts + sizes] - sums[starts]) * down[starts]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(33))


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x, done = np.minimum(x[:-done], x[done:]), done * 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def runs_of(data: np.ndarray, span: int = SPAN, mark: int = MARK) -> tuple[np.ndarray, ...]:
    """(start, windows, minimizer, body): the windows of a text, cut into runs of one minimizer.

    ``body`` is the hash of all bytes that the run's windows cover.  A run depends on nothing but
    those bytes and their neighbours, so copied passages are cut alike.  Long texts are
    taken chunk by chunk; a chunk starts with the last run of the one before it.
    """
    found: list[tuple[np.ndarray, ...]] = []
    begin, total = 0, len(data) - span + 1
    while begin < total:
        piece = data[begin : begin + CHUNK + span - 1]
        sums = prefix_hashes(piece)
        marks = _mixed(hashes_of(sums, np.arange(len(piece) - mark + 1), mark))
        least = _window_minimum(marks, span - mark + 1)
        starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        lengths = np.diff(np.append(starts, len(least)))
        if lengths.max() > RUN_WINDOWS:  # only text of a short period
            parts = -(-lengths // RUN_WINDOWS)
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts = np.repeat(starts, parts) + inside * RUN_WINDOWS
            lengths = np.diff(np.append(starts, len(least)))
        last = begin + len(least) >= total
        if not last:
            starts, lengths = starts[:-1], lengths[:-1]
        bodies = _mixed(hashes_of(sums, starts, lengths + (span - 1)) + lengths.astype(_U))
        found.append((starts + begin, lengths, least[starts], bodies))
        begin = total if last else int(starts[-1] + lengths[-1]) + begin
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def agreement(sums: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> np.ndarray:
    """How many bytes, up to ``span``, the suffixes at a and b have in common: a binary search over equal hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), span)
    while (low < high).any():
        middle = (low + high + 1) // 2
        equal = hashes_of(sums, a, middle) == hashes_of(sums, b, middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return low


def suffix_order(data: np.ndarray, sums: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Order of the suffixes by their first ``span`` bytes.

    A bottom-up mergesort, all merges of a level at once.  Two suffixes are compared at the first
    byte after their agreement.  The runs it starts from are in order of the first 16 bytes, and
    two neighbouring runs that are in order already need one comparison.
    """
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = [np.ascontiguousarray(windows[starts + at]).view(">u8").ravel() for at in (0, 8)]
    order = np.lexsort((np.arange(len(starts)), words[1], words[0]))

    def after(x: np.ndarray, y: np.ndarray, or_equal: bool) -> np.ndarray:
        a, b = starts[x], starts[y]
        common = agreement(sums, a, b, span)
        whole = common >= span
        at = np.minimum(common, span - 1)
        return np.where(whole, or_equal, data[a + at] > data[b + at])

    def passed(own: np.ndarray, lows: np.ndarray, highs: np.ndarray, or_equal: bool) -> np.ndarray:
        """How many of a sorted stretch go in front of each element."""
        low, high = lows.copy(), highs.copy()
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, lows)
            front = open_ & after(order[own], order[middle], or_equal)
            low, high = np.where(front, middle + 1, low), np.where(open_ & ~front, middle, high)
        return low - lows

    n, width = len(starts), 1
    while width < n:
        mid = np.arange(width, n, 2 * width)
        wrong = mid[after(order[mid - 1], order[mid], False)]
        if len(wrong):
            half = np.repeat(wrong, width)
            left = half + np.tile(np.arange(-width, 0), len(wrong))
            right = half + np.tile(np.arange(width), len(wrong))
            end = np.minimum(half + width, n)
            there = right < end
            merged = order.copy()
            merged[left + passed(left, half, end, False)] = order[left]
            # Equals of the left half stay in front.
            right, middle = right[there], half[there]
            merged[right - width + passed(right, middle - width, middle, True)] = order[right]
            order = merged
        width *= 2
    return order


def repeated_windows(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, span: int) -> np.ndarray:
    """Whether each window also starts in a document with a smaller id.

    Windows whose hash stands in one document only are passed over; the others are sorted as
    suffixes, and neighbours are equal if they agree over the whole span, byte by byte.
    """
    sums = prefix_hashes(data)
    prints = hashes_of(sums, starts, span)
    order = np.argsort(prints)
    prints = prints[order]
    same = prints[1:] == prints[:-1]
    order = order[np.r_[False, same] | np.r_[same, False]]
    late = np.zeros(len(starts), bool)
    if not len(order):
        return late
    prints = hashes_of(sums, starts[order], span)
    firsts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
    sizes = np.diff(np.append(firsts, len(order)))
    held = ids[order]
    low, high = np.minimum.reduceat(held, firsts), np.maximum.reduceat(held, firsts)
    chosen = order[np.repeat(low < high, sizes)]
    if not len(chosen):
        return late
    chosen = chosen[suffix_order(data, sums, starts[chosen], span)]
    view = np.lib.stride_tricks.sliding_window_view(data, span)
    a, b = starts[chosen[:-1]], starts[chosen[1:]]
    equal = agreement(sums, a, b, span) == span
    at = np.flatnonzero(equal)
    for block in range(0, len(at), 100_000):
        part = at[block : block + 100_000]
        equal[part] = (view[a[part]] == view[b[part]]).all(axis=1)
    firsts = np.flatnonzero(np.r_[True, ~equal])
    sizes = np.diff(np.append(firsts, len(chosen)))
    late[chosen] = ids[chosen] > np.repeat(np.minimum.reduceat(ids[chosen], firsts), sizes)
    return late


class Group:
    """The runs of a group of documents, and its classes of equal runs in an order that follows from their hashes alone."""

    def __init__(self, docs: pa.Table, hot: np.ndarray, span: int, mark: int):
        docs = docs.sort_by([("id", "ascending"), ("sig", "ascending")])
        self.ids, self.sigs = docs["id"].to_numpy(), docs["sig"].to_numpy()
        self.data = [np.frombuffer(t.as_buffer(), np.uint8) for t in docs["data"]]
        parts = [runs_of(d, span, mark) for d in self.data]
        counts = [len(p[0]) for p in parts]
        self.doc = np.repeat(np.arange(len(parts)), counts)
        joined = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4
        self.start, self.windows, self.mark, self.body = joined
        self.is_hot = np.isin(self.mark, hot) if len(hot) else np.zeros(len(self.mark), bool)
        cold = np.flatnonzero(~self.is_hot)
        # Both hashes in one number: one sort instead of two.
        both = self.body[cold] ^ (self.mark[cold] * _U(0x9FB21C651E98DF25))
        order = np.argsort(both)
        self.order, both = cold[order], both[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
        self.sizes = np.diff(np.append(first, len(both)))
        self.class_mark, self.class_body = self.mark[self.order[first]], self.body[self.order[first]]
        owner = self.ids[self.doc[self.order]]
        self.class_id = np.minimum.reduceat(owner, first) if len(first) else np.zeros(0, np.int64)

    def buckets(self, count: int) -> dict[int, np.ndarray]:
        """Numbers of the classes of each bucket, in their order.  A class's minimizer alone decides its bucket."""
        return dealt_by(((self.class_mark * _U(0xD6E8FEB86659FD93)) >> _U(33)).astype(np.int64) % count)

    def hot_windows(self, span: int) -> Iterator[tuple[int, int, bytes]]:
        """(document, start, bytes) of every window under a hot minimizer."""
        for run in np.flatnonzero(self.is_hot):
            doc, begin = int(self.doc[run]), int(self.start[run])
            raw = self.data[doc][begin : begin + int(self.windows[run]) + span - 1].tobytes()
            for at in range(int(self.windows[run])):
                yield doc, begin + at, raw[at : at + span]


def dealt_by(numbers: np.ndarray) -> dict[int, np.ndarray]:
    """Positions of each number, ascending."""
    order = np.argsort(numbers, kind="stable")
    values, starts = np.unique(numbers[order], return_index=True)
    return dict(zip(values.tolist(), np.split(order, starts[1:]), strict=True)) if len(numbers) else {}


def hot_marks(docs: DataFrame, total: int, span: int, mark: int) -> np.ndarray:
    """Minimizers that start many different runs all over the corpus.

    They only choose the way a run takes, and every task sees the same list.  Each batch names at
    most its bytes / HOT_RUNS of them, and one must be named by every HOT_SHARE-th, so the list is
    bounded by HOT_SHARE * GROUP_BYTES / HOT_RUNS.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: list[np.ndarray] = []
        bodies: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            m, b = np.concatenate(marks), np.concatenate(bodies)
            values, counts = np.unique(m, return_counts=True)
            often = np.isin(m, values[counts >= HOT_RUNS])
            values, counts = np.unique(_distinct(m[often], b[often]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values[counts >= HOT_RUNS].view(np.int64))], names=["mark"])

        for batch in batches:
            for text in batch["data"]:
                _, _, m, b = runs_of(np.frombuffer(text.as_buffer(), np.uint8), span, mark)
                marks.append(m)
                bodies.append(b)
                size += len(text.as_buffer())
                if size >= GROUP_BYTES:
                    yield flush()
                    marks, bodies, size = [], [], 0
        if marks:
            yield flush()

    found = docs.select("data").mapInArrow(named, "mark bigint").groupBy("mark").agg(F.count("*").alias("n"))
    least = max(2, -(-total // GROUP_BYTES) // HOT_SHARE)
    return found.where(F.col("n") >= least).select("mark").toArrow()["mark"].to_numpy().view(_U)


def _distinct(marks: np.ndarray, bodies: np.ndarray) -> np.ndarray:
    """The minimizer of every distinct (minimizer, body)."""
    order = np.lexsort((bodies, marks))
    m, b = marks[order], bodies[order]
    return m[np.r_[True, (m[1:] != m[:-1]) | (b[1:] != b[:-1])]] if len(m) else m


def packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def unpacked(column: pa.ChunkedArray, counts: list[int], kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [
        np.frombuffer(pa.decompress(v, decompressed_size=n * size, codec="zstd", asbytes=True), kind)
        for v, n in zip(column.to_pylist(), counts, strict=True)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


SAME, APART, SHIP = 1, 0, 2


def verdicts(marks: np.ndarray, bodies: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each class of a group: SAME if an earlier document elsewhere holds the same run, SHIP if
    it is first of its kind but its minimizer also stands in other documents, else APART."""
    out = np.zeros(len(marks), np.uint8)
    order = np.argsort(marks)
    same = marks[order[1:]] == marks[order[:-1]]
    # Most minimizers stand in one class only; the others are sorted in full.
    order = order[np.r_[False, same] | np.r_[same, False]]
    if not len(order):
        return out
    order = order[np.lexsort((ids[order], bodies[order], marks[order]))]
    m, b, i = marks[order], bodies[order], ids[order]
    new_mark = np.r_[True, m[1:] != m[:-1]]
    new_class = new_mark | np.r_[True, b[1:] != b[:-1]]
    number = np.cumsum(new_class) - 1
    first = i[new_class]
    of_mark = np.cumsum(new_mark)[new_class] - 1
    starts = np.flatnonzero(np.r_[True, of_mark[1:] != of_mark[:-1]])
    low, high = np.minimum.reduceat(first, starts), np.maximum.reduceat(first, starts)
    shared = (low < high)[of_mark]
    out[order] = np.where(i > first[number], SAME, np.where(shared[number], SHIP, APART))
    return out


def merged_ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the ranges; ranges that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], reach[ends]


def removable(docs: DataFrame, id_col: str, text_col: str, span: int = SPAN, mark: int = MARK) -> DataFrame:
    """(id, sig, begin, end): byte ranges that strings of ``span`` bytes from earlier documents cover.

    Documents are grouped by a hash of their id into groups of ``GROUP_BYTES``.  Each group sends
    one entry for each class of equal runs to the bucket of its minimizer and gets a verdict for it;
    what is equal as a whole (minimizer, body: two 64-bit hashes) is settled by that.  Runs
    that share a minimizer but differ, as at the borders of a copied passage, are sent with their
    bytes and settled window by window.  Under hot minimizers windows are grouped by
    their bytes instead, folded in every group first, so that no bucket holds a hot group.
    """
    rows = texts(docs, id_col, text_col).where(F.col("id").isNotNull())
    rows = rows.select(F.col("id").cast("bigint").alias("id"), "sig", F.col("text").cast("binary").alias("data"))
    rows = rows.where(F.octet_length("data") >= span)
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    count = max(1, round(total * 2 / (span - mark + 2) / BUCKET_RUNS))
    hot = hot_marks(rows, total, span, mark)
    shared = rows.sparkSession.sparkContext.broadcast(hot)
    dealt = rows.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))

    def entries(docs: pa.Table) -> pa.Table:
        group, g = Group(docs, shared.value, span, mark), docs["g"][0].as_py()
        out = {name: [] for name in ("bucket", "g", "n", "marks", "bodies", "ids")}
        for bucket, mine in group.buckets(count).items():
            values = (bucket, g, len(mine), packed(group.class_mark[mine]), packed(group.class_body[mine]), packed(group.class_id[mine]))
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.table(out, schema=entry_schema)

    entry_schema = pa.schema(
        [("bucket", pa.int32()), ("g", pa.int32()), ("n", pa.int32()), ("marks", pa.binary()), ("bodies", pa.binary()), ("ids", pa.binary())]
    )

    def judged(bucket: pa.Table) -> pa.Table:
        counts = bucket["n"].to_pylist()
        flags = verdicts(
            unpacked(bucket["marks"], counts, np.uint64),
            unpacked(bucket["bodies"], counts, np.uint64),
            unpacked(bucket["ids"], counts, np.int64),
        )
        cuts = np.cumsum([0, *counts])
        answers = [packed(flags[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"g": bucket["g"], "bucket": bucket["bucket"], "flags": pa.array(answers, pa.binary())})

    def hot_windows(docs: pa.Table) -> pa.Table:
        group, g = Group(docs, shared.value, span, mark), docs["g"][0].as_py()
        reach: dict[bytes, tuple[int, int]] = {}
        for doc, _, window in group.hot_windows(span):
            i = int(group.ids[doc])
            low, high = reach.get(window, (i, i))
            reach[window] = (min(low, i), max(high, i))
        columns = {"g": [g] * len(reach), "window": list(reach), "low": [r[0] for r in reach.values()], "high": [r[1] for r in reach.values()]}
        return pa.table(columns, schema=pa.schema([("g", pa.int32()), ("window", pa.binary()), ("low", pa.int64()), ("high", pa.int64())]))

    by_group = dealt.groupBy("g")
    sent = by_group.applyInArrow(entries, "bucket int, g int, n int, marks binary, bodies binary, ids binary")
    replies = sent.groupBy("bucket").applyInArrow(judged, "g int, bucket int, flags binary")
    answers = replies.select("g", "bucket", "flags", F.lit(None).cast("binary").alias("window"), F.lit(None).cast("bigint").alias("first"))
    if len(hot):
        folded = by_group.applyInArrow(hot_windows, "g int, window binary, low bigint, high bigint")
        firsts = folded.groupBy("window").agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first < last")
        told = folded.toDF("g", "window", "low", "high").join(firsts.select("window", "first"), "window").where("high > first")
        answers = answers.unionByName(
            told.select("g", F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("flags"), "window", "first")
        )

    def settled(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return piece_schema.empty_table()
        group = Group(docs, shared.value, span, mark)
        of = group.buckets(count)
        flags = np.zeros(len(group.class_mark), np.uint8)
        first: dict[bytes, int] = {}
        for answer in answers.to_pylist():
            if answer["flags"] is not None:
                mine = of[answer["bucket"]]
                flags[mine] = np.frombuffer(pa.decompress(answer["flags"], decompressed_size=len(mine), codec="zstd", asbytes=True), np.uint8)
            else:
                first[answer["window"]] = answer["first"]
        run, flag = group.order, np.repeat(flags, group.sizes)
        owner = group.ids[group.doc[run]]
        local = np.repeat(group.class_id, group.sizes)
        gone = run[(flag == SAME) | (owner > local)]
        doc, start, stop = group.doc[gone], group.start[gone], group.start[gone] + group.windows[gone] + (span - 1)
        late = [(d, s) for d, s, window in group.hot_windows(span) if first.get(window, group.ids[d]) < group.ids[d]]
        if late:
            extra = np.array(late, np.int64)
            doc, start, stop = np.append(doc, extra[:, 0]), np.append(start, extra[:, 1]), np.append(stop, extra[:, 1] + span)
        out = {name: [] for name in piece_schema.names}

        def add(d: int, begin: int, end: int | None, key: int | None, data: bytes | None) -> None:
            for name, value in zip(out, (int(group.ids[d]), int(group.sigs[d]), begin, end, key, data), strict=True):
                out[name].append(value)

        order = np.argsort(doc, kind="stable")
        doc, start, stop = doc[order], start[order], stop[order]
        cuts = np.searchsorted(doc, np.arange(len(group.ids) + 1))
        for d in np.flatnonzero(np.diff(cuts)):
            for begin, end in zip(*merged_ranges(start[cuts[d] : cuts[d + 1]], stop[cuts[d] : cuts[d + 1]]), strict=True):
                add(d, int(begin), int(end), None, None)
        for r in run[(flag == SHIP) & (owner == local)]:
            d, begin = int(group.doc[r]), int(group.start[r])
            raw = group.data[d][begin : begin + int(group.windows[r]) + span - 1].tobytes()
            add(d, begin, None, int(group.mark[r : r + 1].view(np.int64)[0]), raw)
        return pa.table(out, schema=piece_schema)

    piece_schema = pa.schema(
        [("id", pa.int64()), ("sig", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("mark", pa.int64()), ("data", pa.binary())]
    )
    schema = "id bigint, sig bigint, begin bigint, end bigint, mark bigint, data binary"
    pieces = written(by_group.cogroup(answers.groupBy("g")).applyInArrow(settled, schema), "pieces")

    def compared(runs: pa.Table) -> pa.Table:
        raw = runs["data"].to_pylist()
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.cumsum([0, *map(len, raw)])
        windows = np.diff(offsets) - (span - 1)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = np.repeat(offsets[:-1], windows) + inside
        owner = np.repeat(np.arange(len(windows)), windows)
        late = repeated_windows(data, starts, runs["id"].to_numpy()[owner], span)
        # Neighbouring windows of one run make one range.
        at = np.flatnonzero(late)
        new = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])] if len(at) else np.zeros(0, bool)
        head = at[new]
        tail = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        who, begin = owner[head], runs["begin"].to_numpy()
        return pa.table(
            {
                "id": runs["id"].to_numpy()[who],
                "sig": runs["sig"].to_numpy()[who],
                "begin": begin[who] + inside[head],
                "end": begin[who] + inside[tail] + span,
            }
        )

    shipped = pieces.where(F.col("data").isNotNull()).select(
        F.pmod(F.xxhash64("mark"), F.lit(4 * count)).alias("bucket"), "id", "sig", "begin", "data"
    )
    more = shipped.groupBy("bucket").applyInArrow(compared, "id bigint, sig bigint, begin bigint, end bigint")
    return pieces.where(F.col("data").isNull()).select("id", "sig", "begin", "end").unionByName(more)


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, mark: int = MARK
) -> DataFrame:
    """(id, sig, n_bytes, spans, kept): each document without the bytes that earlier documents hold.

    A byte goes if a string of ``span`` bytes that covers it also starts in a document with a smaller
    id; strings are judged on the input and never cross documents.  ``spans`` are the maximal
    removed runs (begin, end) in bytes, ``kept`` the remaining bytes, which may end inside a character.

    * A null text is empty; a text shorter than ``span`` bytes keeps everything.
    * Strings repeated inside their first document stay.
    * A row without an id loses nothing and takes nothing from others.
    * Rows that repeat an id take nothing from one another; each has its own result.
    * An empty table gives an empty table; further columns are not read.
    """
    rows = texts(docs, id_col, text_col).select(F.col("id").cast("bigint").alias("id"), "sig", F.col("text").cast("binary").alias("data"))
    ranges = removable(docs, id_col, text_col, span, mark)
    per_row = ranges.groupBy("id", "sig").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    joined = rows.join(per_row, ["id", "sig"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for data, ranges in zip(batch["data"], batch["ranges"], strict=True):
                raw = memoryview(data.as_buffer())
                found = ranges.as_py()
                if not found:
                    spans.append([])
                    kept.append(raw)
                    continue
                both = np.array([(r["begin"], r["end"]) for r in found], np.int64)
                begins, ends = merged_ranges(both[:, 0], both[:, 1])
                spans.append([{"begin": int(b), "end": int(e)} for b, e in zip(begins, ends, strict=True)])
                stays = zip([0, *ends.tolist()], [*begins.tolist(), len(raw)], strict=True)
                kept.append(b"".join(raw[a:b] for a, b in stays))
            sizes = [len(d.as_buffer()) for d in batch["data"]]
            arrays = [batch["id"], batch["sig"], pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array([bytes(k) for k in kept], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "sig", "n_bytes", "spans", "kept"])

    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return joined.mapInArrow(cut, "id bigint, sig bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
