"""Runs of words that repeat with a period, found by convolving blocks with what follows them.

At every dyadic scale B the words are cut into blocks of B.  The sum of squared differences between a block
and the text at each distance behind it is zero just where the block occurs again; it comes, for all
distances of a scale at once, from an exact number-theoretic transform.  A run of period q has at
least one whole block of the scale with 2B - 1 <= q <= 4B - 2 that occurs again q words on, so the
distances found are the seeds from which runs are extended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import texts

#: Words that a run has at least, besides twice its period.
LEAST = 12
#: A prime just below 2**31 with roots of unity of order 2**27, and a generator of its units.
PRIME, GENERATOR = 15 * 2**27 + 1, 31
#: Bytes of text taken at once, and numbers that one transform holds.
CHUNK_BYTES, TRANSFORM = 2_000_000, 1 << 18

_U = np.uint64
_P = _U(PRIME)
_ROOTS: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}


def _powers(root: int, count: int) -> np.ndarray:
    out = np.ones(count, _U)
    step = 1
    while step < count:
        out[step : 2 * step] = out[:step][: count - step] * _U(pow(root, step, PRIME)) % _P
        step *= 2
    return out


def roots(size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Powers of the roots of unity and of their inverses for each halving of ``size``, the whole first."""
    if size not in _ROOTS:
        forward, back, length = [], [], size
        while length > 1:
            root = pow(GENERATOR, (PRIME - 1) // length, PRIME)
            forward.append(_powers(root, length // 2))
            back.append(_powers(pow(root, -1, PRIME), length // 2))
            length //= 2
        _ROOTS[size] = (forward, back)
    return _ROOTS[size]


def transform(values: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order; the length is a power of two."""
    rows, size = values.shape
    for factors in roots(size)[0]:
        halves = values.reshape(rows, -1, 2, len(factors))
        a, b = halves[:, :, 0], halves[:, :, 1]
        values = np.stack(((a + b) % _P, (a + _P - b) * factors % _P), axis=2).reshape(rows, size)
    return values


def inverse(values: np.ndarray) -> np.ndarray:
    """Inverse of ``transform``."""
    rows, size = values.shape
    for factors in reversed(roots(size)[1]):
        halves = values.reshape(rows, -1, 2, len(factors))
        a, b = halves[:, :, 0], halves[:, :, 1] * factors % _P
        values = np.stack(((a + b) % _P, (a + _P - b) % _P), axis=2).reshape(rows, size)
    return values * _U(pow(size, -1, PRIME)) % _P


def square_differences(blocks: np.ndarray, windows: np.ndarray, shifts: int) -> np.ndarray:
    """Sums of squared differences between each block and its window at every shift, modulo the prime.

    Both are rows of numbers; a transform of 4 times the block's length holds a window without wrapping.
    """
    count, width = blocks.shape
    size = 4 * width
    turned = np.zeros((count, size), _U)
    turned[:, 0] = blocks[:, 0]
    turned[:, size - width + 1 :] = blocks[:, :0:-1]
    ahead = np.zeros((count, size), _U)
    ahead[:, : windows.shape[1]] = windows
    products = inverse(transform(turned) * transform(ahead) % _P)[:, :shifts]
    sums = np.zeros((count, windows.shape[1] + 1), _U)
    np.cumsum(windows * windows, axis=1, out=sums[:, 1:])
    squares = sums[:, width : width + shifts] - sums[:, :shifts]
    own = (blocks * blocks).sum(axis=1, keepdims=True)
    return (own + squares + _U(2) * (_P - products)) % _P


def next_places(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How far each word's next occurrence in its document is; a number beyond all distances if there is none."""
    order = np.argsort(codes.astype(np.uint16) if len(codes) and codes.max() < 1 << 16 else codes, kind="stable")
    out = np.full(len(codes), np.iinfo(np.int64).max)
    here, there = order[:-1], order[1:]
    again = (codes[here] == codes[there]) & (owner[here] == owner[there])
    out[here[again]] = (there - here)[again]
    return out


def seeds(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(B, places, distances) for every scale: blocks of B words, and how far behind them they occur again.

    A block with a word that has no next occurrence within the reach of its scale has none itself and is not
    transformed.  Words are spread over as few numbers as keep the largest possible sum below the
    prime: a sum is then zero exactly if all numbers agree.  Different words may share a number, so a
    seed can be false, and the extension finds that; none is missed.
    """
    largest = int(np.diff(np.append(0, ends)).max(initial=0))
    farthest = next_places(codes, owner)
    block = 1
    while True:
        block *= 2
        near = 1 if block == 2 else 2 * block - 1
        if near > largest // 2:
            return
        whole = len(farthest) // 2
        farthest = np.maximum(farthest[0 : 2 * whole : 2], farthest[1 : 2 * whole : 2])
        at = np.flatnonzero(farthest <= 4 * block - 2) * block
        at = at[owner[at] == owner[at + block - 1]]
        if not len(at):
            continue
        shifts = 4 * block - 1 - near
        spread = _U(max(2, int(((PRIME - 1) // block) ** 0.5)))
        step = max(1, TRANSFORM // (4 * block))
        for begin in range(0, len(at), step):
            part = at[begin : begin + step]
            stop = ends[owner[part]]
            ahead = part[:, None] + near + np.arange(shifts + block - 1)
            windows = _spread(codes[np.minimum(ahead, len(codes) - 1)], spread)
            blocks = _spread(codes[part[:, None] + np.arange(block)], spread)
            zero = square_differences(blocks, windows, shifts) == 0
            zero &= part[:, None] + near + np.arange(shifts) + block <= stop[:, None]
            row, shift = np.nonzero(zero)
            if len(row):
                yield block, part[row], shift + near


def _spread(codes: np.ndarray, count: np.uint64) -> np.ndarray:
    return ((codes.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15) >> _U(33)) % count


def runs_of(codes: np.ndarray, counts: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run in each document, by start and period.

    ``codes`` numbers the words of all documents, one after the other; ``counts`` are their lengths.
    """
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    found: dict[int, dict[tuple[int, int], int]] = {}
    for block, places, distances in seeds(codes, owner, ends):
        # Blocks come in order of their place, so those of a document stand together.
        docs, cuts = np.unique(owner[places], return_index=True)
        for doc, own, apart in zip(docs.tolist(), np.split(places, cuts[1:]), np.split(distances, cuts[1:]), strict=True):
            begin = int(ends[doc] - counts[doc])
            _extend(codes[begin : ends[doc]], block, own - begin, apart, least, found.setdefault(doc, {}))
    return [sorted((s, e - s, q) for (s, e), q in found.get(d, {}).items()) for d in range(len(counts))]


def _extend(words: np.ndarray, block: int, places: np.ndarray, distances: np.ndarray, least: int, runs: dict[tuple[int, int], int]) -> None:
    """Extend seeds, smallest distance first, as far as words so far apart are the same.

    A seed whose distance is a multiple of the period of a known run that holds block and copy
    leads to that run again.  Where a stretch of some period is long enough and has a smaller one,
    that divides it, and the run has seeds of the smaller one too: the smallest stays.
    """

    def unexplained(places: np.ndarray, distances: np.ndarray, known: list[tuple[tuple[int, int], int]]) -> tuple[np.ndarray, np.ndarray]:
        for (start, end), period in known:
            inside = (places >= start) & (places + block + distances <= end) & (distances % period == 0)
            places, distances = places[~inside], distances[~inside]
        return places, distances

    places, distances = unexplained(places, distances, list(runs.items()))
    while len(places):
        period = int(distances.min())
        edges = np.flatnonzero(np.diff(np.r_[False, words[:-period] == words[period:], False]))
        starts, stops = edges[::2], edges[1::2] + period
        fresh = []
        for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
            if e - s >= max(least, 2 * period) and runs.get((s, e), period + 1) > period:
                runs[(s, e)] = period
                fresh.append(((s, e), period))
        rest = distances != period
        places, distances = unexplained(places[rest], distances[rest], fresh)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[bytes]]]:
    ids, held, size = [], [], 0
    for i, data in zip(batch["id"].to_pylist(), batch["data"], strict=True):
        raw = data.as_buffer().to_pybytes()
        ids.append(i)
        held.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield ids, held
            ids, held, size = [], [], 0
    if ids:
        yield ids, held


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(id, n_words, runs, collapsed): the runs of every document, and its words without their repetitions.

    Words are what ASCII blanks part.  A run is a stretch of words of smallest period q, at least ``least`` and
    2 * q words long, that no neighbouring word extends; ``runs`` holds (start, length, period)
    by start and period.  ``collapsed`` (UTF-8) leaves out every word that some run holds behind
    its first q words, and joins the others by one space.

    * A null or empty text has no words, no runs and collapses to nothing.
    * Every row has its own result, also rows that repeat an id or have none.
    * An empty table gives an empty table; further columns are not read.

    Nothing is shuffled; documents are taken in chunks of ``CHUNK_BYTES``, a longer one alone.  The work is
    about n log n log n for n words, and more only for texts with many different periods.
    """
    rows = texts(docs, id_col, text_col).select(F.col("id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("data"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, held in _chunks(batch):
                words = [raw.split() for raw in held]
                counts = np.array([len(w) for w in words], np.int64)
                coded = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
                runs = runs_of(coded.indices.to_numpy().astype(np.int64), counts, least)
                named = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
                kept = [_collapsed(own, of) for own, of in zip(words, runs, strict=True)]
                columns = (ids, counts.tolist(), named, kept)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    schema = "id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    return rows.mapInArrow(found, schema)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(stays).tolist()])
