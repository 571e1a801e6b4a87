"""JSON lists of any size, cut into byte ranges.

A range cannot tell whether it begins inside a string or how deep it stands.  The index pass
therefore measures each range for both cases (outside and inside a string): what it
adds to the depth, and how many objects open at each depth relative to its start.  Walking over
the ranges of a file, one small row each, settles the true case, depth and number of the first member;
the second pass emits the members that open in a range, reading past its end to close the last.
Neither a file nor a range is held in memory: a task holds a block and the member it is in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import spread
from tidelake.sources.paths import open_in_task

#: Bytes scanned at once, and about as many handed on at once.
BLOCK_BYTES = 8 << 20
_BOM = b"\xef\xbb\xbf"
_BLANK = b" \t\r\n"
NOT_A_LIST = "expected a JSON list"
NOT_OBJECTS = "expected every JSON list item to be an object"
TORN = "the JSON list ends inside a member"

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[[ord('"'), ord("\\")]] = True


def _escaped_at(handle, begin: int) -> bool:
    """Whether an odd run of backslashes stands right before ``begin``."""
    run, at = 0, begin
    while at:
        size = min(at, 4096)
        handle.seek(at - size)
        piece = handle.read(size)
        tail = size - len(piece.rstrip(b"\\"))
        run += tail
        if tail < size:
            break
        at -= size
    return run % 2 == 1


def _marks(block: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, int]:
    """Brackets of a block: places, bytes, and quotes before each (mod 2); then whether the byte after
    the block is escaped, and the block's number of quotes."""
    raw = np.frombuffer(block, np.uint8)
    places = np.flatnonzero(_MARK[raw])
    kinds = raw[places]
    slashes = places[kinds == ord("\\")]
    skipped = np.empty(0, np.int64)
    carried = False
    if len(slashes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(first, append=len(slashes))
        starts = slashes[first]
        # A run at the block's start goes on from the one before it.
        lengths = lengths + ((starts == 0) & escaped)
        after = slashes[first + np.diff(first, append=len(slashes)) - 1] + 1
        skipped = after[lengths % 2 == 1]
        carried = bool(len(skipped)) and int(skipped[-1]) == len(block)
    if escaped and (not len(slashes) or slashes[0] != 0):
        skipped = np.append(skipped, 0)
        carried = carried or not len(block)
    quotes = (kinds == ord('"')) & ~np.isin(places, skipped)
    before = np.cumsum(quotes) & 1
    brackets = _STEP[kinds] != 0
    return places[brackets], kinds[brackets], before[brackets], carried, int(quotes.sum())


def _blocks(handle, start: int, stop: int | None) -> Iterator[tuple[int, bytes]]:
    handle.seek(start)
    while (stop is None or start < stop) and (block := handle.read(BLOCK_BYTES if stop is None else min(BLOCK_BYTES, stop - start))):
        yield start, block
        start += len(block)


def _measure(handle, start: int, stop: int) -> dict:
    """What a range does to one that enters it outside (0) or inside (1) a string."""
    escaped, quotes = _escaped_at(handle, start), 0
    depth, opens = [0, 0], [{}, {}]
    for _, block in _blocks(handle, start, stop):
        _, kinds, before, escaped, more = _marks(block, escaped)
        for inside in (0, 1):
            seen = kinds[(before + quotes) % 2 == inside]
            steps = _STEP[seen].astype(np.int64)
            levels = depth[inside] + np.cumsum(steps) - steps
            for level, n in zip(*np.unique(levels[seen == ord("{")], return_counts=True), strict=True):
                opens[inside][int(level)] = opens[inside].get(int(level), 0) + int(n)
            depth[inside] += int(steps.sum())
        quotes += more
    return {
        "flips": quotes % 2,
        "out_depth": depth[0],
        "in_depth": depth[1],
        "out_levels": list(opens[0]),
        "out_opens": list(opens[0].values()),
        "in_levels": list(opens[1]),
        "in_opens": list(opens[1].values()),
    }


_MEASURED = (
    "path string, source_path string, begin bigint, flips bigint, out_depth bigint, in_depth bigint, out_levels array<bigint>, "
    "out_opens array<bigint>, in_levels array<bigint>, in_opens array<bigint>"
)
_PLACED = "path string, source_path string, begin bigint, inside bigint, depth bigint, first bigint, n bigint"


def _placed(ranges: pd.DataFrame) -> pd.DataFrame:
    """The true entry of every range of one file, walked in order."""
    inside, depth, first, rows = 0, 0, 0, []
    for r in ranges.sort_values("begin").to_dict("records"):
        side = "in" if inside else "out"
        n = sum(int(n) for level, n in zip(r[f"{side}_levels"], r[f"{side}_opens"], strict=True) if depth + level == 1)
        rows.append((r["path"], r["source_path"], r["begin"], inside, depth, first, n))
        inside, depth, first = (inside + r["flips"]) % 2, depth + r[f"{side}_depth"], first + n
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PLACED.split(", ")])


def _refused(path: str, why: str) -> ValueError:
    return ValueError(f"{why}: {path}")


def _head(handle, path: str) -> int:
    """Where the list's bracket stands."""
    at = 0
    for at, block in _blocks(handle, 0, None):
        whole = block
        if not at and block.startswith(_BOM):
            block = block[len(_BOM) :]
        if kept := block.lstrip(_BLANK):
            if not kept.startswith(b"["):
                raise _refused(path, NOT_A_LIST)
            return at + len(whole) - len(kept)
    raise _refused(path, NOT_A_LIST)


def members_in(handle, path: str, begin: int, stop: int, inside: int, depth: int) -> Iterator[bytes]:
    """Members that open in [begin, stop), checked up to the next member or the end of the list.

    What stands before the first of them was checked by the range of the member before it.
    """
    start = _head(handle, path) if begin == 0 else begin
    escaped, quotes = _escaped_at(handle, start), inside
    # ``kept`` holds the bytes from ``kept_at`` on; ``opened`` and ``gap`` say what is being read.
    kept, kept_at = bytearray(), start
    opened, gap, first, any_yet = None, None, False, begin != 0
    for at, block in _blocks(handle, start, None):
        kept += block
        places, kinds, before, escaped, more = _marks(block, escaped)
        out = (before + quotes) % 2 == 0
        quotes += more
        places, kinds = places[out] + at, kinds[out]
        steps = _STEP[kinds].astype(np.int64)
        after = depth + np.cumsum(steps)
        depth += int(steps.sum())
        # Only what opens or closes a member, or the list, counts.
        edge = ((steps > 0) & (after <= 2)) | ((steps < 0) & (after <= 1))
        for place, kind, level in zip(places[edge].tolist(), kinds[edge].tolist(), after[edge].tolist(), strict=True):
            if level == 1 and kind == ord("[") and gap is None and begin == 0 and not any_yet:
                gap, any_yet = place + 1, True
                first = True
            elif level == 2:
                if gap is not None:
                    between = bytes(kept[gap - kept_at : place - kept_at]).strip(_BLANK)
                    if kind != ord("{") or between != (b"" if first else b","):
                        raise _refused(path, NOT_OBJECTS)
                    gap = None
                if place >= stop:
                    return
                opened = place
            elif level == 1 and opened is not None:
                yield bytes(kept[opened - kept_at : place + 1 - kept_at])
                opened, gap, first = None, place + 1, False
            elif level <= 0 and gap is not None:
                if bytes(kept[gap - kept_at : place - kept_at]).strip(_BLANK):
                    raise _refused(path, NOT_OBJECTS)
                if kind != ord("]") or bytes(kept[place + 1 - kept_at :]).strip(_BLANK):
                    raise _refused(path, NOT_A_LIST)
                if any(block.strip(_BLANK) for _, block in _blocks(handle, at + len(block), None)):
                    raise _refused(path, NOT_A_LIST)
                return
            elif level <= 0:
                # The list ended in a range that owns no member here.
                return
        if opened is None and gap is None and at + len(block) >= stop:
            return
        need = opened if opened is not None else gap if gap is not None else at + len(block)
        del kept[: need - kept_at]
        kept_at = need
    if opened is not None or gap is not None:
        raise _refused(path, TORN)


def read_members(spark: SparkSession, path: str | Sequence[str], split_bytes: int | None = None) -> DataFrame:
    """Members of JSON lists as (source_path, position, payload), ``position`` counted per file from 0.

    Ranges are of ``split_bytes`` (the session's ``spark.sql.files.maxPartitionBytes``); no row is
    shuffled to be numbered.  A file that is no list of objects, or is cut off, fails the job.
    """
    if split_bytes is None:
        split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    begins = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))
    ranges = files.select("path", F.col("_metadata.file_path").alias("source_path"), F.explode(begins).alias("begin"))

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                with open_in_task(r["path"]) as handle:
                    rows.append(r | _measure(handle, r["begin"], r["begin"] + split_bytes))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _MEASURED.split(", ")])

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open_in_task(r["path"]) as handle:
                    held, size, number = [], 0, r["first"]
                    for member in members_in(handle, r["path"], r["begin"], r["begin"] + split_bytes, r["inside"], r["depth"]):
                        held.append(member.decode("utf-8", "replace"))
                        size += len(member)
                        if size >= BLOCK_BYTES or len(held) == 10_000:
                            yield _batch(r["source_path"], number, held)
                            held, size, number = [], 0, number + len(held)
                    if held:
                        yield _batch(r["source_path"], number, held)

    entered = spread(ranges).mapInPandas(measured, _MEASURED).groupBy("path").applyInPandas(_placed, _PLACED)
    owners = spread(entered.where("n > 0 OR begin = 0"))
    return owners.mapInArrow(emitted, "source_path string, position bigint, payload string")


def _batch(path: str, first: int, members: list[str]) -> pa.RecordBatch:
    n = len(members)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(members, pa.string())],
        names=["source_path", "position", "payload"],
    )
