"""Removal of word windows that also start earlier in the corpus.

Every window of ``width`` words gets two Rabin-Karp hashes.  Documents are gathered in groups of a
few megabytes; a group folds its own repeats and deals one entry for each different window to
buckets, which count the entries of all groups.  Windows that start earlier elsewhere come back as
flags, and a document's late windows merge into maximal intervals of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import texts

WIDTH = 20
#: Text that a group of documents holds on average, and windows that a bucket holds on average.
GROUP_BYTES, BUCKET_WINDOWS = 5_000_000, 250_000
#: Bytes of text that a word takes about, with the blank behind it; it only sets the number of buckets.
WORD_BYTES = 6

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hashes, modulo 2**64, of all stretches of ``width`` values: doubled from 1, 2, 4, ... values."""
    found, done, part, size = None, 0, words, 1
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    left = width
    while left:
        if left & 1:
            piece = part[done : done + n]
            found = piece.copy() if found is None else found + piece * _U(pow(base, done, 2**64))
            done += size
        left >>= 1
        if left:
            part = part[: len(part) - size] + part[size:] * _U(pow(base, size, 2**64))
            size *= 2
    # The low bits of such a sum hardly depend on the order of the words.
    found ^= found >> _U(29)
    found *= _U(0xBF58476D1CE4E5B9)
    return found ^ (found >> _U(32))


def planes(values: np.ndarray) -> bytes:
    """The bytes of 64-bit numbers, all first ones first: what hardly changes compresses to nothing."""
    return pa.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def from_planes(packed: bytes, count: int) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=8 * count, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, count).T).view("<u8").ravel()


class Group:
    """The documents of a group, their words and windows.

    Windows of one hash are a class.  ``class_id`` is the smallest id that holds it, ``late`` marks
    the windows that start earlier within the group.
    """

    def __init__(self, docs: pa.Table, width: int):
        docs = docs.sort_by([("id", "ascending"), ("sig", "ascending")])
        ids, sigs = docs["id"].combine_chunks(), docs["sig"].to_numpy()
        known = np.asarray(ids.is_valid())
        numbers = ids.fill_null(0).to_numpy()
        # Equal rows are one document with several results.
        new = np.r_[True, (numbers[1:] != numbers[:-1]) | (sigs[1:] != sigs[:-1]) | (known[1:] != known[:-1])]
        rows = np.flatnonzero(new)
        self.copies = np.diff(np.append(rows, len(new)))
        self.ids, self.sigs, self.known = numbers[rows], sigs[rows], known[rows]
        data = docs["data"].combine_chunks()
        self.words = [data[int(r)].as_buffer().to_pybytes().split() for r in rows]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.counts)
        coded = pa.array([w for words in self.words for w in words], pa.binary()).dictionary_encode()
        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()), "<u8").reshape(-1, 2)
        codes = coded.indices.to_numpy()
        owner = np.repeat(np.arange(len(rows)), self.counts)
        hashes = [window_hashes(both[codes, k], width, _BASES[k]) for k in (0, 1)]
        start = np.flatnonzero(np.arange(len(hashes[0])) + width <= self.ends[owner[: len(hashes[0])]])
        owner = owner[start]
        deal, print_ = hashes[0][start], hashes[1][start]
        lone = ~self.known[owner]
        if lone.any():  # a row without an id meets nothing but itself
            print_ = np.where(lone, print_ ^ (self.sigs[owner].view(_U) | _U(1)), print_)
        order = np.argsort(print_)
        same = print_[order[1:]] == print_[order[:-1]]
        often = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        part = order[often]
        order[often] = part[np.lexsort((part, deal[part], print_[part]))]
        p, d, who = print_[order], deal[order], owner[order]
        first = np.r_[True, (p[1:] != p[:-1]) | (d[1:] != d[:-1])] if len(p) else np.zeros(0, bool)
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(p)))
        # Documents stand in order of their ids, windows in order of their place.
        self.class_id = self.ids[who[heads]]
        again = ~first & (who == np.r_[-1, who[:-1]])[: len(who)]
        late = again | (self.ids[who] > np.repeat(self.class_id, sizes))
        self.order, self.sizes, self.start, self.late = order, sizes, start, late
        self.print, self.deal = p[heads], d[heads]
        self.sent = self.known[who[heads]]

    def buckets(self, count: int) -> dict[int, np.ndarray]:
        """Numbers of the classes that go to each bucket, in the order of their hashes."""
        chosen = np.flatnonzero(self.sent)
        bucket = ((self.deal[chosen] >> _U(32)) * _U(count) >> _U(32)).astype(np.uint16 if count <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        values, starts = np.unique(bucket[order], return_index=True)
        return dict(zip(values.tolist(), np.split(chosen[order], starts[1:]), strict=True)) if len(chosen) else {}

    def removed(self, elsewhere: np.ndarray, width: int) -> np.ndarray:
        """Whether each word lies in a window that starts earlier; ``elsewhere`` tells of each class."""
        late = self.late | np.repeat(elsewhere, self.sizes)
        starts = np.zeros(int(self.ends[-1]) + 1 if len(self.ends) else 1, np.int32)
        starts[self.start[self.order[late]]] = 1
        seen = np.cumsum(starts[:-1])
        seen[width:] -= seen[:-width].copy()
        return seen > 0


_ENTRY = pa.schema([("bucket", pa.int64()), ("g", pa.int64()), ("n", pa.int32()), ("prints", pa.binary()), ("ids", pa.binary())])
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_DONE = pa.schema([("id", pa.int64()), ("sig", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS), ("kept", pa.binary())])


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, sig, n_words, spans, kept): each document without the words that earlier windows hold.

    Words are what ASCII blanks part.  A word goes if a window of ``width`` consecutive words that covers
    it also starts earlier: in a document with a smaller id, or in the same one further in front.
    Windows are judged on the input and never cross documents.  ``spans`` are the maximal intervals
    (begin, end) of removed words, ``kept`` (UTF-8) the other words, joined by one space.

    * A null text has no words; a text of fewer than ``width`` words keeps them all.
    * A row without an id loses only what it repeats itself, and others lose nothing to it.
    * Rows that repeat an id take nothing from one another; each has its own result.
    * An empty table gives an empty table; further columns are not read.

    Two windows are taken for the same if 64 bits of one hash and the bucket, which follows from
    another, agree.  The number of buckets grows with the input, and the bits compared with it:
    a pair of different windows is taken for the same with a chance of one in 2**64 times the buckets.

    A window reaches a bucket at most once from each group, so neither a group of copies nor a
    passage that all documents share fills a bucket.  A window costs about ten bytes of shuffle; where
    a group has less than a few windows for a bucket, it is the cost of a row each.
    """
    rows = texts(docs, id_col, text_col).select(F.col("id").cast("bigint").alias("id"), "sig", F.col("text").cast("binary").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    count = max(1, -(-total // (WORD_BYTES * BUCKET_WINDOWS)))
    dealt = rows.withColumn("g", F.pmod(F.xxhash64(F.coalesce("id", "sig")), F.lit(groups)))

    def entries(docs: pa.Table) -> pa.Table:
        group, g = Group(docs, width), docs["g"][0].as_py()
        out = [
            (bucket, g, len(mine), planes(np.diff(group.print[mine], prepend=_U(0))), planes(group.class_id[mine]))
            for bucket, mine in group.buckets(count).items()
        ]
        columns = zip(*out, strict=True) if out else [[]] * len(_ENTRY)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)

    def counted(bucket: pa.Table) -> pa.Table:
        counts = bucket["n"].to_pylist()
        prints = np.concatenate([np.cumsum(from_planes(p, n), dtype=_U) for p, n in zip(bucket["prints"].to_pylist(), counts, strict=True)])
        ids = np.concatenate([from_planes(p, n) for p, n in zip(bucket["ids"].to_pylist(), counts, strict=True)]).view(np.int64)
        order = np.argsort(prints)
        p = prints[order]
        heads = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        first = np.minimum.reduceat(ids[order], heads)
        late = np.zeros(len(p), bool)
        late[order] = ids[order] > np.repeat(first, np.diff(np.append(heads, len(p))))
        cuts = np.cumsum([0, *counts])
        told = [k for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if late[a:b].any()]
        answers = [np.packbits(late[cuts[k] : cuts[k + 1]]).tobytes() for k in told]
        return bucket.select(["g", "bucket"]).take(pa.array(told, pa.int64())).append_column("late", pa.array(answers, pa.binary()))

    def settled(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _DONE.empty_table()
        group = Group(docs, width)
        of, elsewhere = group.buckets(count), np.zeros(len(group.sizes), bool)
        for bucket, late in zip(answers["bucket"].to_pylist(), answers["late"].to_pylist(), strict=True):
            mine = of[bucket]
            elsewhere[mine] = np.unpackbits(np.frombuffer(late, np.uint8), count=len(mine)).astype(bool)
        gone = group.removed(elsewhere, width)
        out: dict[str, list] = {name: [] for name in _DONE.names}
        for d, words in enumerate(group.words):
            mine = gone[group.ends[d] - group.counts[d] : group.ends[d]]
            edges = np.flatnonzero(np.diff(np.r_[False, mine, False])).tolist()
            spans = [{"begin": b, "end": e} for b, e in zip(edges[::2], edges[1::2], strict=True)]
            stays = zip([0, *edges[1::2]], [*edges[::2], len(words)], strict=True)
            kept = b" ".join([w for b, e in stays for w in words[b:e]] if spans else words)
            values = (int(group.ids[d]) if group.known[d] else None, int(group.sigs[d]), len(words), spans, kept)
            for name, value in zip(out, values, strict=True):
                out[name] += [value] * int(group.copies[d])
        return pa.table(out, schema=_DONE)

    by_group = dealt.groupBy("g")
    sent = by_group.applyInArrow(entries, "bucket bigint, g bigint, n int, prints binary, ids binary")
    answers = sent.groupBy("bucket").applyInArrow(counted, "g bigint, bucket bigint, late binary")
    schema = "id bigint, sig bigint, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"
    return by_group.cogroup(answers.groupBy("g")).applyInArrow(settled, schema)
