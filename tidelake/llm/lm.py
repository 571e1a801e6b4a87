"""Language-model scores: a gated recurrent network with a class-factored softmax, and corpus counts for rare words.

P(word | before) = P(class | before) P(word | class, before).  The state of the network, which runs
through a whole document, gives the first factor and, among the commonest words of a class and the
rest of it as one, the second.  Within the rest, counts over all training texts decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm import gru
from tidelake.llm.rows import crc_fold, texts, written
from tidelake.llm.suffix_dedup import dealt_by, hashes_of, packed, prefix_hashes, unpacked

#: Classes of words, and the commonest words of each that the network tells apart.
CLASSES, SLOTS = 48, 40
#: Such a word makes up at least one in so many words, so few reach the driver.
RAREST = 100_000
#: Text that one group of documents holds on average.
GROUP_BYTES = 8_000_000
#: Rounds of training, and the share of the training documents that each takes: another one each time, together all.
ROUNDS = 2
TRAIN_SHARE = 1 / ROUNDS
#: Tokens after which a long document's state starts anew in training, so that lanes end together; scoring carries it on.
PIECE = 4096
ADDED = 0.1  # to every count, fixed
#: Bytes of short texts that are cut into words at once.
TOGETHER = 1 << 16

_SPACE = np.full(1, 0x20, np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Code of the end of a text; other codes are the first two bytes of a word.
END = 1 << 16


def tokens_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, code, place of its first byte) of each word in order, A-Z lowered.  ``code`` is the word's first two bytes, folded into the hash."""
    low = _LOWER[data]
    word = ~_BLANK[low]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), starts
    sums = prefix_hashes(low)
    hashes = hashes_of(sums, starts, ends - starts)
    second = np.where(ends - starts > 1, low[np.minimum(starts + 1, len(low) - 1)], 0).astype(np.int32)
    codes = low[starts].astype(np.int32) * 256 + second
    return hashes ^ (codes.astype(np.uint64) << np.uint64(47)), codes, starts


@dataclass
class Tokens:
    """The tokens of a group of documents, each text closed by an end."""

    hashes: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(texts: list[np.ndarray]) -> Tokens:
        parts, counts, first = [], [], 0
        # Short texts are taken together, a blank after each: the calls cost more than their bytes.
        ends = np.cumsum([len(t) + 1 for t in texts])
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, side="right")))
            some = texts[first:last]
            hashes, codes, starts = tokens_of(np.concatenate([x for t in some for x in (t, _SPACE)]))
            cuts = np.cumsum([len(t) + 1 for t in some])
            parts.append((hashes, codes))
            counts.append(np.diff(np.searchsorted(starts, cuts), prepend=0))
            first = last
        words = np.concatenate(counts or [np.zeros(0, np.int64)])
        offsets = np.concatenate([[0], np.cumsum(words + 1)])
        hashes, codes = np.full(offsets[-1], END << 47, np.uint64), np.full(offsets[-1], END, np.int32)
        word = np.ones(offsets[-1], bool)
        word[offsets[1:] - 1] = False
        if parts:
            hashes[word], codes[word] = (np.concatenate(column) for column in zip(*parts, strict=True))
        return Tokens(hashes, codes, offsets)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, code, which): distinct words in order of their hash, and the word of every token."""
        order = np.argsort(self.hashes)
        h, c = self.hashes[order], self.codes[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
        which = np.empty(len(h), np.int32)
        which[order] = np.cumsum(new) - 1
        return h[new], c[new], which


def _raw(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint8) for t in column]


@dataclass
class Shares:
    """Class of every code, the commonest words of each class, and the training tokens and distinct words of the others.

    ``common`` are the hashes of the commonest words in order, ``slot`` the place of each in its class;
    ``log_share`` and ``slot_share`` are the shares that the network starts from.
    """

    class_of: np.ndarray
    common: np.ndarray
    slot: np.ndarray
    rest_tokens: np.ndarray
    rest_words: np.ndarray
    log_share: np.ndarray
    slot_share: np.ndarray
    tokens: float
    words: float

    @staticmethod
    def of(stats: pa.Table, often: pa.Table, classes: int, slots: int) -> Shares:
        """The commonest codes are classes of their own; the others share one, and the end has its own."""
        codes, n, v = (stats[name].to_numpy() for name in ("code", "n", "v"))
        words = codes != END
        top = codes[words][np.lexsort((codes[words], -n[words]))][: classes - 2]
        class_of = np.full(END + 1, classes - 2)
        class_of[top] = np.arange(len(top))
        class_of[END] = classes - 1
        tokens, distinct = np.bincount(class_of[codes], n, classes), np.bincount(class_of[codes], v, classes)
        hashes, code, count = often["hash"].to_numpy().view(np.uint64), often["code"].to_numpy(), often["n"].to_numpy()
        kind = class_of[code]
        order = np.lexsort((hashes, -count, kind))
        order = order[code[order] != END]
        first = np.searchsorted(kind[order], np.arange(classes))
        slot = np.arange(len(order)) - first[kind[order]]
        order, slot = order[slot < slots], slot[slot < slots]
        held = np.zeros((classes, slots + 1))
        held[kind[order], slot] = count[order]
        held[:, slots] = tokens - held.sum(axis=1)
        share = np.where(held > 0, np.log((held + 1) / (held.sum(axis=1, keepdims=True) + slots + 1)), gru.NEVER)
        share[:, slots] = np.log((held[:, slots] + 1) / (held.sum(axis=1) + slots + 1))
        by_hash = np.argsort(hashes[order])
        total = tokens + 1.0
        return Shares(
            class_of, hashes[order][by_hash], slot[by_hash], held[:, slots], distinct - (held[:, :slots] > 0).sum(axis=1),
            np.log(total / total.sum()), share, float(tokens.sum()), float(distinct.sum()),
        )

    def slots_of(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each word in its class; the last one is that of the rest."""
        rest = self.slot_share.shape[1] - 1
        if not len(self.common):
            return np.full(len(hashes), rest)
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        return np.where(self.common[at] == hashes, self.slot[at], rest)


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    classes: int = CLASSES,
    slots: int = SLOTS,
    train_share: float = TRAIN_SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, sig, n_tokens, n_known, train_tokens, base_score, score): log10 probability of every text.

    Learns from the rows outside fold 0 (crc32 of the id modulo ``folds``).  Documents are grouped by
    a hash of id and text; a group folds its words first and sends them to buckets by hash, where
    the counts of all training texts meet and go back to the groups that asked.  The network is
    trained on every training document: each round takes ``train_share`` of them, another share each time, told
    apart by id and text, and rounds too few for all are refused.  In a round every ``GROUP_BYTES`` of an input
    split's share start from the same weights, and the weights they reach are averaged by their tokens.  Of each class the ``slots`` commonest words
    have outputs of their own; a word unseen in training is of the rest, with a count of ``ADDED``.

    * A null or empty text is its end alone.
    * A row without an id is scored but never learnt from; rows that repeat an id are scored one by one.
    * Without training rows all classes are equally likely.
    * An empty table gives an empty table; further columns are not read.
    """
    rows = texts(docs, id_col, text_col).withColumn("fold", crc_fold(F.col("id"), folds))
    rows = rows.select("id", "sig", F.col("text").cast("binary").alias("data"), F.coalesce(F.col("fold") != 0, F.lit(False)).alias("learn"))
    id_type = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    buckets = max(1, groups // 2)
    dealt = rows.withColumn("g", F.pmod(F.xxhash64("id", "sig"), F.lit(groups)).cast("int"))

    def parted(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets

    def sent(docs: pa.Table) -> pa.Table:
        found = Tokens.of(_raw(docs["data"]))
        hashes, codes, which = found.distinct()
        learn = np.repeat(docs["learn"].to_numpy(), np.diff(found.offsets))
        counts = np.bincount(which[learn], minlength=len(hashes)).astype(np.int64)
        out = {name: [] for name in word_schema.names}
        for bucket, mine in dealt_by(parted(hashes)).items():
            values = (bucket, docs["g"][0].as_py(), len(mine), packed(hashes[mine]), packed(codes[mine]), packed(counts[mine]))
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.table(out, schema=word_schema)

    word_schema = pa.schema(
        [("bucket", pa.int32()), ("g", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
    )

    def summed(bucket: pa.Table) -> pa.Table:
        sizes = bucket["n"].to_pylist()
        hashes, codes, counts = (
            unpacked(bucket[name], sizes, kind) for name, kind in (("hashes", np.uint64), ("codes", np.int32), ("counts", np.int64))
        )
        order = np.argsort(hashes)
        h, c = hashes[order], codes[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        sums = np.add.reduceat(counts[order], first)
        known = np.empty(len(hashes), np.int64)
        known[order] = np.repeat(sums, np.diff(np.append(first, len(h))))
        seen = sums > 0
        code, where = np.unique(c[first][seen], return_inverse=True)
        n = np.bincount(where, sums[seen], len(code)).astype(np.int64)
        v = np.bincount(where, minlength=len(code)).astype(np.int64)
        cuts = np.cumsum([0, *sizes])
        answers = [packed(known[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        common = sums >= often
        # Answers to the groups, counts by code, and common words: rows of three kinds.
        kinds = (
            {"g": bucket["g"].to_pylist(), "bucket": bucket["bucket"].to_pylist(), "counts": answers},
            {"code": code.tolist(), "n": n.tolist(), "v": v.tolist()},
            {"hash": h[first][common].view(np.int64).tolist(), "code": c[first][common].tolist(), "n": sums[common].tolist()},
        )
        columns = {f.name: [x for k in kinds for x in k.get(f.name, [None] * len(next(iter(k.values()))))] for f in answer_schema}
        return pa.table(columns, schema=answer_schema)

    answer_schema = pa.schema(
        [
            ("g", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()),
            ("code", pa.int64()), ("n", pa.int64()), ("v", pa.int64()), ("hash", pa.int64()),
        ]
    )
    often = max(1, total // (6 * RAREST))

    words = dealt.groupBy("g").applyInArrow(sent, "bucket int, g int, n int, hashes binary, codes binary, counts binary")
    answer = "g int, bucket int, counts binary, code bigint, n bigint, v bigint, hash bigint"
    told = written(words.groupBy("bucket").applyInArrow(summed, answer), "words")
    stats = told.where(F.col("v").isNotNull()).groupBy("code").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    common = told.where(F.col("hash").isNotNull()).select("hash", "code", "n")
    shares = Shares.of(stats.toArrow(), common.toArrow(), classes, slots)  # at most 65,537 rows, and some 100,000
    weights = trained(rows.where("learn"), shares, train_share, rounds)
    shared = rows.sparkSession.sparkContext.broadcast((shares, weights))

    def scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return result_schema.empty_table()
        known, model = shared.value
        found = Tokens.of(_raw(docs["data"]))
        hashes, codes, which = found.distinct()
        of, counts = dealt_by(parted(hashes)), np.zeros(len(hashes), np.int64)
        for answer in answers.to_pylist():
            mine = of[answer["bucket"]]
            counts[mine] = np.frombuffer(pa.decompress(answer["counts"], decompressed_size=8 * len(mine), codec="zstd", asbytes=True), np.int64)
        kind, slot = known.class_of[codes], known.slots_of(hashes)
        base = np.log10((counts + ADDED) / (known.tokens + ADDED * (known.words + 1)))
        inside = np.log10((counts + ADDED) / (known.rest_tokens[kind] + ADDED * (known.rest_words[kind] + 1)))
        inside[(codes == END) | (slot < slots)] = 0.0  # the end's class holds nothing else
        modelled = gru.score(model, kind[which], found.offsets, slots=slot[which]) / np.log(10)
        at = found.offsets[:-1]
        columns = {
            "id": docs["id"],
            "sig": docs["sig"],
            "n_tokens": np.diff(found.offsets),
            "n_known": np.add.reduceat((counts[which] > 0).astype(np.int64), at),
            "train_tokens": np.full(docs.num_rows, int(known.tokens)),
            "base_score": np.add.reduceat(base[which], at),
            "score": np.add.reduceat(inside[which] + modelled, at),
        }
        return pa.table(columns, schema=result_schema)

    numbers = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    result_schema = pa.schema([("id", _arrow_type(rows)), ("sig", pa.int64()), *numbers])
    replies = told.where(F.col("g").isNotNull()).select("g", "bucket", "counts")
    result = f"id {id_type}, sig bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return dealt.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(scored, result)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)


def pieces_of(offsets: np.ndarray, most: int = PIECE) -> np.ndarray:
    """Offsets of the documents and, inside longer ones, of every ``most`` tokens."""
    parts = [np.arange(a, b, most) if b - a > most else [a] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.concatenate([*parts, offsets[-1:]]).astype(np.int64)


def trained(rows: DataFrame, shares: Shares, share: float, rounds: int) -> gru.Weights:
    """Weights after some rounds of training on every input split and averaging, weighted by tokens.

    Each round takes another share of the rows; every row moves the weights.

    What returns is one row for each weight and split, folded on the way; its number on the driver is that
    of the weights.
    """
    spark = rows.sparkSession
    weights = gru.initial(len(shares.log_share), shares.log_share, slot_share=shares.slot_share)
    names = list(weights)
    parts = max(1, round(1 / share))
    if parts > rounds:
        raise ValueError(f"{rounds} rounds of 1/{parts} of the training documents leave some out")
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((shares, weights))

        def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, start = shared.value

            def after(texts: list[np.ndarray]) -> pa.RecordBatch:
                found = Tokens.of(texts)
                moved = gru.train(start, known.class_of[found.codes], pieces_of(found.offsets), slots=known.slots_of(found.hashes))
                flat = np.concatenate([moved[name].ravel() for name in names]).astype(np.float64)
                size = float(len(found.codes))
                columns = [np.arange(len(flat)), flat * size, np.full(len(flat), size)]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "w", "n"])

            held, size = [], 0
            for batch in batches:
                for text in _raw(batch["data"]):
                    held.append(text)
                    size += len(text)
                    if size >= GROUP_BYTES:
                        yield after(held)
                        held, size = [], 0
            if held:
                yield after(held)

        chosen = rows.where(F.pmod(F.xxhash64("id", "sig", F.lit(3)), F.lit(parts)) == turn % parts).select("data")
        folded = chosen.mapInArrow(fitted, "i bigint, w double, n double").groupBy("i")
        means = folded.agg((F.sum("w") / F.sum("n")).alias("w")).toArrow().sort_by("i")["w"].to_numpy()
        if len(means):
            cuts = np.cumsum([0, *(weights[name].size for name in names)])
            weights = {
                name: means[a:b].reshape(weights[name].shape).astype(np.float32)
                for name, a, b in zip(names, cuts[:-1], cuts[1:], strict=True)
            }
    return weights
