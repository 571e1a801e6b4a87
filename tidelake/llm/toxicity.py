"""Toxicity by noisy-channel deobfuscation: words written to slip past filters are decoded
by a Viterbi search over lattices of characters under a character language model learnt
from the corpus, and the restored text is scored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.rows import crc_fold, texts, written

# The alphabet of the character model (0 is a boundary, 1 any other letter),
# and what obfuscating signs may stand for.
ALPHABET = "abcdefghijklmnopqrstuvwxyzáàâäçéèêëíîïñóôöúùûüßœ"
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c",
}
BREAKS = "*._-~'\"`^,:;/\\=#"
#: Signs that may also stand in for any letter, where letters surround them.
MASKS = "*#%?_"

SYMBOLS = len(ALPHABET) + 2
#: Natural logs of the channel: a sign for a letter, a letter written more than twice, a break inside a word.
SIGN_COST, REPEAT_COST, BREAK_COST = -1.0, -0.7, -0.7
#: A sign that stands for nothing.
DROP_COST = -9.0
#: A masked letter, whichever it is.
MASK_COST = -2.0
#: Labelled rows that the classifier is fitted on, at most: those of least hash.
MAX_LABELLED = 20_000
#: Features are hashed to so many places, each with a weight; families of toxic rows that a weighed one needs.
SPACE, LEAST_FAMILIES = 1 << 20, 3

#: A longer token, and a spelt-out stretch, is decoded in windows of nearly twice this length, half of which
#: the next window shares.
LONGEST = 64
#: Log odds of any text where no label was learnt from.
NO_LABELS = -10.0

_EDGES = ".,;:!?\"'()[]{}<>«»„“”|-–—…*_`"
#: Single letters parted by blanks or by one sign.
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!])(?:(?: +|[.\-_*~'\"`^,:;/\\=#])(?:[^\W_]|[@$!])){2,}(?![^\s.,;:!?])")
_BLANKS = re.compile(" +")
_SEPARATED = re.compile(r"[^\w@$!|+]+")
#: A number, a price, a share; no letters are behind its signs.
_NUMBER = re.compile(r"[(<]?[+#$€£]?[\d\s.,:;/\\=~^'\"`-]*[%$€£+]?[!?.,;:]*[)>]?")
_THRICE = re.compile(r"([^\W\d_])\1\1")


def symbol_table() -> np.ndarray:
    """Symbol of every code point below 0x250; letters outside the alphabet are 1, the rest 0."""
    table = np.array([int(chr(c).isalpha()) for c in range(0x250)], np.int64)
    for number, letter in enumerate(ALPHABET):
        table[ord(letter)] = number + 2
    return table


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a lower-case text, with a boundary at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([[0, 0], table[np.minimum(points, len(table) - 1)], [0]])


def trigram_counts(rows: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all texts; SYMBOLS**3 numbers, however large the corpus."""
    table = symbol_table()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        waiting, size = [], 0
        for batch in batches:
            for text in batch["text"]:
                s = symbols_of(text.as_py().lower(), table)
                waiting.append((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:])
                size += len(s)
                if size > 2_000_000:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["code", "n"])

    summed = rows.select("text").mapInArrow(counted, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    dense = np.zeros(SYMBOLS**3, np.int64)
    for batch in summed.toArrow().to_batches():
        dense[batch["code"].to_numpy()] = batch["n"].to_numpy()
    return dense


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with P(c | b) and P(c)."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 20 * p2[None]) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p3)


def lattice(token: str, spelt: bool = False, parted: bool = False) -> list[list[tuple[str, float]]]:
    """For every character its readings (letters, log cost); an empty reading leaves it out.

    In a ``spelt`` stretch every second character is a break, which may also part two words; in a
    ``parted`` token every break may.
    """
    if spelt:
        breaks = [("", 0.0), (" ", 0.0)]
        return [breaks if at % 2 else lattice(c)[0] for at, c in enumerate(token)]
    columns: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(token):
        c, end = token[at], at + 1
        while end < len(token) and token[end] == c:
            end += 1
        run = end - at
        if c.isalpha():
            if run > 2:
                columns.append([(c, REPEAT_COST), (c * 2, REPEAT_COST), (c * run, 0.0)])
            elif run == 2:
                columns.append([(c * 2, 0.0), (c, 2 * REPEAT_COST)])
            else:
                columns.append([(c, 0.0)])
        elif c in SIGNS:
            readings = [(letter * count, SIGN_COST * count) for letter in SIGNS[c] for count in {1, min(run, 2)}]
            columns.append(readings + [("", DROP_COST)])
        elif c in BREAKS or c == " " or c in MASKS:
            readings = [("", BREAK_COST if c in BREAKS else DROP_COST)]
            if c in MASKS and run == 1 and 0 < at < len(token) - 1:
                readings += [(letter, MASK_COST) for letter in ALPHABET[:26]]
            if parted and c in BREAKS:
                readings.append((" ", 0.0))
            columns.append(readings)
        else:
            columns.append([("", DROP_COST)])
        at = end
    return columns


def decode(
    token: str, model: np.ndarray, table: np.ndarray, most: int = 3, spelt: bool = False, parted: bool = False
) -> tuple[str, ...]:
    """The likeliest letters behind a token, best first.

    Viterbi over the lattice; states are the last two symbols, and each keeps its ``most`` best
    paths, so that close readings (``1`` as i or l) all reach the score.
    """
    best: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    for column in lattice(token, spelt, parted):
        following: dict[tuple[int, int], dict[str, float]] = {}
        for (a, b), paths in best.items():
            for letters, cost in column:
                x, y, gained = a, b, cost
                for letter in letters:
                    z = int(table[min(ord(letter), len(table) - 1)])
                    gained += model[x, y, z]
                    x, y = y, z
                reached = following.setdefault((x, y), {})
                for score, text in paths:
                    reached[text + letters] = max(score + gained, reached.get(text + letters, -np.inf))
        best = {
            state: sorted(((score, text) for text, score in reached.items()), reverse=True)[:most]
            for state, reached in following.items()
        }
    ended: dict[str, float] = {}
    for (a, b), paths in best.items():
        for score, text in paths:
            ended[text] = max(score + model[a, b, 0], ended.get(text, -np.inf))
    return tuple(sorted((t for t in ended if t), key=lambda t: (-ended[t], t))[:most])


def coded(token: str) -> bool:
    """Whether a token without letters may be a word in signs: two different ones at least, and no number."""
    return len({c for c in token if c in SIGNS or c in MASKS}) > 1 and not _NUMBER.fullmatch(token)


@dataclass
class Restorer:
    """Restored words of texts; each distinct token is decoded once."""

    model: np.ndarray
    table: np.ndarray = field(default_factory=symbol_table)
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)
    most_known: int = 400_000

    def readings(self, token: str) -> tuple[str, ...]:
        """The token without punctuation at its ends if that leaves plain letters, else decoded."""
        for plain in (token, token.strip(_EDGES)):
            if plain.isalpha() and not _THRICE.search(plain):
                return (plain,)
        # Another token without letters is a number or a rule.
        if not any(c.isalpha() for c in token) and not coded(token):
            return ()
        if _SPACED.fullmatch(token):
            spelt = self.parted(_BLANKS.sub(" ", token), True)
            return spelt if len(token) > LONGEST else tuple(dict.fromkeys(self.whole(token) + spelt))
        if len(token) <= LONGEST:
            return self.whole(token)
        # The pieces between separators as tokens of their own, and the words that windows of the token hold.
        pieces = (word for part in _SEPARATED.split(token) if len(part) <= LONGEST for word in self.readings(part))
        return tuple(dict.fromkeys((*pieces, *self.parted(token, False))))

    def whole(self, token: str) -> tuple[str, ...]:
        """The likeliest readings of a token as one word."""
        most = 8 if any(c in MASKS for c in token[1:-1]) else 3
        return decode(token.strip(BREAKS + "?()[]{}\"«»„“”–—…").rstrip("!" + BREAKS), self.model, self.table, most)

    def parted(self, token: str, spelt: bool) -> tuple[str, ...]:
        """The words of a spelt-out stretch or a long token, by windows; a word that a window's end may cut is left to the next one."""
        found: dict[str, None] = {}
        for at in range(0, max(len(token) - LONGEST + 1, 1), LONGEST):
            window = token[at : at + 2 * LONGEST - 1]
            for text in decode(window, self.model, self.table, spelt=spelt, parted=not spelt):
                words = text.split()
                for number, word in enumerate(words):
                    cut = (at and number == 0) or (at + len(window) < len(token) and number == len(words) - 1)
                    if not cut or len(word) >= LONGEST // 2:
                        found[word] = None
        return tuple(found)

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a whole text, spelt-out words joined, and parted where the model says so."""
        lowered = text.lower()
        found = set(lowered.split())
        found.update(m.group() for m in _SPACED.finditer(lowered))
        known, out = self.known, set()
        for token in found:
            words = known.get(token)
            if words is None:
                words = self.readings(token)
                if len(known) >= self.most_known:
                    known.clear()
                known[token] = words
            out.update(words)
        return out


def features(word: str) -> list[int]:
    """The word itself, and its beginnings of four to six letters, as places in a fixed space."""
    named = (f"={word}", *(f"^{word[:n]}" for n in range(4, min(len(word), 6) + 1)))
    return [zlib.crc32(name.encode("utf-8", "surrogatepass")) % SPACE for name in named]


def family(words: set[str]) -> int:
    """Nearly equal texts mostly share it: the two least hashes of their long words."""
    long = sorted({zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words if len(w) >= 8})
    least = long[:2] if len(long) >= 2 else sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)
    return zlib.crc32(repr(least).encode())


@dataclass
class ToxicityModel:
    """Character model and weights; its size is bounded by SYMBOLS and SPACE."""

    model: np.ndarray
    weights: dict[int, float]
    bias: float


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """Learn from the rows outside fold 0 (crc32 of the id modulo ``folds``).

    The character model counts every such text, labelled or not.  The classifier is fitted on the
    ``max_labelled`` labelled rows of least hash: hashed features form sparse rows, are counted on the
    cluster, and the regression is solved over those that are at least twice as common among
    toxic rows and stand in three families of them.  Equal texts, and families of nearly equal
    ones, count once, so a group of copies teaches no more than one row.

    * Rows without an id have no fold and are not learnt from; of labels that repeat an id, the
      largest counts, and null labels none.
    * Without labels every text scores alike, close to 0.
    """
    rows = texts(docs, id_col, text_col).withColumn("fold", crc_fold(F.col("id"), folds))
    learnt = rows.where(F.col("fold") != 0)
    model = log_model(trigram_counts(learnt))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("y").isNotNull()).groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("sig", F.lit(11))
    sample = (
        learnt.select("id", "sig").join(marks, "id").groupBy("sig").agg(F.min("id").alias("id"), F.max("y").alias("y"))
        .orderBy(order, "sig").limit(max_labelled)
    )
    sample = written(sample, "labelled")
    labelled = learnt.join(F.broadcast(sample), ["id", "sig"], "left_semi").join(F.broadcast(sample.select("sig", "y")), "sig").select("text", "y")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            xs, families = [], []
            for text in batch["text"]:
                words = restorer.words(text.as_py())
                xs.append(sorted({f for word in words for f in features(word)}))
                families.append(family(words))
            arrays = [batch["y"], pa.array(families, pa.int64()), pa.array(xs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["y", "family", "x"])

    found = labelled.select("text", F.col("y").cast("int").alias("y")).mapInArrow(sparse, "y int, family bigint, x array<int>")
    families = found.groupBy("family", "y").agg(F.min("x").alias("x")).persist()
    try:
        useful = useful_features(families)

        def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                xs = [x[useful[x]] for x in (np.asarray(x or [], np.int64) for x in batch["x"].to_pylist())]
                yield pa.RecordBatch.from_arrays([batch["y"], batch["family"], pa.array(xs, pa.list_(pa.int32()))], names=["y", "family", "x"])

        kept = families.select("y", "family", "x").mapInArrow(thinned, "y int, family bigint, x array<int>").toArrow()
    finally:
        families.unpersist()
    kept = kept.sort_by([("family", "ascending"), ("y", "ascending")]).combine_chunks()
    if not kept.num_rows:
        return ToxicityModel(model, {}, NO_LABELS)
    x = kept["x"].combine_chunks()
    row = np.repeat(np.arange(kept.num_rows), np.diff(x.offsets.to_numpy()))
    weights, bias = solve(x.flatten().to_numpy(), row, kept["y"].to_numpy() == 1, SPACE)
    return ToxicityModel(model, {int(i): float(weights[i]) for i in np.flatnonzero(weights)}, bias)


def useful_features(families: DataFrame) -> np.ndarray:
    """Whether each feature is at least twice as common among toxic rows, and not rare there; counted on the cluster."""
    totals = families.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")).first()
    each = families.select("y", F.explode("x").alias("f")).groupBy("f").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    ).where(F.col("pos") >= LEAST_FAMILIES).toArrow()
    pos, neg = np.zeros(SPACE), np.zeros(SPACE)
    pos[each["f"].to_numpy()], neg[each["f"].to_numpy()] = each["pos"].to_numpy(), each["neg"].to_numpy()
    return (pos >= LEAST_FAMILIES) & ((pos + 0.5) / (totals["pos"] + 1) >= 2 * (neg + 0.5) / (totals["neg"] + 1))


def solve(flat: np.ndarray, row: np.ndarray, toxic: np.ndarray, size: int, rounds: int = 300, ridge: float = 0.02):
    """Weights and bias of a logistic regression: feature ``flat[i]`` is present in row ``row[i]``.

    Full-batch descent with momentum.  Each weight has its own pace, as the curvature of a
    feature is at most a quarter of its count.
    """
    rows = len(toxic)
    counts = np.bincount(flat, minlength=size)
    weights, bias = np.zeros(size), float(np.log((toxic.sum() + 0.5) / ((~toxic).sum() + 0.5)))
    step, speed = np.zeros(size), 0.0
    for _ in range(rounds):
        margin = np.bincount(row, weights[flat], minlength=rows) + bias
        slope = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - toxic
        gradient = np.bincount(flat, slope[row], minlength=size) + ridge * rows / 1000 * weights
        step = 0.8 * step - gradient / (counts + 1) * 0.4
        weights = weights + step
        speed = 0.8 * speed - slope.mean()
        bias += speed
    return weights, bias


def toxicity_score(spark: SparkSession, fitted: ToxicityModel) -> Callable[[Column], Column]:
    """A column function: text to the chance that it is toxic.  Rows stay where they are."""
    shared = spark.sparkContext.broadcast((fitted.model, fitted.weights, fitted.bias))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, weights, bias = shared.value
        restorer = Restorer(model)
        found: dict[str, tuple[str, ...]] = {}  # word -> its features that carry weight
        for batch in batches:
            scores = []
            for text in batch:
                mine: set[str] = set()
                for word in restorer.words(text.as_py() or ""):
                    active = found.get(word)
                    if active is None:
                        if len(found) > 400_000:
                            found.clear()
                        active = found[word] = tuple(f for f in features(word) if f in weights)
                    if active:
                        mine.update(active)
                margin = bias + sum(weights[f] for f in sorted(mine))
                scores.append(float(1 / (1 + np.exp(-np.clip(margin, -40, 40)))))
            yield pa.array(scores, pa.float64())

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Declared non-deterministic so that a filter on the score never evaluates it again.
    return F.arrow_udf(scored, "double").asNondeterministic()


def score_toxicity(
    docs: DataFrame,
    fitted: ToxicityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, sig, score): the chance that a row is toxic, from its restored words alone.

    * A null or empty text has the score of no evidence.
    * Rows without an id, and rows that repeat one, are scored one by one.
    * An empty table gives an empty table; further columns are not read.
    """
    score = toxicity_score(docs.sparkSession, fitted)
    return texts(docs, id_col, text_col).select("id", "sig", score(F.col("text")).alias("score"))


def without_toxic(
    docs: DataFrame, fitted: ToxicityModel, text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The rows, all columns unchanged, whose score is below the threshold."""
    score = toxicity_score(docs.sparkSession, fitted)
    return docs.withColumn("__score", score(F.col(text_col))).where(F.col("__score") < threshold).drop("__score")
