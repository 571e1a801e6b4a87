"""Information-theoretic sanitisation of personal data, in DataFrame and SQL functions only.

Patterns find the protected entities.  Words that the corpus mostly shows beside one
entity give it away even where the entity itself is masked; co-occurrence counts over
the whole corpus measure how much, and such words are generalised or removed too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import texts, written

#: Kinds of base spans in their listed order; the method's own kind comes last.
KINDS = ("email", "ip", "card", "phone", "term")

# Fixed patterns of the contract.  Possessive repetition and the look-behind leave the
# matches as they are (what follows a repetition is never one of its characters, and a
# match starts at the start of its run or where the last match ended), but keep the
# search linear and free of recursion on very long runs.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_IN_RANGE = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"

_WORD_GAP = r"[^\p{L}]+"
#: Context is sought in slices of 16 code points a word, made so many times as long until there is enough.
SLICES = (1, 8, 64)
_ONE_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(_IP_IN_RANGE)
    if kind == "card":
        digits = _digits(hit)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _keeps(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["value"])


def _is_kind(number: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == number


def located(text: Column, pattern: Column, kind: int) -> Column:
    """All matches with their places in code points, leftmost first and not overlapping.

    The pieces between matches and the matches alternate, so their lengths add up to the places.
    """
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast(f"array<{_ONE_SPAN}>").alias("spans"))

    def step(done: Column, one: Column) -> Column:
        begin = done["at"] + one["gap"]
        end = begin + F.length(one["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), one["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.aggregate(steps, start, step)["spans"]


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, end, value) of the four base kinds."""
    none = F.expr("array()").cast(f"array<{_ONE_SPAN}>")
    # A cheap look for a character that every match has spares most texts the search.
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
    found = []
    for number, kind in enumerate(KINDS[:4]):
        spans = located(text, F.lit(patterns[kind]), number)
        good = F.filter(spans, _keeps(kind))
        found.append(F.when(gates[kind], good).otherwise(none))
    return F.array_sort(F.concat(*found))


def _context_words(text: Column, span: Column, words: int) -> Column:
    """The nearest words on both sides of a span, within its line; a word that a slice may have cut is left out.

    Slices of the text grow until they hold enough whole words or the line's end.
    """

    def side(reach: int, ahead: bool) -> tuple[Column, Column]:
        """The whole words of a slice, nearest first, and whether there can be no more, or need not."""
        if ahead:
            piece = F.substr(text, span["end"] + 1, F.lit(reach))
            line, short = F.substring_index(piece, "\n", 1), F.length(piece) < reach
        else:
            piece = F.substr(text, F.greatest(span["start"] - reach + 1, F.lit(1)), F.least(span["start"], F.lit(reach)))
            line, short = F.substring_index(piece, "\n", -1), span["start"] <= reach
        parts = F.split(F.lower(line), _WORD_GAP)
        parts = parts if ahead else F.reverse(parts)
        whole = short | (F.length(line) < F.length(piece))
        inside = F.when(whole, parts).otherwise(F.slice(parts, F.lit(1), F.size(parts) - 1))
        found = F.filter(inside, lambda w: w != "")
        return F.slice(found, F.lit(1), F.lit(words)), whole | (F.size(found) >= words)

    def nearest(ahead: bool) -> Column:
        slices = [side(16 * words * grown, ahead) for grown in SLICES]
        chosen = slices[-1][0]
        for found, enough in reversed(slices[:-1]):
            chosen = F.when(enough, found).otherwise(chosen)
        return chosen

    return F.concat(F.reverse(nearest(False)), nearest(True))


def _sieve(terms: DataFrame, bits: int = 20) -> Column:
    """2**bits bits as an array of longs, set at the hashes of the terms: 128 KB, however many terms there are."""
    slot = F.pmod(F.xxhash64("term"), F.lit(1 << bits))
    words = terms.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))).alias("mask")
    )
    dense = [0] * (1 << (bits - 6))
    for row in words.collect():  # at most 2**(bits - 6) rows
        dense[row["word"]] = row["mask"]
    # One text literal; the optimizer folds the split into a constant array.
    return F.split(F.lit(",".join(map(str, dense))), ",").cast("array<bigint>")


def _passes(term: Column, sieve: Column, bits: int = 20) -> Column:
    slot = F.pmod(F.xxhash64(term), F.lit(1 << bits))
    word = F.element_at(sieve, F.shiftright(slot, 6).cast("int") + 1)
    return F.getbit(word, (slot % 64).cast("int")) == 1


def disclosing_terms(
    rows: DataFrame,
    min_contexts: int = 3,
    min_confidence: float = 0.5,
    min_share: float = 0.5,
    min_letters: int = 3,
    words: int = 5,
) -> DataFrame:
    """(term, confidence, information): words that give a protected entity away.

    ``rows`` holds (text, spans).  A word discloses an entity when

    * it stands within ``words`` words of the entity, on its line and at most 16 * ``words`` * 64 code points
      away, in ``min_contexts`` different contexts (copies of one context count once),
    * seeing it makes the entity likely: joint count / count of the word anywhere in the
      corpus is at least ``min_confidence``, and
    * its pointwise mutual information with the entity is at least ``min_share`` of the entity's
      own information, log2(all words / the entity's occurrences).

    Words that stand beside many entities fail the second test.  All counts are over all rows.
    """
    held = rows.where(F.size("spans") > 0)
    beside = held.select("text", F.explode("spans").alias("span")).select(
        F.struct(F.col("span.kind"), F.lower("span.value").alias("value")).alias("entity"),
        _context_words(F.col("text"), F.col("span"), words).alias("context"),
    )
    pairs = beside.select("entity", F.xxhash64("context").alias("context"), F.explode("context").alias("term"))
    pairs = pairs.where(F.length("term") >= min_letters)
    joint = (
        pairs.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= min_contexts)
    )
    joint = written(joint, "joint")
    sieve = _sieve(joint.select("term"))
    # Every word of the corpus is read; those that can't be candidates stop at the sieve.
    corpus = rows.select(F.explode(F.split(F.lower("text"), _WORD_GAP)).alias("term"))
    counts = corpus.where(_passes(F.col("term"), sieve)).groupBy("term").agg(F.count("*").alias("n_term"))
    entities = beside.groupBy("entity").agg(F.count("*").alias("n_entity"))
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).scalar()
    judged = (
        joint.join(counts, "term").join(entities, "entity")
        .withColumn("confidence", F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0)))
        .withColumn("own", F.log2(total / F.col("n_entity")))
        .withColumn("information", F.log2(F.col("n_both") * total / (F.col("n_term") * F.col("n_entity"))))
        .where((F.col("confidence") >= min_confidence) & (F.col("information") >= min_share * F.col("own")))
    )
    return judged.groupBy("term").agg(F.max("confidence").alias("confidence"), F.max("information").alias("information"))


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    remove_above: float = 0.8,
    **thresholds,
) -> DataFrame:
    """(id, sig, text, spans, clean): each document's personal data and its text without it.

    ``spans`` is a sorted array of (start, kind, end, value); starts and ends count code points, the
    end is exclusive; kinds number ``KINDS``.  In ``clean`` a base span becomes its kind in
    brackets; a disclosing word is generalised to ``[WORD]`` or, where it is as sure as
    ``remove_above``, removed.  Overlapping spans are replaced as one, by the first of them.

    * A null or empty text has no spans.
    * Rows without an id are treated like others but get no disclosing words, for lack of a key.
    * Rows that repeat an id are told apart by their text.
    * An empty table gives an empty table; further columns are not read.
    """
    rows = texts(docs, id_col, text_col).withColumn("spans", base_spans(F.col("text")))
    terms = disclosing_terms(rows.select("text", "spans"), **thresholds)
    terms = written(terms, "terms")
    sieve = _sieve(terms.select("term"))
    worded = rows.select("id", "sig", F.explode(F.array_distinct(F.split(F.lower("text"), _WORD_GAP))).alias("term"))
    told = (
        worded.where(_passes(F.col("term"), sieve)).join(terms, "term")
        .groupBy("id", "sig")
        .agg(F.sort_array(F.collect_set(F.struct("term", "confidence"))).alias("told"))
    )
    joined = rows.join(told, ["id", "sig"], "left")
    # Terms hold letters only, so they need no quoting in a pattern.
    pattern = F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"),
        F.array_join(F.transform("told", lambda t: t["term"]), "|"),
        F.lit(r")(?!\p{L})"),
    )
    extra = F.when(F.col("told").isNull(), F.expr("array()").cast(f"array<{_ONE_SPAN}>")).otherwise(
        located(F.col("text"), pattern, len(KINDS) - 1)
    )
    spans = F.array_sort(F.concat("spans", extra))
    sure = F.transform(F.filter("told", lambda t: t["confidence"] >= remove_above), lambda t: t["term"])
    sure = F.coalesce(sure, F.expr("array()").cast("array<string>"))
    return joined.select("id", "sig", "text", spans.alias("spans"), sure.alias("_sure")).select(
        "id", "sig", "text", "spans", masked(F.col("text"), F.col("spans"), F.col("_sure")).alias("clean")
    )


def masked(text: Column, spans: Column, sure: Column) -> Column:
    """The text with every span replaced; ``sure`` lists the words that are removed."""
    marks = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS[:4]], F.lit("[WORD]"))

    def step(done: Column, span: Column) -> Column:
        gone = (span["kind"] == len(KINDS) - 1) & F.array_contains(sure, F.lower(span["value"]))
        mark = F.when(gone, F.lit("")).otherwise(F.element_at(marks, span["kind"] + 1))
        fresh = span["start"] >= done["at"]
        piece = F.concat(F.substr(text, done["at"] + 1, span["start"] - done["at"]), mark)
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], F.array(piece))).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<string>").alias("out"))
    replaced = F.aggregate(
        spans,
        start,
        step,
        lambda done: F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"] + 1, F.greatest(F.length(text) - done["at"], F.lit(0)))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(replaced)


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, in order, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def kind_counts(spans: Column) -> dict[str, Column]:
    """Number of spans of each base kind."""
    return {
        kind: F.size(F.filter(spans, _is_kind(number))).cast("bigint")
        for number, kind in enumerate(KINDS[:4])
    }
