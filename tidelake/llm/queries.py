"""One query for each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.ann import nearest
from tidelake.llm.decontaminate import contaminated_words
from tidelake.llm.line_dedup import dedup_lines
from tidelake.llm.lm import score_texts
from tidelake.llm.merkle import hashed, hex_of, manifest, record
from tidelake.llm.packing import pack_best_fit
from tidelake.llm.pii import KINDS, kind_counts, personal_data, span_text
from tidelake.llm.rows import crc_fold, table
from tidelake.llm.runs import periodic_runs
from tidelake.llm.simhash import hex_fingerprint, near_duplicates
from tidelake.llm.suffix_dedup import dedup_substrings
from tidelake.llm.toxicity import fit_toxicity, score_toxicity
from tidelake.llm.url_filter import url_verdicts
from tidelake.llm.window_dedup import dedup_windows
from tidelake.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return function(spark, sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def word_count(text):
    """Number of words between ASCII blanks; a null text has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, counted in words, in the sequences they are packed into."""
    docs = table(spark, sf_dir, "documents")
    return pack_best_fit(docs, word_count(F.col("text"))).withColumnRenamed("id", "doc_id")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that 50-byte strings of earlier documents cover, and a digest of the rest."""
    done = dedup_substrings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return done.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document lie in windows of benchmark items, and of which items."""
    found = contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, those dropped, and a digest of the rest."""
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, coalesce(k.doc_id > f.first, false) AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    fitted = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, fitted)
    return scored.select(
        F.col("id").alias("doc_id"),
        (crc_fold(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), hex_fingerprint(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth id."""
    found = nearest(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of every page."""
    return url_verdicts(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the recurrent model and under the base counts."""
    found = score_texts(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        (crc_fold(F.col("id"), 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and places."""
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)
    return found.select(
        F.col("id").alias("doc_id"),
        *[count.alias(f"n_{kind}") for kind, count in kind_counts(F.col("spans")).items()],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == len(KINDS) - 1)).cast("bigint").alias("n_term"),
        F.sha2("clean", 256).alias("clean_sha256"),
    )


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that windows of 20 words starting earlier cover, and a digest of the rest."""
    done = dedup_windows(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return done.select(
        F.col("id").alias("doc_id"),
        "n_words",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op11_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
windows AS (
  SELECT doc_id, pos, array_to_string(ws[pos:pos + 19], ' ') AS key
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS pos FROM docs)),
late AS (
  SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM late, (SELECT unnest(range(20)) AS k)),
marked AS (
  SELECT w.*, g.pos IS NOT NULL AS gone,
         g.pos IS NOT NULL AND lag(g.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos) IS NULL AS begins
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id) m ON d.doc_id = m.doc_id
"""

#: Unsigned crc32 of the decimal doc_id, in SQL: eight steps of the reversed polynomial for every character.
_SQL_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce([xor(crc, c), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots, proof, and whether a partly tampered table still leads to the root."""
    docs = table(spark, sf_dir, "documents")
    held = hashed(record(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))))
    changed = hashed(record(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")))
    claimed = F.when((crc_fold(F.col("doc_id"), 7) == 0) & F.col("n_chars").isNotNull(), changed)
    done = manifest(docs, F.col("doc_id"), F.col("lang"), held, claimed)
    return done.select(
        F.col("id").alias("doc_id"),
        *[hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.array_join(F.transform("siblings", hex_of), ""), 256).alias("proof_sha256"),
        hex_of(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


ORACLES["op12_merkle_manifest"] = (
    """
WITH RECURSIVE base AS (
  SELECT doc_id, lang, n_chars, """
    + _SQL_CRC
    + """ AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
  FROM base),
nodes AS (
  SELECT rank, 0 AS level, idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT rank, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY rank, level, idx // 2),
tops AS (
  SELECT 0 AS level, rank AS idx, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, idx // 2),
steps AS (
  SELECT l.doc_id, s.level, s.digest AS sibling, (l.idx >> s.level) & 1 AS side
  FROM leaves l JOIN nodes s ON s.rank = l.rank AND s.n > 1 AND s.idx = xor(l.idx >> s.level, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + s.level, s.digest, (l.rank >> s.level) & 1
  FROM leaves l JOIN tops s ON s.n > 1 AND s.idx = xor(l.rank >> s.level, 1)),
levels AS (
  SELECT rank, level, row_number() OVER (PARTITION BY rank ORDER BY level) AS turn
  FROM (SELECT DISTINCT rank, level FROM nodes WHERE n > 1
        UNION ALL
        SELECT rank, 1000 + level FROM (SELECT DISTINCT rank FROM leaves), (SELECT DISTINCT level FROM tops WHERE n > 1))),
folds AS (
  SELECT doc_id, rank, 0 AS turn, coalesce(changed, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.doc_id, f.rank, v.turn,
    sha256(CASE WHEN s.sibling IS NULL THEN f.digest WHEN s.side = 1 THEN s.sibling || f.digest ELSE f.digest || s.sibling END)
  FROM folds f JOIN levels v ON v.rank = f.rank AND v.turn = f.turn + 1
  LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.level = v.level)
SELECT l.doc_id, l.leaf, u.digest AS subroot, r.digest AS root,
  sha256(coalesce(p.proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l
JOIN nodes u ON u.rank = l.rank AND u.n = 1
JOIN (SELECT digest FROM tops WHERE n = 1) r ON true
LEFT JOIN (SELECT doc_id, string_agg(sibling, '' ORDER BY level) AS proof FROM steps GROUP BY doc_id) p ON p.doc_id = l.doc_id
JOIN (SELECT doc_id, arg_max(digest, turn) AS digest FROM folds GROUP BY doc_id) f ON f.doc_id = l.doc_id
"""
)


def with_repeats(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents the words from one place on repeat with a period; both follow from the id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        period = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        places = F.sequence(F.lit(0), n - 1)
        named = F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period)))
        return F.when(n > 0, F.array_join(named, " ")).otherwise("")

    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    # Bound once by the lambda, not split anew for every word.
    changed = F.transform(F.array(words), repeated)[0]
    return docs.withColumn("text", F.when(crc % 10 == 0, changed).otherwise(F.col("text")))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, the longest of them, and a digest of what is left without repetitions."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    keyed = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", F.array_min(keyed)).withColumn("lines", F.array_join(lines, ""))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.n")).alias("length"),
        F.col("best.q").alias("period"),
        F.floor(F.lit(-1000) * F.col("best.n") / F.col("best.q")).cast("bigint").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op13_periodic_runs"] = (
    r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    """
    + _SQL_CRC
    + r""" AS crc FROM documents),
turned AS (SELECT *, len(ws) AS n, (crc // 10) % greatest(len(ws), 1) AS a FROM docs),
placed AS (SELECT *, 1 + (n - a) // (3 + (crc // 10) % 8) AS p FROM turned),
words AS (
  SELECT doc_id, i, ws[1 + CASE WHEN crc % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS d FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i),
islands AS (
  SELECT doc_id, d, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT doc_id, d, min(i) AS start, count(*) + d AS length FROM islands GROUP BY doc_id, d, island
  HAVING count(*) + d >= greatest(12, 2 * d)),
runs AS (SELECT doc_id, start, length, min(d) AS period FROM stretches GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS rest
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id),
folded AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM docs d LEFT JOIN folded f ON f.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
)
