"""The corpus pipeline against a plain version, stage by stage and as a whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from test_operators import awkward_texts, plain_pack
from tidelake.llm import packing, toxicity
from tidelake.llm.rows import table

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_scores(fitted, docs):
    restorer, out = toxicity.Restorer(fitted.model), {}
    for i, text in docs.items():
        found = {f for w in restorer.words(text or "") for f in toxicity.features(w) if f in fitted.weights}
        out[i] = 1 / (1 + np.exp(-(fitted.bias + sum(fitted.weights[f] for f in found))))
    return out


def plain_near(docs):
    classes = brute.components({i: brute.fingerprint(t) for i, t in docs.items()})
    return {i: t for i, t in docs.items() if classes[i] == i}


def plain_clean(docs, items):
    hit = brute.contamination(docs, items)
    return {i: t for i, t in docs.items() if not hit[i][1]}


def plain_lines(docs):
    return {i: t if t is None else brute.line_dedup(docs)[i][3] for i, t in docs.items()}


def check_packing(rows, docs):
    words = {i: len((t or "").encode().split()) for i, t in docs.items()}
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == words
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for pieces in shards.values():
        pieces.sort(key=lambda r: (-r.n_tokens, r.doc_id, r.piece))
        place, final = plain_pack([r.n_tokens for r in pieces], packing.CAPACITIES, packing.bin_cost)
        assert [(r.bin, r.bin_offset, r.capacity) for r in pieces] == [(b, o, final[b]) for b, o in place]


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_plain_version(spark, sf):
    documents = table(spark, sf, "documents")
    docs = {r.doc_id: r.text for r in documents.collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    fitted = toxicity.fit_toxicity(documents, table(spark, sf, "labels"))
    scores = plain_scores(fitted, docs)
    docs = {i: t for i, t in docs.items() if scores[i] < 0.5}
    expected = plain_clean(plain_near(plain_lines(docs)), items)
    check_packing(corpus_pipeline.run(spark, sf).collect(), expected)


@pytest.fixture
def awkward(spark):
    rows = [(i, t, None, "s" if i % 2 else None, None if t is None else len(t)) for i, t in awkward_texts().items()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_every_stage_takes_awkward_rows(spark, sf, awkward):
    docs = awkward_texts()
    kept = STAGES["toxicity"](spark, awkward, sf)
    assert kept.columns == COLUMNS and {r.doc_id: r.text for r in kept.collect()} == docs
    shorter = STAGES["line_dedup"](spark, awkward, sf)
    assert shorter.columns == COLUMNS and shorter.schema["n_chars"].dataType == awkward.schema["n_chars"].dataType
    found = {r.doc_id: (r.text, r.n_chars) for r in shorter.collect()}
    assert found == {i: (t, None if t is None else len(t)) for i, t in plain_lines(docs).items()}
    single = STAGES["simhash_near_dedup"](spark, awkward, sf)
    assert single.columns == COLUMNS and {r.doc_id: r.text for r in single.collect()} == plain_near(docs)
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    marked = awkward.unionAll(awkward.where("doc_id = 1").withColumns({"doc_id": F.lit(500).cast("bigint"), "text": F.lit(f"before {items[0][1]} after")}))
    clean = STAGES["decontamination"](spark, marked, sf)
    assert clean.columns == COLUMNS and {r.doc_id: r.text for r in clean.collect()} == docs
    check_packing(STAGES["best_fit_packing"](spark, awkward, sf).collect(), docs)


def test_every_stage_takes_an_empty_table(spark, sf, awkward):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward.where("false"), sf).count() == 0, name


def test_repeated_and_nameless_rows_pass_through(spark, sf, awkward):
    rows = awkward.where("doc_id IN (16, 17)")
    rows = rows.unionAll(rows.where("doc_id = 16")).unionAll(rows.where("doc_id = 17").withColumn("doc_id", F.lit(None).cast("bigint")))
    for name in ("toxicity", "line_dedup", "decontamination"):
        assert sorted((r.doc_id or 0) for r in STAGES[name](spark, rows, sf).collect()) == [0, 16, 16, 17], name
    # Of copies one stays, and a copy without an id goes.
    assert sorted((r.doc_id or 0) for r in STAGES["simhash_near_dedup"](spark, rows, sf).collect()) == [16, 17]
    assert sorted((r.doc_id or 0) for r in STAGES["best_fit_packing"](spark, rows, sf).collect()) == [0, 16, 16, 17]
