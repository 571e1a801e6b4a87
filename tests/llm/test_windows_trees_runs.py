"""Window de-duplication, the hash tree and run detection against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from test_operators import PASSAGE, awkward_texts, frame
from tidelake.llm import merkle, queries, runs, window_dedup
from tidelake.llm.rows import table


@pytest.fixture(scope="module")
def documents(spark, sf):
    return table(spark, sf, "documents").collect()


# ------------------------------------------------------------- op11 window dedup


def check_windows(rows, found, width=20):
    expected = brute.window_dedup(rows, width)
    got = sorted((repr(r.id), r.sig, r.n_words, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in found)
    keyed = sorted((repr(i), None, *e) for (i, _), e in zip(rows, expected, strict=True))
    assert sorted((g[0], *g[2:]) for g in got) == sorted((k[0], *k[2:]) for k in keyed)


@pytest.mark.parametrize("group, bucket", [(5_000_000, 250_000), (30_000, 500)])
def test_windows_equal_the_plain_version(spark, sf, documents, monkeypatch, group, bucket):
    monkeypatch.setattr(window_dedup, "GROUP_BYTES", group)
    monkeypatch.setattr(window_dedup, "BUCKET_WINDOWS", bucket)
    found = window_dedup.dedup_windows(table(spark, sf, "documents")).collect()
    check_windows([(d.doc_id, d.text) for d in documents], found)


@pytest.mark.parametrize("group", [5_000_000, 1_000])
def test_windows_of_awkward_rows(spark, monkeypatch, group):
    """Nulls, empties, repeats inside a text, repeated rows, an id with two texts, rows without an id, clashing columns."""
    monkeypatch.setattr(window_dedup, "GROUP_BYTES", group)
    loop = " ".join(["a", "b", "c"] * 30)
    more = [(5, PASSAGE + " other"), (None, loop), (None, loop), (40, loop), (41, "x " + loop), (-3, "é " + loop), (2**62, loop)]
    docs = frame(spark, awkward_texts(), repeat=True)
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for width in (20, 3, 1):
        check_windows(rows, window_dedup.dedup_windows(docs, width=width).collect(), width)
    assert window_dedup.dedup_windows(docs.where("false")).count() == 0


def test_window_hashes_tell_windows_apart():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 3, 4000).astype(np.uint64) + np.uint64(1)
    for width in (1, 2, 3, 7, 20):
        hashes = window_dedup.window_hashes(words, width, window_dedup._BASES[0])
        keys = [tuple(words[k : k + width].tolist()) for k in range(len(words) - width + 1)]
        assert len(hashes) == len(keys) and len(set(zip(keys, hashes.tolist()))) == len(set(keys)) == len(set(hashes.tolist()))


# ---------------------------------------------------------------- op12 hash tree


def plain_manifest(docs):
    """{doc_id: row of the query}, by climbing the tree; ids are all different."""
    groups, held = {}, {}
    for d in sorted(docs, key=lambda d: (d.lang is not None, (d.lang or "").encode(), d.doc_id)):
        leaf = brute.sha(brute.record(d.doc_id, d.source, d.lang, d.n_chars, d.text))
        claim = leaf
        if zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None:
            claim = brute.sha(brute.record(d.doc_id, d.source, d.lang, d.n_chars + 1, d.text))
        groups.setdefault(d.lang, []).append(leaf)
        held.setdefault(d.lang, []).append((d.doc_id, claim))
    out = {}
    for lang, rows in brute.merkle(groups).items():
        for (i, claim), (leaf, sub, root, proof) in zip(held[lang], rows, strict=True):
            reached = brute.fold(claim, proof)
            out[i] = (leaf, sub, root, brute.sha("".join(s[1] for s in proof if s)), reached, reached == root)
    return out


def shown(done):
    return {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in done}


@pytest.mark.parametrize("bits", [10, 1, 3])
def test_manifest_equals_the_plain_version(spark, sf, documents, monkeypatch, bits):
    """With small blocks the tree is built in many rounds and ancestors are spread over blocks."""
    whole = merkle.manifest
    monkeypatch.setattr(queries, "manifest", lambda *a: whole(*a, bits=bits))
    done = queries.QUERIES["op12_merkle_manifest"](spark, sf).collect()
    assert shown(done) == plain_manifest(documents)
    assert 0 < sum(not r.verified for r in done) < len(done) / 3


def test_manifest_of_awkward_rows(spark, tmp_path):
    """Null texts, groups, sources and counts, a lone leaf, a group name that is empty, columns with clashing names."""
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, idx int, level int, digest string, block int"
    rows = [(i, None if i % 5 == 0 else "é" * i, [None, "", "en", "a"][i % 4], None if i % 3 else "s", None if i % 2 else i, "x", 1, 2, "d", 3) for i in range(1, 75)]
    rows.append((500, "alone", "zz", "s", 5, "x", 1, 2, "d", 3))
    spark.createDataFrame(rows, shape).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    done = queries.QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()
    docs = table(spark, str(tmp_path), "documents").collect()
    assert shown(done) == plain_manifest(docs)


def test_manifest_of_few_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")

    def done(frame):
        leaf = merkle.hashed(merkle.record(F.col("doc_id"), F.col("text")))
        return merkle.manifest(frame, F.col("doc_id"), F.lit(None), leaf).collect()

    (lone,) = done(docs)
    assert lone.leaf == lone.subroot == lone.root == lone.folded and lone.siblings == []
    assert done(docs.where("false")) == []
    twice = done(docs.unionAll(docs).unionAll(spark.createDataFrame([(None, "a")], docs.schema)))
    assert len(twice) == 3 and all(r.folded == r.root for r in twice)
    assert [r.siblings for r in twice if len(r.siblings) == 1] != [] and sorted(len(r.siblings) for r in twice) == [1, 2, 2]


# ---------------------------------------------------------------------- op13 runs


def found_runs(texts):
    words = [t.split() for t in texts]
    numbers = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for own in words for w in own], np.int64)
    return runs.runs_of(codes, np.array([len(w) for w in words], np.int64))


def test_transform_is_exact():
    draw = np.random.default_rng(1)
    for block in (2, 4, 16, 128):
        shifts = 2 * block if block > 2 else 6
        x = draw.integers(0, int(((runs.PRIME - 1) // block) ** 0.5), (5, block)).astype(np.uint64)
        y = draw.integers(0, int(((runs.PRIME - 1) // block) ** 0.5), (5, shifts + block - 1)).astype(np.uint64)
        plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q[s:])) for s in range(shifts)] for p, q in zip(x, y)]
        assert runs.square_differences(x, y, shifts).tolist() == plain
        values = draw.integers(0, runs.PRIME, (3, 4 * block)).astype(np.uint64)
        assert (runs.inverse(runs.transform(values)) == values).all()


def test_runs_of_random_words():
    """Few different words, repeated stretches inside repeated stretches, many documents in one chunk."""
    draw = random.Random(4)
    for letters in ("ab", "abc", "abcdefgh"):
        texts = []
        for _ in range(60):
            words = []
            while len(words) < draw.randint(0, 160):
                piece = [draw.choice(letters) for _ in range(draw.randint(1, 30))]
                words += piece * draw.choice((1, 1, 2, 3, 7)) + piece[: draw.randint(0, len(piece))]
                if draw.random() < 0.2:
                    words += words[: draw.randint(0, 80)]
            texts.append(" ".join(words))
        assert found_runs(texts) == [brute.runs(t.split()) for t in texts]


def test_runs_of_single_words_and_fibonacci():
    one, two = "a", "a b"
    for _ in range(10):
        one, two = two, f"{two} {one}"
    texts = ["x " * 4000, two, "", "y", " ".join(map(str, range(500))) + " " + " ".join(map(str, range(500))), "p q " * 700 + "r " * 90]
    assert found_runs(texts[1:]) == [brute.runs(t.split()) for t in texts[1:]]
    assert found_runs(texts[:1]) == [[(0, 4000, 1)]]


def plain_repeats(i, words):
    h, n = zlib.crc32(str(i).encode()) if i is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k if k < a else a + (k - a) % p] for k in range(n)]


def check_runs(docs, done):
    assert len(docs) == len(done)
    expected = []
    for i, text in docs:
        words = plain_repeats(i, (text or "").encode().split())
        own = brute.runs(words)
        best = min(((-n, s, q) for s, n, q in own), default=None)
        top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        expected.append((i, len(own), *top, brute.sha(lines), brute.sha(brute.collapsed(words, own))))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in done)


def test_runs_query_equals_the_plain_version(spark, sf, documents):
    done = queries.QUERIES["op13_periodic_runs"](spark, sf).collect()
    check_runs([(d.doc_id, d.text) for d in documents], done)
    assert sum(r.n_runs > 0 for r in done) > 10


def test_runs_of_awkward_rows(spark, tmp_path, monkeypatch):
    texts = awkward_texts()
    texts[11], texts[12] = " ".join(f"w{k % 700}" for k in range(3000)), " ".join(f"word{k}" for k in range(3000))
    # Ids of the tenth that is changed, with every kind of text.
    changed = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts |= dict(zip(changed, [None, "", "  ", "one", "a b", PASSAGE, "a " * 50, texts[12]], strict=False))
    for chunk in (2_000_000, 1):
        monkeypatch.setattr(runs, "CHUNK_BYTES", chunk)
        path = f"{tmp_path}/{chunk}"
        docs = frame(spark, texts, repeat=True)
        docs.write.parquet(f"{path}/documents.parquet")
        done = queries.QUERIES["op13_periodic_runs"](spark, path).collect()
        check_runs([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], done)
        for r in done:
            assert r.runs_sha256 and r.collapsed_sha256
    assert runs.periodic_runs(docs.where("false")).count() == 0
