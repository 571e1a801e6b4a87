"""nearest neighbours took a time square to the vectors' length to draw a sample, and a row for every bucket asked."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import ann


def test_long_vectors_are_measured_once_a_row(spark):
    """Before, a norm took the length squared, and was worked out anew for every comparison of the sample's sort."""
    x = np.random.default_rng(1).normal(size=(1_500, 512)).astype(np.float32)
    rows = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>").cache()
    rows.count()
    began = time.monotonic()
    found = ann.nearest(rows).collect()
    assert time.monotonic() - began < 90
    assert len(found) == 75 * 20
    scores = x.astype(float) @ x[100].astype(float)
    assert all(abs(r.score - scores[r.id]) < 1e-9 for r in found if r.query_id == 100)


def test_norms_of_floats_and_doubles(spark):
    data = [(0, [3.0, 4.0]), (1, [0.0, -0.25]), (2, [1e-30, 0.0])]
    for kind in ("float", "double"):
        rows = ann.usable(spark.createDataFrame(data, f"i bigint, e array<{kind}>"), "i", "e")
        assert dict(rows.dtypes)["v"] == f"array<{kind}>"
        norms = [r.n for r in rows.orderBy("id").select(ann.log_norm().alias("n")).collect()]
        assert norms == pytest.approx([np.log2(5), -2.0, np.log2(1e-30)])


def test_the_sample_is_that_of_all_rows_sorted(spark, monkeypatch):
    monkeypatch.setattr(ann, "FIT_ROWS", 50)
    sizes = {0: 3, 1: 900, 2: 2_000}
    data = [(i + 10_000 * band, band, [float(i), float(band)]) for band, n in sizes.items() for i in range(n)]
    data += [(7, 3, [float(i), 3.0]) for i in range(400)]  # one id for all rows of a range
    sizes[3] = 400
    rows = spark.createDataFrame(data, "id bigint, band int, v array<double>")
    n = F.element_at(F.create_map(*[F.lit(x) for b, n in sizes.items() for x in (b, float(n))]), F.col("band"))
    draw = (F.xxhash64("id", F.lit(5)).cast("double") + 2.0**63) * n
    expected = sorted((r.draw, r.id) for r in rows.select(draw.alias("draw"), "id").collect())[:50]
    found = ann.fit_sample(rows, F.col("band"), sizes, 5)
    place = {tuple(v): (i) for i, _, v in data}
    assert sorted(place[tuple(v)] for v in found.tolist()) == sorted(i for _, i in expected)


def test_cells_scored_at_once_are_those_of_the_heap():
    draw = np.random.default_rng(3)
    for n in (0, 1, 3, 5):
        places = draw.uniform(-4, 4, (20, n))
        for most in (1, 2, 17, 3**n):
            most = min(most, 3**n)
            for place, found in zip(places, ann.probed_codes(places, most), strict=True):
                cells = ann.probe_order(place, most)
                assert sorted(found.tolist()) == sorted(ann.codes(cells).tolist())
                assert ann.probe_ranks(place, cells, most + 1).tolist() == list(range(most))
        far = np.floor(places[0]).astype(np.int64)[None] + 2
        assert n == 0 or ann.probe_ranks(places[0], far, 9).tolist() == [9]


@pytest.mark.parametrize("tile", [4, 512])
@pytest.mark.parametrize("size", [1.0, 1e160])
def test_a_cell_gives_the_best_of_the_asked_buckets(monkeypatch, tile, size):
    monkeypatch.setattr(ann, "TILE", tile)
    draw = np.random.default_rng(4)
    x = draw.integers(-2 if size == 1 else 0, 3, (300, 3)).astype(float) * size  # many ties
    ids, bucket = draw.permutation(300), draw.integers(0, 9, 300)
    query, y = ids[:40].copy(), x[:40]
    asked = [np.unique(draw.integers(0, 12, 4)) for _ in query]
    pairs = np.repeat(np.arange(40), [len(b) for b in asked]), np.concatenate(asked)
    for whole in (False, True):
        who, found, scores = ann.cell_best(query, y, None if whole else pairs, ids, x, bucket, 5)
        for i in range(40):
            own = ann.products(y[i : i + 1], x)[0]
            expected = sorted((-s, j) for s, j, b in zip(own, ids, bucket, strict=True) if j != query[i] and (whole or b in asked[i]))[:5]
            assert list(zip(-scores[who == i], found[who == i], strict=True)) == expected


def test_large_buckets_are_cells_of_their_own():
    layout = ann.Layout(3, np.array([-5, 8]), np.array([2, 4], np.int32))
    cell, large, parts = layout.of(np.array([8, 7, -5, 9, -6]))
    assert large.tolist() == [True, False, True, False, False] and parts.tolist() == [4, 1, 2, 1, 1]
    assert cell[0] == 8 and cell[2] == -5 and ((cell[[1, 3, 4]] >= 0) & (cell[[1, 3, 4]] < 3)).all()
    cell, large, part = layout.everywhere()
    assert list(zip(cell, large, part, strict=True)) == [(0, False, 0), (1, False, 0), (2, False, 0), *((-5, True, i) for i in range(2)), *((8, True, i) for i in range(4))]
