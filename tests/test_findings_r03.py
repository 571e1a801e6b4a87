"""Faults that a review found at larger sizes, each on the smallest input that shows it."""

import zipfile
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidelake.contract import landing
from tidelake.contract.registry import ORACLES, QUERIES
from tidelake.llm import gru, lm
from tidelake.operators import archive
from tidelake.sources import lake
from tidelake.streaming import health_state


@pytest.mark.parametrize("name", ["read_csv_source", "read_zip_csv_source", "read_parquet_source"])
def test_only_file_rows_are_broadcast(spark, sf, name):
    # What a task reads of a file is unknown to the planner, which sent all rows to the driver.
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_compared_files_hold_their_rows_in_one_order(spark, sf, tmp_path):
    # Rows arrive from a shuffle in any order; files written of them and compared by digest differed at random.
    docs = pq.read_table(f"{sf}/documents.parquet")
    (tmp_path / "documents.parquet").mkdir()
    for k in range(4):
        part = docs.slice(len(docs) - (k + 1) * len(docs) // 4, len(docs) // 4)
        pq.write_table(part.take(list(range(len(part)))[::-1]), tmp_path / f"documents.parquet/part-{k}.parquet")
    found = {(r.doc_id, r.n, r.verdict) for r in QUERIES["mirror_round_trip"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert found == set(con.execute(ORACLES["mirror_round_trip"]).fetchall())
    newest = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("mirror-*"), key=lambda p: p.stat().st_mtime)
    for path in newest.glob("*/docs/part=*/*.parquet"):
        ids = pq.ParquetFile(path).read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)


def test_tables_kept_as_folders_and_tables_without_rows(spark, tmp_path):
    (tmp_path / "big.parquet").mkdir()
    for k in range(3):
        pq.write_table(pa.table({"a": list(range(k))}, schema=pa.schema([("a", pa.int64())])), tmp_path / f"big.parquet/part-{k}.parquet")
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "small.parquet")
    pq.write_table(pa.table({"a": pa.array([], pa.int64())}), tmp_path / "none.parquet")
    found = {r.key: r.rows for r in lake.scan_parquet_rows(spark, str(tmp_path)).collect()}
    assert found == {"big.parquet": 3, "small.parquet": 2, "none.parquet": 0}


def test_archives_are_packed_a_batch_at_a_time(tmp_path):
    folder, alive = str(tmp_path / "zips"), []

    def batches():
        for k in range(3):
            alive.append(sorted(p.name for p in tmp_path.glob("zips/*")))
            yield pa.RecordBatch.from_pydict({"a": [f'say "{k}"', None], "b": ["x", "y,z"]})


    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 7

    import pyspark

    kept, pyspark.TaskContext = pyspark.TaskContext, Context
    try:
        (out,) = landing._zip_writer(folder, "a,b")(batches())
    finally:
        pyspark.TaskContext = kept
    assert out.to_pydict() == {"rows": [6]}
    # The archive lies there before the later rows are asked for.
    assert alive == [[], ["part-7.zip"], ["part-7.zip"]]
    with zipfile.ZipFile(f"{folder}/part-7.zip") as archive:
        assert archive.read("data/events.CSV").decode() == "﻿a,b\n" + "".join(f'"say ""{k}""","x"\n"","y,z"\n' for k in range(3))


def test_every_training_document_moves_the_weights(spark, monkeypatch):
    # Two rounds of an eighth each left three quarters of the documents out.
    docs = spark.createDataFrame([(i, f"w{i} " * (i + 1)) for i in range(40)], "doc_id long, text string")
    called, fitted = [], lm.trained

    def noted(rows, shares, share, rounds):
        called.append((share, rounds))
        return fitted(rows, shares, share, rounds)

    monkeypatch.setattr(lm, "trained", noted)
    assert lm.score_texts(docs).count() == 40
    ((share, rounds),) = called
    assert share * rounds >= 1
    with pytest.raises(ValueError, match="leave some out"):
        lm.score_texts(docs, train_share=1 / 8)


def test_a_job_goes_to_its_state_once_for_all_its_deltas(monkeypatch):
    # Every delta was brought to the state by itself, each time by calls to another process.
    calls = []

    class Kept:
        def __init__(self):
            self.rows = []

        def get(self):
            calls.append("get")
            return self.rows or None

        def update(self, row):
            calls.append("update")
            self.rows = row

        def appendList(self, rows):
            calls.append("append")
            self.rows = [*self.rows, *rows]

        put = update

        def clear(self):
            calls.append("clear")
            self.rows = []

    class Handle:
        def getValueState(self, name, shape):
            return Kept()

        def getListState(self, name, shape):
            return Kept()

    def failed(seq):
        delta = dict.fromkeys(f.name for f in health_state._DELTA.fields) | dict.fromkeys(health_state._COUNTS, 0)
        return delta | {"job": "j", "runs": 1, "failures": 1, "failed": [seq], "empty": []}

    job = health_state._JobHealth()
    job.init(Handle())
    (row,) = job.handleInputRows(("j",), iter([failed(seq) for seq in range(50)]), None)
    assert row.failed_since == row.failures == 50
    assert len(calls) == 3
    # What is gathered is bounded: beyond it, numbers go to the state earlier.
    monkeypatch.setattr(health_state, "GATHERED", 10)
    (row,) = job.handleInputRows(("j",), iter([failed(seq) for seq in range(50, 100)]), None)
    assert row.failed_since == row.failures == 100
    assert sorted(r[0] for r in job._pending["failed"].rows) == list(range(100))


def test_stored_keys_are_not_broadcast(spark, sf, tmp_path, monkeypatch):
    # An archive's files are far smaller than its keys in memory, which the planner took for small and broadcast.
    plans = []
    root = str(tmp_path)
    snapshots = landing._snapshots(spark, sf)
    archive.write_event_archive(snapshots.where("seq % 2 = 0"), root, ["seq"])
    joined = type(snapshots).join

    def noted(left, right, *args, **kwargs):
        found = joined(left, right, *args, **kwargs)
        if args and args[0] == archive.MERGE_KEY:
            plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(type(snapshots), "join", noted)
    archive.write_event_archive(snapshots, root, ["seq"])
    assert len(plans) == 3 and not any("BroadcastHashJoin" in plan for plan in plans)


def test_short_texts_are_cut_into_words_together(monkeypatch):
    # Every text by itself cost some twenty calls of numpy; the words, their codes and the ends stay what they were.
    calls, cut = [], lm.tokens_of

    def noted(data):
        calls.append(len(data))
        return cut(data)

    monkeypatch.setattr(lm, "tokens_of", noted)
    texts = [np.frombuffer(t, np.uint8) for t in (b"", b" \n", b"Ab c", b"x" * 200_000, b"c ab\xff", b"", b"ab")] + [np.frombuffer(b"w v", np.uint8)] * 500
    found = lm.Tokens.of(texts)
    assert len(calls) < 6
    assert np.diff(found.offsets).tolist() == [1, 1, 3, 2, 3, 1, 2] + [3] * 500
    alone = [lm.Tokens.of([t]) for t in texts]
    assert (found.hashes == np.concatenate([a.hashes for a in alone])).all() and (found.codes == np.concatenate([a.codes for a in alone])).all()
    assert lm.Tokens.of([]).offsets.tolist() == [0]


def test_scoring_lays_out_no_more_lanes_than_the_longest_text_fills(monkeypatch):
    # Beside a long text most of 512 lanes were laid out empty.
    shapes, laid = [], gru.laid_out

    def noted(*args):
        out = laid(*args)
        shapes.append(out[0].size)
        return out

    monkeypatch.setattr(gru, "laid_out", noted)
    offsets = np.cumsum([0, 4000, *[10] * 1000])
    classes = np.arange(offsets[-1]) % 5
    gru.score(gru.initial(5, np.zeros(5)), classes, offsets)
    assert shapes[0] < 2 * offsets[-1]
