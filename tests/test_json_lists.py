"""JSON lists cut into byte ranges, against a plain parse."""

import io
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelake.sources import dumps as du
from tidelake.sources import json_lists as jl


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 6)
    if kind < 4:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "a", " ", "\n", "\\\\"]) for _ in range(rng.randrange(9)))
    if kind < 6:
        return rng.choice([None, True, 1, -2.5, 10**20])
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}\\": value(rng, depth + 1) for i in range(rng.randrange(4))}


def items(seed, n=40):
    rng = random.Random(seed)
    return [{"id": i, "v": value(rng)} for i in range(n)]


def in_ranges(text, size):
    """The members, range by range, as the two passes find them."""
    handle = io.BytesIO(text)
    begins = range(0, max(len(text), 1), size)
    measured = pd.DataFrame([{"path": "p", "source_path": "p", "begin": b} | jl._measure(handle, b, b + size) for b in begins])
    found = []
    for r in jl._placed(measured).itertuples():
        assert r.first == len(found)
        if r.n or not r.begin:
            own = list(jl.members_in(handle, "p", r.begin, r.begin + size, r.inside, r.depth))
            assert len(own) == r.n
            found += own
    return [json.loads(member) for member in found]


@pytest.mark.parametrize("block", [3, 64, 8 << 20])
@pytest.mark.parametrize("size", [1, 2, 7, 100, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_of_any_size_hold_all_members_once(monkeypatch, seed, size, block):
    monkeypatch.setattr(jl, "BLOCK_BYTES", block)
    listed = items(seed, 12 if size < 7 else 40)
    for spelled in (json.dumps(listed), "﻿ \n" + json.dumps(listed, ensure_ascii=False, indent=2) + "\n "):
        assert in_ranges(spelled.encode(), size) == listed


def test_backslashes_across_ranges(monkeypatch):
    monkeypatch.setattr(jl, "BLOCK_BYTES", 5)
    for run in range(1, 12):
        listed = [{"a": "\\" * run + '"}{'}, {"b": "\\" * run}, {"c": "x"}]
        for size in range(1, 12):
            assert in_ranges(json.dumps(listed).encode(), size) == listed


@pytest.mark.parametrize("size", [1, 4, 1 << 20])
@pytest.mark.parametrize(
    "text, why",
    [
        ("", jl.NOT_A_LIST), (" \n", jl.NOT_A_LIST), ('{"a":1}', jl.NOT_A_LIST), ('"[]"', jl.NOT_A_LIST), ("[{}] x", jl.NOT_A_LIST),
        ("[{}][{}]", jl.NOT_A_LIST), ("[1]", jl.NOT_OBJECTS), ("[[{}]]", jl.NOT_OBJECTS), ('[{}, "a"]', jl.NOT_OBJECTS),
        ("[{} {}]", jl.NOT_OBJECTS), ("[{},,{}]", jl.NOT_OBJECTS), ("[{},]", jl.NOT_OBJECTS), ("[,{}]", jl.NOT_OBJECTS),
        ("[{}, null, {}]", jl.NOT_OBJECTS), ('[{"a":1}, {"b":', jl.TORN), ('[{"a":1}', jl.TORN), ("[", jl.TORN), ('[{"a":"]', jl.TORN),
    ],
)
def test_what_is_no_list_of_objects_is_refused(text, why, size):
    with pytest.raises(ValueError, match=why):
        in_ranges(text.encode(), size)


@pytest.mark.parametrize("size", [1, 3, 1 << 20])
def test_an_empty_list_has_no_members(size):
    assert in_ranges(b" [ \n ] ", size) == []


def test_files_are_read_by_many_tasks(spark, tmp_path):
    lists = {f"list {n}.json": items(n, 300) for n in range(3)} | {"none.json": []}
    for name, listed in lists.items():
        (tmp_path / name).write_text(json.dumps(listed, ensure_ascii=False))
    rows = du.read_json_list_source(spark, str(tmp_path), "id", split_bytes=1000).collect()
    assert {r.source_path.rsplit("/", 1)[1].replace("%20", " ") for r in rows} == {n for n in lists if lists[n]}
    for name, listed in lists.items():
        own = sorted((r for r in rows if r.source_path.replace("%20", " ").endswith(name)), key=lambda r: r.source_row_number)
        assert [r.source_row_number for r in own] == list(range(len(listed)))
        assert [r.payload_json for r in own] == [json.dumps(x, sort_keys=True, separators=(",", ":")) for x in listed]
        assert [r.external_id for r in own] == [str(x["id"]) for x in listed]


def test_ranges_are_not_gathered_in_one_task(spark, tmp_path):
    """Ranges are few bytes, so adaptive execution would gather them; each stands for much work."""
    (tmp_path / "a.json").write_text(json.dumps(items(1, 300)))
    (tmp_path / "a.csv").write_text("k\n" + "".join(f"{k}\n" for k in range(3000)))
    listed = jl.read_members(spark, str(tmp_path / "a.json"), 500)
    assert listed.select(F.spark_partition_id()).distinct().count() == 4
    given = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = du.read_csv_source(spark, str(tmp_path / "a.csv"))
        assert rows.select(F.spark_partition_id()).distinct().count() == 4 and rows.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", given)


def test_members_beyond_a_block_and_broken_members(spark, tmp_path, monkeypatch):
    big = [{"id": "x", "v": "ü{" * 300_000}, {"v": 1}]
    (tmp_path / "a.json").write_text(json.dumps(big, ensure_ascii=False))
    rows = du.read_json_list_source(spark, str(tmp_path / "a.json"), "id", split_bytes=100_000).collect()
    assert sorted((r.source_row_number, r.external_id, len(json.loads(r.payload_json)["v"]) if not r.source_row_number else 0) for r in rows) == [
        (0, "x", 600_000), (1, "1", 0),
    ]
    (tmp_path / "b.json").write_text('[{"a" 1}]')
    with pytest.raises(Exception, match="not JSON"):
        du.read_json_list_source(spark, str(tmp_path / "b.json"), "id").collect()
