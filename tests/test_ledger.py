"""The digest ledger: what is read again, what is not, and what a crash leaves."""

import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidelake.sources import commits, lake, ledger


def put(root, key, body, at=1_700_000_000):
    name = root / key
    name.parent.mkdir(parents=True, exist_ok=True)
    name.write_bytes(body)
    os.utime(name, (at, at))


def table(root, key, rows, at=1_700_000_000):
    name = root / key
    name.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"a": list(range(rows))}), name)
    os.utime(name, (at, at))


def look(spark, root, **options):
    return {r.key: r for r in ledger.ledger_inventory(spark, str(root), **options).collect()}


def test_only_changed_files_are_read_again(spark, tmp_path):
    root = tmp_path / "lake"
    for n in range(6):
        put(root, f"docs/source-{n}.json", b"body %d" % n)
    put(root, "docs/unfinished.part", b"no")
    table(root, "docs/part-0.parquet", 7)
    first = look(spark, root)
    assert all(r.reread for r in first.values()) and len(first) == 7
    same = {r.key: r for r in lake.lake_inventory(spark, str(root)).collect()}
    assert {k: r.asDict() for k, r in same.items()} == {k: {c: v for c, v in r.asDict().items() if c != "reread"} for k, r in first.items()}
    # Other bytes under the same size and time: only a ledger that reads nothing can miss them.
    put(root, "docs/source-1.json", b"BODY 1")
    put(root, "docs/source-2.json", b"body 2", at=1_700_000_100)
    put(root, "docs/source-3.json", b"longer than before")
    put(root, "docs/new one.json", b"new")
    os.remove(root / "docs/source-4.json")
    table(root, "docs/part-0.parquet", 9, at=1_700_000_200)
    second = look(spark, root)
    assert {k.split("/")[1] for k, r in second.items() if r.reread} == {"source-2.json", "source-3.json", "new one.json", "part-0.parquet"}
    assert "docs/source-4.json" not in second
    assert second["docs/source-1.json"].digest == hashlib.sha256(b"body 1").hexdigest()
    assert second["docs/source-3.json"].digest == hashlib.sha256(b"longer than before").hexdigest()
    assert second["docs/part-0.parquet"].rows == 9
    # Nothing changed: nothing is read, also where a file came back to what it was before.
    assert not any(r.reread for r in look(spark, root).values())


def test_files_that_were_just_written_are_read_once_more(spark, tmp_path):
    root = tmp_path / "lake"
    put(root, "docs/a.json", b"a", at=4_000_000_000)
    put(root, "docs/b.json", b"b")
    look(spark, root)
    assert {k for k, r in look(spark, root).items() if r.reread} == {"docs/a.json"}


def test_folded_ledgers_forget_files_that_are_gone(spark, tmp_path):
    root, path = tmp_path / "lake", str(tmp_path / "ledger")
    for n in range(4):
        put(root, f"docs/{n}.json", b"%d" % n)
        assert len(look(spark, root, ledger=path, fold_after=2)) == n + 1
    os.remove(root / "docs/0.json")
    for n in range(3):
        found = look(spark, root, ledger=path, fold_after=2)
        assert set(found) == {f"docs/{i}.json" for i in (1, 2, 3)} and not any(r.reread for r in found.values())
    held = commits.generations(spark, path)
    assert held[0].is_base and len(held) <= 3
    keys = {r.key for r in spark.read.parquet(f"{path}/{held[0].name}").collect()}
    assert keys == {f"docs/{i}.json" for i in (1, 2, 3)}


def test_a_run_that_dies_leaves_the_ledger_as_it_was(spark, tmp_path, monkeypatch):
    root = tmp_path / "lake"
    put(root, "docs/a.json", b"a")
    look(spark, root)
    put(root, "docs/b.json", b"b")

    def die(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ledger.commits, "commit", die)
        with pytest.raises(OSError, match="lost"):
            look(spark, root)
    found = look(spark, root)
    assert {k: r.reread for k, r in found.items()} == {"docs/a.json": False, "docs/b.json": True}
