"""Writes that die half-way, writers side by side, and archives that are damaged."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tidelake.operators import bulk_archive as ba
from tidelake.operators import manifest_log as log
from tidelake.sources import commits, dumps, lake
from tidelake.streaming import collect


def lines(spark, entries, at="2024-01-01"):
    bodies = [json.dumps({"dataset": "d", "updated_at": at, "partitions": {p: {"rows": n}}}) for p, n in entries.items()]
    return spark.createDataFrame([(b,) for b in bodies], "value string")


def listed(spark, root):
    bodies = [json.loads(r.body)["partitions"] for r in lake.read_manifest(spark, root, "d").collect()]
    return {p: e["rows"] for b in bodies for p, e in b.items()}


def torn(spark, root, name):
    lines(spark, {"torn": 0}).write.text(f"{log.log_path(root, 'd')}/{name}")


def test_the_newest_entry_of_a_partition_counts(spark, tmp_path):
    root = str(tmp_path)
    assert lake.read_manifest(spark, root, "d").count() == 0
    log.append_entries(lines(spark, {"a": 1, "b": 1}), root, "d")
    torn(spark, root, "part-000000000002-x")
    log.append_entries(lines(spark, {"b": 2}), root, "d")
    assert listed(spark, root) == {"a": 1, "b": 2}
    torn(spark, root, "base-000000000003-x")
    log.append_entries(lines(spark, {"c": 3, "a": 4}), root, "d")
    assert listed(spark, root) == {"a": 4, "b": 2, "c": 3}
    log.fold(spark, root, "d")
    path = log.log_path(root, "d")
    assert listed(spark, root) == {"a": 4, "b": 2, "c": 3} and len(commits.generations(spark, path)) == 1
    log.append_entries(lines(spark, {"b": 5}), root, "d")
    known = commits.generations(spark, path)
    log.append_entries(lines(spark, {"late": 1}), root, "d")
    # A whole manifest leaves out "c"; what was appended since it was begun stays.
    log.replace_entries(lines(spark, {"a": 6, "b": 6}), root, "d", known)
    assert listed(spark, root) == {"a": 6, "b": 6, "late": 1}


def test_a_log_is_folded_and_swept(spark, tmp_path):
    root, path = str(tmp_path), log.log_path(str(tmp_path), "d")
    for n in range(9):
        log.append_entries(lines(spark, {f"p{n % 4}": n, "all": n}), root, "d", fold_after=3)
        assert len(commits.generations(spark, path)) <= 4
    assert listed(spark, root) == {"p0": 8, "p1": 5, "p2": 6, "p3": 7, "all": 8}
    assert len(commits.child_folders(spark, path)) <= 8


def test_writers_side_by_side_lose_nothing(spark, tmp_path, monkeypatch):
    """Two writers take one number; a fold that saw only one of them does not stand for the other."""
    root, path = str(tmp_path), log.log_path(str(tmp_path), "d")
    log.append_entries(lines(spark, {"a": 1}), root, "d")
    monkeypatch.setattr(commits, "next_number", lambda *_: 2)
    log.append_entries(lines(spark, {"b": 1}), root, "d")
    seen = commits.generations(spark, path)
    log.append_entries(lines(spark, {"b": 2, "c": 2}, at="2024-01-02"), root, "d")
    log.fold(spark, root, "d", seen)
    assert listed(spark, root) == {"a": 1, "b": 2, "c": 2}


def test_a_torn_registry_is_not_read(spark, tmp_path):
    shape = "job string, seq bigint, ts timestamp, status string, fetched bigint, added bigint, detail string"
    runs = spark.createDataFrame([("j", n, None, "ok", 1, 1, "") for n in range(6)], shape).withColumn("ts", F.timestamp_seconds("seq"))
    base = str(tmp_path)

    def step(part):
        runs.where(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(runs.schema).parquet(f"{base}/in")
        collect.stream_job_health(stream, f"{base}/log", f"{base}/health", f"{base}/checkpoint").awaitTermination()

    step("seq < 2")
    spark.range(1).write.parquet(f"{base}/health/version=7")  # complete by its files, never by its mark
    assert collect.current_health(spark, f"{base}/health").first().runs == 2
    step("seq >= 2")
    assert collect.current_health(spark, f"{base}/health").first().runs == 6


def damaged(path, rows=200_000):
    draw = random.Random(1)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("t.csv", "a,b\n" + "".join(f"{n},{draw.random()}\n" for n in range(rows)))
    raw = bytearray(path.read_bytes())
    raw[len(raw) * 2 // 3] ^= 0xFF
    path.write_bytes(raw)


def test_a_damaged_archive_is_never_cut_short(spark, tmp_path):
    damaged(tmp_path / "bad.zip")
    assert [r.reason is None for r in dumps.zip_headers(spark, str(tmp_path)).collect()] == [True]
    (checked,) = dumps.zip_headers(spark, str(tmp_path), whole=True).collect()
    assert checked.header is None and checked.reason
    with pytest.raises(Exception, match="damaged|invalid"):
        dumps.read_zip_csv_source(spark, str(tmp_path)).count()


def test_a_damaged_archive_is_refused_and_imported_once_repaired(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    damaged(landing / "bad.zip")
    with zipfile.ZipFile(landing / "good.zip", "w") as archive:
        archive.writestr("t.csv", "a,b\n1,2\n")
    (landing / "none.zip").write_bytes(b"no archive")

    def run():
        collect.stream_bulk_import(
            spark, str(landing), None, root, "d", "scope=all", str(tmp_path / "checkpoint"), file_format="zip", quarantine_path=str(tmp_path / "refused")
        ).awaitTermination()

    run()
    reasons = spark.read.json(str(tmp_path / "refused")).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in reasons) == ["bad.zip", "none.zip"] and all(r.reason for r in reasons)
    assert [r.rows for r in ba.read_artifacts(spark, root).collect()] == [1]
    with zipfile.ZipFile(landing / "repaired.zip", "w") as archive:
        archive.writestr("t.csv", "a,b\n" + "3,4\n" * 5)
    run()
    assert sorted(r.rows for r in ba.read_artifacts(spark, root).collect()) == [1, 5]
    assert lake.read_bulk(spark, root, "d").count() == 6


def test_refused_files_get_no_record(spark, tmp_path):
    shape = (
        "seq bigint, dataset string, partition string, source_sha256 string, source_url string, source_media_type string, "
        "source_filename string, fetched_at string, license_name string, license_url string, source_path string"
    )
    files = spark.createDataFrame([(n, "d", "scope=all", f"{n}" * 64, "u", "m", f"f{n}", "2024-01-01T00:00:00Z", "", "", f"/f{n}") for n in (1, 2, 3)], shape)
    rows = spark.createDataFrame([("x", "/f1", 1)], "a string, source_path string, source_row_number bigint")
    refused = spark.createDataFrame([("/f2", "why")], "source_path string, reason string")
    result = ba.write_bulk_version(files, rows, str(tmp_path), "d", refused)
    assert (result.attempted, result.added, result.rows, result.refused) == (3, 2, 1, 1)
    assert sorted((r.source_file, r.rows) for r in ba.read_artifacts(spark, str(tmp_path)).collect()) == [("/f1", 1), ("/f3", 0)]
    more = rows.unionAll(spark.createDataFrame([("y", "/f2", 1)], rows.schema))
    again = ba.write_bulk_version(files, more, str(tmp_path), "d")
    assert (again.added, again.rows, again.refused) == (1, 1, 0)
