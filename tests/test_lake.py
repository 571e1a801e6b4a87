"""Archives, manifests, dumps and imports on small files."""

import hashlib
import json
import zipfile
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelake.operators import archive as ar
from tidelake.operators import bulk as b
from tidelake.operators import bulk_archive as ba
from tidelake.operators import catalog as c
from tidelake.operators import merge as m
from tidelake.operators import normalize as n
from tidelake.schemas import BULK_KEY, EVENT_SNAPSHOT, EVENTS_DATASET
from tidelake.sources import dumps as du
from tidelake.sources import lake
from tidelake.streaming import collect as st

SEEN = datetime(2026, 7, 10, 12)


def now():
    return F.lit("2026-07-11").cast("timestamp")


def event(status="NS", day="2026-07-10", number=1, sport="Ice Hockey"):
    return {"idEvent": str(number), "strEvent": "Reds vs Blues", "strSport": sport, "dateEvent": day, "strStatus": status}


def snapshots(spark, *items, seen=SEEN):
    rows = [(json.dumps(i), seen, k) for k, i in enumerate(items)]
    return n.accepted(n.normalize_thesportsdb(spark.createDataFrame(rows, "payload string, observed_at timestamp, k int")))


def test_a_repeated_snapshot_adds_nothing_and_a_changed_one_is_kept(spark, tmp_path):
    root = str(tmp_path)
    first = ar.write_event_archive(snapshots(spark, event()), root)
    assert (first.received, first.added) == (1, 1)
    again = ar.write_event_archive(snapshots(spark, event(), event(), seen=SEEN + timedelta(days=1)), root)
    assert (again.received, again.added) == (2, 0)
    final = ar.write_event_archive(snapshots(spark, event("FT")), root)
    assert final.added == 1
    rows = lake.read_archive(spark, root, EVENTS_DATASET).collect()
    assert sorted(r.status for r in rows) == ["final", "scheduled"]
    assert {r.observed_at for r in rows if r.status == "scheduled"} == {SEEN}
    assert rows[0].sport == "Ice Hockey" and rows[0].sport_slug == "ice-hockey"


def test_nothing_in_nothing_out(spark, tmp_path):
    result = ar.write_event_archive(snapshots(spark, event()).limit(0), str(tmp_path / "none"))
    assert (result.received, result.added) == (0, 0)
    assert not (tmp_path / "none").exists()


def test_files_are_zstandard_sorted_and_one_per_partition(spark, tmp_path):
    items = [event(number=i, day=f"2026-07-{10 + i % 2}") for i in range(40)]
    ar.write_event_archive(snapshots(spark, *items), str(tmp_path))
    files = sorted((tmp_path / EVENTS_DATASET).rglob("*.parquet"))
    assert len(files) == 2
    for file in files:
        meta = pq.ParquetFile(file).metadata
        assert meta.row_group(0).column(0).compression == "ZSTD"
        ids = pq.ParquetFile(file).read(["external_id"]).column(0).to_pylist()
        assert ids == sorted(ids)


def test_a_write_reads_only_touched_days(spark, tmp_path):
    items = [event(number=i, day=f"2026-07-{10 + i}") for i in range(8)]
    ar.write_event_archive(snapshots(spark, *items), str(tmp_path))
    incoming = m.add_partition_columns(snapshots(spark, event("FT", day="2026-07-12")))
    near = lake.read_archive(spark, str(tmp_path), EVENTS_DATASET).where(ar.near_partitions(incoming))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert near.count() == 1


def test_verification_notices_missing_and_repeated_keys(spark, tmp_path):
    ar.write_event_archive(snapshots(spark, event()), str(tmp_path))
    archive = lake.read_archive(spark, str(tmp_path), EVENTS_DATASET)
    more = m.add_partition_columns(snapshots(spark, event(), event(number=2)))
    with pytest.raises(ar.VerificationError, match="1 keys missing"):
        ar.verify_stored(more, archive)
    with pytest.raises(ar.VerificationError, match="1 stored more than once"):
        ar.verify_stored(archive, archive.union(archive))


def test_a_lake_in_the_plain_layout_is_read_by_its_data(spark, tmp_path):
    """Directories named after data columns, and a column that is null throughout a file."""
    for sport, day, venue in (("Ice Hockey", 10, None), ("Soccer", 11, "Park")):
        folder = tmp_path / EVENTS_DATASET / "source=thesportsdb" / f"sport={sport.lower().replace(' ', '-')}" / f"event_date=2026-07-{day}"
        folder.mkdir(parents=True)
        at = datetime(2026, 7, day)
        row = {f.name: "x" for f in EVENT_SNAPSHOT.fields} | {"sport": sport, "source": "thesportsdb", "venue": venue}
        utc = pa.timestamp("us", tz="UTC")
        table = pa.Table.from_pylist([row]).drop(["observed_at", "event_ts"])
        for name in ("observed_at", "event_ts"):
            table = table.append_column(name, pa.array([at], utc))
        pq.write_table(table, folder / "events.parquet")
    rows = lake.read_plain_archive(spark, str(tmp_path), EVENTS_DATASET).orderBy("event_ts").collect()
    assert [(r.sport, r.sport_slug, r.venue) for r in rows] == [("Ice Hockey", "ice-hockey", None), ("Soccer", "soccer", "Park")]


# ------------------------------------------------------------------- manifests


def test_manifests_are_rebuilt_valid_and_the_same(spark, tmp_path):
    root = str(tmp_path)
    ar.write_event_archive(snapshots(spark, event(), event(number=2), event(day="2026-07-11")), root)
    assert ba.rebuild_catalogs(spark, root, now()) == [EVENTS_DATASET]
    once = sorted(r.body for r in lake.read_manifest(spark, root, EVENTS_DATASET).collect())
    ba.rebuild_catalogs(spark, root, now())
    bodies = lake.read_manifest(spark, root, EVENTS_DATASET)
    assert sorted(r.body for r in bodies.collect()) == once
    assert c.validate_manifest(bodies).count() == 0
    entries = {k: v for body in once for k, v in json.loads(body)["partitions"].items()}
    assert entries["sports_events/source_slug=thesportsdb/sport_slug=ice-hockey/event_date=2026-07-10"] == {
        "rows": 2, "min_ts": "2026-07-10T00:00:00+00:00", "max_ts": "2026-07-10T00:00:00+00:00", "updated_at": "2026-07-11T00:00:00+00:00",
    }


def test_manifest_violations(spark):
    good = {
        "dataset": "d", "schema_version": 1, "ts_column": "t", "key_columns": [], "schema": {}, "updated_at": "x",
        "partitions": {"p": {"rows": 1, "min_ts": "", "max_ts": "", "updated_at": ""}},
    }
    old = {k: v for k, v in good.items() if k != "ts_column"} | {"timestamp_column": "t"}
    cases = [good, old, good | {"partitions": [1]}, good | {"partitions": {"p": {"rows": 1}, "q": 3}}]
    df = spark.createDataFrame([(json.dumps(x),) for x in cases], "body string")
    found = {(r.partition, r.problem, r["keys"]) for r in c.validate_manifest(df).collect()}
    assert found == {
        (None, "missing manifest keys", "ts_column"),
        (None, "partitions is not a mapping", "partitions"),
        ("p", "missing partition keys", "max_ts,min_ts,updated_at"),
        ("q", "partition is not a mapping", "max_ts,min_ts,rows,updated_at"),
    }


def test_unreadable_manifests_give_no_rows(spark, tmp_path):
    (tmp_path / "_catalog").mkdir()
    for name, text in (("bad", "{"), ("list", "[1]"), ("good", '{\n "dataset": "good"\n}')):
        (tmp_path / "_catalog" / f"{name}.json").write_text(text)
    counts = [lake.read_manifest(spark, str(tmp_path), d).count() for d in ("bad", "list", "good", "absent")]
    assert counts == [0, 0, 1, 0]


def test_inventory_skips_unfinished_files(spark, tmp_path):
    for name in ("_staging/x/abc.part", "d/a.parquet", "d/a.parquet.tmp", "d/v/source-b.json", "_catalog/d.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("xx")
    found = {r.key: (r.size, r.dataset, r.is_source, r.is_parquet) for r in lake.scan_inventory(spark, str(tmp_path)).collect()}
    # Spark itself skips names that start with an underscore, the catalog and the staging area among them.
    assert found.items() >= {"d/a.parquet": (2, "d", False, True), "d/v/source-b.json": (2, "d", True, False)}.items()
    assert not any(k.endswith((".tmp", ".part")) for k in found)


# ----------------------------------------------------------------------- dumps


def numbered(df, *columns):
    return [tuple(r[c] for c in (*columns, "source_row_number")) for r in df.orderBy("source_path", "source_row_number").collect()]


def test_csv_is_text_with_nulls_and_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "e0.csv").write_bytes("﻿Div,Date,FTHG\nE0,10/07/2026,04\nE0,NA,NULL\nE0,\"a, \"\"b\"\"\",n/a\n".encode())
    df = du.read_csv_source(spark, str(tmp_path))
    assert numbered(df, "Div", "Date", "FTHG") == [("E0", "10/07/2026", "04", 0), ("E0", None, None, 1), ("E0", 'a, "b"', None, 2)]


def test_csv_rows_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("n\n" + "\n".join(f"r{i}" for i in range(50_000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = du.read_csv_source(spark, str(tmp_path))
        assert df.where(F.concat(F.lit("r"), F.col("source_row_number").cast("string")) == F.col("n")).count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ragged_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        du.read_csv_source(spark, str(tmp_path)).collect()


def test_an_empty_csv_has_only_positions(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    df = du.read_csv_source(spark, str(tmp_path))
    assert df.columns == ["source_path", "source_row_number"] and df.count() == 0


def archive_of(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "."), text)


def test_zip_holds_exactly_one_csv(spark, tmp_path):
    archive_of(tmp_path / "ok.zip", shots__csv="﻿shotID,xGoal\n1,0.5\n\n2,NA\n", notes__txt="x")
    assert numbered(du.read_zip_csv_source(spark, str(tmp_path)), "shotID", "xGoal") == [("1", "0.5", 0), ("2", None, 1)]
    archive_of(tmp_path / "two.zip", a__csv="x\n1\n", b__csv="x\n1\n")
    (tmp_path / "broken.zip").write_bytes(b"PK")
    # A refused archive costs its own rows only, and is named with the reason.
    assert numbered(du.read_zip_csv_source(spark, str(tmp_path)), "shotID") == [("1", 0), ("2", 1)]
    refused = {r.path.rsplit("/", 1)[-1]: r.reason for r in du.zip_headers(spark, str(tmp_path)).where("reason IS NOT NULL").collect()}
    assert refused["two.zip"] == "holds 2 CSV tables instead of one" and "broken.zip" in refused
    small = {r.reason for r in du.zip_headers(spark, str(tmp_path / "ok.zip"), max_bytes=5).collect()}
    assert small == {"unpacks to 28 bytes, more than 5"}


def test_archives_of_three_headers_are_each_unpacked_once(spark, tmp_path):
    for k, text in enumerate(("a,b\n1,2\n", "b,c,a\n3,4,5\n", "d\n6\n")):
        archive_of(tmp_path / f"{k}.zip", t__csv=text)
    rows = du.read_zip_csv_source(spark, str(tmp_path))
    assert numbered(rows, "a", "b", "c", "d") == [("1", "2", None, None, 0), ("5", "3", "4", None, 0), (None, None, None, "6", 0)]
    assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_splits_share_no_row_and_lose_none(spark, tmp_path):
    text = "k,v\r\n" + "".join(f"{i},{'x' * (i % 37)}\r\n" for i in range(3_000)) + "last,line"
    (tmp_path / "s.csv").write_text(text, newline="")
    for size in (1_000, 4_097, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            rows = du.read_csv_source(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted((r.source_row_number, r.k) for r in rows) == [(i, str(i)) for i in range(3_000)] + [(3_000, "last")]


def test_parquet_seasons_of_three_generations(spark, tmp_path):
    pq.write_table(pa.table({"season": [2001], "yards": pa.array([3], pa.int32())}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"season": [2002], "yards": [3.5], "extra": ["x"]}), tmp_path / "2.parquet")
    pq.write_table(pa.table({"season": [2003]}), tmp_path / "3.parquet")
    rows = du.read_parquet_source(spark, str(tmp_path))
    assert numbered(rows, "season", "yards", "extra") == [(2001, 3.0, None, 0), (2002, 3.5, "x", 0), (2003, None, None, 0)]
    assert du.common_types([spark.sql("SELECT 1L AS a").schema, spark.sql("SELECT 1D AS a").schema]) == {"a": "string"}


def test_json_lists(spark, tmp_path):
    items = [{"match_id": 7, "b": 1.0}, {"x": "é"}, {"match_id": None, "token": "kept"}]
    (tmp_path / "m.json").write_bytes(("﻿" + json.dumps(items, ensure_ascii=False)).encode())
    rows = numbered(du.read_json_list_source(spark, str(tmp_path / "m.json"), "match_id"), "external_id", "payload_json")
    assert rows == [(i, json.dumps(x, sort_keys=True, separators=(",", ":")), k) for k, (i, x) in enumerate(zip(["7", "1", "None"], items))]
    for text, why in (('{"a":1}', "expected a JSON list"), ("[1]", "to be an object")):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(Exception, match=why):
            du.read_json_list_source(spark, str(tmp_path / "bad.json"), "id").collect()


def test_parquet_keeps_types_and_schema_union_takes_the_first(spark, tmp_path):
    pq.write_table(pa.table({"game_id": ["a", "b"], "yards": [1.5, 2.5]}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"game_id": ["c"], "yards": [3], "extra": [True]}), tmp_path / "2.parquet")
    rows = du.read_parquet_source(spark, str(tmp_path / "1.parquet"))
    assert rows.schema["yards"].dataType.typeName() == "double" and numbered(rows, "game_id") == [("a", 0), ("b", 1)]
    union = {r.name: r.type for r in c.schema_union(du.parquet_columns(spark, str(tmp_path))).collect()}
    assert union["yards"] == "double" and union["extra"] == "bool"
    counts = {r.key: r.rows for r in lake.scan_parquet_rows(spark, str(tmp_path)).collect()}
    assert counts == {"1.parquet": 2, "2.parquet": 1}


# --------------------------------------------------------------------- imports


def import_files(spark, root, *files):
    """files: (name, season, content rows)"""
    described, rows = [], []
    for k, (name, season, content) in enumerate(files):
        sha = hashlib.sha256("\n".join(content).encode()).hexdigest()
        described.append((k, "shots", f"season={season}", sha, "u", "text/csv", name, "2026-07-10T00:00:00+00:00", "l", "u", name))
        rows += [(name, value, sha, i, SEEN) for i, value in enumerate(content)]
    shape = "seq int, dataset string, partition string, source_sha256 string, source_url string, source_media_type string, source_filename string, fetched_at string, license_name string, license_url string, source_path string"
    data = spark.createDataFrame(rows, "source_path string, value string, source_sha256 string, source_row_number bigint, source_fetched_at timestamp")
    return ba.write_bulk_version(spark.createDataFrame(described, shape), data, root, "shots")


def test_versions_are_immutable_and_counted_once(spark, tmp_path):
    root = str(tmp_path)
    first = import_files(spark, root, ("a b.csv", "2025", ["x", "y"]), ("copy.csv", "2025", ["x", "y"]), ("c.csv", "2026", ["x", "y"]))
    assert (first.attempted, first.added, first.rows) == (3, 2, 4)
    again = import_files(spark, root, ("a b.csv", "2025", ["x", "y"]), ("d.csv", "2025", ["z"]))
    assert (again.attempted, again.added, again.rows) == (2, 1, 1)
    records = {r.source_file: r for r in ba.read_artifacts(spark, root).collect()}
    assert {k: r.rows for k, r in records.items()} == {"a b.csv": 2, "c.csv": 2, "d.csv": 1}
    assert sorted(r.part_season for r in lake.read_bulk(spark, root, "shots").collect()) == ["2025"] * 3 + ["2026"] * 2
    assert ba.rebuild_catalogs(spark, root, now()) == ["shots"]
    bodies = lake.read_manifest(spark, root, "shots")
    assert c.validate_manifest(bodies).count() == 0
    manifest = json.loads(bodies.first().body)
    assert manifest["key_columns"] == BULK_KEY and manifest["ts_column"] == "source_fetched_at"


def test_an_import_that_died_before_its_record_is_repeated_without_copies(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(ba, "write_provenance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            import_files(spark, root, ("a.csv", "2025", ["x", "y"]))
    assert import_files(spark, root, ("a.csv", "2025", ["x", "y"])).added == 1
    assert lake.read_bulk(spark, root, "shots").count() == 2


def test_stored_artifacts_need_their_data_file(spark):
    shape = "dataset string, partition string, source_sha256 string, data_file string"
    recorded = spark.createDataFrame([("d", "p", "s1", "f1"), ("d", "p", "s2", "f2")], shape)
    present = spark.createDataFrame([("f1",)], "key string")
    incoming = spark.createDataFrame([(k, "src", "d", "p", s, 5) for k, s in enumerate(["s1", "s2", "s2"])], "seq int, source string, dataset string, partition string, source_sha256 string, rows bigint")
    results = b.import_results(incoming, b.stored_artifacts(recorded, present))
    assert [(r.rows, r.added) for r in results.orderBy("seq").collect()] == [(0, False), (5, True), (0, False)]
    assert b.import_summary(results).first().asDict() == {"source": "src", "attempted": 3, "added": 1, "rows": 5}


def test_refused_responses_are_kept_apart_from_the_stream(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps({"events": [event(), {"idEvent": "2"}]}))
    (landing / "2.json").write_text("<html>")
    for _ in range(2):
        st.stream_event_archive(
            spark, str(landing), "thesportsdb", str(tmp_path / "lake"), str(tmp_path / "check"), quarantine_path=str(tmp_path / "refused")
        ).awaitTermination()
    assert lake.read_archive(spark, str(tmp_path / "lake"), EVENTS_DATASET).count() == 1
    reasons = sorted(r.reject_reason for r in spark.read.json(str(tmp_path / "refused")).collect())
    assert reasons == ["missing strEvent", "response is not JSON"]


def test_provenance_records_are_found_below_the_root(spark, tmp_path):
    for folder, text in (("d/season=1/version=a", '{"dataset":"d","rows":3,\n"source_pruned":true}'), ("d/season=2/version=b", "{"), ("e/version=c", "[]")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "provenance.json").write_text(text)
    rows = lake.read_provenance(spark, str(tmp_path)).collect()
    assert [(r.record_key, r.dataset, r.rows, r.source_pruned) for r in rows] == [("d/season=1/version=a/provenance.json", "d", 3, True)]
    names = c.bulk_datasets(lake.scan_files(spark, str(tmp_path)).where("key like '%/provenance.json'")).collect()
    assert [r.dataset for r in names] == ["d", "e"]


def test_landed_responses_are_read_with_their_mark_and_time(spark, tmp_path):
    from tidelake.sources.envelopes import envelope_items, read_landed

    body = json.dumps({"events": [event(), event(number=2)]}, indent=1)
    (tmp_path / "a.json").write_bytes(("\ufeff" + body).encode())
    items = envelope_items(read_landed(spark, str(tmp_path)), "thesportsdb")
    rows = n.accepted(n.normalize_thesportsdb(items)).orderBy("external_id").collect()
    assert [(r.external_id, r.position) for r in rows] == [("1", 0), ("2", 1)]
    assert rows[0].observed_at.year >= 2024 and rows[0].path.endswith("a.json")


def test_an_engine_written_lake_passes_its_own_audits(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert import_files(spark, root, ("a.csv", "2025", ["x", "y"]), ("b.csv", "2026", ["z"])).added == 2
    records = ba.current_artifacts(ba.read_artifacts(spark, root))
    folders = {r.data_file for r in ba.stored_folders(spark, root, "shots").collect()}
    assert {r.data_file for r in records.collect()} == folders and len(folders) == 2
    beside = lake.read_provenance(spark, root)
    assert {(r.partition, r.rows) for r in beside.collect()} == {("season=2025", 2), ("season=2026", 1)}
    assert {r.record_key.rsplit("/", 1)[0] for r in beside.collect()} == folders
    # A record whose folder never landed, or was lost, does not keep its content from being imported.
    lost = records.where("partition = 'season=2025'").withColumn("partition", F.lit("season=2027")).withColumn(
        "data_file", F.lit("shots/part_season=2027/version=0")
    )
    lost.drop("generation").write.mode("append").parquet(f"{root}/{ba.ARTIFACTS_TABLE}")
    assert import_files(spark, root, ("a.csv", "2027", ["x", "y"])).added == 1
    assert import_files(spark, root, ("a.csv", "2027", ["x", "y"])).added == 0


def test_contents_that_share_a_version_folder_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ba, "version_of", lambda sha: F.lit("same"))
    with pytest.raises(ba.VerificationError, match="share a version folder"):
        import_files(spark, str(tmp_path), ("a.csv", "2025", ["x"]), ("b.csv", "2025", ["y"]))


def test_flags_are_stored_as_a_new_generation(spark, tmp_path):
    root = str(tmp_path)
    import_files(spark, root, ("a.csv", "2025", ["x"]), ("b.csv", "2026", ["y"]))
    known = ba.current_artifacts(ba.read_artifacts(spark, root))
    pruned = known.withColumn("source_pruned", F.when(F.col("partition") == "season=2025", True)).withColumn("source_remote_key", F.lit(None).cast("string"))
    assert ba.write_flags(pruned, root) == 1 and ba.write_flags(pruned, root) == 0
    now = ba.current_artifacts(ba.read_artifacts(spark, root))
    assert {r.partition: r.source_pruned for r in now.collect()} == {"season=2025": True, "season=2026": None}


def test_manifests_of_drifting_versions(spark, tmp_path):
    shape = "seq string, dataset string, partition string, source_sha256 string, source_url string, source_media_type string, source_filename string, fetched_at string, license_name string, license_url string, source_path string"
    for k, value in enumerate((F.lit(1), F.lit(1.5), F.lit(2))):
        row = (f"{k}", "d", "scope=all", f"{k}" * 64, "", "", "f", "2026-01-01T00:00:00+00:00", "", "", f"p{k}")
        rows = spark.range(1).select(value.alias("v"), F.lit(f"p{k}").alias("source_path"), F.lit(f"{k}" * 64).alias("source_sha256"), F.lit(0).cast("bigint").alias("source_row_number"), now().alias("source_fetched_at"))
        ba.write_bulk_version(spark.createDataFrame([row], shape), rows, str(tmp_path), "d")
    assert ba.rebuild_catalogs(spark, str(tmp_path), now()) == ["d"]
    schema = json.loads(lake.read_manifest(spark, str(tmp_path), "d").first().body)["schema"]
    assert schema["v"] in ("int32", "double") and schema["source_row_number"] == "int64" and "version" not in schema
    assert sorted(r.v for r in lake.read_bulk(spark, str(tmp_path), "d").collect()) == [1.0, 1.5, 2.0]


def test_an_outlier_date_costs_two_partitions_not_the_span(spark, tmp_path):
    root = str(tmp_path)
    days = [f"2026-03-{d:02d}" for d in range(1, 29)]
    ar.write_event_archive(snapshots(spark, *[event(day=day, number=k, sport="Soccer") for k, day in enumerate(days)]), root)
    parts = spark.createDataFrame([("thesportsdb", "soccer", d) for d in ("1990-01-01", "2026-03-05")], "source_slug string, sport_slug string, event_date string").withColumn("event_date", F.to_date("event_date"))
    near = ar.near_partitions(parts)
    read = lake.read_archive(spark, root, EVENTS_DATASET).where(near)
    assert [str(r.event_date) for r in read.select("event_date").distinct().collect()] == ["2026-03-05"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan
    scoped = n.provider_scope(lake.read_archive(spark, root, EVENTS_DATASET), sport="Soccer")
    assert "PartitionFilters: [isnotnull(sport_slug" in scoped._jdf.queryExecution().executedPlan().toString()


def test_a_new_checkpoint_keeps_every_log_row(spark, tmp_path):
    shape = "job string, seq bigint, ts timestamp, status string, fetched bigint, added bigint, detail string"
    for turn in range(2):
        rows = [(None if k % 5 == 0 else f"j{k % 3}", turn * 50 + k, SEEN, "ok", 1, 1, "") for k in range(50)]
        spark.createDataFrame(rows, shape).write.parquet(str(tmp_path / f"in{turn}"))
        log = spark.readStream.schema(shape).parquet(str(tmp_path / f"in{turn}"))
        st.stream_job_health(log, str(tmp_path / "log"), str(tmp_path / "health"), str(tmp_path / f"check{turn}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 100
    runs = {r.job: r.runs for r in st.current_health(spark, str(tmp_path / "health")).collect()}
    assert sum(runs.values()) == 100 and runs[None] == 20


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tidelake import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else None

    class Fake:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_writes_feed_the_ingest_summary(spark, tmp_path):
    from tidelake.operators.ingest import ingest_rows, ingest_summary, touched_partitions

    first = ar.write_event_archive(snapshots(spark, event(), event(), event(number=2)), str(tmp_path))
    second = ar.write_event_archive(snapshots(spark, event(), event(number=3, day="2026-07-11")), str(tmp_path))
    rows = [ingest_rows(w.touched, EVENTS_DATASET, F.lit(f"2026-07-1{k}").cast("date")) for k, w in enumerate((first, second))]
    total = ingest_summary(rows[0].unionByName(rows[1])).first()
    assert (total.days, total.snapshots_fetched, total.snapshots_added, total.partitions) == (2, 4, 3, 2)
    assert touched_partitions(*rows).count() == 2 and (first.received, second.received) == (3, 2)
