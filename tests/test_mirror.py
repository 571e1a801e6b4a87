"""Mirror decisions, restores and work lists."""

import pytest
from pyspark.sql import functions as F

from tidelake.operators import fetch as fe
from tidelake.operators import mirror as mi
from tidelake.plans import worklists as w

FILE = "key string, size bigint, dataset string, is_source boolean, is_parquet boolean, digest string, rows bigint"
OBJECT = "key string, digest string, rows bigint"
FILES = [
    ("d/v/source-a.csv", 10, "d", True, False, "aaaa", None),
    ("d/v/data.parquet", 20, "d", False, True, "bbbb", 5),
    ("statsbomb_matches/v/source-m.json", 30, "statsbomb_matches", True, False, "cccc", None),
    ("d/w/source-big.csv", 101, "d", True, False, "dddd", None),
]
EQUAL = [(k, d, r) for k, _, _, _, _, d, r in FILES]


def decide(spark, before, after, limit=100, **options):
    files = spark.createDataFrame(FILES, FILE)
    objects = lambda rows: spark.createDataFrame(rows, OBJECT)
    outcomes = mi.sync_outcomes(files, objects(before), objects(after), limit=limit, **options)
    return outcomes, {r.key: (r.status, r.detail, r.freed_bytes) for r in outcomes.collect()}


def test_a_first_run_uploads_everything_but_the_oversize(spark):
    outcomes, found = decide(spark, [], EQUAL)
    assert [found[k][0] for k, *_ in FILES] == ["uploaded", "uploaded", "uploaded", "oversize"]
    totals = mi.sync_summary(outcomes).first().asDict()
    assert totals == {
        "ok": False, "scanned": 4, "uploaded": 3, "already_present": 0, "verified": 3, "pruned": 0, "planned": 0, "freed_bytes": 0, "failures": 1,
    }


def test_size_at_the_limit_is_allowed(spark):
    _, found = decide(spark, [], EQUAL, limit=101)
    assert found["d/w/source-big.csv"][0] == "uploaded"


def test_prune_takes_verified_sources_only(spark):
    outcomes, found = decide(spark, EQUAL[:1], EQUAL, prune=True)
    assert found["d/v/source-a.csv"] == ("pruned", "already-present", 10)
    assert found["d/v/data.parquet"][0] == "uploaded"
    assert found["statsbomb_matches/v/source-m.json"][0] == "uploaded"
    assert mi.sync_summary(outcomes).first().freed_bytes == 10


def test_a_damaged_copy_is_never_pruned_even_if_it_was_there_before(spark):
    damaged = [("d/v/source-a.csv", "tampered", None), *EQUAL[1:]]
    _, found = decide(spark, EQUAL, damaged, prune=True)
    assert found["d/v/source-a.csv"][0] == "failed" and found["d/v/source-a.csv"][2] == 0
    _, found = decide(spark, EQUAL, damaged)
    assert found["d/v/source-a.csv"] == ("present", "", 0)


def test_parquet_must_match_in_rows_and_missing_copies_fail(spark):
    _, found = decide(spark, [], [EQUAL[0], ("d/v/data.parquet", "bbbb", 4)])
    assert found["d/v/data.parquet"][:2] == ("failed", "row counts differ: local 5, mirror 4")
    assert found["statsbomb_matches/v/source-m.json"][:2] == ("failed", "no copy in the mirror")


def test_dry_run_plans_without_verifying(spark):
    outcomes, found = decide(spark, EQUAL[:2], [], prune=True, dry_run=True)
    assert found["d/v/source-a.csv"] == ("would-prune", "present", 10)
    assert found["d/v/data.parquet"] == ("present", "", 0)
    assert found["statsbomb_matches/v/source-m.json"] == ("would-upload", "absent", 0)
    assert mi.sync_summary(outcomes).first().planned == 2 and mi.sync_summary(outcomes).first().freed_bytes == 0


ARTIFACT = "dataset string, partition string, source_sha256 string, source_file string, source_pruned boolean, source_remote_key string"


def test_restore_checks_the_recorded_hash_and_clears_the_flags(spark):
    rows = [
        ("d", "p", "h1", "f1", True, "f1"), ("d", "p", "h2", "f2", True, None), ("d", "p", "h3", "f3", True, "gone"),
        ("d", "p", "", "f4", True, "f4"), ("d", "p", "h5", "f5", None, None),
    ]
    artifacts = spark.createDataFrame(rows, ARTIFACT)
    mirror = spark.createDataFrame([("f1", "h1", None), ("f2", "other", None), ("f4", "any", None)], OBJECT)
    plan = mi.restore_plan(artifacts, mirror)
    assert {r.source_file: r.status for r in plan.collect()} == {"f1": "restored", "f2": "failed", "f3": "failed", "f4": "restored"}
    cleared = {r.source_file: (r.source_pruned, r.source_remote_key) for r in mi.clear_restored(artifacts, plan).collect()}
    assert cleared == {"f1": (None, None), "f2": (True, None), "f3": (True, "gone"), "f4": (None, None), "f5": (None, None)}


def test_source_state_consults_the_record_beside_the_data(spark):
    catalogued = spark.createDataFrame(
        [("d", "p", "h", f, False, None) for f in ("here", "beside", "lost")] + [("d", "p", "h", "noted", True, "k")], ARTIFACT
    )
    beside = spark.createDataFrame([("beside", True, None)], "source_file string, source_pruned boolean, source_remote_key string")
    inventory = spark.createDataFrame([("here",)], "key string")
    states = {r.source_file: (r.state, r.restore_from) for r in mi.source_state(catalogued, beside, inventory).collect()}
    assert states == {"here": ("present", None), "beside": ("pruned", "the mirror"), "lost": ("missing", None), "noted": ("pruned", "k")}


@pytest.mark.parametrize(
    "status, offset, length, kind, decision",
    [
        (304, 0, 0, None, "reuse"), (200, 0, 10, "text/csv", "accept"), (206, 5, 10, "text/csv", "append"), (206, 0, 10, "text/csv", "accept"),
        (200, 95, 10, "text/csv", "accept"), (206, 95, 10, "text/csv", "reject-size"), (200, 0, 101, "text/csv", "reject-size"),
        (200, 0, 10, "text/html; charset=utf-8", "reject-html"), (500, 0, 0, None, "reject-status"),
    ],
)
def test_fetch_rules(spark, status, offset, length, kind, decision):
    shape = "url string, status_code int, offset bigint, content_length bigint, received bigint, content_type string"
    fetches = spark.createDataFrame([("u", status, offset, length, length, kind)], shape)
    staged = spark.createDataFrame([("u", "abc")], "url string, sha256 string")
    row = fe.fetch_audit(fetches, staged, max_bytes=100).first()
    assert row.decision == decision and (row.reused_sha256 == "abc") == (decision == "reuse")


def test_season_league_worklist(spark):
    df = spark.createDataFrame([(2024, 2025, " e0,E0, d1")], "from_year int, to_year int, leagues string")
    rows = w.season_league_worklist(df).orderBy("start_year", "position").collect()
    assert [r.partition for r in rows] == [f"league={code}/season={s}" for s in ("2425", "2526") for code in ("E0", "D1")]
    assert rows[0].url == "https://www.football-data.co.uk/mmz4281/2425/E0.csv"
    early = w.season_league_worklist(spark.createDataFrame([(1989, 1990, "E0")], df.schema)).orderBy("start_year").collect()
    assert [(r.reject_reason, r.partition) for r in early] == [("no two-digit season starts in 1989", None), (None, "league=E0/season=9091")]
    for bad in ((2025, 2024, "E0"), (2024, 2024, ",")):
        with pytest.raises(Exception, match="range|league"):
            w.season_league_worklist(spark.createDataFrame([bad], df.schema)).collect()


def test_only_the_request_that_is_too_long_is_refused(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, DATE'2026-07-01', DATE'2026-07-03'), (2, DATE'2026-01-01', DATE'2026-12-31') AS t(id, from_day, to_day)")
    refused = w.day_worklist(rows, max_days=31)
    assert [(r.id, r.reject_reason) for r in refused.where("day IS NULL").collect()] == [(2, "more days than 31")]
    assert refused.where("id = 1 AND reject_reason IS NULL").count() == 3
    assert w.day_worklist(rows).count() == 368


def test_first_matches_in_list_order(spark):
    df = spark.createDataFrame([("1", "2", p, str(100 - p)) for p in range(5)], "competition_id string, season_id string, position int, match_id string")
    rows = w.match_event_worklist(df, 2).orderBy("position").collect()
    assert [r.partition for r in rows] == [f"competition_id=1/season_id=2/match_id={m}" for m in (100, 99)]
    assert w.match_event_worklist(df).count() == 5


def test_later_quotes_do_not_leak(spark):
    from tidelake.plans.reads import odds_as_of

    rows = [("e", "2026-01-01", "a"), ("e", "2026-01-02", "b"), ("e", "2026-01-03 00:00:01", "c")]
    odds = spark.createDataFrame(rows, "external_id string, t string, payload_hash string").select(
        F.lit("s").alias("source"), "external_id", F.lit("h2h").alias("market"), F.to_timestamp("t").alias("observed_at"),
        F.lit("2026-01-03").cast("timestamp").alias("event_ts"), "payload_hash",
    )
    assert [r.payload_hash for r in odds_as_of(odds).collect()] == ["b"]


@pytest.mark.parametrize("share", [1, 10_000])
def test_movement_carries_across_spans(spark, monkeypatch, share):
    from tidelake.operators import skew
    from tidelake.plans.reads import HOUR, line_movement

    monkeypatch.setattr(skew, "HEAVY_SHARE", share)
    quotes = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))).alias("k"),
        F.timestamp_seconds(F.col("id") * 700).alias("at"), "id", (F.col("id") * 37 % 101).alias("price"),
    )
    last, count, expected = {}, {}, {}
    for r in quotes.orderBy("id").collect():
        count[r.k] = count.get(r.k, 0) + 1
        expected[r.id] = (count[r.k], last.get(r.k))
        last[r.k] = r.price
    found = line_movement(quotes, ["k"], ["at", "id"], span=HOUR)
    assert {r.id: (r.quote, r.previous_price) for r in found.collect()} == expected
