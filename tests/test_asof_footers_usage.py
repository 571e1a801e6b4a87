"""As-of merges, footer statistics and the live view of usage against plain versions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelake.operators import archive as ar
from tidelake.operators import bulk_archive as ba
from tidelake.operators import catalog as c
from tidelake.operators.quota import quota_admission
from tidelake.plans import asof
from tidelake.schemas import EVENT_SNAPSHOT, EVENTS_DATASET, ODDS_DATASET, ODDS_SNAPSHOT
from tidelake.sources import footers, lake
from tidelake.streaming import collect as st
from tidelake.streaming import usage as us

START = datetime(2026, 1, 1)
FACT = "key string, at timestamp, n bigint, price string"
QUOTE = "key string, seen timestamp, quote string, value bigint, at timestamp"


def sides(seed, facts=400, quotes=900):
    """Random facts and quotes with ties, nulls, repeats and one key that holds a third of all."""
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None, "only facts", "", "x" * 5000])

    def moment():
        return None if rng.random() < 0.05 else START + timedelta(minutes=rng.randrange(600))

    left = [(key(), moment(), n, "mine") for n in range(facts)]
    right = [(key(), moment(), f"q{i:04}", i, START) for i in range(quotes)]
    right = [row for row in right if row[0] != "only facts"]
    return left + left[:5], right + right[:5]


def plain(left, right, same_instant=True, within=None):
    by_key = {}
    for key, seen, quote, value, _ in right:
        if seen is not None:
            by_key.setdefault(key, []).append((seen, quote, value))
    out = []
    for key, at, n, price in left:
        held = sorted(by_key.get(key, []))
        best = None
        if at is not None:
            known = [h for h in held if h[0] < at or (same_instant and h[0] == at)]
            best = known[-1] if known else None
            if best and within is not None and at - best[0] > within:
                best = None
        out.append((key, at, n, price, best and best[1], best and best[2]))
    return out


def text(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("same_instant", [True, False])
@pytest.mark.parametrize("within", [None, timedelta(minutes=2)])
def test_as_of_merge_equals_a_search(spark, monkeypatch, same_instant, within):
    monkeypatch.setattr("tidelake.operators.skew.HEAVY_SHARE", 5)
    left, right = sides(3)
    merged = asof.as_of_merge(
        spark.createDataFrame(left, FACT), spark.createDataFrame(right, QUOTE), ["key"], "at", "seen", ["quote"],
        ["quote", "value"], same_instant=same_instant, within=within and within // timedelta(microseconds=1),
        span=30 * 60 * 1_000_000,
    )
    assert merged.columns == ["key", "at", "n", "price", "quote", "value"]
    assert text(merged.collect()) == text(plain(left, right, same_instant, within))


def test_as_of_merge_of_empty_sides(spark):
    left, right = sides(4, 20, 40)
    facts, quotes = spark.createDataFrame(left, FACT), spark.createDataFrame(right, QUOTE)
    args = (["key"], "at", "seen", ["quote"], ["quote", "value"])
    assert asof.as_of_merge(facts.limit(0), quotes, *args).count() == 0
    lone = asof.as_of_merge(facts, quotes.limit(0), *args)
    assert text(lone.collect()) == text(plain(left, []))
    assert asof.as_of_merge(facts, quotes.limit(0), *args, how="inner").count() == 0
    inner = asof.as_of_merge(facts, quotes, *args, how="inner")
    assert text(inner.collect()) == text([r for r in plain(left, right) if r[4]])


def test_as_of_merge_refuses_what_it_cannot_name(spark):
    facts, quotes = spark.createDataFrame([], FACT), spark.createDataFrame([], QUOTE)
    with pytest.raises(ValueError, match="columns named"):
        asof.as_of_merge(facts, quotes, ["key"], "at", "seen", ["quote"], ["at"])
    with pytest.raises(ValueError, match="how"):
        asof.as_of_merge(facts, quotes, ["key"], "at", "seen", ["quote"], ["quote"], how="right")


def snapshot(shape, **given):
    base = {name: "x" for name in shape.fieldNames()}
    base.update(sport="Basketball", source="feed", observed_at=START, event_ts=START)
    base.update(given)
    return tuple(base[name] for name in shape.fieldNames())


def events(spark, rows):
    return spark.createDataFrame([snapshot(EVENT_SNAPSHOT, **r) for r in rows], EVENT_SNAPSHOT)


def timed(n, days=3):
    return [
        dict(external_id=str(i), payload_hash=f"h{i}", event_ts=START + timedelta(days=i % days, minutes=7 * i % 1440, microseconds=i))
        for i in range(n)
    ]


def test_two_archives_meet_in_time(spark, tmp_path):
    root = str(tmp_path)
    ar.write_event_archive(events(spark, [dict(external_id=g, payload_hash=g, event_ts=START + timedelta(hours=5)) for g in "ab"]), root)
    quoted = [("a", 1, "p1"), ("a", 4, "p4"), ("a", 6, "too late"), ("b", 6, "too late")]
    odds = [
        snapshot(ODDS_SNAPSHOT, external_id=g, payload_hash=p, payload_json=p, observed_at=START + timedelta(hours=h)) for g, h, p in quoted
    ]
    ar.write_odds_archive(spark.createDataFrame(odds, ODDS_SNAPSHOT), root)
    games, prices = lake.read_archive(spark, root, EVENTS_DATASET), lake.read_archive(spark, root, ODDS_DATASET)
    known = asof.odds_before_events(games, prices)
    assert {r.external_id: r.odds_payload_json for r in known.collect()} == {"a": "p4", "b": None}
    assert [c for c in known.columns if not c.startswith("odds_")] == games.columns
    assert asof.odds_before_events(games, prices, how="inner").count() == 1


def test_footers_equal_a_scan_and_read_no_column(spark, tmp_path):
    root = str(tmp_path)
    ar.write_event_archive(events(spark, timed(200)), root)
    ar.write_event_archive(events(spark, timed(260, 4)), root)
    scanned = c.partition_stats(lake.read_archive(spark, root, EVENTS_DATASET))
    held = footers.footer_stats(spark, root, EVENTS_DATASET)
    assert text(held.select(scanned.columns).collect()) == text(scanned.collect())
    assert footers.footer_spans(spark, root, EVENTS_DATASET).agg(F.sum("groups_read")).first()[0] == 0
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in plan and "FileScan parquet" not in plan
    one = footers.footer_spans(spark, root, EVENTS_DATASET, where=F.col("event_date") == START.date())
    assert {r.event_date for r in one.collect()} == {START.date()}


def test_files_without_statistics_have_their_time_column_read(spark, tmp_path):
    root = str(tmp_path)
    rows = events(spark, timed(90))
    dated = rows.selectExpr("*", "'feed' AS source_slug", "'basketball' AS sport_slug", "to_date(event_ts) AS event_date")
    path = f"{root}/{EVENTS_DATASET}"
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        dated.write.partitionBy("source_slug", "sport_slug", "event_date").parquet(path)
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    far = dated.limit(1).withColumn("event_ts", F.lit("2500-01-01").cast("timestamp"))
    far.write.mode("append").partitionBy("source_slug", "sport_slug", "event_date").parquet(path)
    # Nulls only, no rows at all, and a partition without a date.
    nothing = dated.limit(3).withColumns({"event_ts": F.lit(None).cast("timestamp"), "event_date": F.lit(None).cast("date")})
    nothing.write.mode("append").partitionBy("source_slug", "sport_slug", "event_date").parquet(path)
    rows.limit(0).write.parquet(f"{path}/source_slug=feed/sport_slug=none/event_date=2026-01-09")
    archive = lake.read_archive(spark, root, EVENTS_DATASET)
    scanned = c.partition_stats(archive)
    held = footers.footer_stats(spark, root, EVENTS_DATASET)
    assert text(held.select(scanned.columns).collect()) == text(scanned.collect())
    assert footers.footer_spans(spark, root, EVENTS_DATASET).agg(F.sum("groups_read")).first()[0] > 0


def test_manifest_from_footers_after_a_refresh(spark, tmp_path):
    root, now = str(tmp_path), F.lit(START).cast("timestamp")
    ar.write_event_archive(events(spark, timed(60)), root)
    ba.write_snapshot_manifest(spark, root, EVENTS_DATASET, now)
    result = ar.write_event_archive(events(spark, timed(200, 4)), root)
    ba.refresh_snapshot_manifest(spark, root, EVENTS_DATASET, result.touched, now)
    entries = lake.read_manifest(spark, root, EVENTS_DATASET)
    rows = entries.select(F.explode(F.from_json("body", "partitions map<string, struct<rows:bigint,max_ts:string>>").partitions).alias("key", "e"))
    archive = c.partition_stats(lake.read_archive(spark, root, EVENTS_DATASET))
    expected = {(r.rows, r.max_ts.isoformat()) for r in archive.collect()}
    assert {(r.e.rows, r.e.max_ts[:26]) for r in rows.collect()} == expected


def landed(spark, path, requests):
    spark.createDataFrame(requests, "provider string, seq bigint, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def test_live_usage_closes_days_and_late_rows_stay_in_the_log(spark, tmp_path):
    base = str(tmp_path)
    rng = random.Random(5)
    everything = []

    def day(number, count, start):
        rows = [(rng.choice(["hot", "hot", "cold", None]), start + i, START + timedelta(days=number, minutes=rng.randrange(1440))) for i in range(count)]
        everything.extend(rows)
        landed(spark, f"{base}/in", rows)

    def run():
        stream = spark.readStream.schema("provider string, seq bigint, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        us.stream_usage(stream, f"{base}/usage", f"{base}/view").awaitTermination()
        st.stream_quota(stream, f"{base}/log", f"{base}/admission", 20, f"{base}/quota").awaitTermination()

    day(0, 90, 0)
    day(1, 80, 100)
    run()
    day(3, 70, 200)
    run()
    day(0, 6, 300)  # Day 0 is closed by now.
    day(5, 5, 400)
    run()
    view, log = spark.read.parquet(f"{base}/usage"), spark.read.parquet(f"{base}/log")
    counts = {}
    for provider, seq, ts in everything:
        counts.setdefault((provider, ts.date()), []).append(seq)
    published = {(r.provider, r.day): r.requests for r in view.collect()}
    assert published == {k: sum(s < 300 for s in v) for k, v in counts.items() if k[1] < (START + timedelta(days=4)).date()}
    sofar = {(r.provider, r.day): r.requests for r in us.usage_so_far(view, log).collect()}
    assert sofar == {k: len(v) for k, v in counts.items()}
    late = {(r.provider, r.day): r.requests - r.published for r in us.late_usage(view, log).collect()}
    assert late == {k: n for k, v in counts.items() if (n := sum(300 <= s < 400 for s in v))}
    # The whole log's admission is what the budget stream has decided batch by batch.
    decided = spark.read.parquet(f"{base}/admission").select("provider", "seq", "claim")
    again = quota_admission(log.drop("day", "batch"), 20).select("provider", "seq", "claim")
    assert text(decided.collect()) == text(again.collect())
