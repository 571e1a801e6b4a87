"""Health, streaks, budgets and pacing against plain sequential folds, hot keys included."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelake.functions.status import health_status
from tidelake.functions.times import age_text
from tidelake.operators import health as h
from tidelake.operators import quota as q
from tidelake.operators import skew

START = datetime(2026, 1, 1)
RUN = "job string, seq bigint, ts timestamp, status string, fetched bigint, added bigint, detail string"


def run_log(seed, jobs=12, rows=900):
    """Random runs of which one job holds a third."""
    rng = random.Random(seed)
    log = []
    for seq in range(rows):
        job = "hot" if rng.random() < 0.33 else f"job{rng.randrange(jobs)}"
        status = rng.choices(["ok", "partial", "error", "skipped"], [4, 2, 3, 1])[0]
        log.append((job, seq, START + timedelta(minutes=seq), status, rng.randrange(5), rng.choice([0, 0, 1]), rng.choice(["", f"d{seq}"])))
    log.append(("only-skipped", rows, START, "skipped", 0, 0, "no key"))
    return log


def sequential_fold(log):
    state = {}
    for job, seq, ts, status, fetched, added, detail in log:
        e = state.setdefault(job, dict(
            runs=0, failures=0, consecutive_failures=0, degraded_runs=0, writeless_successes=0, last_run=None, last_success=None,
            last_failure=None, last_wrote=None, last_status=None, last_fetched=0, last_added=0, last_detail="", last_error=None, skip_reason=None,
        ))
        e.update(last_status=status, last_detail=detail)
        if status == "skipped":
            e["skip_reason"] = detail
            continue
        e.update(skip_reason=None, last_run=ts, last_fetched=fetched, last_added=added, runs=e["runs"] + 1)
        if status == "error":
            e.update(failures=e["failures"] + 1, consecutive_failures=e["consecutive_failures"] + 1, last_failure=ts, last_error=detail or "job reported error")
            continue
        e.update(consecutive_failures=0, last_success=ts, last_error=detail if status == "partial" else None)
        e["degraded_runs"] += status == "partial"
        if added:
            e.update(last_wrote=ts, writeless_successes=0)
        else:
            e["writeless_successes"] += 1
    return state


def entries(df):
    return {r.job: {k: v for k, v in r.asDict().items() if k not in ("job", "interval_seconds", "last_traceback")} for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_the_sequence(spark, seed):
    log = run_log(seed)
    shuffled = random.Random(seed).sample(log, len(log))
    assert entries(h.health_fold(spark.createDataFrame(shuffled, RUN))) == sequential_fold(log)


@pytest.mark.parametrize("cut", [0, 1, 400, 901])
def test_fold_resumes_from_an_earlier_state(spark, cut):
    log = run_log(7)
    part = lambda rows: h.health_fold(spark.createDataFrame(rows, RUN))
    assert entries(h.resume_health(part(log[:cut]), part(log[cut:]))) == sequential_fold(log)


@pytest.mark.parametrize("share, rows", [(skew.HEAVY_SHARE, 10), (4, 7), (1, 10)])
def test_streaks_equal_the_sequence(spark, monkeypatch, share, rows):
    """Cut into short segments: all keys, only the hot one, and none."""
    monkeypatch.setattr(skew, "HEAVY_SHARE", share)
    log = run_log(5)
    expected, state = {}, {}
    for job, seq, _, status, _, added, _ in log:
        e, w = state.get(job, (0, 0))
        if status == "error":
            e += 1
        elif status in ("ok", "partial"):
            e, w = 0, (0 if added else w + 1)
        state[job] = (e, w)
        expected[seq] = (e, w)
    found = h.run_streaks(spark.createDataFrame(log, RUN), rows=rows).collect()
    assert {r.seq: (r.failure_streak, r.writeless_streak) for r in found} == expected


@pytest.mark.parametrize("share, rows", [(skew.HEAVY_SHARE, 5), (4, 9), (1, 10)])
def test_pacing_equals_the_sequence(spark, monkeypatch, share, rows):
    monkeypatch.setattr(skew, "HEAVY_SHARE", share)
    rng = random.Random(3)
    log, clock = [], START
    for seq in range(600):
        clock += timedelta(seconds=rng.randrange(6))
        log.append(("hot" if rng.random() < 0.33 else f"p{rng.randrange(9)}", seq, clock))
    released, last = {}, {}
    for provider, seq, at in log:
        last[provider] = released[seq] = max(at, last[provider] + timedelta(seconds=13)) if provider in last else at
    df = spark.createDataFrame(log, "provider string, seq bigint, ts timestamp")
    found = q.pacing_schedule(df, F.lit(13), rows=rows).collect()
    assert {r.seq: r.released_at for r in found} == released


def test_pacing_waits_for_the_rest_of_the_spacing(spark):
    df = spark.createDataFrame([("p", 0, START), ("p", 1, START + timedelta(seconds=3))], "provider string, seq bigint, ts timestamp")
    waits = [r.wait_micros for r in q.pacing_schedule(df, F.lit(13)).orderBy("seq").collect()]
    assert waits == [0, 10_000_000]


@pytest.mark.parametrize("limit", [2, 1200])
def test_budget_admits_the_first_requests_of_a_day(spark, limit):
    log = [("hot", seq, START + timedelta(seconds=seq * 40)) for seq in range(5000)]
    found = q.quota_admission(spark.createDataFrame(log, "provider string, seq bigint, ts timestamp"), limit).collect()
    used = {}
    expected = {}
    for _, seq, ts in log:
        used[ts.date()] = used.get(ts.date(), 0) + 1
        expected[seq] = used[ts.date()] if used[ts.date()] <= limit else None
    assert {r.seq: r.claim for r in found} == expected
    with pytest.raises(ValueError):
        q.quota_admission(spark.range(1).selectExpr("'p' provider", "id seq", "timestamp'2026-01-01' ts"), 0)


NOW = START + timedelta(days=1)


@pytest.mark.parametrize(
    "change, status",
    [
        ({}, "ok"),
        ({"consecutive_failures": 1, "last_success": START - timedelta(days=9)}, "failing"),
        ({"runs": 0, "skip_reason": "no key"}, "skipped"),
        ({"runs": 0}, "never-run"),
        ({"last_success": None}, "never-run"),
        ({"last_success": NOW - timedelta(seconds=54_000)}, "ok"),
        ({"last_success": NOW - timedelta(seconds=54_001), "last_status": "partial"}, "stale"),
        ({"last_success": START - timedelta(days=9), "interval_seconds": None}, "ok"),
        ({"last_status": "partial", "writeless_successes": 9}, "degraded"),
        ({"writeless_successes": 2}, "ok"),
        ({"writeless_successes": 3}, "idle"),
    ],
)
def test_verdicts(spark, change, status):
    entry = {
        "consecutive_failures": 0, "runs": 5, "skip_reason": None, "last_success": NOW, "interval_seconds": 21_600.0,
        "last_status": "ok", "writeless_successes": 0, **change,
    }
    shape = "consecutive_failures bigint, runs bigint, skip_reason string, last_success timestamp, interval_seconds double, last_status string, writeless_successes bigint"
    df = spark.createDataFrame([tuple(entry.values())], shape)
    assert df.select(health_status(F.lit(NOW)).alias("s")).first().s == status


def test_a_scheduled_job_without_runs_is_listed_last_but_one(spark):
    runs = spark.createDataFrame([("b", 1, START, "error", 0, 0, ""), ("c", 2, NOW, "ok", 1, 1, "")], RUN)
    schedule = spark.createDataFrame([("a", 21_600.0), ("b", 21_600.0), ("c", 21_600.0)], "job string, interval_seconds double")
    judged = h.with_verdict(h.health_fold(runs, schedule), F.lit(NOW))
    rows = h.health_worst_first(judged, F.lit(NOW)).collect()
    assert [(r.job, r.status) for r in rows] == [("b", "failing"), ("a", "never-run"), ("c", "ok")]
    assert rows[0].reason == "job reported error" and rows[1].last_ok == "never"
    assert [r.job for r in h.health_worst_first(judged, F.lit(NOW), quiet=True).collect()] == ["b", "a"]
    assert h.health_report(judged).first().asDict()["ok"] is False


def test_outcome_of_a_run(spark):
    rows = [
        ("j", "all", 1, "nba", 3, 1, None), ("j", "all", 2, "nfl", 0, 0, None), ("j", "some", 3, "nba", 3, 1, None), ("j", "some", 9, "mlb", 0, 0, "mlb: down"),
        ("j", "some", 5, "nfl", 0, 0, "nfl: late"), ("j", "some", 11, "nfl", 0, 0, "nfl: gone"), ("j", "none", 6, "nba", 0, 0, "nba: down"),
    ]
    df = spark.createDataFrame(rows, "job string, run string, seq bigint, unit string, fetched bigint, added bigint, failure string")
    found = {r.run: (r.status, r.fetched, r.added, r.detail) for r in h.run_outcome(df).collect()}
    assert found == {"all": ("ok", 3, 1, ""), "some": ("partial", 3, 1, "nfl: late; mlb: down; nfl: gone"), "none": ("error", 0, 0, "nba: down")}


def test_runs_without_a_job_are_kept(spark, monkeypatch):
    rows = [(None, 1, START, "error", 0, 0, "x"), ("a", 2, START, "ok", 1, 1, ""), (None, 3, START, "ok", 2, 2, "")]
    df = spark.createDataFrame(rows, RUN)
    for share in (1, 10_000):
        monkeypatch.setattr(skew, "HEAVY_SHARE", share)
        assert {r.job: (r.runs, r.failures) for r in h.health_fold(df).collect()} == {None: (2, 1), "a": (1, 0)}
        streaks = {r.seq: r.failure_streak for r in h.run_streaks(df, rows=1).collect()}
        assert streaks == {1: 1, 2: 0, 3: 0}


def test_ages(spark):
    ago = [timedelta(days=3, hours=5), timedelta(hours=5), timedelta(minutes=2), timedelta(seconds=9), timedelta(0), timedelta(seconds=-5)]
    df = spark.createDataFrame([(k, NOW - a) for k, a in enumerate(ago)] + [(9, None)], "k int, t timestamp")
    texts = [r.a for r in df.orderBy("k").select(age_text(F.col("t"), F.lit(NOW)).alias("a")).collect()]
    assert texts == ["3d ago", "5h ago", "2m ago", "9s ago", "0s ago", "just now", "never"]


def test_state_document_is_read_tolerantly(spark):
    from tidelake.sources.lake import health_entries

    bodies = [
        ('{"written_at":"x","jobs":{"a":{"job":"other","runs":4,"later":1,"last_success":"2026-01-01T00:00:00+00:00"},"b":7}}',),
        ('{"jobs":[]}',), ("{",), ("[]",),
    ]
    (row,) = health_entries(spark.createDataFrame(bodies, "body string")).collect()
    assert (row.job, row.runs, row.failures, row.last_detail, row.last_success) == ("a", 4, 0, "", START)


def test_hot_keys_join_without_loss(spark):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    per_key = facts.groupBy("k").agg(F.max("id").alias("top"))
    joined = skew.join_per_key(facts, per_key, ["k"], F.col("id"))
    assert joined.count() == 30_000
    assert joined.where("k = 'hot'").select("top").distinct().collect()[0].top == 29_997


def test_copies_are_folded_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    plan = skew.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
