"""Health as keyed state: equal to the sequential fold, whatever the order and the restarts."""

import random

import pytest
from pyspark.sql import functions as F
from test_logs import RUN, START, entries, run_log, sequential_fold

from tidelake.operators import health as h
from tidelake.schemas import HEALTH_ENTRY
from tidelake.streaming import health_state as hs


def land(spark, rows, path, files=1):
    """Rows as ``files`` files, which the stream takes one by one."""
    step = -(-len(rows) // files)
    for number in range(files):
        part = rows[number * step : (number + 1) * step]
        spark.createDataFrame(part, RUN).coalesce(1).write.mode("append").parquet(path)


def follow(spark, base, checkpoint="checkpoint", out="entries", seed=None):
    runs = spark.readStream.schema(RUN).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    hs.stream_health_state(runs, f"{base}/{out}", f"{base}/{checkpoint}", seed).awaitTermination()
    return hs.current_states(spark.read.parquet(f"{base}/{out}"))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_a_restart_equal_the_sequence(spark, tmp_path, seed):
    base = str(tmp_path)
    log = run_log(seed)
    shuffled = random.Random(seed).sample(log, len(log))
    land(spark, shuffled[:500], f"{base}/in", 2)
    follow(spark, base)
    land(spark, shuffled[500:], f"{base}/in", 2)
    assert entries(follow(spark, base)) == sequential_fold(log)
    # Nothing new: nothing changes.
    assert entries(follow(spark, base)) == sequential_fold(log)


def test_late_marks_cut_streaks(spark, tmp_path):
    base = str(tmp_path)
    row = lambda seq, status, added=0: ("j", seq, START, status, 1, added, f"d{seq}")
    failing = [row(seq, "error") for seq in range(10, 30)]
    land(spark, failing, f"{base}/in")
    assert follow(spark, base).first().consecutive_failures == 20
    late = [row(20, "ok"), row(5, "ok"), row(21, "partial", 1), row(3, "ok", 1)]
    # 20 and 21 are taken twice; each number of a run stands once.
    log = [r for r in failing if r[1] not in (20, 21)] + late
    base = f"{base}/second"
    land(spark, failing[:10] + failing[12:], f"{base}/in")
    for one in late:
        land(spark, [one], f"{base}/in")
    assert entries(follow(spark, base)) == sequential_fold(sorted(log, key=lambda r: r[1]))


@pytest.mark.parametrize("cut", [0, 1, 450])
def test_a_seed_is_the_initial_state(spark, tmp_path, cut):
    base = str(tmp_path)
    log = run_log(7)
    before = h.health_fold(spark.createDataFrame(log[:cut], RUN)) if cut else spark.createDataFrame([], HEALTH_ENTRY)
    land(spark, log[cut:], f"{base}/in", 2)
    assert entries(follow(spark, base, seed=before)) == sequential_fold(log)


def test_a_new_checkpoint_goes_on_from_the_old_states(spark, tmp_path):
    base = str(tmp_path)
    log = run_log(9)
    land(spark, log[:600], f"{base}/old/in", 2)
    kept = follow(spark, f"{base}/old")
    land(spark, log[600:], f"{base}/new/in", 2)
    assert entries(follow(spark, f"{base}/new", seed=kept)) == sequential_fold(log)


def test_awkward_runs_have_a_defined_entry(spark, tmp_path):
    """No job, no number, no status, no counts, equal texts, an empty log."""
    base = str(tmp_path)
    land(spark, [
        (None, 1, START, "error", None, None, None),
        (None, 2, START, "ok", None, None, None),
        ("a", None, START, "error", 1, 1, "x"),
        ("a", 4, START, "error", 1, 1, "y"),
        ("b", 1, None, None, None, None, None),
        ("ü" * 50_000, 1, START, "skipped", 0, 0, "z" * 100_000),
    ], f"{base}/in")
    found = entries(follow(spark, base))
    assert (found[None]["runs"], found[None]["consecutive_failures"], found[None]["writeless_successes"]) == (2, 0, 1)
    assert (found["a"]["consecutive_failures"], found["a"]["last_error"]) == (2, "y")
    assert (found["b"]["runs"], found["b"]["last_status"]) == (0, None)
    assert len(found["ü" * 50_000]["skip_reason"]) == 100_000
    spark.createDataFrame([], RUN).write.parquet(f"{base}/none/in")
    runs = spark.readStream.schema(RUN).parquet(f"{base}/none/in")
    hs.stream_health_state(runs, f"{base}/none/out", f"{base}/none/check", spark.createDataFrame([], HEALTH_ENTRY)).awaitTermination()
    assert hs.current_states(spark.read.parquet(f"{base}/none/out")).isEmpty()


def test_runs_are_combined_before_the_shuffle(spark):
    """A hot job sends one row per Arrow batch, not one per run."""
    runs = spark.range(0, 20_000, 1, 1).selectExpr(
        "'hot' AS job", "id AS seq", "TIMESTAMP'2026-01-01' AS ts", "'error' AS status", "1L AS fetched", "0L AS added", "'' AS detail"
    ).withColumns({name: F.lit(name in ("ran", "failed")) for name in ("ran", "failed", "partly", "worked", "wrote")})
    runs = runs.withColumn("ts", F.unix_micros("ts"))
    deltas = runs.mapInPandas(hs._deltas, hs._DELTA).collect()
    assert len(deltas) == 2 and sum(d.failures for d in deltas) == 20_000
    assert sorted(s for d in deltas for s in d.failed) == list(range(20_000))
