"""Job health: run outcomes, the fold over the run log, verdicts and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.status import health_status, status_rank
from tidelake.functions.times import age_text
from tidelake.operators.skew import SEGMENT_ROWS, join_by_keys, join_per_key, segment, segmented, so_far
from tidelake.schemas import HEALTH_ENTRY, UNHEALTHY_STATUSES

def _succeeded() -> Column:
    return F.col("status").isin("ok", "partial")


def run_outcome(units: DataFrame) -> DataFrame:
    """Per (job, run): totals and ok / partial / error.

    Input: job, run, seq, unit, fetched, added, failure (null when the unit
    worked).  ``detail`` holds every failure text of the run, in order of ``seq``;
    ``run_failures`` has them as rows.
    """
    failed = F.when(F.col("failure").isNotNull(), F.struct("seq", "failure"))
    totals = units.groupBy("job", "run").agg(
        F.sum("fetched").alias("fetched"),
        F.sum("added").alias("added"),
        F.count(failed).alias("failures"),
        F.array_sort(F.collect_list(failed)).alias("failed"),
    )
    nothing = (F.col("fetched") == 0) & (F.col("added") == 0)
    return totals.select(
        "job",
        "run",
        F.when(F.col("failures") == 0, "ok").when(nothing, "error").otherwise("partial").alias("status"),
        "fetched",
        "added",
        F.array_join(F.col("failed.failure"), "; ").alias("detail"),
    )


def run_failures(units: DataFrame) -> DataFrame:
    """Every failure of every run as a row: job, run, seq, unit, failure."""
    return units.where(F.col("failure").isNotNull()).select("job", "run", "seq", "unit", "failure")


def health_fold(runs: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """One health entry per job, equal to folding its runs in ``seq`` order.

    Input: job, seq (bigint, arrival order), ts, status, fetched, added, detail.
    ``schedule`` (job, interval_seconds) adds promised cadences; jobs that are
    only scheduled appear with no runs.  Runs without a job make one entry, of no name.

    Two passes, neither ordering a job's history: the first finds counters and
    the last marker of each kind with partially aggregated longs; the second
    looks only at rows after those markers, spread by ``join_per_key``.
    """
    seq, status = F.col("seq"), F.col("status")
    ran, failed = status != "skipped", status == "error"
    wrote = _succeeded() & (F.col("added") > 0)
    last = lambda condition: F.max(F.when(condition, seq))
    marks = runs.groupBy("job").agg(
        F.count_if(ran).alias("runs"),
        F.count_if(failed).alias("failures"),
        F.count_if(status == "partial").alias("degraded_runs"),
        F.count_if(_succeeded()).alias("_successes"),
        last(_succeeded()).alias("_success"),
        last(wrote).alias("_wrote"),
        last(ran).alias("_run"),
        last(failed).alias("_failure"),
        F.max(seq).alias("_last"),
    )
    ends_at = ["_success", "_wrote", "_run", "_failure", "_last"]
    is_mark = F.coalesce(seq.isin(*[F.col(name) for name in ends_at]), F.lit(False))
    facts = runs.select("job", "seq", "ts", "status", "fetched", "added", "detail")
    tail = join_per_key(facts, marks, ["job"], seq).where(
        is_mark | (seq > F.col("_success")) | (seq > F.col("_wrote"))
    )
    at = lambda mark, value: F.max(F.when(seq == F.col(mark), F.col(value)))
    # Every job's last run is in its tail, so the counters of the first pass ride along.
    ride = ["runs", "failures", "degraded_runs", "_successes", "_success", "_wrote"]
    entries = tail.groupBy("job").agg(
        *[F.max(name).alias(name) for name in ride],
        F.count_if(failed & (seq > F.col("_success"))).alias("_failed_since"),
        F.count_if(_succeeded() & (seq > F.col("_wrote"))).alias("_empty_since"),
        at("_run", "ts").alias("last_run"),
        at("_success", "ts").alias("last_success"),
        at("_failure", "ts").alias("last_failure"),
        at("_wrote", "ts").alias("last_wrote"),
        at("_last", "status").alias("last_status"),
        at("_last", "detail").alias("last_detail"),
        at("_run", "status").alias("_run_status"),
        at("_run", "detail").alias("_run_detail"),
        at("_run", "fetched").alias("last_fetched"),
        at("_run", "added").alias("last_added"),
    )
    if schedule is not None:
        entries = join_by_keys(entries, schedule.select("job", "interval_seconds"), ["job"], "full")
    else:
        entries = entries.withColumn("interval_seconds", F.lit(None).cast("double"))
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    said = F.coalesce(F.col("_run_detail"), F.lit(""))
    built = entries.select(
        "job",
        F.col("interval_seconds").cast("double").alias("interval_seconds"),
        count("runs").alias("runs"),
        count("failures").alias("failures"),
        F.when(F.col("_success").isNull(), count("failures"))
        .otherwise(count("_failed_since"))
        .alias("consecutive_failures"),
        count("degraded_runs").alias("degraded_runs"),
        F.when(F.col("_wrote").isNull(), count("_successes"))
        .otherwise(count("_empty_since"))
        .alias("writeless_successes"),
        "last_run",
        "last_success",
        "last_failure",
        "last_wrote",
        "last_status",
        count("last_fetched").alias("last_fetched"),
        count("last_added").alias("last_added"),
        F.coalesce(F.col("last_detail"), F.lit("")).alias("last_detail"),
        F.when(
            F.col("_run_status") == "error",
            F.when(said == "", "job reported error").otherwise(said),
        )
        .when(F.col("_run_status") == "partial", said)
        .alias("last_error"),
        F.lit(None).cast("string").alias("last_traceback"),
        F.when(F.col("last_status") == "skipped", F.coalesce(F.col("last_detail"), F.lit(""))).alias(
            "skip_reason"
        ),
    )
    return built.select(*[f.name for f in HEALTH_ENTRY.fields])


def resume_health(prior: DataFrame, folded: DataFrame) -> DataFrame:
    """Entries after the runs in ``folded``, starting from an earlier state.

    Counters add up; a streak continues only if the new runs did not break it.
    """
    p, f = prior.alias("p"), folded.alias("f")
    old, new = (lambda n: F.col(f"p.{n}")), (lambda n: F.col(f"f.{n}"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    total = lambda n: zero(old(n)) + zero(new(n))
    ran, seen = new("last_run").isNotNull(), new("last_status").isNotNull()

    def streak(name: str, breaker: str) -> Column:
        return F.when(new(breaker).isNotNull(), zero(new(name))).otherwise(total(name))

    def pick(name: str, condition: Column) -> Column:
        return F.when(condition, new(name)).otherwise(old(name))

    built = {
        "job": F.coalesce(old("job"), new("job")),
        "interval_seconds": F.coalesce(new("interval_seconds"), old("interval_seconds")),
        "runs": total("runs"),
        "failures": total("failures"),
        "consecutive_failures": streak("consecutive_failures", "last_success"),
        "degraded_runs": total("degraded_runs"),
        "writeless_successes": streak("writeless_successes", "last_wrote"),
        "last_run": F.coalesce(new("last_run"), old("last_run")),
        "last_success": F.coalesce(new("last_success"), old("last_success")),
        "last_failure": F.coalesce(new("last_failure"), old("last_failure")),
        "last_wrote": F.coalesce(new("last_wrote"), old("last_wrote")),
        "last_status": pick("last_status", seen),
        "last_fetched": zero(pick("last_fetched", ran)),
        "last_added": zero(pick("last_added", ran)),
        "last_detail": F.coalesce(pick("last_detail", seen), F.lit("")),
        "last_error": pick("last_error", ran),
        "last_traceback": pick("last_traceback", ran),
        "skip_reason": pick("skip_reason", seen),
    }
    joined = p.join(f, F.col("p.job").eqNullSafe(F.col("f.job")), "full")
    return joined.select(*[c.alias(n) for n, c in built.items()])


def with_verdict(entries: DataFrame, now: Column) -> DataFrame:
    return entries.withColumn("status", health_status(now))


def unhealthy_jobs(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("status").isin(UNHEALTHY_STATUSES))


def health_report(judged: DataFrame) -> DataFrame:
    """One row: the overall verdict and the number of jobs per class.

    The problem list itself is ``unhealthy_jobs`` as rows, since it grows with the jobs.
    """
    bad = F.col("status").isin(UNHEALTHY_STATUSES)
    return judged.agg(
        (F.count_if(bad) == 0).alias("ok"),
        F.count("*").alias("jobs"),
        F.count_if(bad).alias("problems"),
        *[F.count_if(F.col("status") == s).alias(s) for s in UNHEALTHY_STATUSES],
    )


def health_worst_first(judged: DataFrame, now: Column, quiet: bool = False) -> DataFrame:
    """Display rows, worst verdict first, then by name; ``quiet`` leaves healthy jobs out."""
    rows = judged.where(F.col("status") != "ok") if quiet else judged
    reason = F.coalesce(F.nullif("last_error", F.lit("")), F.nullif("skip_reason", F.lit("")))
    return (
        rows.withColumn("rank", status_rank(F.col("status")))
        .orderBy("rank", "job")
        .select(
            "rank",
            "job",
            "status",
            age_text(F.col("last_success"), now).alias("last_ok"),
            age_text(F.col("last_wrote"), now).alias("wrote"),
            "runs",
            "failures",
            F.when(F.col("status") != "ok", reason).alias("reason"),
        )
    )


def run_streaks(runs: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every run with the failure streak and the writeless streak it leaves behind.

    A streak is a running count minus its value at the last row that reset it;
    both are carried across segments, so a job's history may be of any length.
    """
    failed = (F.col("status") == "error").cast("bigint")
    wrote = _succeeded() & (F.col("added") > 0)
    empty = (_succeeded() & (F.col("added") <= 0)).cast("bigint")
    facts = runs.select("job", "seq", "status", "added")
    result = segmented(
        facts,
        ["job"],
        ["seq"],
        segment("seq", rows),
        local=lambda run: {
            "_failed": F.sum(failed).over(so_far(run)),
            "_empty": F.sum(empty).over(so_far(run)),
            "_failed_reset": F.max(F.when(_succeeded(), F.col("_failed"))).over(so_far(run)),
            "_empty_reset": F.max(F.when(wrote, F.col("_empty"))).over(so_far(run)),
        },
        summary={
            "_failed_n": F.sum(failed),
            "_empty_n": F.sum(empty),
            "_failed_mark": F.max("_failed_reset"),
            "_empty_mark": F.max("_empty_reset"),
        },
        carry=lambda before: [
            {
                "_failed_0": F.coalesce(F.sum("_failed_n").over(before), F.lit(0)),
                "_empty_0": F.coalesce(F.sum("_empty_n").over(before), F.lit(0)),
            },
            {
                "_failed_mark_0": F.max(F.col("_failed_0") + F.col("_failed_mark")).over(before),
                "_empty_mark_0": F.max(F.col("_empty_0") + F.col("_empty_mark")).over(before),
            },
        ],
    )

    def streak(name: str) -> Column:
        before = F.coalesce(f"_{name}_0", F.lit(0))
        count = before + F.col(f"_{name}")
        reset = F.greatest(F.col(f"_{name}_mark_0"), before + F.col(f"_{name}_reset"))
        return count - F.coalesce(reset, F.lit(0))

    return result.select(
        "job",
        "seq",
        "status",
        streak("failed").alias("failure_streak"),
        streak("empty").alias("writeless_streak"),
    )
