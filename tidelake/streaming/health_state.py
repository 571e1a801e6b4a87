"""Job health as keyed state: one entry per job, moved forward by each micro-batch.

The state of a job is a mergeable form of its fold: counters, the newest run of
each kind by ``seq``, and the numbers of failures since its last success and of
empty successes since its last write.  Runs may therefore arrive in any order;
nothing is read again, neither the log nor the entries of other jobs.

Rows are combined where they are read, one delta per job and ``COMBINED`` runs, so a
job with a third of all runs sends one row per hundred thousand runs to its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidelake.schemas import HEALTH_ENTRY

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Runs that a task combines at a time.
COMBINED = 100_000
#: Numbers of runs that a job's task gathers before it goes to the state.
GATHERED = 100_000
#: A run without a number comes before all others.
_FIRST = -(1 << 63)

#: The newest run of each kind, and what is kept of it.
_MARKS = {
    "success": ("ts",),
    "wrote": ("ts",),
    "run": ("ts", "status", "detail", "fetched", "added"),
    "failure": ("ts",),
    "last": ("status", "detail"),
}
_COUNTS = ("seen", "runs", "failures", "degraded", "successes")
#: What counts since which mark.
_STREAKS = {"failed": "success", "empty": "wrote"}


def _mark_fields() -> list[T.StructField]:
    fields = []
    for mark, values in _MARKS.items():
        fields.append(T.StructField(f"{mark}_seq", T.LongType()))
        for value in values:
            kind = T.StringType() if value in ("status", "detail") else T.LongType()
            fields.append(T.StructField(f"{mark}_{value}", kind))
    return fields


_JOB = T.StructField("job", T.StringType())
_COUNT_FIELDS = [T.StructField(name, T.LongType()) for name in _COUNTS]
_DELTA = T.StructType(
    [_JOB, *_COUNT_FIELDS, *_mark_fields(), *[T.StructField(s, T.ArrayType(T.LongType())) for s in _STREAKS]]
)
_STATE = T.StructType(
    [
        *_COUNT_FIELDS,
        *_mark_fields(),
        *[T.StructField(f"{streak}_{part}", T.LongType()) for streak in _STREAKS for part in ("since", "seed", "max")],
        T.StructField("interval_seconds", T.DoubleType()),
        T.StructField("seed_error", T.StringType()),
        T.StructField("seed_traceback", T.StringType()),
        T.StructField("seed_skip", T.StringType()),
    ]
)
_NAMES = [field.name for field in _STATE.fields]
_NEW = {name: 0 for name in (*_COUNTS, "failed_since", "failed_seed", "empty_since", "empty_seed")}


def _gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches put together until they have ``COMBINED`` rows."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= COMBINED:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def _deltas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per job of every batch: counters, newest runs, and what came after them."""
    for runs in frames:
        codes, jobs = pd.factorize(runs["job"], use_na_sentinel=False)
        runs = runs.assign(code=codes).sort_values("seq", kind="stable")
        out = pd.DataFrame(index=range(len(jobs)))
        out["job"] = [None if pd.isna(job) else job for job in jobs]
        grouped = runs.groupby("code")
        out["seen"] = grouped.size()
        for name, flag in (("runs", "ran"), ("failures", "failed"), ("degraded", "partly"), ("successes", "worked")):
            out[name] = grouped[flag].sum()
        kinds = {"success": "worked", "wrote": "wrote", "run": "ran", "failure": "failed"}
        for mark, values in _MARKS.items():
            kept = runs[runs[kinds[mark]]] if mark in kinds else runs
            newest = kept.drop_duplicates("code", keep="last").set_index("code")
            out[f"{mark}_seq"] = newest["seq"].astype("Int64").reindex(out.index)
            for value in values:
                column = newest[value]
                text = value in ("status", "detail")
                out[f"{mark}_{value}"] = (column.astype("object") if text else column.astype("Int64")).reindex(out.index)
        for streak, flag in (("failed", "failed"), ("empty", "worked")):
            kept = runs[runs[flag]]
            since = out[f"{_STREAKS[streak]}_seq"].reindex(kept["code"])
            after = kept[(since.isna().to_numpy()) | (kept["seq"].to_numpy() > since.fillna(_FIRST).to_numpy("int64"))]
            lists = after.groupby("code")["seq"].agg(list).reindex(out.index)
            out[streak] = [found if isinstance(found, list) else [] for found in lists]
        yield out[[field.name for field in _DELTA.fields]].astype(
            {f.name: "Int64" for f in _DELTA.fields if isinstance(f.dataType, T.LongType)}
        )


def _after(numbers: list[int], since: int | None) -> list[int]:
    return list(numbers) if since is None else [seq for seq in numbers if seq > since]


def _combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _deltas(_gathered(frames))


class _JobHealth(StatefulProcessor):
    """Merges deltas into a job's entry and emits the entry after the batch."""

    def init(self, handle) -> None:
        self._entry = handle.getValueState("entry", _STATE)
        number = T.StructType([T.StructField("seq", T.LongType())])
        self._pending = {streak: handle.getListState(streak, number) for streak in _STREAKS}

    def _held(self) -> dict:
        found = self._entry.get()
        return dict(zip(_NAMES, found)) if found is not None else dict.fromkeys(_NAMES) | _NEW

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Deltas meet here first: every access to the state is a call to another process."""
        held = self._held()
        moved, fresh = set(), {streak: [] for streak in _STREAKS}
        for delta in rows:
            for name in _COUNTS:
                held[name] += delta[name]
            for mark, values in _MARKS.items():
                seq, known = delta[f"{mark}_seq"], held[f"{mark}_seq"]
                if seq is not None and (known is None or seq >= known):
                    held[f"{mark}_seq"] = seq
                    for value in values:
                        held[f"{mark}_{value}"] = delta[f"{mark}_{value}"]
                    moved.add(mark)
            for streak, mark in _STREAKS.items():
                fresh[streak].extend(_after(delta[streak], held[f"{mark}_seq"]))
            if sum(map(len, fresh.values())) >= GATHERED:
                self._settle(held, moved, fresh)
                moved, fresh = set(), {streak: [] for streak in _STREAKS}
        self._settle(held, moved, fresh)
        self._entry.update(tuple(held[name] for name in _NAMES))
        yield Row("job", *_NAMES)(key[0], *[held[name] for name in _NAMES])

    def _settle(self, held: dict, moved: set[str], fresh: dict[str, list[int]]) -> None:
        for streak, mark in _STREAKS.items():
            since = held[f"{mark}_seq"]
            self._advance(held, streak, since, mark in moved, _after(fresh[streak], since))

    def _advance(self, held: dict, streak: str, since: int | None, moved: bool, numbers: list[int]) -> None:
        """Forget what lies before the mark, and add ``numbers``, which lie after it."""
        pending = self._pending[streak]
        since_name, most = f"{streak}_since", f"{streak}_max"
        fresh = [(seq,) for seq in numbers]
        if moved:
            held[f"{streak}_seed"] = 0
            if held[since_name]:
                # In order, the mark lies behind all pending numbers and nothing is read.
                kept = [] if held[most] <= since else [row for row in pending.get() if row[0] > since]
                pending.clear()
                if kept:
                    pending.put(kept)
                held[since_name] = len(kept)
        if fresh:
            pending.appendList(fresh)
            top = max(numbers)
            held[most] = top if held[most] is None else max(held[most], top)
            held[since_name] += len(fresh)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._entry.update(tuple(initialState[name] for name in _NAMES))

    def close(self) -> None:
        pass


def _seeded(entries: DataFrame) -> DataFrame:
    """Entries of an earlier state (``HEALTH_ENTRY``) as states; they precede every run of the stream."""
    given = {
        "seen": F.col("runs"),
        "runs": F.col("runs"),
        "failures": F.col("failures"),
        "degraded": F.col("degraded_runs"),
        "successes": F.lit(0),
        "success_ts": F.unix_micros("last_success"),
        "wrote_ts": F.unix_micros("last_wrote"),
        "run_ts": F.unix_micros("last_run"),
        "run_fetched": F.col("last_fetched"),
        "run_added": F.col("last_added"),
        "failure_ts": F.unix_micros("last_failure"),
        "last_status": F.col("last_status"),
        "last_detail": F.col("last_detail"),
        "failed_since": F.lit(0),
        "failed_seed": F.col("consecutive_failures"),
        "empty_since": F.lit(0),
        "empty_seed": F.col("writeless_successes"),
        "interval_seconds": F.col("interval_seconds"),
        "seed_error": F.col("last_error"),
        "seed_traceback": F.col("last_traceback"),
        "seed_skip": F.col("skip_reason"),
    }
    columns = []
    for field in _STATE.fields:
        value = given.get(field.name, F.lit(None)).cast(field.dataType)
        columns.append((F.coalesce(value, F.lit(0)) if field.name in _NEW else value).alias(field.name))
    return entries.select("job", *columns)


def _entries(states: DataFrame) -> DataFrame:
    """States as health entries, with ``seen``: the number of runs behind the entry, which only grows."""
    time = lambda name: F.timestamp_micros(F.col(name))
    none = lambda name: F.coalesce(F.col(name), F.lit(0))
    said = F.coalesce("run_detail", F.lit(""))
    told = F.coalesce("last_detail", F.lit(""))
    error = (
        F.when(F.col("run_seq").isNull(), F.col("seed_error"))
        .when(F.col("run_status") == "error", F.when(said == "", "job reported error").otherwise(said))
        .when(F.col("run_status") == "partial", said)
    )
    built: dict[str, Column] = {
        "job": F.col("job"),
        "interval_seconds": F.col("interval_seconds"),
        "runs": F.col("runs"),
        "failures": F.col("failures"),
        "consecutive_failures": F.col("failed_seed") + F.col("failed_since"),
        "degraded_runs": F.col("degraded"),
        "writeless_successes": F.col("empty_seed") + F.col("empty_since"),
        "last_run": time("run_ts"),
        "last_success": time("success_ts"),
        "last_failure": time("failure_ts"),
        "last_wrote": time("wrote_ts"),
        "last_status": F.col("last_status"),
        "last_fetched": none("run_fetched"),
        "last_added": none("run_added"),
        "last_detail": told,
        "last_error": error,
        "last_traceback": F.when(F.col("run_seq").isNull(), F.col("seed_traceback")),
        "skip_reason": F.when(F.col("last_seq").isNull(), F.col("seed_skip")).when(
            F.col("last_status") == "skipped", told
        ),
    }
    return states.select("seen", *[built[field.name].alias(field.name) for field in HEALTH_ENTRY.fields])


def health_updates(run_log: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """The entry of every job that a micro-batch touches, after that batch.

    Input: job, seq, ts, status, fetched, added, detail (a stream); ``seq`` orders the runs of a
    job and is its own for each run.  ``seed`` holds earlier entries (``HEALTH_ENTRY``): they are
    the initial state, and all runs of the stream come after them; their plan is a plain scan, as
    of a table.  Runs without a job make
    one entry, of no name; a run without a number comes before all others.
    """
    status = F.col("status")
    worked = status.isin("ok", "partial")
    flag = lambda condition: F.coalesce(condition, F.lit(False))
    runs = run_log.select(
        "job",
        F.coalesce("seq", F.lit(_FIRST)).cast("bigint").alias("seq"),
        F.unix_micros("ts").alias("ts"),
        "status",
        F.coalesce("fetched", F.lit(0)).cast("bigint").alias("fetched"),
        F.coalesce("added", F.lit(0)).cast("bigint").alias("added"),
        "detail",
        flag(status != "skipped").alias("ran"),
        flag(status == "error").alias("failed"),
        flag(status == "partial").alias("partly"),
        flag(worked).alias("worked"),
        flag(worked & (F.col("added") > 0)).alias("wrote"),
    )
    states = (
        runs.mapInPandas(_combined, _DELTA)
        .groupBy("job")
        .transformWithState(
            _JobHealth(),
            T.StructType([_JOB, *_STATE.fields]),
            "Update",
            "None",
            initialState=_seeded(seed).groupBy("job") if seed is not None else None,
        )
    )
    return _entries(states)


def stream_health_state(
    run_log: DataFrame, entries_path: str, checkpoint: str, seed: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Keep health as keyed state and write the entries that each batch changes.

    A batch costs its own runs and jobs: it writes only the entries it touched, as ``batch=N``,
    which a replay replaces.  Seeded entries lie there from the start.  A new checkpoint wants
    a new ``entries_path``, with ``current_states`` of the old one as its seed.
    """
    spark = run_log.sparkSession
    if seed is not None:
        # Written first: a restart starts from the same rows, and the stream's plan holds a plain scan.
        _entries(_seeded(seed)).write.mode("overwrite").parquet(f"{entries_path}/batch=-1")
        seed = spark.read.parquet(f"{entries_path}/batch=-1")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{entries_path}/batch={number}")

    kept = spark.conf.get(_PROVIDER)
    # Keyed state lives in RocksDB; a query keeps the setting it was started with.
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        writer = health_updates(run_log, seed).writeStream.foreachBatch(each).outputMode("update")
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.set(_PROVIDER, kept)


def current_states(entries: DataFrame) -> DataFrame:
    """The newest entry of every job, of all that ``stream_health_state`` wrote."""
    names = [field.name for field in HEALTH_ENTRY.fields]
    # Later entries have seen more runs; a seed comes first also where it has seen as many.
    newest = entries.groupBy("job").agg(
        F.max_by(F.struct(*names[1:]), F.struct("seen", "batch")).alias("entry")
    )
    return newest.select("job", *[F.col(f"entry.{name}").alias(name) for name in names[1:]])
