"""Health, budgets, mirror audits and fetch rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.contract import views as v
from tidelake.contract.registry import query
from tidelake.contract.views import with_views
from tidelake.operators import fetch as fe
from tidelake.operators import health as h
from tidelake.operators import mirror as mi
from tidelake.operators import quota as q

# ---------------------------------------------------------------------- health

_FOLD = """marks AS (
    SELECT job, count(*) FILTER (status <> 'skipped') AS runs, count(*) FILTER (status = 'error') AS failures,
           count(*) FILTER (status = 'partial') AS degraded_runs,
           max(seq) FILTER (status IN ('ok', 'partial')) AS ls, max(seq) FILTER (status IN ('ok', 'partial') AND added > 0) AS lw,
           max(seq) FILTER (status <> 'skipped') AS lr, max(seq) FILTER (status = 'error') AS lf, max(seq) AS lseq
    FROM runs GROUP BY job),
entries AS (
    SELECT r.job, CAST(21600 AS DOUBLE) AS interval_seconds, any_value(m.runs) AS runs, any_value(m.failures) AS failures,
           count(*) FILTER (status = 'error' AND (ls IS NULL OR seq > ls)) AS consecutive_failures,
           any_value(m.degraded_runs) AS degraded_runs,
           count(*) FILTER (status IN ('ok', 'partial') AND (lw IS NULL OR seq > lw)) AS writeless_successes,
           max(ts) FILTER (seq = lr) AS last_run, max(ts) FILTER (seq = ls) AS last_success,
           max(ts) FILTER (seq = lf) AS last_failure, max(ts) FILTER (seq = lw) AS last_wrote,
           max(status) FILTER (seq = lseq) AS last_status,
           coalesce(max(fetched) FILTER (seq = lr), 0) AS last_fetched, coalesce(max(added) FILTER (seq = lr), 0) AS last_added,
           max(detail) FILTER (seq = lseq) AS last_detail,
           max(CASE WHEN status IN ('error', 'partial') THEN detail END) FILTER (seq = lr) AS last_error,
           CAST(NULL AS VARCHAR) AS last_traceback,
           max(CASE WHEN status = 'skipped' THEN detail END) FILTER (seq = lseq) AS skip_reason
    FROM runs r JOIN marks m ON r.job = m.job GROUP BY r.job),
judged AS (
    SELECT *, CASE WHEN consecutive_failures > 0 THEN 'failing'
                   WHEN runs = 0 THEN CASE WHEN coalesce(skip_reason, '') <> '' THEN 'skipped' ELSE 'never-run' END
                   WHEN last_success IS NULL THEN 'never-run'
                   WHEN epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_success) > interval_seconds * 2500000 THEN 'stale'
                   WHEN last_status = 'partial' THEN 'degraded' WHEN writeless_successes >= 3 THEN 'idle' ELSE 'ok' END AS status
    FROM entries)"""


def _health_sql(select: str) -> str:
    return with_views("", "runs").rstrip() + ",\n" + _FOLD + "\n" + select


def _fold(spark, sf):
    return h.health_fold(v.runs(spark, sf), v.schedule(spark, sf))


def _judged(spark, sf):
    return h.with_verdict(_fold(spark, sf), v.now())


@query("health_fold", _health_sql("SELECT * FROM entries"))
def health_fold(spark, sf):
    return _fold(spark, sf)


@query("health_resumed", _health_sql("SELECT * FROM entries"))
def health_resumed(spark, sf):
    """The fold of the second half of the log, started from the state after the first half."""
    runs, cut = v.runs(spark, sf), F.lit(v.SPLIT).cast("timestamp")
    early = h.health_fold(runs.where(F.col("ts") < cut), v.schedule(spark, sf))
    return h.resume_health(early, h.health_fold(runs.where(F.col("ts") >= cut), v.schedule(spark, sf)))


@query("status_for", _health_sql("SELECT job, status FROM judged"))
def status_for(spark, sf):
    return _judged(spark, sf).select("job", "status")


@query("unhealthy_jobs", _health_sql("SELECT job, status FROM judged WHERE status IN ('failing', 'stale', 'degraded', 'idle')"))
def unhealthy_jobs(spark, sf):
    return h.unhealthy_jobs(_judged(spark, sf)).select("job", "status")


@query(
    "health_report",
    _health_sql(
        """SELECT count(*) FILTER (status NOT IN ('ok', 'never-run', 'skipped')) = 0 AS ok, count(*) AS jobs,
           count(*) FILTER (status IN ('failing', 'stale', 'degraded', 'idle')) AS problems,
           count(*) FILTER (status = 'failing') AS failing, count(*) FILTER (status = 'stale') AS stale,
           count(*) FILTER (status = 'degraded') AS degraded, count(*) FILTER (status = 'idle') AS idle FROM judged"""
    ),
)
def health_report(spark, sf):
    return h.health_report(_judged(spark, sf))


def _age(column: str) -> str:
    a = f"((epoch_us(TIMESTAMP '2024-01-31') - epoch_us({column})) // 1000000)"
    return f"""CASE WHEN {column} IS NULL THEN 'never' WHEN {a} >= 86400 THEN {a} // 86400 || 'd ago'
        WHEN {a} >= 3600 THEN {a} // 3600 || 'h ago' WHEN {a} >= 60 THEN {a} // 60 || 'm ago' ELSE {a} || 's ago' END"""


@query(
    "health_worst_first",
    _health_sql(
        f"""SELECT CASE status WHEN 'failing' THEN 0 WHEN 'stale' THEN 1 WHEN 'degraded' THEN 2 WHEN 'idle' THEN 3
                  WHEN 'never-run' THEN 4 WHEN 'skipped' THEN 5 ELSE 9 END AS rank, job, status,
            {_age('last_success')} AS last_ok, {_age('last_wrote')} AS wrote, runs, failures,
            CASE WHEN status <> 'ok' THEN coalesce(last_error, skip_reason) END AS reason
            FROM judged WHERE status <> 'ok'"""
    ),
)
def health_worst_first(spark, sf):
    return h.health_worst_first(_judged(spark, sf), v.now(), quiet=True)


@query(
    "run_streaks",
    with_views(
        """, counted AS (SELECT job, seq, status, added,
              count(*) FILTER (status = 'error') OVER w AS e, count(*) FILTER (status IN ('ok', 'partial') AND added = 0) OVER w AS n
              FROM runs WINDOW w AS (PARTITION BY job ORDER BY seq ROWS UNBOUNDED PRECEDING))
           SELECT job, seq, status,
                  e - coalesce(max(CASE WHEN status IN ('ok', 'partial') THEN e END) OVER w, 0) AS failure_streak,
                  n - coalesce(max(CASE WHEN status IN ('ok', 'partial') AND added > 0 THEN n END) OVER w, 0) AS writeless_streak
           FROM counted WINDOW w AS (PARTITION BY job ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
        "runs",
    ),
)
def run_streaks(spark, sf):
    """Cut into short segments so that the carry between them is exercised."""
    return h.run_streaks(v.runs(spark, sf), rows=1000)


@query(
    "run_outcome",
    with_views(
        """SELECT job, run, CASE WHEN count(failure) = 0 THEN 'ok' WHEN sum(fetched) = 0 AND sum(added) = 0 THEN 'error' ELSE 'partial' END AS status,
                  CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(added) AS BIGINT) AS added,
                  coalesce(string_agg(failure, '; ' ORDER BY seq), '') AS detail
           FROM units GROUP BY job, run""",
        "units",
    ),
)
def run_outcome(spark, sf):
    return h.run_outcome(v.units(spark, sf))


@query("run_failures", with_views("SELECT job, run, seq, unit, failure FROM units WHERE failure IS NOT NULL", "units"))
def run_failures(spark, sf):
    return h.run_failures(v.units(spark, sf))


@query("health_seed", _health_sql("SELECT * REPLACE (0 AS failures) FROM entries"))
def health_seed(spark, sf):
    """Entries written as a state document and read back; unknown fields go, missing ones default."""
    from tidelake.sources.lake import health_entries

    e = _fold(spark, sf)
    fields = [F.col(c) if e.schema[c].dataType.typeName() != "timestamp" else F.col(c).cast("string").alias(c)
              for c in e.columns if c not in ("job", "failures")]
    document = F.to_json(F.struct(F.create_map("job", F.struct(*fields, F.lit(1).alias("later_field"))).alias("jobs")))
    return health_entries(e.select(document.alias("body")))


# --------------------------------------------------------------------- budgets


@query(
    "quota_usage",
    with_views("SELECT provider, CAST(ts AS DATE) AS day, count(*) AS requests FROM requests GROUP BY ALL", "requests"),
)
def quota_usage(spark, sf):
    return q.quota_usage(v.requests(spark, sf))


_CLAIMS = """, claims AS (SELECT provider, seq, ts, CAST(ts AS DATE) AS day,
    row_number() OVER (PARTITION BY provider, CAST(ts AS DATE) ORDER BY seq) AS n FROM requests)"""


@query(
    "quota_admission",
    with_views(
        _CLAIMS + " SELECT provider, day, seq, ts, CASE WHEN n <= 60 THEN n END AS claim, n <= 60 AS admitted FROM claims",
        "requests",
    ),
)
def quota_admission(spark, sf):
    return q.quota_admission(v.requests(spark, sf), 60)


@query(
    "pacing_schedule",
    with_views(
        _CLAIMS
        + """, numbered AS (SELECT provider, seq, ts, epoch_us(ts) AS a, row_number() OVER (PARTITION BY provider ORDER BY seq) AS i,
                CASE provider WHEN 'view' THEN 7200000000 ELSE 1800000000 END AS d FROM claims WHERE n <= 60),
            released AS (SELECT *, d * i + max(a - d * i) OVER (PARTITION BY provider ORDER BY seq ROWS UNBOUNDED PRECEDING) AS r FROM numbered)
            SELECT provider, seq, ts, make_timestamp(CAST(r AS BIGINT)) AS released_at, CAST(r - a AS BIGINT) AS wait_micros FROM released""",
        "requests",
    ),
)
def pacing_schedule(spark, sf):
    """Admitted requests only: a refused request never moves the clock."""
    admitted = q.quota_admission(v.requests(spark, sf), 60).where("admitted")
    spacing = F.when(F.col("provider") == "view", F.lit(7200)).otherwise(F.lit(1800))
    return q.pacing_schedule(admitted, spacing, rows=1000)


# ---------------------------------------------------------------------- mirror


@query("scan_inventory", with_views("SELECT key, size, dataset, is_source, is_parquet FROM local_files", "local_files"))
def scan_inventory(spark, sf):
    from tidelake.sources.lake import inventory

    return inventory(v.files(spark, sf))


@query(
    "prunable",
    with_views("SELECT key FROM local_files WHERE is_source AND dataset NOT IN ('statsbomb_matches', 'statsbomb_competitions')", "local_files"),
)
def prunable(spark, sf):
    return mi.prunable_files(v.local_files(spark, sf)).select("key")


@query("oversize", with_views("SELECT key, size FROM local_files WHERE size > 2000", "local_files"))
def oversize(spark, sf):
    return mi.oversize_files(v.local_files(spark, sf), 2000).select("key", "size")


@query(
    "mirror_presence",
    with_views(
        "SELECT key, key IN (SELECT key FROM mirror_before) AS present FROM local_files", "mirror_before", "local_files"
    ),
)
def mirror_presence(spark, sf):
    return mi.mirror_presence(v.local_files(spark, sf), v.mirror_before(spark, sf)).select("key", "present")


@query("verify_mirror", with_views("SELECT key, problem FROM verified", "verified"))
def verify_mirror(spark, sf):
    return mi.verify_mirror(v.local_files(spark, sf), v.mirror_after(spark, sf)).select("key", "problem")


_LIMIT = 8000


def _outcomes_sql(prune: bool, dry_run: bool) -> str:
    wanted = (
        "(is_source AND dataset NOT IN ('statsbomb_matches', 'statsbomb_competitions'))" if prune else "false"
    )
    if dry_run:
        status = "CASE WHEN wanted THEN 'would-prune' ELSE 'would-upload' END"
        detail = "CASE WHEN present THEN 'present' ELSE 'absent' END"
        freed = "CASE WHEN wanted THEN size ELSE 0 END"
    else:
        status = "CASE WHEN problem IS NOT NULL THEN 'failed' WHEN wanted THEN 'pruned' ELSE 'uploaded' END"
        detail = "CASE WHEN problem IS NOT NULL THEN problem WHEN NOT wanted THEN '' WHEN present THEN 'already-present' ELSE 'uploaded' END"
        freed = "CASE WHEN problem IS NULL AND wanted THEN size ELSE 0 END"
    return f""", considered AS (SELECT *, {wanted} AS wanted, key IN (SELECT key FROM mirror_before) AS present FROM verified),
        outcomes AS (SELECT key, dataset,
            CASE WHEN size > {_LIMIT} THEN 'oversize' WHEN present AND NOT wanted THEN 'present' ELSE {status} END AS status,
            CASE WHEN size > {_LIMIT} THEN size || ' bytes, over the limit of {_LIMIT}'
                 WHEN present AND NOT wanted THEN '' ELSE {detail} END AS detail,
            CAST(CASE WHEN size > {_LIMIT} OR (present AND NOT wanted) THEN 0 ELSE {freed} END AS BIGINT) AS freed_bytes
            FROM considered)"""


def _sync_sql(select: str, prune: bool, dry_run: bool) -> str:
    return with_views(_outcomes_sql(prune, dry_run) + " " + select, "verified", "mirror_before")


def _outcomes(spark, sf, prune, dry_run):
    return mi.sync_outcomes(
        v.local_files(spark, sf), v.mirror_before(spark, sf), v.mirror_after(spark, sf), prune, dry_run, _LIMIT
    )


def _register_sync(label: str, prune: bool, dry_run: bool) -> None:
    @query(f"sync_status_{label}", _sync_sql("SELECT * FROM outcomes", prune, dry_run))
    def decisions(spark, sf):
        return _outcomes(spark, sf, prune, dry_run)

    @query(
        f"sync_summary_{label}",
        _sync_sql(
            """SELECT count(*) FILTER (status IN ('failed', 'oversize')) = 0 AS ok, count(*) AS scanned,
                      count(*) FILTER (status = 'uploaded' OR (status = 'pruned' AND detail = 'uploaded')) AS uploaded,
                      count(*) FILTER (status = 'present') AS already_present,
                      count(*) FILTER (status IN ('uploaded', 'pruned')) AS verified, count(*) FILTER (status = 'pruned') AS pruned,
                      count(*) FILTER (status IN ('would-upload', 'would-prune')) AS planned,
                      CAST(coalesce(sum(freed_bytes) FILTER (status = 'pruned'), 0) AS BIGINT) AS freed_bytes,
                      count(*) FILTER (status IN ('failed', 'oversize')) AS failures FROM outcomes""",
            prune,
            dry_run,
        ),
    )
    def totals(spark, sf):
        return mi.sync_summary(_outcomes(spark, sf, prune, dry_run))


_register_sync("upload", False, False)
_register_sync("prune", True, False)
_register_sync("dry_run", True, True)


@query(
    "top_failures",
    _sync_sql(
        """SELECT key, status, detail,
           greatest((SELECT count(*) FROM outcomes WHERE status IN ('failed', 'oversize')) - 10, 0) AS more
           FROM outcomes WHERE status IN ('failed', 'oversize') ORDER BY key LIMIT 10""",
        True,
        False,
    ),
)
def top_failures(spark, sf):
    return mi.top_failures(_outcomes(spark, sf, True, False))


_PRUNED = """, gone AS (SELECT DISTINCT source_file FROM artifacts WHERE rows % 3 = 0)"""


def _pruned_now(spark, sf):
    """Outcomes of a run that pruned the sources of every artifact with rows divisible by three."""
    a = v.artifacts(spark, sf).where(F.col("rows") % 3 == 0)
    return a.select(F.col("source_file").alias("key"), "dataset", F.lit("pruned").alias("status"))


@query(
    "mark_pruned",
    with_views(
        _PRUNED
        + """ SELECT a.* REPLACE (a.source_pruned OR g.source_file IS NOT NULL AS source_pruned,
                  CASE WHEN g.source_file IS NOT NULL THEN a.source_file ELSE a.source_remote_key END AS source_remote_key)
              FROM artifacts a LEFT JOIN gone g ON a.source_file = g.source_file""",
        "artifacts",
    ),
)
def mark_pruned(spark, sf):
    return mi.mark_pruned(v.artifacts(spark, sf), _pruned_now(spark, sf))


@query(
    "stale_copies",
    with_views(
        _PRUNED
        + """ SELECT DISTINCT regexp_replace(source_file, '[^/]*$', '') || 'provenance.json' AS key, 'refreshed' AS status FROM gone
              UNION ALL SELECT '_catalog/documents.json', 'refreshed' WHERE EXISTS (SELECT 1 FROM gone)""",
        "artifacts",
    ),
)
def stale_copies(spark, sf):
    return mi.stale_copies(v.artifacts(spark, sf), _pruned_now(spark, sf))


@query("read_provenance_pruned", with_views("SELECT * FROM artifacts WHERE source_pruned", "artifacts"))
def read_provenance_pruned(spark, sf):
    return mi.pruned_records(v.artifacts(spark, sf))


_RESTORE = """, objects AS (SELECT coalesce(source_remote_key, source_file) AS key,
        CASE WHEN seq % 15 = 0 THEN sha256(source_sha256) ELSE source_sha256 END AS digest FROM artifacts WHERE seq % 20 <> 5),
    plan AS (SELECT a.*, coalesce(a.source_remote_key, a.source_file) AS key, o.digest AS d
             FROM artifacts a LEFT JOIN objects o ON o.key = coalesce(a.source_remote_key, a.source_file) WHERE a.source_pruned)"""


def _restore_plan(spark, sf):
    a = v.artifacts(spark, sf)
    objects = a.where(F.col("seq") % 20 != 5).select(
        F.coalesce("source_remote_key", "source_file").alias("key"),
        F.when(F.col("seq") % 15 == 0, F.sha2("source_sha256", 256)).otherwise(F.col("source_sha256")).alias("digest"),
    )
    return mi.restore_plan(a, objects)


@query(
    "restore_plan",
    with_views(
        _RESTORE
        + """ SELECT key, dataset, partition, source_file, CASE WHEN d = source_sha256 THEN 'restored' ELSE 'failed' END AS status,
              CASE WHEN d IS NULL THEN 'no copy in the mirror' WHEN d <> source_sha256 THEN 'the copy''s digest '
                   || d || ' is not the recorded ' || source_sha256 ELSE '' END AS detail
              FROM plan""",
        "artifacts",
    ),
)
def restore_plan(spark, sf):
    return _restore_plan(spark, sf)


@query(
    "clear_restored",
    with_views(
        _RESTORE
        + """ SELECT a.* REPLACE (CASE WHEN b.source_file IS NULL THEN a.source_pruned END AS source_pruned,
                  CASE WHEN b.source_file IS NULL THEN a.source_remote_key END AS source_remote_key)
              FROM artifacts a LEFT JOIN (SELECT DISTINCT source_file FROM plan WHERE d = source_sha256) b ON a.source_file = b.source_file""",
        "artifacts",
    ),
)
def clear_restored(spark, sf):
    return mi.clear_restored(v.artifacts(spark, sf), _restore_plan(spark, sf))


@query(
    "source_state",
    with_views(
        """SELECT dataset, partition, source_file,
                  CASE WHEN rows % 2 = 0 THEN 'present' WHEN source_pruned OR seq % 7 = 0 THEN 'pruned' ELSE 'missing' END AS state,
                  CASE WHEN rows % 2 = 1 AND (source_pruned OR seq % 7 = 0)
                       THEN coalesce(source_remote_key, CASE WHEN seq % 7 = 0 THEN source_file END, 'the mirror') END AS restore_from
           FROM artifacts""",
        "artifacts",
    ),
)
def source_state(spark, sf):
    """The catalog copy knows some prunes, the records beside the data know others."""
    a = v.artifacts(spark, sf)
    later = F.col("seq") % 7 == 0
    beside = a.select(
        "source_file",
        later.alias("source_pruned"),
        F.when(later, F.col("source_file")).alias("source_remote_key"),
    )
    here = a.where(F.col("rows") % 2 == 0).select(F.col("source_file").alias("key"))
    return mi.source_state(a, beside, here)


@query("file_digest", "SELECT CAST(doc_id AS VARCHAR) AS key, sha256(text) AS digest FROM documents")
def file_digest(spark, sf):
    d = v.table(spark, sf, "documents")
    return mi.file_digests(d.select(F.col("doc_id").cast("string").alias("key"), F.col("text").cast("binary").alias("content")))


# --------------------------------------------------------------------- fetches


@query(
    "fetch_audit",
    """SELECT page_id, url, status_code, "offset", content_length, received, content_type,
              CASE WHEN status_code = 304 AND page_id % 2 = 0 THEN sha256(url) END AS reused_sha256,
              string_split(content_type, ';')[1] AS media_type,
              CASE WHEN status_code = 304 AND page_id % 2 = 0 THEN 'reuse' WHEN status_code NOT BETWEEN 200 AND 299 THEN 'reject-status'
                   WHEN o + greatest(content_length, received) > 40000 THEN 'reject-size'
                   WHEN string_split(content_type, ';')[1] = 'text/html' THEN 'reject-html'
                   WHEN status_code = 206 AND "offset" > 0 THEN 'append' ELSE 'accept' END AS decision
       FROM (SELECT *, CASE WHEN status_code = 206 AND "offset" > 0 THEN "offset" ELSE 0 END AS o FROM (
           SELECT page_id, url || '#' || page_id AS url, ([200, 304, 206, 404])[CAST(page_id % 4 AS INTEGER) + 1] AS status_code,
                  CASE WHEN page_id % 3 = 0 THEN 0 ELSE 30000 END AS "offset", length(url) * 100 AS content_length,
                  CAST(strlen(html) AS BIGINT) AS received,
                  CASE WHEN page_id % 5 = 0 THEN 'text/html; charset=utf-8' ELSE 'application/json' END AS content_type FROM pages))""",
)
def fetch_audit(spark, sf):
    p = v.table(spark, sf, "pages")
    page = F.col("page_id")
    fetches = p.select(
        "page_id",
        F.concat_ws("#", "url", page.cast("string")).alias("url"),
        F.element_at(F.array(*[F.lit(c) for c in (200, 304, 206, 404)]), (page % 4 + 1).cast("int")).alias("status_code"),
        F.when(page % 3 == 0, 0).otherwise(30000).alias("offset"),
        (F.length("url") * 100).cast("bigint").alias("content_length"),
        F.octet_length("html").cast("bigint").alias("received"),
        F.when(page % 5 == 0, "text/html; charset=utf-8").otherwise("application/json").alias("content_type"),
    )
    known = p.where(page % 2 == 0).select(
        F.concat_ws("#", "url", page.cast("string")).alias("url"),
        F.sha2(F.concat_ws("#", "url", page.cast("string")), 256).alias("sha256"),
    )
    return fe.fetch_audit(fetches, known, max_bytes=40000)
