"""Merging, archives and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.contract import views as v
from tidelake.contract.registry import query
from tidelake.contract.views import with_views
from tidelake.operators import catalog as c
from tidelake.operators import merge as m
from tidelake.schemas import NATURAL_KEY, PARTITION_COLUMNS, REQUIRED_PARTITION_KEYS

_ROW = "source, external_id, payload_hash, observed_at, event_ts, sport, payload_json, seq, source_slug, sport_slug, event_date"
_KEYS = "source_slug, sport_slug, event_date, source, external_id, payload_hash"


@query("merge_keep_first", with_views(f"SELECT {_ROW} FROM existing UNION ALL SELECT {_ROW} FROM added", "added"))
def merge_keep_first(spark, sf):
    return m.merge_keep_first(v.existing(spark, sf), v.incoming(spark, sf), ["seq"])


@query("keep_first", with_views(f"SELECT {_ROW} FROM first_arrivals", "first_arrivals"))
def keep_first(spark, sf):
    return m.keep_first(v.observations(spark, sf), ["seq"])


@query("new_snapshots", with_views(f"SELECT {_ROW} FROM added", "added"))
def new_snapshots(spark, sf):
    return m.new_snapshots(v.incoming(spark, sf), v.existing(spark, sf), ["seq"])


@query(
    "added_counts",
    with_views(
        "SELECT (SELECT count(*) FROM incoming) AS received, (SELECT count(*) FROM added) AS added", "added"
    ),
)
def added_counts(spark, sf):
    return m.added_counts(v.incoming(spark, sf), v.existing(spark, sf), ["seq"])


@query(
    "union_archive",
    with_views(f"SELECT {_ROW} FROM existing UNION ALL SELECT {_ROW.replace('payload_json', 'NULL')} FROM incoming", "added"),
)
def union_archive(spark, sf):
    return m.union_archive(v.existing(spark, sf), v.incoming(spark, sf).drop("payload_json"))


@query(
    "key_differences",
    with_views(
        f"""SELECT *, 'missing' AS problem FROM (SELECT {_KEYS} FROM incoming EXCEPT SELECT {_KEYS} FROM existing)
        UNION ALL
        SELECT *, 'unexpected' AS problem FROM (SELECT {_KEYS} FROM existing EXCEPT SELECT {_KEYS} FROM incoming)""",
        "added",
    ),
)
def key_differences(spark, sf):
    return m.key_differences(v.incoming(spark, sf), v.existing(spark, sf))


@query(
    "key_set_equal",
    with_views(
        f"""SELECT NOT EXISTS (SELECT {_KEYS} FROM first_arrivals EXCEPT SELECT {_KEYS} FROM observations)
               AND NOT EXISTS (SELECT {_KEYS} FROM observations EXCEPT SELECT {_KEYS} FROM first_arrivals) AS equal""",
        "first_arrivals",
    ),
)
def key_set_equal(spark, sf):
    obs = v.observations(spark, sf)
    return m.key_sets_equal(obs, m.keep_first(obs, ["seq"]))


@query(
    "add_partition_columns",
    with_views("SELECT seq, source_slug, sport_slug, event_date FROM observations", "observations"),
)
def add_partition_columns(spark, sf):
    obs = v.observations(spark, sf).drop(*PARTITION_COLUMNS)
    return m.add_partition_columns(obs).select("seq", *PARTITION_COLUMNS)


_STATS = """SELECT source_slug, sport_slug, event_date, count(*) AS rows, min(event_ts) AS min_ts, max(event_ts) AS max_ts
            FROM {} GROUP BY ALL"""


@query("partition_stats", with_views(_STATS.format("first_arrivals"), "first_arrivals"))
def partition_stats(spark, sf):
    return c.partition_stats(m.keep_first(v.observations(spark, sf), ["seq"]))


@query("refresh_partition_stats", with_views(_STATS.format("first_arrivals"), "first_arrivals"))
def refresh_partition_stats(spark, sf):
    """Only the partitions the incoming rows touch are counted again."""
    before, after = v.existing(spark, sf), m.keep_first(v.observations(spark, sf), ["seq"])
    touched = v.incoming(spark, sf).select(*PARTITION_COLUMNS).distinct()
    recount = c.partition_stats(after.join(touched, PARTITION_COLUMNS, "left_semi"))
    return c.refresh_partition_stats(c.partition_stats(before), recount)


@query(
    "manifest_partitions",
    with_views(
        """SELECT 'sports_events/source_slug=' || source_slug || '/sport_slug=' || sport_slug || '/event_date='
                  || event_date AS partition, count(*) AS rows,
                  strftime(min(event_ts), '%Y-%m-%dT%H:%M:%S+00:00') AS min_ts,
                  strftime(max(event_ts), '%Y-%m-%dT%H:%M:%S+00:00') AS max_ts,
                  '2024-01-31T00:00:00+00:00' AS updated_at
           FROM first_arrivals GROUP BY source_slug, sport_slug, event_date""",
        "first_arrivals",
    ),
)
def manifest_partitions(spark, sf):
    stats = c.partition_stats(m.keep_first(v.observations(spark, sf), ["seq"]))
    return c.manifest_partitions(stats, c.partition_key("sports_events"), v.now())


def _manifests(spark, sf):
    """A manifest line per archived partition; every third is damaged in one of four ways."""
    first = m.keep_first(v.observations(spark, sf), ["seq"])
    entries = c.manifest_partitions(c.partition_stats(first), c.partition_key("sports_events"), v.now())
    lines = c.manifest_lines(entries, {"source": "string"}, "sports_events", "event_ts", NATURAL_KEY, v.now())
    body = F.col("value")
    day = F.regexp_extract(body, r"event_date=\d{4}-\d{2}-(\d{2})", 1).cast("int")
    damaged = (
        F.when(day % 6 == 0, F.replace(body, F.lit('"ts_column"'), F.lit('"timestamp_column"')))
        .when(day % 6 == 1, F.regexp_replace(body, r',"updated_at":"[^"]*"\}\}', "}}"))
        .when(day % 6 == 2, F.regexp_replace(body, r'"partitions":\{.*\}\},', '"partitions":[1],'))
        .when(day % 6 == 3, F.regexp_replace(body, r'("partitions":\{"[^"]*":)\{[^}]*\}', "$15"))
        .otherwise(body)
    )
    return lines.select(damaged.alias("body"))


@query(
    "validate_manifest",
    with_views(
        """SELECT 'sports_events' AS dataset,
                  CASE WHEN d IN (1, 3) THEN p END AS partition,
                  CASE d WHEN 0 THEN 'missing manifest keys' WHEN 1 THEN 'missing partition keys'
                         WHEN 2 THEN 'partitions is not a mapping' ELSE 'partition is not a mapping' END AS problem,
                  CASE d WHEN 0 THEN 'ts_column' WHEN 1 THEN 'updated_at' WHEN 2 THEN 'partitions'
                         ELSE 'max_ts,min_ts,rows,updated_at' END AS keys
           FROM (SELECT DISTINCT day(event_date) % 6 AS d,
                        'sports_events/source_slug=' || source_slug || '/sport_slug=' || sport_slug
                        || '/event_date=' || event_date AS p FROM observations) WHERE d < 4""",
        "observations",
    ),
)
def validate_manifest(spark, sf):
    return c.validate_manifest(_manifests(spark, sf))


@query(
    "missing_keys",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'max_ts,min_ts' ELSE 'max_ts,min_ts,rows' END AS absent
       FROM events""",
)
def missing_keys(spark, sf):
    e = v.table(spark, sf, "events")
    present = F.when(F.col("event_type") == "click", F.array(F.lit("updated_at"), F.lit("rows"))).otherwise(
        F.array(F.lit("updated_at"))
    )
    return e.select("event_id", F.array_join(c.missing_keys(REQUIRED_PARTITION_KEYS, present), ",").alias("absent"))


@query(
    "schema_union",
    """SELECT name, first(type ORDER BY file, type) AS type FROM (
           SELECT lang || '/' || source AS file, 'text' AS name, 'string' AS type FROM documents
           UNION ALL SELECT lang || '/' || source, 'n_chars', CASE WHEN n_chars > 500 THEN 'bigint' ELSE 'int' END FROM documents
           UNION ALL SELECT lang || '/' || source, 'only_' || lang, CASE WHEN doc_id % 2 = 0 THEN 'double' ELSE 'float' END FROM documents)
       GROUP BY name""",
)
def schema_union(spark, sf):
    d = v.table(spark, sf, "documents")
    described = F.array(
        F.struct(F.lit("text").alias("name"), F.lit("string").alias("type")),
        F.struct(
            F.lit("n_chars").alias("name"), F.when(F.col("n_chars") > 500, "bigint").otherwise("int").alias("type")
        ),
        F.struct(
            F.concat(F.lit("only_"), "lang").alias("name"),
            F.when(F.col("doc_id") % 2 == 0, "double").otherwise("float").alias("type"),
        ),
    )
    columns = d.select(F.concat_ws("/", "lang", "source").alias("file"), F.inline(described))
    return c.schema_union(columns)


@query(
    "bulk_datasets",
    with_views(
        """SELECT DISTINCT CASE source WHEN 'src0' THEN 'statsbomb_matches' ELSE source END AS dataset
           FROM files WHERE doc_id % 4 = 3 AND source NOT IN ('src1', 'src2')""",
        "files",
    ),
)
def bulk_datasets(spark, sf):
    return c.bulk_datasets(v.files(spark, sf).where(F.col("key").endswith("/provenance.json")))


@query(
    "bulk_manifest",
    with_views(
        """SELECT partition AS dataset, count(*) AS artifacts, CAST(sum(rows) AS BIGINT) AS rows,
                  min(strptime(fetched_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS min_ts,
                  max(strptime(fetched_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS max_ts
           FROM artifacts GROUP BY partition""",
        "artifacts",
    ),
)
def bulk_manifest(spark, sf):
    artifacts = v.artifacts(spark, sf)
    return c.bulk_manifest(artifacts.withColumn("dataset", F.col("partition")))


@query(
    "ingest_summary",
    with_views(
        """SELECT count(DISTINCT day) AS days, CAST(sum(fetched) AS BIGINT) AS snapshots_fetched,
                  CAST(sum(added) AS BIGINT) AS snapshots_added, count(DISTINCT partition) AS partitions FROM (
             SELECT CAST(o.observed_at AS DATE) AS day, o.source_slug || '/' || o.sport_slug || '/' || o.event_date AS partition,
                    count(*) AS fetched, count(f.seq) AS added
             FROM observations o LEFT JOIN first_arrivals f USING (seq) GROUP BY 1, 2)""",
        "first_arrivals",
    ),
)
def ingest_summary(spark, sf):
    from tidelake.operators.ingest import ingest_summary as summary

    return summary(_writes(spark, sf))


def _writes(spark, sf):
    """Per observation day and partition: snapshots fetched, and those no earlier day had brought."""
    obs = v.observations(spark, sf)
    first = m.keep_first(obs, ["seq"]).select("seq", F.lit(1).alias("is_new"))
    return (
        obs.join(first, "seq", "left")
        .groupBy(
            F.to_date("observed_at").alias("day"),
            F.concat_ws("/", *[F.col(p).cast("string") for p in PARTITION_COLUMNS]).alias("partition"),
        )
        .agg(F.count("*").alias("fetched"), F.count("is_new").alias("added"))
    )


@query(
    "partition_union",
    with_views(
        "SELECT DISTINCT source_slug || '/' || sport_slug || '/' || event_date AS partition FROM observations",
        "observations",
    ),
)
def partition_union(spark, sf):
    from tidelake.operators.ingest import touched_partitions

    name = F.concat_ws("/", *[F.col(p).cast("string") for p in PARTITION_COLUMNS]).alias("partition")
    return touched_partitions(v.existing(spark, sf).select(name), v.incoming(spark, sf).select(name))


@query(
    "sort_events",
    with_views(f"SELECT {_ROW} FROM first_arrivals", "first_arrivals"),
)
def sort_events(spark, sf):
    from tidelake.operators.archive import sort_events as ordered

    return ordered(m.keep_first(v.observations(spark, sf), ["seq"]))


@query("sort_odds", with_views(f"SELECT {_ROW} FROM first_arrivals", "first_arrivals"))
def sort_odds(spark, sf):
    from tidelake.operators.archive import sort_odds as ordered

    return ordered(m.keep_first(v.observations(spark, sf), ["seq"]))


@query(
    "filter_provider_scope",
    with_views(
        "SELECT seq, sport FROM observations WHERE event_date = DATE '2024-02-10' AND sport = 'Soccer'", "observations"
    ),
)
def filter_provider_scope(spark, sf):
    from tidelake.operators.normalize import provider_scope

    obs = v.observations(spark, sf)
    return provider_scope(obs, F.lit("2024-02-10").cast("date"), " Soccer ").select("seq", "sport")
