"""The given tables in the shapes the operators take.

Each view has a SQL twin of the same name in ``SQL``; the twins are the CTEs of
the check queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.text import slug
from tidelake.session import pin_utc

SPORTS = ["Soccer", "Baseball", "Basketball", "Ice Hockey", "American Football"]
SPLIT = "2024-01-16"
NOW = "2024-01-31 00:00:00"
INTERVAL = 21_600.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def instant(column: str) -> Column:
    """A zone-less table time as a UTC instant."""
    return F.col(column).cast("timestamp")


def plain_times(df: DataFrame) -> DataFrame:
    """Instants back to zone-less times for comparison."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as snapshots: the payload decides the event date, as it does in a feed."""
    e = table(spark, sf, "events")
    sport = F.element_at(F.array(*[F.lit(s) for s in SPORTS]), (F.col("user_id") % 5 + 1).cast("int"))
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("external_id"),
        F.sha2("props", 256).alias("payload_hash"),
        instant("ts").alias("observed_at"),
        F.date_add(F.lit("2024-01-01").cast("date"), k).cast("timestamp").alias("event_ts"),
        sport.alias("sport"),
        F.col("props").alias("payload_json"),
        F.col("event_id").alias("seq"),
        slug("event_type").alias("source_slug"),
        slug(sport).alias("sport_slug"),
        F.date_add(F.lit("2024-01-01").cast("date"), k).alias("event_date"),
    )


def existing(spark: SparkSession, sf: str) -> DataFrame:
    """What the archive holds before the split: first arrivals of the first half of the month."""
    from tidelake.operators.merge import keep_first

    early = observations(spark, sf).where(F.col("observed_at") < F.lit(SPLIT).cast("timestamp"))
    return keep_first(early, ["seq"])


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).where(F.col("observed_at") >= F.lit(SPLIT).cast("timestamp"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "error")
        .when(kind == "signup", "skipped")
        .when(kind == "view", "partial")
        .otherwise("ok")
    )
    return e.select(
        F.col("user_id").cast("string").alias("job"),
        F.col("event_id").alias("seq"),
        instant("ts").alias("ts"),
        status.alias("status"),
        F.length("props").cast("bigint").alias("fetched"),
        F.when(F.col("value") < 40, 0).otherwise(1).cast("bigint").alias("added"),
        F.col("props").alias("detail"),
    )


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    return runs(spark, sf).select("job").distinct().withColumn("interval_seconds", F.lit(INTERVAL))


def units(spark: SparkSession, sf: str) -> DataFrame:
    """Polls of one unit (event type) within a job's daily run."""
    e = table(spark, sf, "events")
    failed = F.col("value") >= 60
    return e.select(
        F.col("user_id").cast("string").alias("job"),
        F.to_date(instant("ts")).alias("run"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("unit"),
        F.when(failed, 0).otherwise(F.length("props")).cast("bigint").alias("fetched"),
        F.when(failed, 0).otherwise(1).cast("bigint").alias("added"),
        F.when(failed, F.concat("event_type", F.lit(": "), "props")).alias("failure"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("provider"), F.col("event_id").alias("seq"), instant("ts").alias("ts")
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as lake files: half of them sources, the others data, some elsewhere."""
    d = table(spark, sf, "documents")
    kind = F.col("doc_id") % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("source-"), F.col("doc_id").cast("string"), F.lit(".json")))
        .when(kind == 1, F.concat(F.col("doc_id").cast("string"), F.lit(".parquet")))
        .when(kind == 2, F.concat(F.lit("source-"), F.col("doc_id").cast("string"), F.lit(".csv.part")))
        .otherwise(F.lit("provenance.json"))
    )
    top = (
        F.when(F.col("source") == "src0", "statsbomb_matches")
        .when(F.col("source") == "src1", "_catalog")
        .when(F.col("source") == "src2", "_staging")
        .otherwise(F.col("source"))
    )
    return d.select(
        F.concat_ws("/", top, "lang", F.col("doc_id").cast("string"), name).alias("key"),
        F.col("n_chars").alias("length"),
        F.sha2("text", 256).alias("digest"),
        (F.col("n_chars") % 97).alias("rows"),
        F.col("doc_id"),
    )


def local_files(spark: SparkSession, sf: str) -> DataFrame:
    from tidelake.sources.lake import inventory

    listed = files(spark, sf)
    return inventory(listed).join(listed.select("key", "digest", "rows", "doc_id"), "key")


def mirror_before(spark: SparkSession, sf: str) -> DataFrame:
    """The mirror lacks every seventh object and holds some damaged ones."""
    return mirror_after(spark, sf).where(F.col("doc_id") % 7 != 0)


def mirror_after(spark: SparkSession, sf: str) -> DataFrame:
    """The mirror as read back after copying: every eleventh object is damaged, some miscounted."""
    return files(spark, sf).select(
        "key",
        F.when(F.col("doc_id") % 11 == 0, F.sha2(F.concat("digest", F.lit("tampered")), 256))
        .otherwise(F.col("digest"))
        .alias("digest"),
        F.when(F.col("doc_id") % 13 == 0, F.col("rows") + 1).otherwise(F.col("rows")).alias("rows"),
        "doc_id",
    )


def imports(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as attempted artifact imports; exact copies are the same content."""
    d = table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("seq"),
        F.col("source"),
        F.lit("documents").alias("dataset"),
        F.concat(F.lit("lang="), "lang").alias("partition"),
        F.sha2("text", 256).alias("source_sha256"),
        F.col("n_chars").alias("rows"),
        F.concat("source", F.lit(" "), F.col("doc_id").cast("string"), F.lit(".json")).alias("source_filename"),
        F.date_format(
            F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
        ).alias("fetched_at"),
    )


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded artifacts: the first import of each content, some of them pruned."""
    from tidelake.operators.bulk import ARTIFACT_KEY, artifact_paths
    from tidelake.operators.skew import first_per_key

    first = first_per_key(imports(spark, sf), ARTIFACT_KEY, ["seq"])
    pruned = F.col("seq") % 5 == 0
    return artifact_paths(first).select(
        "seq",
        "dataset",
        "partition",
        "source_sha256",
        "source_file",
        "data_file",
        "rows",
        "fetched_at",
        pruned.alias("source_pruned"),
        F.when(pruned & (F.col("seq") % 10 == 0), F.concat(F.lit("remote/"), "source_file")).alias(
            "source_remote_key"
        ),
    )


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as price quotes of a part by a supplier."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("source"),
        F.col("l_partkey").cast("string").alias("external_id"),
        instant("l_shipdate").alias("observed_at"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "quote_id"
        ),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
    )


SQL = {
    "observations": """
        SELECT event_type AS source, CAST(user_id AS VARCHAR) AS external_id, sha256(props) AS payload_hash,
               ts AS observed_at,
               CAST(DATE '2024-01-01' + CAST(json_extract_string(props, '$.k') AS INTEGER) AS TIMESTAMP) AS event_ts,
               (['Soccer','Baseball','Basketball','Ice Hockey','American Football'])[CAST(user_id % 5 AS INTEGER) + 1] AS sport,
               props AS payload_json, event_id AS seq, lower(event_type) AS source_slug,
               replace(lower((['Soccer','Baseball','Basketball','Ice Hockey','American Football'])[CAST(user_id % 5 AS INTEGER) + 1]), ' ', '-') AS sport_slug,
               CAST(DATE '2024-01-01' + CAST(json_extract_string(props, '$.k') AS INTEGER) AS DATE) AS event_date
        FROM events""",
    "first_arrivals": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY source_slug, sport_slug, event_date, source, external_id,
                                         payload_hash ORDER BY seq) AS rn FROM observations) WHERE rn = 1""",
    "existing": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY source_slug, sport_slug, event_date, source, external_id,
                                         payload_hash ORDER BY seq) AS rn
            FROM observations WHERE observed_at < TIMESTAMP '2024-01-16') WHERE rn = 1""",
    "incoming": "SELECT * FROM observations WHERE observed_at >= TIMESTAMP '2024-01-16'",
    "added": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY source_slug, sport_slug, event_date, source, external_id,
                                         payload_hash ORDER BY seq) AS rn FROM incoming) i
        WHERE rn = 1 AND NOT EXISTS (
            SELECT 1 FROM existing e WHERE e.source_slug = i.source_slug AND e.sport_slug = i.sport_slug
              AND e.event_date = i.event_date AND e.source = i.source AND e.external_id = i.external_id
              AND e.payload_hash = i.payload_hash)""",
    "runs": """
        SELECT CAST(user_id AS VARCHAR) AS job, event_id AS seq, ts,
               CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped'
                               WHEN 'view' THEN 'partial' ELSE 'ok' END AS status,
               CAST(length(props) AS BIGINT) AS fetched,
               CAST(CASE WHEN value < 40 THEN 0 ELSE 1 END AS BIGINT) AS added, props AS detail
        FROM events""",
    "units": """
        SELECT CAST(user_id AS VARCHAR) AS job, CAST(ts AS DATE) AS run, event_id AS seq, event_type AS unit,
               CAST(CASE WHEN value >= 60 THEN 0 ELSE length(props) END AS BIGINT) AS fetched,
               CAST(CASE WHEN value >= 60 THEN 0 ELSE 1 END AS BIGINT) AS added,
               CASE WHEN value >= 60 THEN event_type || ': ' || props END AS failure
        FROM events""",
    "requests": "SELECT event_type AS provider, event_id AS seq, ts FROM events",
    "files": """
        SELECT concat_ws('/',
                 CASE source WHEN 'src0' THEN 'statsbomb_matches' WHEN 'src1' THEN '_catalog'
                             WHEN 'src2' THEN '_staging' ELSE source END,
                 lang, CAST(doc_id AS VARCHAR),
                 CASE doc_id % 4 WHEN 0 THEN 'source-' || doc_id || '.json' WHEN 1 THEN doc_id || '.parquet'
                                 WHEN 2 THEN 'source-' || doc_id || '.csv.part' ELSE 'provenance.json' END) AS key,
               n_chars AS length, sha256(text) AS digest, n_chars % 97 AS rows, doc_id, source
        FROM documents""",
    "local_files": """
        SELECT key, length AS size,
               CASE source WHEN 'src0' THEN 'statsbomb_matches' WHEN 'src1' THEN '' ELSE source END AS dataset,
               doc_id % 4 = 0 AS is_source, doc_id % 4 = 1 AS is_parquet, digest, rows, doc_id
        FROM files WHERE source <> 'src2' AND doc_id % 4 <> 2""",
    "mirror_after": """
        SELECT key, CASE WHEN doc_id % 11 = 0 THEN sha256(digest || 'tampered') ELSE digest END AS digest,
               CASE WHEN doc_id % 13 = 0 THEN rows + 1 ELSE rows END AS rows, doc_id FROM files""",
    "mirror_before": "SELECT * FROM mirror_after WHERE doc_id % 7 <> 0",
    "verified": """
        SELECT f.*, m.digest AS mirror_digest, m.rows AS mirror_rows,
               CASE WHEN f.digest <> m.digest THEN 'digests differ: local ' || f.digest || ', mirror ' || m.digest
                    WHEN f.is_parquet AND f.rows <> m.rows THEN 'row counts differ: local ' || f.rows
                         || ', mirror ' || m.rows END AS problem
        FROM local_files f JOIN mirror_after m USING (key)""",
    "imports": """
        SELECT doc_id AS seq, source, 'documents' AS dataset, 'lang=' || lang AS partition,
               sha256(text) AS source_sha256, n_chars AS rows, source || ' ' || doc_id || '.json' AS source_filename,
               strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%S+00:00') AS fetched_at
        FROM documents""",
    "first_imports": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY dataset, partition, source_sha256 ORDER BY seq) AS rn
            FROM imports) WHERE rn = 1""",
    "artifacts": """
        SELECT seq, dataset, partition, source_sha256,
               dataset || '/' || partition || '/version=' || substr(source_sha256, 1, 16) || '/source-'
                   || replace(source_filename, ' ', '-') AS source_file,
               dataset || '/' || partition || '/version=' || substr(source_sha256, 1, 16) || '/data.parquet' AS data_file,
               rows, fetched_at, seq % 5 = 0 AS source_pruned,
               CASE WHEN seq % 10 = 0 THEN 'remote/' || dataset || '/' || partition || '/version='
                   || substr(source_sha256, 1, 16) || '/source-' || replace(source_filename, ' ', '-') END AS source_remote_key
        FROM first_imports""",
    "quotes": """
        SELECT CAST(l_suppkey AS VARCHAR) AS source, CAST(l_partkey AS VARCHAR) AS external_id,
               l_shipdate AS observed_at, l_orderkey || '-' || l_linenumber AS quote_id,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS price
        FROM lineitem""",
}

_NEEDS = {
    "first_arrivals": ["observations"],
    "existing": ["observations"],
    "incoming": ["observations"],
    "added": ["observations", "existing", "incoming"],
    "local_files": ["files"],
    "mirror_after": ["files"],
    "mirror_before": ["files", "mirror_after"],
    "verified": ["files", "local_files", "mirror_after"],
    "first_imports": ["imports"],
    "artifacts": ["imports", "first_imports"],
}


def with_views(query: str, *views: str) -> str:
    """A query preceded by the views it reads and those they read."""
    ordered: list[str] = []
    for view in views:
        for name in [*_NEEDS.get(view, []), view]:
            if name not in ordered:
                ordered.append(name)
    return "WITH " + ",\n".join(f"{name} AS ({SQL[name]})" for name in ordered) + "\n" + query
