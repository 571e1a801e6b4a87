"""Bulk imports, work lists and the documented reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.contract import views as v
from tidelake.contract.registry import query
from tidelake.contract.views import with_views
from tidelake.operators import bulk as b
from tidelake.plans import asof
from tidelake.plans import reads as r
from tidelake.plans import worklists as w
from tidelake.schemas import FOOTBALL_SEASON_URL, OPEN_DATA_URL, PLAY_BY_PLAY_URL, TEAM_GAMES_URL

# --------------------------------------------------------------------- imports


@query(
    "add_provenance",
    "SELECT doc_id, lang, sha256(text) AS source_sha256, doc_id // 2 AS source_row_number, TIMESTAMP '2024-01-31' AS source_fetched_at FROM documents",
)
def add_provenance(spark, sf):
    d = v.table(spark, sf, "documents").select("doc_id", "lang", "text")
    return b.add_provenance(d, F.sha2("text", 256), F.floor(F.col("doc_id") / 2), v.now()).drop("text")


@query("artifact_paths", with_views("SELECT seq, source_file, data_file FROM artifacts", "artifacts"))
def artifact_paths(spark, sf):
    return v.artifacts(spark, sf).select("seq", "source_file", "data_file")


_STORED = """, stored AS (SELECT * FROM artifacts WHERE rows % 2 = 0),
    fresh AS (SELECT * FROM first_imports f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.dataset = f.dataset
              AND s.partition = f.partition AND s.source_sha256 = f.source_sha256))"""


def _stored(spark, sf):
    """Recorded artifacts of which only those with an even row count still have their data file."""
    a = v.artifacts(spark, sf)
    files = a.where(F.col("rows") % 2 == 0).select(F.col("data_file").alias("key"))
    return b.stored_artifacts(a, files)


@query(
    "new_artifacts",
    with_views(_STORED + " SELECT seq, dataset, partition, source_sha256, rows FROM fresh", "artifacts"),
)
def new_artifacts(spark, sf):
    fresh = b.new_artifacts(v.imports(spark, sf), _stored(spark, sf))
    return fresh.select("seq", "dataset", "partition", "source_sha256", "rows")


_RESULTS = (
    _STORED
    + """, results AS (SELECT i.seq, i.source, i.dataset, i.partition, i.source_sha256,
           CASE WHEN f.seq IS NULL THEN 0 ELSE i.rows END AS rows, f.seq IS NOT NULL AS added
           FROM imports i LEFT JOIN fresh f ON f.seq = i.seq),
    summaries AS (SELECT source, count(*) AS attempted, count(*) FILTER (added) AS added, CAST(sum(rows) AS BIGINT) AS rows
                  FROM results GROUP BY source)"""
)


def _results(spark, sf):
    return b.import_results(v.imports(spark, sf), _stored(spark, sf))


@query("import_results", with_views(_RESULTS + " SELECT * FROM results", "artifacts"))
def import_results(spark, sf):
    return _results(spark, sf)


@query("import_summary", with_views(_RESULTS + " SELECT * FROM summaries", "artifacts"))
def import_summary(spark, sf):
    return b.import_summary(_results(spark, sf))


@query(
    "refresh_outcome",
    with_views(
        _RESULTS
        + """ SELECT 'ok' AS status, CAST(sum(attempted) AS BIGINT) AS fetched, CAST(sum(added) AS BIGINT) AS added,
              count(*) || ' datasets' AS detail FROM summaries""",
        "artifacts",
    ),
)
def refresh_outcome(spark, sf):
    return b.refresh_outcome(b.import_summary(_results(spark, sf)))


@query(
    "verify_row_count",
    """SELECT 'v' || c_nationkey AS version, count(*) + CASE WHEN c_nationkey % 4 = 0 THEN 1 ELSE 0 END AS rows, count(*) AS stored
       FROM customer WHERE c_nationkey % 4 = 0 GROUP BY c_nationkey""",
)
def verify_row_count(spark, sf):
    rows = v.table(spark, sf, "customer").withColumn("version", F.concat(F.lit("v"), F.col("c_nationkey").cast("string")))
    wrong = F.when(F.col("c_nationkey") % 4 == 0, 1).otherwise(0)
    announced = rows.groupBy("version", "c_nationkey").agg(F.count("*").alias("n")).select(
        "version", (F.col("n") + wrong).alias("rows")
    )
    return b.row_count_mismatches(announced, rows)


# ------------------------------------------------------------------- worklists


@query(
    "season_league_worklist",
    f"""SELECT c_custkey, y AS start_year, s AS season, p AS position, l AS league, 'football_data_uk_matches' AS dataset, CAST(NULL AS VARCHAR) AS reject_reason,
          'league=' || l || '/season=' || s AS partition,
          replace(replace('{FOOTBALL_SEASON_URL}', '{{season}}', s), '{{league}}', l) AS url
        FROM (SELECT c_custkey, y, lpad(CAST(y % 100 AS VARCHAR), 2, '0') || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS s, p,
                     CASE p WHEN 0 THEN 'E' || c_nationkey WHEN 1 THEN 'D1' END AS l
              FROM (SELECT c_custkey, c_nationkey, CAST(unnest(range(1995, 1998 + c_nationkey % 6)) AS INTEGER) AS y FROM customer)
                   CROSS JOIN (SELECT unnest([0, 1]) AS p)) """,
)
def season_league_worklist(spark, sf):
    c = v.table(spark, sf, "customer")
    code = F.concat(F.lit("e"), F.col("c_nationkey").cast("string"))
    requests = c.select(
        "c_custkey",
        F.lit(1995).alias("from_year"),
        (F.lit(1997) + F.col("c_nationkey") % 6).cast("int").alias("to_year"),
        F.concat(code, F.lit(", d1 ,,"), F.upper(code), F.lit(",D1")).alias("leagues"),
    )
    return w.season_league_worklist(requests)


@query(
    "season_worklist",
    f"""SELECT c_custkey, season, 'nflverse_play_by_play' AS dataset, 'season=' || season AS partition,
               replace('{PLAY_BY_PLAY_URL}', '{{season}}', CAST(season AS VARCHAR)) AS url
        FROM (SELECT c_custkey, CAST(unnest(range(2010, 2011 + c_nationkey)) AS INTEGER) AS season FROM customer)""",
)
def season_worklist(spark, sf):
    requests = v.table(spark, sf, "customer").select(
        "c_custkey", F.lit(2010).alias("from_year"), (F.lit(2010) + F.col("c_nationkey")).cast("int").alias("to_year")
    )
    return w.season_worklist(requests, "nflverse_play_by_play")


@query(
    "team_games_worklist",
    f"SELECT c_custkey, 'moneypuck_team_games' AS dataset, 'scope=all-seasons' AS partition, '{TEAM_GAMES_URL}' AS url FROM customer",
)
def team_games_worklist(spark, sf):
    return w.team_games_worklist(v.table(spark, sf, "customer").select("c_custkey"))


@query(
    "competition_worklist",
    f"""SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS competition_id, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
        'statsbomb_matches' AS dataset, 'competition_id=' || o_custkey || '/season_id=' || year(o_orderdate) AS partition,
        '{OPEN_DATA_URL}/matches/' || o_custkey || '/' || year(o_orderdate) || '.json' AS url FROM orders""",
)
def competition_worklist(spark, sf):
    targets = v.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("competition_id"), F.year("o_orderdate").cast("string").alias("season_id")
    )
    return w.competition_worklist(targets.distinct())


_MATCHES = """matches AS (SELECT CAST(l_suppkey AS VARCHAR) AS competition_id, l_returnflag AS season_id,
    l_linenumber - 1 AS position, CAST(l_orderkey AS VARCHAR) AS match_id FROM lineitem)"""


def _matches(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("competition_id"),
        F.col("l_returnflag").alias("season_id"),
        (F.col("l_linenumber") - 1).alias("position"),
        F.col("l_orderkey").cast("string").alias("match_id"),
    )


@query("limit_matches", f"WITH {_MATCHES} SELECT * FROM matches WHERE position < 3")
def limit_matches(spark, sf):
    return w.limit_matches(_matches(spark, sf), 3)


@query(
    "match_event_worklist",
    f"""WITH {_MATCHES} SELECT *, 'statsbomb_events' AS dataset,
        'competition_id=' || competition_id || '/season_id=' || season_id || '/match_id=' || match_id AS partition,
        '{OPEN_DATA_URL}/events/' || match_id || '.json' AS url FROM matches WHERE position < 2""",
)
def match_event_worklist(spark, sf):
    return w.match_event_worklist(_matches(spark, sf), 2)


@query(
    "day_worklist",
    """SELECT o_orderkey, CAST(unnest(range(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 + 1 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS day, CAST(NULL AS VARCHAR) AS reject_reason FROM orders""",
)
def day_worklist(spark, sf):
    first = F.to_date("o_orderdate")
    requests = v.table(spark, sf, "orders").select(
        "o_orderkey", first.alias("from_day"), F.date_add(first, (F.col("o_orderkey") % 4).cast("int")).alias("to_day")
    )
    return w.day_worklist(requests)


# ----------------------------------------------------------------------- reads

_READ = "source, external_id, payload_hash, observed_at, event_ts, sport, payload_json, seq"


@query(
    "latest_snapshot",
    with_views(
        f"""SELECT {_READ} FROM (SELECT *, row_number() OVER (PARTITION BY source, external_id
            ORDER BY observed_at DESC, payload_hash DESC) AS rn FROM first_arrivals) WHERE rn = 1""",
        "first_arrivals",
    ),
)
def latest_snapshot(spark, sf):
    from tidelake.operators.merge import keep_first

    return r.latest_snapshot(keep_first(v.observations(spark, sf), ["seq"])).select(*_READ.split(", "))


@query(
    "snapshot_history",
    with_views(
        """SELECT source, external_id, payload_hash, observed_at, sport AS status,
                  row_number() OVER w AS version, lag(sport) OVER w AS previous_status
           FROM (SELECT * REPLACE (payload_json AS sport) FROM observations)
           WINDOW w AS (PARTITION BY source, external_id ORDER BY observed_at, payload_hash)""",
        "observations",
    ),
)
def snapshot_history(spark, sf):
    obs = v.observations(spark, sf).select(
        "source", "external_id", "payload_hash", "observed_at", F.col("payload_json").alias("status")
    )
    return r.snapshot_history(obs, span=24 * r.HOUR)


@query(
    "line_movement",
    with_views(
        """SELECT source, external_id, observed_at, quote_id, price, row_number() OVER w AS quote,
                  lag(price) OVER w AS previous_price, price - lag(price) OVER w AS movement
           FROM quotes WINDOW w AS (PARTITION BY source, external_id ORDER BY observed_at, quote_id)""",
        "quotes",
    ),
)
def line_movement(spark, sf):
    return r.line_movement(v.quotes(spark, sf), ["source", "external_id"], ["observed_at", "quote_id"])


@query(
    "odds_as_of",
    with_views(
        """SELECT source, external_id, observed_at, event_ts, payload_hash, price FROM (
             SELECT q.source, q.external_id, q.observed_at, TIMESTAMP '1999-06-01' + to_days(CAST(CAST(q.external_id AS BIGINT) % 300 AS INTEGER)) AS event_ts,
                    q.quote_id AS payload_hash, q.price,
                    row_number() OVER (PARTITION BY source, external_id ORDER BY observed_at DESC, quote_id DESC) AS rn
             FROM quotes q
             WHERE observed_at <= TIMESTAMP '1999-06-01' + to_days(CAST(CAST(q.external_id AS BIGINT) % 300 AS INTEGER))) WHERE rn = 1""",
        "quotes",
    ),
)
def odds_as_of(spark, sf):
    played = F.date_add(F.lit("1999-06-01").cast("date"), (F.col("external_id").cast("bigint") % 300).cast("int"))
    odds = v.quotes(spark, sf).select(
        "source", "external_id", "observed_at", played.cast("timestamp").alias("event_ts"),
        F.col("quote_id").alias("payload_hash"), "price",
    )
    return r.odds_as_of(odds, ["source", "external_id"])


@query(
    "as_of_merge",
    with_views(
        """SELECT CAST(o_custkey AS VARCHAR) AS external_id, o_orderkey AS seq, o_orderdate AS event_ts,
                  k.quote_id, k.price, k.observed_at
           FROM orders o ASOF LEFT JOIN (
             SELECT source, observed_at, quote_id, price, row_number() OVER (
                      PARTITION BY source, observed_at ORDER BY quote_id DESC, price DESC) AS rn
             FROM quotes QUALIFY rn = 1) k
           ON CAST(o_custkey AS VARCHAR) = k.source AND o.o_orderdate >= k.observed_at""",
        "quotes",
    ),
)
def as_of_merge(spark, sf):
    """Orders as events, each with the last quote made under its number by then."""
    orders = v.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("external_id"), F.col("o_orderkey").alias("seq"),
        v.instant("o_orderdate").alias("event_ts"),
    )
    quotes = v.quotes(spark, sf).select(F.col("source").alias("external_id"), "observed_at", "quote_id", "price")
    taken = ["quote_id", "price", "observed_at"]
    return asof.as_of_merge(orders, quotes, ["external_id"], "event_ts", "observed_at", ["quote_id", "price"], taken)
