"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.contract import views as v
from tidelake.contract.registry import query
from tidelake.functions import payload as p
from tidelake.functions import status as s
from tidelake.functions import text as t
from tidelake.functions import times as tm
from tidelake.schemas import CSV_NULL_TOKENS


@query(
    "slug",
    """SELECT doc_id, coalesce(nullif(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug
       FROM documents""",
)
def slug(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", t.slug("text").alias("slug"))


@query(
    "safe_component",
    "SELECT page_id, trim(regexp_replace(url, '[^A-Za-z0-9._=-]+', '-', 'g'), '-.') AS component FROM pages",
)
def safe_component(spark, sf):
    return v.table(spark, sf, "pages").select("page_id", t.safe_component("url").alias("component"))


_BLANKS = "chr(9) || chr(10) || chr(13) || chr(32) || chr(160)"


@query(
    "optional_text",
    f"""SELECT conv_id, turn, nullif(trim(CASE WHEN turn % 3 = 0 THEN ' ' || chr(9) || text || chr(160)
             WHEN turn % 3 = 1 THEN ' ' || chr(10) END, {_BLANKS}), '') AS cleaned FROM conversations""",
)
def optional_text(spark, sf):
    c = v.table(spark, sf, "conversations")
    raw = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(" \t"), "text", F.lit("\xa0"))).when(
        F.col("turn") % 3 == 1, F.lit(" \n")
    )
    return c.select("conv_id", "turn", t.optional_text(raw).alias("cleaned"))


@query(
    "first_present",
    """SELECT event_id, coalesce(CASE WHEN user_id % 2 = 0 THEN 0 END, CASE WHEN user_id % 3 = 0 THEN user_id END, event_id) AS present
       FROM events""",
)
def first_present(spark, sf):
    user = F.col("user_id")
    return v.table(spark, sf, "events").select(
        "event_id",
        F.coalesce(F.when(user % 2 == 0, F.lit(0)), F.when(user % 3 == 0, user), F.col("event_id")).alias("present"),
    )


@query(
    "team_name",
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN 'display ' || c_name
              WHEN 2 THEN n_name || ' ' || c_mktsegment WHEN 3 THEN c_mktsegment END AS team
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def team_name(spark, sf):
    c, n = v.table(spark, sf, "customer"), v.table(spark, sf, "nation")
    kind = F.col("c_custkey") % 5
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        t.team_name(
            F.when(kind == 0, F.concat("c_name", F.lit(" "))).when(kind == 1, F.lit("")),
            F.when(kind < 2, F.concat(F.lit("display "), "c_name")),
            F.when(kind == 2, F.concat(F.lit(" "), "n_name")),
            F.when(kind.isin(2, 3), F.col("c_mktsegment")).when(kind == 4, F.lit("  ")),
        ).alias("team"),
    )


@query(
    "split_away_at_home",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority || ' at ' ELSE '' END || c_name END AS home,
              CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS away
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def split_away_at_home(spark, sf):
    o, c = v.table(spark, sf, "orders"), v.table(spark, sf, "customer")
    kind = F.col("o_orderkey") % 3
    name = (
        F.when(kind == 0, F.concat_ws(" at ", "o_orderstatus", "c_name"))
        .when(kind == 1, F.concat_ws(" at ", "o_orderstatus", "o_orderpriority", "c_name"))
        .otherwise(F.concat_ws(" vs ", "o_orderstatus", "c_name"))
    )
    home, away = t.split_away_at_home(name)
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", home.alias("home"), away.alias("away")
    )


@query(
    "versus_name",
    """SELECT event_id, coalesce(CASE WHEN user_id % 4 > 0 THEN event_type END, 'TBD') || ' vs '
              || coalesce(CASE WHEN user_id % 3 > 0 THEN CAST(user_id AS VARCHAR) END, 'TBD') AS name FROM events""",
)
def versus_name(spark, sf):
    user = F.col("user_id")
    return v.table(spark, sf, "events").select(
        "event_id",
        t.versus_name(
            F.when(user % 4 > 0, F.col("event_type")), F.when(user % 3 > 0, user.cast("string"))
        ).alias("name"),
    )


@query(
    "season_code",
    """SELECT o_orderkey, lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')
              || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS season FROM orders""",
)
def season_code(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", t.season_code(F.year("o_orderdate")).alias("season"))


@query(
    "season_start_year",
    """SELECT o_orderkey, CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 0 ELSE 1 END AS INTEGER) AS soccer,
              CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) >= 9 THEN 0 ELSE 1 END AS INTEGER) AS hockey FROM orders""",
)
def season_start_year(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        tm.season_start_year(F.col("o_orderdate"), "soccer").alias("soccer"),
        tm.season_start_year(F.col("o_orderdate"), "ice-hockey").alias("hockey"),
    )


@query(
    "inclusive_years",
    """SELECT o_orderkey, CAST(unnest(range(year(o_orderdate), year(o_orderdate) + o_orderkey % 3 + 1)) AS INTEGER) AS y FROM orders""",
)
def inclusive_years(spark, sf):
    o = v.table(spark, sf, "orders")
    first = F.year("o_orderdate")
    last = first + (F.col("o_orderkey") % 3).cast("int")
    return o.select("o_orderkey", F.explode(tm.inclusive_range(first, last)).alias("y"))


@query(
    "date_range",
    """SELECT o_orderkey, CAST(unnest(range(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 31 + 1 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS d
       FROM orders""",
)
def date_range(spark, sf):
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_orderkey") % 31).cast("int"))
    return v.table(spark, sf, "orders").select("o_orderkey", F.explode(tm.inclusive_days(first, last)).alias("d"))


@query(
    "collection_days",
    """SELECT event_id, CAST(unnest([CAST(ts AS DATE) - 1, CAST(ts AS DATE)]) AS DATE) AS d FROM events""",
)
def collection_days(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", F.explode(tm.collection_days(F.to_date("ts"))).alias("d")
    )


@query(
    "null_tokens",
    "SELECT event_id, CASE WHEN event_id % 20 >= {n} THEN event_type END AS label FROM events".format(
        n=len(CSV_NULL_TOKENS)
    ),
)
def null_tokens(spark, sf):
    tokens = F.array(*[F.lit(token) for token in CSV_NULL_TOKENS])
    place = (F.col("event_id") % 20 + 1).cast("int")
    raw = F.coalesce(F.get(tokens, place - 1), F.col("event_type"))
    return v.table(spark, sf, "events").select("event_id", t.null_token(raw).alias("label"))


@query(
    "csv_tokens",
    """SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(text, ','), lambda x: trim(x, chr(9) || chr(10) || chr(13) || ' ')), lambda x: x <> ''), '|') AS tokens
       FROM conversations""",
)
def csv_tokens(spark, sf):
    return v.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(t.csv_tokens("text"), "|").alias("tokens")
    )


@query(
    "ordered_dedupe",
    """SELECT c_custkey, upper(c_mktsegment) || CASE WHEN c_custkey % 2 = 0 THEN '|E0' ELSE '' END || '|D1' AS codes FROM customer""",
)
def ordered_dedupe(spark, sf):
    second = F.when(F.col("c_custkey") % 2 == 0, F.lit(" e0")).otherwise(F.lit(""))
    codes = F.array(
        F.concat(F.lower("c_mktsegment"), F.lit(" ")), second, F.lit("d1 "), F.lit("D1"), F.upper("c_mktsegment")
    )
    return v.table(spark, sf, "customer").select(
        "c_custkey", F.array_join(t.ordered_distinct_codes(codes), "|").alias("codes")
    )


# ------------------------------------------------------------------- payloads


@query("canonical_json", "SELECT event_id, '{\"a\":[1,2],\"k\":' || json_extract_string(props, '$.k') || '}' AS canonical FROM events")
def canonical_json(spark, sf):
    raw = F.concat(F.regexp_replace("props", "\\}$", ""), F.lit(', "a" : [1, 2 ]}'))
    return v.table(spark, sf, "events").select("event_id", p.canonical_json(raw).alias("canonical"))


@query(
    "canonical_json_texts",
    "SELECT doc_id, sha256(text) AS text_hash, true AS ascii, true AS ordered FROM documents",
)
def canonical_json_texts(spark, sf):
    """Whole texts through canonical JSON: ASCII only, keys in order, nothing lost."""
    d = v.table(spark, sf, "documents")
    raw = F.to_json(F.struct("text", F.struct("source", "lang").alias("origin"), "n_chars"))
    made = d.select("doc_id", p.canonical_json(raw).alias("j"))
    return made.select(
        "doc_id",
        F.sha2(F.from_json("j", "text string")["text"], 256).alias("text_hash"),
        F.col("j").rlike(r"^[\x00-\x7f]*$").alias("ascii"),
        F.col("j").rlike(r'^\{"n_chars":\d+,"origin":\{"lang":"..","source":"').alias("ordered"),
    )


@query(
    "redact_sensitive_keys",
    """SELECT c_custkey, '{"name":"' || c_name || '","nested":{"items":[{"segment":"' || c_mktsegment || '"}]}}' AS redacted FROM customer""",
)
def redact_sensitive_keys(spark, sf):
    raw = F.to_json(
        F.struct(
            F.col("c_name").alias("name"),
            F.lit("k").alias("X-API_Key"),
            F.struct(
                F.lit("p").alias("userPassword"),
                F.array(F.struct(F.col("c_mktsegment").alias("segment"), F.lit("t").alias("accessTOKEN"))).alias("items"),
            ).alias("nested"),
            F.lit("c").alias("Set-Cookie"),
        )
    )
    return v.table(spark, sf, "customer").select("c_custkey", p.canonical_json(raw).alias("redacted"))


@query(
    "payload_hash",
    "SELECT event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') AS payload_hash FROM events",
)
def payload_hash(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", p.payload_hash(p.canonical_json(F.col("props"))).alias("payload_hash")
    )


@query(
    "json_extract",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment,
              CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer""",
)
def json_extract(spark, sf):
    """Nested lookups; a parent that is not an object has no fields."""
    kind = F.col("c_custkey") % 3
    inner = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")))
    raw = F.concat(
        F.lit('{"a":'),
        F.when(kind == 0, inner).when(kind == 1, F.lit('"text"')).otherwise(F.lit("[1,2]")),
        F.lit("}"),
    )
    parsed = F.from_json(raw, "a struct<segment:string,nation:string>")["a"]
    return v.table(spark, sf, "customer").select(
        "c_custkey", parsed.segment.alias("segment"), parsed.nation.alias("nation")
    )


# ---------------------------------------------------------------------- times


@query(
    "event_time_iso",
    """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL
              WHEN event_id % 6 = 4 THEN date_trunc('minute', ts)
              WHEN event_id % 6 = 2 THEN date_trunc('second', ts) - INTERVAL 90 MINUTE
              WHEN event_id % 6 = 3 THEN date_trunc('second', ts) ELSE ts END AS at FROM events""",
)
def event_time_iso(spark, sf):
    kind = F.col("event_id") % 6
    shape = lambda pattern: F.date_format("ts", pattern)
    raw = (
        F.when(kind == 0, shape("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 1, shape("yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == 2, shape("yyyy-MM-dd'T'HH:mm:ss'+01:30'"))
        .when(kind == 3, shape("yyyyMMdd'T'HHmmss'Z'"))
        .when(kind == 4, shape("yyyy-MM-dd'T'HH:mm'+00:00'"))
        .otherwise(shape("dd.MM.yyyy HH:mm"))
    )
    return v.table(spark, sf, "events").select("event_id", tm.iso_timestamp(raw).alias("at"))


@query(
    "event_time_thesportsdb",
    """SELECT event_id,
              CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
                                WHEN 2 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS at,
              CASE event_id % 4 WHEN 1 THEN 'provider_utc_time' WHEN 2 THEN 'date_only' ELSE 'timestamp' END AS precision
       FROM events""",
)
def event_time_thesportsdb(spark, sf):
    kind = F.col("event_id") % 4
    stamp = F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(kind == 3, F.lit("soon"))
    clock = F.when(kind == 1, F.date_format("ts", "HH:mm:ss'Z'")).when(kind == 2, F.lit(" "))
    at, precision = tm.schedule_time(stamp, F.date_format("ts", "yyyy-MM-dd"), clock)
    return v.table(spark, sf, "events").select("event_id", at.alias("at"), precision.alias("precision"))


@query(
    "event_time_balldontlie",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS at,
              CASE WHEN event_id % 2 = 0 THEN 'timestamp' ELSE 'date_only' END AS precision FROM events""",
)
def event_time_balldontlie(spark, sf):
    timed = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    at, precision = tm.game_time(timed, F.date_format("ts", "yyyy-MM-dd 00:00"))
    return v.table(spark, sf, "events").select("event_id", at.alias("at"), precision.alias("precision"))


@query(
    "to_utc",
    "SELECT event_id, date_trunc('second', ts) - to_hours(CAST(user_id % 12 AS INTEGER)) AS at FROM events",
)
def to_utc(spark, sf):
    offset = F.format_string("+%02d:00", (F.col("user_id") % 12))
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    return v.table(spark, sf, "events").select("event_id", tm.iso_timestamp(raw).alias("at"))


# ------------------------------------------------------------------- statuses

_SCHEDULE_TEXTS = ["Match Finished", "FT", "Cancelled", "Postponed", "Half Time", "In Progress", "Half", ""]
_SCHEDULE_VERDICTS = ["final", "final", "cancelled", "postponed", "live", "live", "scheduled", "scheduled"]


def _pick(values, column, size):
    return F.element_at(F.array(*[F.lit(x) for x in values]), (F.col(column) % size + 1).cast("int"))


def _cases(values, column, size):
    return f"([{', '.join(repr(x) for x in values)}])[CAST({column} % {size} AS INTEGER) + 1]"


@query(
    "status_thesportsdb",
    f"""SELECT event_id, CASE WHEN event_id % 8 IN (6, 7) AND user_id % 2 = 0 THEN 'final'
               ELSE {_cases(_SCHEDULE_VERDICTS, "event_id", 8)} END AS status FROM events""",
)
def status_thesportsdb(spark, sf):
    score = F.when(F.col("user_id") % 2 == 0, F.lit("0"))
    return v.table(spark, sf, "events").select(
        "event_id", s.schedule_status(_pick(_SCHEDULE_TEXTS, "event_id", 8), score, score).alias("status")
    )


_MATCH_TEXTS = ["FINISHED", "IN_PLAY", "PAUSED", "CANCELLED", "POSTPONED", "SUSPENDED", "TIMED", "AWARDED"]
_MATCH_VERDICTS = ["final", "live", "live", "cancelled", "postponed", "postponed", "scheduled", "scheduled"]


@query("status_football_data", f"SELECT event_id, {_cases(_MATCH_VERDICTS, 'event_id', 8)} AS status FROM events")
def status_football_data(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", s.match_status(_pick(_MATCH_TEXTS, "event_id", 8)).alias("status")
    )


_GAME_TEXTS = ["Final", "FT", "STATUS_FULL_TIME", "3rd Quarter", "Halftime", "Canceled in progress", "Cancelled", "7:30 pm ET"]
_GAME_VERDICTS = ["final", "final", "final", "live", "live", "live", "cancelled", "scheduled"]


@query(
    "status_balldontlie",
    f"""SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'postponed' ELSE {_cases(_GAME_VERDICTS, "event_id", 8)} END AS status
        FROM events""",
)
def status_balldontlie(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", s.game_status(_pick(_GAME_TEXTS, "event_id", 8), F.col("user_id") % 5 == 0).alias("status")
    )


@query(
    "age_text",
    """SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'never' WHEN a < 0 THEN 'just now'
              WHEN a >= 86400 THEN a // 86400 || 'd ago' WHEN a >= 3600 THEN a // 3600 || 'h ago'
              WHEN a >= 60 THEN a // 60 || 'm ago' ELSE a || 's ago' END AS age
       FROM (SELECT *, CAST(trunc((epoch_us(TIMESTAMP '2024-01-16') - epoch_us(ts)) / 1000000) AS BIGINT) AS a FROM events)""",
)
def age_text(spark, sf):
    since = F.when(F.col("user_id") % 10 != 0, v.instant("ts"))
    at = F.lit("2024-01-16").cast("timestamp")
    return v.table(spark, sf, "events").select("event_id", tm.age_text(since, at).alias("age"))


@query(
    "is_stale",
    """SELECT event_id, user_id % 7 > 0 AND epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) > (user_id % 7) * 86400 * 2500000 AS stale
       FROM events""",
)
def is_stale(spark, sf):
    promised = F.when(F.col("user_id") % 7 > 0, (F.col("user_id") % 7 * 86400).cast("double"))
    return v.table(spark, sf, "events").select(
        "event_id", s.is_stale(v.instant("ts"), promised, v.now()).alias("stale")
    )
