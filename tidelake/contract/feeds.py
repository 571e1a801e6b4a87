"""Provider feeds: envelopes, normalisers, rejects and redaction.

Raw items are provider-shaped JSON made from orders, customers and nations; the
SQL side states the expected columns from the same base columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.contract import views as v
from tidelake.contract.registry import query
from tidelake.operators import normalize as n
from tidelake.schemas import ODDS_SPORTS
from tidelake.sources import envelopes as env

_BASE = """base AS (
    SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderdate AS d, o_orderpriority AS prio,
           c_name AS home, n_name AS away, n_nationkey AS nk, c_mktsegment AS seg,
           strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _base(spark, sf) -> DataFrame:
    o, c, na = (v.table(spark, sf, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(
        na, F.col("c_nationkey") == F.col("n_nationkey")
    )
    # A small table is one file and so one task; spread it as many landed files would be.
    return joined.repartition("o_orderkey").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderdate").alias("d"),
        F.col("o_orderpriority").alias("prio"),
        F.col("c_name").alias("home"),
        F.col("n_name").alias("away"),
        F.col("n_nationkey").alias("nk"),
        F.col("c_mktsegment").alias("seg"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


def _items(base: DataFrame, **fields) -> DataFrame:
    payload = F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))
    return base.select(
        F.col("k").alias("seq"), payload.alias("payload"), v.instant("d").alias("observed_at"), "cust", "st"
    )


def _json(*members: str) -> str:
    """SQL for a JSON object from SQL member texts in key order; null members are left out."""
    return "'{' || array_to_string(list_filter([" + ", ".join(members) + "], lambda x: x IS NOT NULL), ',') || '}'"


def _text(name: str, value: str) -> str:
    return f"""'"{name}":"' || {value} || '"'"""


def _raw(name: str, value: str) -> str:
    return f"""'"{name}":' || {value}"""


_EVENT_COLUMNS = """seq, source, external_id, payload_hash, observed_at, event_ts, time_precision, sport,
    league_external_id, league_name, season, event_name, home_team, away_team, home_score, away_score, status,
    venue, country, payload_json"""
_HASHED = "(SELECT *, sha256(payload_json) AS payload_hash FROM rows_)"

# ------------------------------------------------------------ schedule items


def raw_schedule(spark, sf) -> DataFrame:
    k = F.col("k")
    return _items(
        _base(spark, sf),
        idEvent=F.when(k % 41 != 3, k.cast("string")),
        strEvent=F.concat("home", F.lit(" v "), "away", F.lit(" ")),
        strSport=F.when(k % 5 > 0, F.concat(F.lit(" Ice "), "seg")),
        idLeague=F.col("nk"),
        strLeague=F.col("away"),
        strSeason=F.when(k % 2 == 0, F.substring("day", 1, 4)).otherwise(F.lit(" ")),
        dateEvent=F.when(k % 43 == 5, F.lit("soon")).when(k % 43 != 6, F.col("day")),
        strTimestamp=F.when(k % 3 == 0, F.concat("day", F.lit("T20:15:00+02:00"))),
        strTime=F.when(k % 3 == 1, F.lit("19:30:00Z")),
        strHomeTeam=F.col("home"),
        strAwayTeam=F.col("away"),
        intHomeScore=F.when(F.col("st") != "O", (k % 7).cast("int")),
        intAwayScore=F.when(F.col("st") == "F", (k % 4).cast("string")),
        strStatus=F.when(F.col("st") == "F", "Match Finished").when(F.col("st") == "P", "Postponed"),
        strVenue=F.concat(F.lit(" "), "prio"),
        apiToken=F.lit("hidden"),
    )


_SCHEDULE_JSON = _json(
    """CASE WHEN k % 43 = 5 THEN '"dateEvent":"soon"' WHEN k % 43 <> 6 THEN '"dateEvent":"' || day || '"' END""",
    "CASE WHEN k % 41 <> 3 THEN " + _text("idEvent", "k") + " END",
    _raw("idLeague", "nk"),
    "CASE WHEN st = 'F' THEN " + _text("intAwayScore", "k % 4") + " END",
    "CASE WHEN st <> 'O' THEN " + _raw("intHomeScore", "k % 7") + " END",
    _text("strAwayTeam", "away"),
    _text("strEvent", "home || ' v ' || away || ' '"),
    _text("strHomeTeam", "home"),
    _text("strLeague", "away"),
    _text("strSeason", "CASE WHEN k % 2 = 0 THEN day[1:4] ELSE ' ' END"),
    "CASE WHEN k % 5 > 0 THEN " + _text("strSport", "' Ice ' || seg") + " END",
    """CASE st WHEN 'F' THEN '"strStatus":"Match Finished"' WHEN 'P' THEN '"strStatus":"Postponed"' END""",
    """CASE WHEN k % 3 = 1 THEN '"strTime":"19:30:00Z"' END""",
    "CASE WHEN k % 3 = 0 THEN " + _text("strTimestamp", "day || 'T20:15:00+02:00'") + " END",
    _text("strVenue", "' ' || prio"),
)
_SCHEDULE_SQL = f"""WITH {_BASE}, rows_ AS (
    SELECT k AS seq, 'thesportsdb' AS source, CAST(k AS VARCHAR) AS external_id, d AS observed_at,
           CAST(day AS TIMESTAMP) + CASE k % 3 WHEN 0 THEN to_seconds(65700) WHEN 1 THEN to_seconds(70200) ELSE to_seconds(0) END AS event_ts,
           CASE k % 3 WHEN 0 THEN 'timestamp' WHEN 1 THEN 'provider_utc_time' ELSE 'date_only' END AS time_precision,
           CASE WHEN k % 5 > 0 THEN 'Ice ' || seg ELSE 'unknown' END AS sport,
           CAST(nk AS VARCHAR) AS league_external_id, away AS league_name,
           CASE WHEN k % 2 = 0 THEN day[1:4] END AS season, home || ' v ' || away AS event_name,
           home AS home_team, away AS away_team, CASE WHEN st <> 'O' THEN CAST(k % 7 AS VARCHAR) END AS home_score,
           CASE WHEN st = 'F' THEN CAST(k % 4 AS VARCHAR) END AS away_score,
           CASE st WHEN 'F' THEN 'final' WHEN 'P' THEN 'postponed' ELSE 'scheduled' END AS status,
           prio AS venue, CAST(NULL AS VARCHAR) AS country, {_SCHEDULE_JSON} AS payload_json
    FROM base WHERE k % 41 <> 3 AND k % 43 <> 6 AND NOT (k % 43 = 5 AND k % 3 <> 0))
SELECT {_EVENT_COLUMNS} FROM {_HASHED}"""

@query("normalize_thesportsdb", _SCHEDULE_SQL)
def normalize_thesportsdb(spark, sf):
    return n.accepted(n.normalize_thesportsdb(raw_schedule(spark, sf))).drop("cust", "st")


@query(
    "reject_malformed",
    f"""WITH {_BASE} SELECT k AS seq, CASE WHEN k % 41 = 3 THEN 'missing idEvent' WHEN k % 43 = 6 THEN 'missing dateEvent'
            ELSE 'unreadable event time' END AS reject_reason
        FROM base WHERE k % 41 = 3 OR k % 43 = 6 OR (k % 43 = 5 AND k % 3 <> 0)""",
)
def reject_malformed(spark, sf):
    return n.quarantine(n.normalize_thesportsdb(raw_schedule(spark, sf))).select("seq", "reject_reason")


@query(
    "finalize_snapshot",
    f"""WITH {_BASE} SELECT k AS seq, 'feed' AS source, CAST(k AS VARCHAR) AS external_id,
            CASE WHEN k % 2 = 0 THEN home ELSE 'unknown' END AS sport,
            CASE WHEN k % 9 = 0 THEN '' ELSE away END AS event_name,
            CASE WHEN k % 9 = 0 THEN 'blank event name' END AS reject_reason,
            sha256('{{"k":' || k || '}}') AS payload_hash FROM base""",
)
def finalize_snapshot(spark, sf):
    k = F.col("k")
    items = _base(spark, sf).select(
        k.alias("seq"), F.to_json(F.struct("k", F.lit("x").alias("token"))).alias("payload"),
        v.instant("d").alias("observed_at"), "home", "away",
    )
    seq = F.col("seq")
    values = {
        "source": F.lit(" feed "),
        "external_id": F.concat(F.lit("\t"), seq.cast("string")),
        "event_ts": F.col("observed_at"),
        "time_precision": F.lit("timestamp"),
        "sport": F.when(seq % 2 == 0, F.concat("home", F.lit("\n"))).otherwise(F.lit("  ")),
        "event_name": F.when(seq % 9 == 0, F.lit(" ")).otherwise(F.col("away")),
        "status": F.lit("scheduled"),
    }
    done = n.finalize_snapshot(items, values, F.lit(None).cast("string"))
    return done.select("seq", "source", "external_id", "sport", "event_name", "reject_reason", "payload_hash")


# ------------------------------------------------------------------- matches


def raw_matches(spark, sf) -> DataFrame:
    k, st = F.col("k"), F.col("st")
    named = lambda c: F.struct(c.alias("name"))
    return _items(
        _base(spark, sf),
        id=F.when(k % 37 != 2, k),
        utcDate=F.when(k % 31 != 4, F.concat("day", F.lit("T15:00:00Z"))),
        status=F.when(st == "F", "FINISHED").when(st == "P", "SUSPENDED"),
        area=named(F.col("away")),
        competition=F.struct(F.col("nk").alias("id"), F.col("seg").alias("name")),
        season=F.struct(F.col("day").alias("startDate")),
        homeTeam=named(F.when(k % 5 > 0, F.col("home"))),
        awayTeam=named(F.col("away")),
        score=F.struct(
            F.struct(
                F.when(st == "F", (k % 6).cast("int")).alias("home"), F.when(st == "F", F.lit(0)).alias("away")
            ).alias("fullTime")
        ),
        venue=F.col("prio"),
    )


_MATCH_JSON = _json(
    """'"area":{"name":"' || away || '"}'""",
    """'"awayTeam":{"name":"' || away || '"}'""",
    """'"competition":{"id":' || nk || ',"name":"' || seg || '"}'""",
    """CASE WHEN k % 5 > 0 THEN '"homeTeam":{"name":"' || home || '"}' ELSE '"homeTeam":{}' END""",
    _raw("id", "k"),
    """CASE WHEN st = 'F' THEN '"score":{"fullTime":{"away":0,"home":' || k % 6 || '}}' ELSE '"score":{"fullTime":{}}' END""",
    """'"season":{"startDate":"' || day || '"}'""",
    """CASE st WHEN 'F' THEN '"status":"FINISHED"' WHEN 'P' THEN '"status":"SUSPENDED"' END""",
    """'"utcDate":"' || day || 'T15:00:00Z"'""",
    _text("venue", "prio"),
)


@query(
    "normalize_football_data",
    f"""WITH {_BASE}, rows_ AS (
    SELECT k AS seq, 'football-data.org' AS source, CAST(k AS VARCHAR) AS external_id, d AS observed_at,
           CAST(day AS TIMESTAMP) + to_hours(15) AS event_ts, 'timestamp' AS time_precision, 'Soccer' AS sport,
           CAST(nk AS VARCHAR) AS league_external_id, seg AS league_name, day AS season,
           CASE WHEN k % 5 > 0 THEN home ELSE 'TBD' END || ' vs ' || away AS event_name,
           CASE WHEN k % 5 > 0 THEN home END AS home_team, away AS away_team,
           CASE WHEN st = 'F' THEN CAST(k % 6 AS VARCHAR) END AS home_score, CASE WHEN st = 'F' THEN '0' END AS away_score,
           CASE st WHEN 'F' THEN 'final' WHEN 'P' THEN 'postponed' ELSE 'scheduled' END AS status, prio AS venue,
           away AS country, {_MATCH_JSON} AS payload_json
    FROM base WHERE k % 37 <> 2 AND k % 31 <> 4)
    SELECT {_EVENT_COLUMNS} FROM {_HASHED}""",
)
def normalize_football_data(spark, sf):
    return n.accepted(n.normalize_football_data(raw_matches(spark, sf))).drop("cust", "st")


# --------------------------------------------------------------------- games

_CODES = ["nba", "nfl", "mlb", "epl", "nhl"]


def raw_games(spark, sf) -> DataFrame:
    k, st = F.col("k"), F.col("st")
    soccer = k % 5 == 3
    game = ~soccer
    status = F.when(st == "F", "Final").when(st == "P", "2nd Quarter").otherwise("7:00 pm ET")
    items = _items(
        _base(spark, sf),
        id=k,
        date=F.when(k % 2 == 0, F.col("day")).otherwise(F.concat("day", F.lit("T01:30:00Z"))),
        season=F.substring("day", 1, 4).cast("int"),
        status=F.when(game, status).otherwise(F.lit("x")),
        status_detail=F.when(soccer & (st == "F"), "FT"),
        postponed=F.when(game, k % 11 == 0),
        name=F.when(soccer & (k % 4 != 0), F.concat_ws(" at ", "away", "home")),
        home_team=F.when(
            game,
            F.struct(F.when(k % 2 == 0, F.col("home")).alias("full_name"), F.col("seg").alias("city"), F.lit("FC").alias("name")),
        ),
        visitor_team=F.when(game & (k % 3 == 0), F.struct(F.col("away").alias("display_name"))),
        away_team=F.when(game, F.struct(F.lit("Other").alias("full_name"))),
        home_team_score=F.when(game & (k % 5 == 0), (k % 90).cast("int")),
        home_score=F.when(k % 5 == 3, F.lit(0)),
        away_score=F.when(k % 5 == 3, F.lit(2)),
        home_team_data=F.when(k % 5 == 2, F.struct((k % 9).cast("int").alias("runs"))),
        away_team_data=F.when(k % 5 == 2, F.struct(F.lit(0).alias("runs"))),
        visitor_team_score=F.when(game & (k % 5 == 0), F.lit(77)),
        venue_name=F.col("prio"),
    )
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("seq") % 5 + 1).cast("int"))
    return items.withColumn("sport_code", code)


@query(
    "normalize_balldontlie",
    f"""WITH {_BASE}, named AS (SELECT *, (['nba','nfl','mlb','epl','nhl'])[CAST(k % 5 AS INTEGER) + 1] AS code,
           CASE WHEN k % 5 = 3 THEN CASE WHEN k % 4 <> 0 THEN home END WHEN k % 2 = 0 THEN home ELSE seg || ' FC' END AS h,
           CASE WHEN k % 5 = 3 THEN CASE WHEN k % 4 <> 0 THEN away END WHEN k % 3 = 0 THEN away ELSE 'Other' END AS a FROM base)
    SELECT k AS seq, 'balldontlie-' || code AS source, CAST(k AS VARCHAR) AS external_id, d AS observed_at,
           CAST(day AS TIMESTAMP) + CASE WHEN k % 2 = 0 THEN to_minutes(0) ELSE to_minutes(90) END AS event_ts,
           CASE WHEN k % 2 = 0 THEN 'date_only' ELSE 'timestamp' END AS time_precision,
           CASE code WHEN 'nba' THEN 'Basketball' WHEN 'nfl' THEN 'American Football' WHEN 'mlb' THEN 'Baseball' ELSE 'Soccer' END AS sport,
           CASE code WHEN 'epl' THEN 'Premier League' ELSE upper(code) END AS league_name, day[1:4] AS season,
           CASE WHEN code = 'epl' AND h IS NOT NULL THEN a || ' at ' || h ELSE coalesce(h, 'TBD') || ' vs ' || coalesce(a, 'TBD') END AS event_name,
           h AS home_team, a AS away_team,
           CASE code WHEN 'nba' THEN CAST(k % 90 AS VARCHAR) WHEN 'mlb' THEN CAST(k % 9 AS VARCHAR) WHEN 'epl' THEN '0' END AS home_score,
           CASE code WHEN 'nba' THEN '77' WHEN 'mlb' THEN '0' WHEN 'epl' THEN '2' END AS away_score,
           CASE WHEN code <> 'epl' AND k % 11 = 0 THEN 'postponed' WHEN st = 'F' THEN 'final'
                WHEN code <> 'epl' AND st = 'P' THEN 'live' ELSE 'scheduled' END AS status,
           prio AS venue, CASE code WHEN 'epl' THEN 'England' ELSE 'United States' END AS country
    FROM named WHERE code <> 'nhl'""",
)
def normalize_balldontlie(spark, sf):
    rows = n.accepted(n.normalize_balldontlie(raw_games(spark, sf)))
    return rows.drop("cust", "st", "sport_code", "payload_json", "payload_hash", "league_external_id")


# ---------------------------------------------------------------------- odds


def raw_odds(spark, sf) -> DataFrame:
    k = F.col("k")
    price = F.round(F.lit(1) + (k % 400) / 100, 2)
    outcome = lambda team, p: F.struct(team.alias("name"), p.alias("price"))
    book = F.struct(
        F.col("prio").alias("key"),
        F.array(
            F.struct(
                F.lit("h2h").alias("key"),
                F.array(outcome(F.col("home"), price), outcome(F.col("away"), F.lit(2.5))).alias("outcomes"),
            )
        ).alias("markets"),
    )
    bare = F.struct(F.lit("book-2").alias("key"), F.lit(1.75).alias("price"))
    items = _items(
        _base(spark, sf),
        id=F.when(k % 29 != 1, F.concat(F.lit("e"), k.cast("string"))),
        sport_title=F.col("seg"),
        commence_time=F.when(k % 23 != 1, F.concat("day", F.lit("T23:10:00Z"))),
        home_team=F.when(k % 7 > 0, F.col("home")),
        away_team=F.col("away"),
        bookmakers=F.array(F.to_json(book), F.to_json(bare)),
    )
    # Bookmakers were written as text to mix shapes in one list; put them back as objects.
    unquoted = F.regexp_replace(F.regexp_replace("payload", r'\\"', '"'), r'"(\{"key".*?\})"(?=[,\]])', "$1")
    keys = [*ODDS_SPORTS, "icehockey_nhl"]
    key = F.element_at(F.array(*[F.lit(x) for x in keys]), (F.col("seq") % 3 + 1).cast("int"))
    return items.withColumns({"payload": unquoted, "sport_key": key})


_ODDS_ROWS = f"""{_BASE}, odds AS (
    SELECT k AS seq, 'the-odds-api' AS source, 'e' || k AS external_id, d AS observed_at,
           CAST(day AS TIMESTAMP) + to_minutes(1390) AS event_ts,
           CASE k % 3 WHEN 0 THEN 'Basketball' ELSE 'Baseball' END AS sport, seg AS league_name,
           CASE WHEN k % 7 > 0 THEN home ELSE 'TBD' END || ' vs ' || away AS event_name,
           CASE WHEN k % 7 > 0 THEN home END AS home_team, away AS away_team, home, away, prio, k
    FROM base WHERE k % 29 <> 1 AND k % 23 <> 1 AND k % 3 < 2)"""


@query(
    "normalize_odds",
    f"""WITH {_ODDS_ROWS} SELECT seq, source, external_id, observed_at, event_ts, sport, league_name, event_name,
        home_team, away_team, 'h2h' AS market FROM odds""",
)
def normalize_odds(spark, sf):
    rows = n.accepted(n.normalize_odds(raw_odds(spark, sf)))
    return rows.drop("cust", "st", "sport_key", "payload_json", "payload_hash")


@query(
    "explode_bookmakers",
    f"""WITH {_ODDS_ROWS} SELECT seq, external_id, prio AS bookmaker, 'h2h' AS market, home AS outcome, round(1 + (k % 400) / 100, 2) AS price FROM odds
        UNION ALL SELECT seq, external_id, prio, 'h2h', away, 2.5 FROM odds
        UNION ALL SELECT seq, external_id, 'book-2', NULL, NULL, 1.75 FROM odds""",
)
def explode_bookmakers(spark, sf):
    from tidelake.plans.reads import explode_bookmakers as explode

    rows = n.accepted(n.normalize_odds(raw_odds(spark, sf)))
    return explode(rows).select("seq", "external_id", "bookmaker", "market", "outcome", "price")


@query("supported_sport", f"WITH {_BASE} SELECT k AS seq FROM base WHERE k % 3 < 2")
def supported_sport(spark, sf):
    return n.supported_sports(raw_odds(spark, sf), "sport_key", list(ODDS_SPORTS)).select("seq")


# ----------------------------------------------------------------- envelopes


def landed(spark, sf, field: str | None) -> DataFrame:
    """One response per order: mostly a list with two objects and two stray members."""
    k = F.col("k")
    member = F.to_json(F.struct("k", F.col("home").alias("n"), F.lit(1.0).alias("x")))
    members = F.concat(F.lit('['), member, F.lit(',"stray",null,'), F.to_json(F.struct(F.col("away").alias("n"))), F.lit("]"))
    wrap = lambda text: text if field is None else F.concat(F.lit(f'{{"{field}":'), text, F.lit("}"))
    body = (
        F.when(k % 10 == 0, wrap(F.lit("null")))
        .when(k % 10 == 1, wrap(F.lit('{"a":1}')))
        .when(k % 10 == 2, F.lit("<html>"))
        .when(k % 10 == 3, F.lit("{}"))
        .when(k % 10 == 4, F.lit('"text"'))
        .otherwise(wrap(members))
    )
    return _base(spark, sf).select(k.alias("seq"), body.alias("body"))


_ITEMS_SQL = f"""WITH {_BASE} SELECT k AS seq, 0 AS position, '{{"k":' || k || ',"n":"' || home || '","x":1.0}}' AS payload
    FROM base WHERE k % 10 > 4
    UNION ALL SELECT k, 3, '{{"n":"' || away || '"}}' FROM base WHERE k % 10 > 4"""


def _register_envelope(provider: str, name: str, missing: dict[int, str]) -> None:
    @query(f"read_event_envelope_{name}" if name != "odds" else "read_odds_envelope", _ITEMS_SQL)
    def items(spark, sf):
        return env.envelope_items(landed(spark, sf, env.ENVELOPES[provider][0]), provider)

    cases = " ".join(f"WHEN {digit} THEN '{state}'" for digit, state in missing.items())

    @query(f"envelope_state_{name}", f"WITH {_BASE} SELECT k AS seq, CASE k % 10 {cases} ELSE 'rows' END AS state FROM base")
    def states(spark, sf):
        bodies = landed(spark, sf, env.ENVELOPES[provider][0])
        return bodies.select("seq", env.envelope_state(provider).alias("state"))


_BAD = "response is not JSON"
_OTHER = "list is of another type"
_GONE = "list is missing"
_register_envelope("thesportsdb", "thesportsdb", {0: "empty", 1: _OTHER, 2: _BAD, 3: "empty", 4: "empty"})
_register_envelope("football-data", "football_data", {0: _GONE, 1: _OTHER, 2: _BAD, 3: _GONE, 4: _GONE})
_register_envelope("balldontlie", "balldontlie", {0: _GONE, 1: _OTHER, 2: _BAD, 3: _GONE, 4: _GONE})
_register_envelope("odds", "odds", {0: _GONE, 1: _OTHER, 2: _BAD, 3: _OTHER, 4: _OTHER})


@query(
    "read_json_list",
    f"""WITH {_BASE} SELECT k AS seq, 0 AS source_row_number, CAST(k AS VARCHAR) AS external_id,
               '{{"match_id":' || k || ',"t":"s\\u00e9same","x":1.0}}' AS payload_json FROM base
        UNION ALL SELECT k, 1, '1', '{{"name":"' || home || '","token":"kept"}}' FROM base
        UNION ALL SELECT k, 2, 'None', '{{"match_id":null,"y":[1,"two"]}}' FROM base""",
)
def read_json_list(spark, sf):
    from tidelake.sources.dumps import json_list_rows

    body = F.concat(
        F.lit('[{"x":1.0, "match_id":'), F.col("k").cast("string"), F.lit(', "t":"sésame"}, {"token":"kept","name":"'),
        F.col("home"), F.lit('"}, {"y":[1, "two"], "match_id":null}]'),
    )
    documents = _base(spark, sf).select(F.col("k").alias("seq"), body.alias("body"))
    return json_list_rows(documents, "match_id")


@query(
    "json_payload_projection",
    """SELECT c_custkey, '{"a":{"segment":"' || c_mktsegment || '"},"api_key":"kept","z":' || c_nationkey || '}' AS payload_json FROM customer""",
)
def json_payload_projection(spark, sf):
    from tidelake.sources.dumps import json_payload

    raw = F.to_json(
        F.struct(
            F.col("c_nationkey").alias("z"),
            F.struct(F.col("c_mktsegment").alias("segment")).alias("a"),
            F.lit("kept").alias("api_key"),
        )
    )
    return v.table(spark, sf, "customer").select("c_custkey", json_payload(raw).alias("payload_json"))
