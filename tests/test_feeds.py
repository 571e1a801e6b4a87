"""Normalisers, envelopes and payload hashing on hand-made items."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidelake.functions.payload import canonical_json, canonical_text
from tidelake.functions.text import optional_text, safe_component, season_code, season_problem, slug
from tidelake.functions.times import inclusive_days, inclusive_range, iso_timestamp
from tidelake.operators import normalize as n
from tidelake.sources.envelopes import envelope_items, refused_envelopes

SEEN = datetime(2026, 7, 10, 12)

GAME = {
    "idEvent": "100", "strEvent": "Larks vs Moles", "strSport": "Handball", "idLeague": "77", "strLeague": "Pond League",
    "strSeason": "2026", "dateEvent": "2026-07-10", "strTimestamp": "2026-07-10T17:45:00", "strHomeTeam": "Larks",
    "strAwayTeam": " Moles ", "intHomeScore": "31", "intAwayScore": "28", "strStatus": "Finished", "strVenue": " ",
}


def run(spark, normaliser, *items, seen=SEEN, **constants):
    rows = [(json.dumps(i) if not isinstance(i, str) else i, seen, k) for k, i in enumerate(items)]
    df = spark.createDataFrame(rows, "payload string, observed_at timestamp, k int")
    return normaliser(df.withColumns({c: F.lit(x) for c, x in constants.items()})).orderBy("k").collect()


def values(spark, kind, column, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], f"k int, t {kind}")
    return [r.v for r in df.select("k", column(F.col("t")).alias("v")).orderBy("k").collect()]


def test_schedule_item_is_normalised(spark):
    (row,) = run(spark, n.normalize_thesportsdb, GAME)
    assert (row.source, row.external_id, row.status, row.time_precision) == ("thesportsdb", "100", "final", "timestamp")
    assert (row.away_team, row.home_score, row.venue) == ("Moles", "31", None)
    assert row.event_ts == datetime(2026, 7, 10, 17, 45)
    assert row.reject_reason is None


@pytest.mark.parametrize(
    "change, precision, hour",
    [
        ({"strTimestamp": None, "strTime": "19:30:00Z"}, "provider_utc_time", 19),
        ({"strTimestamp": "", "strTime": None}, "date_only", 0),
        ({"strTimestamp": "2026-07-10T21:00:00+02:00"}, "timestamp", 19),
    ],
)
def test_three_time_precisions(spark, change, precision, hour):
    (row,) = run(spark, n.normalize_thesportsdb, {**GAME, **change})
    assert (row.time_precision, row.event_ts.hour) == (precision, hour)


def test_malformed_items_do_not_lose_the_batch(spark):
    rows = run(
        spark, n.normalize_thesportsdb, {"idEvent": "1"}, {**GAME, "dateEvent": "soon", "strTimestamp": None},
        {**GAME, "strTimestamp": "whenever"}, "not json", GAME,
    )
    assert [r.reject_reason is None for r in rows] == [False, False, False, False, True]


def test_status_precedence_differs_by_feed(spark):
    cancelled_live = {**GAME, "strStatus": "Cancelled (was live)", "intHomeScore": None}
    (row,) = run(spark, n.normalize_thesportsdb, cancelled_live)
    assert row.status == "cancelled"
    game = {"id": 1, "date": "2026-07-10", "status": "Cancelled in progress"}
    (row,) = run(spark, n.normalize_balldontlie, game, sport_code="mlb")
    assert row.status == "live"
    (row,) = run(spark, n.normalize_thesportsdb, {**GAME, "strStatus": "half", "intHomeScore": None})
    assert row.status == "scheduled"


def test_hash_ignores_time_of_observation_and_key_order(spark):
    (a,) = run(spark, n.normalize_thesportsdb, GAME)
    (b,) = run(spark, n.normalize_thesportsdb, dict(reversed(GAME.items())), seen=datetime(2026, 8, 1))
    assert a.payload_hash == b.payload_hash
    assert a.payload_hash == hashlib.sha256(a.payload_json.encode()).hexdigest()


def test_soccer_match_with_nested_fields(spark):
    match = {
        "id": 7, "utcDate": "2026-07-10T15:00:00Z", "status": "PAUSED", "area": {"name": "England"},
        "competition": {"id": 2021, "name": "League"}, "season": {"startDate": "2026-08-01"},
        "homeTeam": {"name": "Reds"}, "awayTeam": "unknown", "score": {"fullTime": {"home": 0, "away": None}},
    }
    (row,) = run(spark, n.normalize_football_data, match)
    assert (row.status, row.event_name, row.home_score, row.away_score) == ("live", "Reds vs TBD", "0", None)
    assert (row.league_external_id, row.country, row.sport) == ("2021", "England", "Soccer")


def test_present_but_null_id_is_text(spark):
    rows = run(spark, n.normalize_football_data, {"id": None, "utcDate": "2026-07-10"}, {"utcDate": "2026-07-10"})
    assert [(r.external_id, r.reject_reason) for r in rows] == [("None", None), (None, "missing id")]


def test_team_feed_assembles_names_and_runs(spark):
    game = {
        "id": 9, "date": "2026-07-10T01:00:00Z", "status": "STATUS_FINAL", "home_team": {"city": "Oldham", "name": "Larks"},
        "away_team": {"display_name": "Kiel Moles"}, "visitor_team": {}, "home_team_data": {"runs": 11}, "away_team_data": {"runs": 6},
    }
    (row,) = run(spark, n.normalize_balldontlie, game, sport_code="mlb")
    assert row.event_name == "Oldham Larks vs Kiel Moles"
    assert (row.home_score, row.away_score, row.source, row.league_name) == ("11", "6", "balldontlie-mlb", "MLB")


def test_league_feed_reads_teams_from_the_name(spark):
    match = {"id": 9, "date": "2026-07-10", "status_detail": "FT", "name": "Wick at Tarn", "home_score": 5, "away_score": 4}
    (row,) = run(spark, n.normalize_balldontlie, match, sport_code="epl")
    assert (row.home_team, row.away_team, row.event_name, row.status) == ("Tarn", "Wick", "Wick at Tarn", "final")
    assert (row.time_precision, row.country) == ("date_only", "England")


def test_postponed_flag_outranks_text(spark):
    games = [{"id": i, "date": "2026-07-10", "status": "Final", "postponed": p} for i, p in enumerate([True, False, 0, "yes"])]
    rows = run(spark, n.normalize_balldontlie, *games, sport_code="nba")
    assert [r.status for r in rows] == ["postponed", "final", "final", "postponed"]


def test_odds_item(spark):
    item = {"id": "e1", "sport_title": "NBA", "commence_time": "2026-07-10T23:00:00Z", "home_team": "Reds", "away_team": None, "bookmakers": []}
    (row,) = run(spark, n.normalize_odds, item, sport_key="basketball_nba")
    assert (row.sport, row.market, row.event_name) == ("Basketball", "h2h", "Reds vs TBD")
    (row,) = run(spark, n.normalize_odds, item, sport_key="tennis")
    assert row.reject_reason == "unsupported sport"


PAYLOADS = [
    {"b": 1, "a": [1.0, 2.50, 1e5, -0.0, 10**20], "é": "naïve   \"q\" \\ /"},
    {"apiToken": "x", "nested": {"PASSWORD": "y", "keep": {"my_api-key": 1, "z": [{"Cookie": 2, "ok": None}]}}},
    {"deep": [[[{"authorizationHeader": 1, "v": True}]]], "empty": {}, "n": 12345678901234567},
    {},
]


def test_canonical_bytes(spark):
    def redacted(value):
        words = ("authorization", "cookie", "password", "secret", "apikey", "api_key", "api-key", "token")
        if isinstance(value, dict):
            return {k: redacted(v) for k, v in value.items() if not any(w in k.lower() for w in words)}
        return [redacted(v) for v in value] if isinstance(value, list) else value

    raw = [json.dumps(p, ensure_ascii=False) for p in PAYLOADS]
    expected = [json.dumps(redacted(p), sort_keys=True, separators=(",", ":")) for p in PAYLOADS]
    assert values(spark, "string", canonical_json, raw) == expected
    kept = [json.dumps(p, sort_keys=True, separators=(",", ":")) for p in PAYLOADS]
    assert values(spark, "string", lambda c: canonical_json(c, redact=False), raw) == kept
    assert canonical_text("{broken", {}) is None


def test_an_escaped_credential_name_is_redacted(spark):
    assert values(spark, "string", canonical_json, ['{"\\u0070assword":1,"a":2}']) == ['{"a":2}']


def test_iso_timestamps(spark):
    texts = [
        "2026-07-10T20:00:00Z", "2026-07-10 20:00", "2026-07-10T20", "20260710T2000", "2026-07-10T20:00:00,5Z",
        "2026-07-10T20:00+01:00", "2026-07-10", "20260710", "2026-7-1", "2026", "2026-07-10T25:00:00", "soon", None,
    ]
    at = lambda h, us=0: datetime(2026, 7, 10, h, 0, 0, us)
    expected = [at(20), at(20), at(20), at(20), at(20, 500_000), at(19), at(0), at(0), None, None, None, None, None]
    assert values(spark, "string", iso_timestamp, texts) == expected


def test_text_functions(spark):
    assert values(spark, "string", slug, ["Ice Hockey", "--", "a__B  c!"]) == ["ice-hockey", "unknown", "a-b-c"]
    assert values(spark, "string", optional_text, [" x　\n", "\x1c ", None]) == ["x", None, None]
    assert values(spark, "int", season_code, [2026, 1999, 2098]) == ["2627", "9900", "9899"]
    assert values(spark, "int", season_code, [1989, 2099, None]) == [None, None, None]
    assert values(spark, "int", season_problem, [1989, 2026]) == ["no two-digit season starts in 1989", None]
    with pytest.raises(Exception, match="unsafe"):
        values(spark, "string", safe_component, ["..."])


def test_ranges_are_checked(spark):
    day = lambda t: F.lit(t).cast("date")
    one = spark.range(1)
    assert len(one.select(inclusive_days(day("2026-07-01"), day("2026-07-31")).alias("d")).first().d) == 31
    assert len(one.select(inclusive_days(day("2026-01-01"), day("2026-12-31")).alias("d")).first().d) == 365
    for bad in (
        inclusive_days(day("2026-07-02"), day("2026-07-01")),
        inclusive_range(F.lit(2), F.lit(1)),
    ):
        with pytest.raises(Exception, match="range|start"):
            one.select(bad).collect()


def test_envelope_keeps_number_spelling_and_drops_strays(spark):
    body = '{"events":[{"x":1.0,"t":"\\u00e9"},"{not an object}",null,[{}],{"b":2}]}'
    df = spark.createDataFrame([(body,), ('{"events":null}',), ("[1]",), ("{",)], "body string")
    items = envelope_items(df, "thesportsdb").orderBy("position").collect()
    assert [i.position for i in items] == [0, 4]
    assert json.loads(items[0].payload) == {"x": 1.0, "t": "é"} and "1.0" in items[0].payload
    assert [r.reason for r in refused_envelopes(df, "thesportsdb").collect()] == ["response is not JSON"]
    assert refused_envelopes(df, "football-data").count() == 4


def test_each_payload_is_parsed_and_hashed_once(spark):
    df = spark.createDataFrame([(json.dumps(GAME), SEEN)], "payload string, observed_at timestamp")
    plan = n.accepted(n.normalize_thesportsdb(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("from_json(") == 1
