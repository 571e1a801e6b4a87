"""Row shapes of the lake and the fixed values the data contract prescribes."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# These must equal the values existing lakes were written with.

EVENTS_DATASET = "sports_events"
ODDS_DATASET = "sports_odds"
CATALOG_DIR = "_catalog"
STAGING_DIR = "_staging"
PROVENANCE_FILE = "provenance.json"
SOURCE_FILE_PREFIX = "source-"
#: Data files of imported versions; the copy of a source may be a Parquet file too.
DATA_FILES = "{part-,data}*.parquet"

NATURAL_KEY = ["source", "external_id", "payload_hash"]
BULK_KEY = ["source_sha256", "source_row_number"]
CATALOG_SCHEMA_VERSION = 1
REQUIRED_MANIFEST_KEYS = [
    "dataset", "key_columns", "partitions", "schema", "schema_version", "ts_column", "updated_at",
]
REQUIRED_PARTITION_KEYS = ["max_ts", "min_ts", "rows", "updated_at"]

# Datasets whose source file a later run reads again, so it is never pruned.
READBACK_DATASETS = ["statsbomb_competitions", "statsbomb_matches"]

# Field names that look like credentials, matched anywhere in the name, any case.
SENSITIVE_KEY_PATTERN = r"(?i)authorization|cookie|password|secret|api[_-]?key|token"

# Null spellings in CSV dumps.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# sport code -> (sport, league, country)
GAME_SPORTS = {
    "nba": ("Basketball", "NBA", "United States"),
    "nfl": ("American Football", "NFL", "United States"),
    "mlb": ("Baseball", "MLB", "United States"),
    "epl": ("Soccer", "Premier League", "England"),
}
# odds sport key -> sport
ODDS_SPORTS = {"basketball_nba": "Basketball", "baseball_mlb": "Baseball"}

STALE_INTERVAL_FACTOR = 2.5
IDLE_RUN_THRESHOLD = 3
UNHEALTHY_STATUSES = ["failing", "stale", "degraded", "idle"]
STATUS_ORDER = ["failing", "stale", "degraded", "idle", "never-run", "skipped"]

FIRST_SEASON, LAST_SEASON = 1990, 2098
# first month of the season that a calendar year opens
SEASON_START_MONTH = {"soccer": 7, "american-football": 7, "ice-hockey": 9}

# Download addresses of the public dumps.
FOOTBALL_SEASON_URL = "https://www.football-data.co.uk/mmz4281/{season}/{league}.csv"
PLAY_BY_PLAY_URL = (
    "https://github.com/nflverse/nflverse-data/releases/download/pbp/play_by_play_{season}.parquet"
)
SHOTS_URL = "https://peter-tanner.com/moneypuck/downloads/shots_{season}.zip"
TEAM_GAMES_URL = "https://moneypuck.com/moneypuck/playerData/careers/gameByGame/all_teams.csv"
OPEN_DATA_URL = "https://raw.githubusercontent.com/statsbomb/open-data/master/data"

# --------------------------------------------------------------------- schemas

PARTITION_COLUMNS = ["source_slug", "sport_slug", "event_date"]
MERGE_KEY = PARTITION_COLUMNS + NATURAL_KEY

EVENT_SNAPSHOT = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("external_id", T.StringType(), False),
        T.StructField("payload_hash", T.StringType(), False),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("time_precision", T.StringType(), False),
        T.StructField("sport", T.StringType(), False),
        T.StructField("league_external_id", T.StringType()),
        T.StructField("league_name", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.StringType()),
        T.StructField("away_score", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("venue", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("payload_json", T.StringType(), False),
    ]
)

ODDS_SNAPSHOT = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("external_id", T.StringType(), False),
        T.StructField("payload_hash", T.StringType(), False),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("sport", T.StringType(), False),
        T.StructField("league_name", T.StringType()),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("market", T.StringType(), False),
        T.StructField("payload_json", T.StringType(), False),
    ]
)

PARTITION_FIELDS = [
    T.StructField("source_slug", T.StringType()),
    T.StructField("sport_slug", T.StringType()),
    T.StructField("event_date", T.DateType()),
]

ARTIFACT = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
        T.StructField("source_media_type", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("data_file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("license_name", T.StringType()),
        T.StructField("license_url", T.StringType()),
        T.StructField("source_pruned", T.BooleanType()),
        T.StructField("source_remote_key", T.StringType()),
    ]
)

HEALTH_ENTRY = T.StructType(
    [
        T.StructField("job", T.StringType(), False),
        T.StructField("interval_seconds", T.DoubleType()),
        T.StructField("runs", T.LongType()),
        T.StructField("failures", T.LongType()),
        T.StructField("consecutive_failures", T.LongType()),
        T.StructField("degraded_runs", T.LongType()),
        T.StructField("writeless_successes", T.LongType()),
        T.StructField("last_run", T.TimestampType()),
        T.StructField("last_success", T.TimestampType()),
        T.StructField("last_failure", T.TimestampType()),
        T.StructField("last_wrote", T.TimestampType()),
        T.StructField("last_status", T.StringType()),
        T.StructField("last_fetched", T.LongType()),
        T.StructField("last_added", T.LongType()),
        T.StructField("last_detail", T.StringType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("last_traceback", T.StringType()),
        T.StructField("skip_reason", T.StringType()),
    ]
)
