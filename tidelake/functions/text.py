"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.schemas import CSV_NULL_TOKENS, FIRST_SEASON, LAST_SEASON

# Every character that counts as blank when a provider field is trimmed.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    return F.btrim(_col(value), F.lit(BLANKS))


def not_blank(value: Column) -> Column:
    """The value, or null where it is an empty string."""
    return F.nullif(value, F.lit(""))


def optional_text(value: Column | str) -> Column:
    """Text without surrounding blanks; nothing left means null."""
    return not_blank(strip(_col(value).cast("string")))


def slug(value: Column | str) -> Column:
    """Directory-safe lower-case name, ``unknown`` where nothing is left."""
    dashed = F.regexp_replace(F.lower(_col(value)), "[^a-z0-9]+", "-")
    return F.coalesce(not_blank(F.btrim(dashed, F.lit("-"))), F.lit("unknown"))


def safe_component(value: Column | str) -> Column:
    """A path component; the job fails on a value that leaves nothing usable."""
    text = _col(value)
    cleaned = F.btrim(F.regexp_replace(text, "[^A-Za-z0-9._=-]+", "-"), F.lit("-."))
    return F.when(cleaned != "", cleaned).otherwise(
        F.raise_error(F.concat(F.lit("unsafe in a path, nothing usable is left of: "), F.coalesce(text, F.lit("null"))))
    )


def versus_name(home: Column, away: Column) -> Column:
    return F.concat(F.coalesce(home, F.lit("TBD")), F.lit(" vs "), F.coalesce(away, F.lit("TBD")))


def split_away_at_home(name: Column) -> tuple[Column, Column]:
    """``A at B`` names the visitor first: returns (home, away), null if the name is not of that form."""
    parts = F.split(name, " at ", 2)
    return F.get(parts, F.lit(1)), F.when(F.contains(name, F.lit(" at ")), F.get(parts, F.lit(0)))


def team_name(full_name: Column, display_name: Column, city: Column, name: Column) -> Column:
    """The full or display name, else city and nickname, else null."""
    named = optional_text(F.coalesce(not_blank(full_name), display_name))
    return F.coalesce(named, not_blank(F.concat_ws(" ", optional_text(city), optional_text(name))))


def season_code(start_year: Column | str) -> Column:
    """2026 becomes 2627; null outside the range where two digits name one year.

    ``season_problem`` says why.
    """
    year = _col(start_year)
    digits = [F.lpad((y % 100).cast("string"), 2, "0") for y in (year, year + 1)]
    return F.when(year.between(FIRST_SEASON, LAST_SEASON), F.concat(*digits))


def season_problem(start_year: Column | str) -> Column:
    """Why a year has no season code, null where it has one."""
    year = _col(start_year)
    said = F.concat(F.lit("no two-digit season starts in "), F.coalesce(year.cast("string"), F.lit("an unknown year")))
    return F.when(~F.coalesce(year.between(FIRST_SEASON, LAST_SEASON), F.lit(False)), said)


def csv_tokens(value: Column | str) -> Column:
    """Comma-separated setting to an array, without blanks."""
    return F.filter(F.transform(F.split(_col(value), ","), strip), lambda token: token != "")


def ordered_distinct_codes(codes: Column | str) -> Column:
    """Upper-cased codes, each at its first place; empty entries dropped before trimming."""
    given = F.filter(_col(codes), lambda code: code.isNotNull() & (code != ""))
    return F.array_distinct(F.transform(given, lambda code: F.upper(strip(code))))


def null_token(value: Column | str) -> Column:
    """Null for any of the spellings that mean null in a CSV dump."""
    text = _col(value)
    return F.when(~text.isin(CSV_NULL_TOKENS), text)


def artifact_directory(dataset: Column, parts: Column, sha256: Column) -> Column:
    """``dataset/part/.../version=<first 16 digits>``; parts is an array."""
    return F.concat_ws(
        "/", safe_component(dataset), F.transform(parts, safe_component),
        F.concat(F.lit("version="), F.substring(sha256, 1, 16)),
    )
