"""Payload JSON: redaction, canonical bytes and their hash."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidelake.schemas import SENSITIVE_KEY_PATTERN


def _without_secrets(value, names: dict[str, bool]):
    """The value without credential-like fields; ``names`` remembers the verdict on each name."""
    if isinstance(value, list):
        return [_without_secrets(member, names) for member in value]
    if not isinstance(value, dict):
        return value
    kept = {}
    for name, member in value.items():
        if name not in names:
            names[name] = re.search(SENSITIVE_KEY_PATTERN, name) is not None
        if not names[name]:
            kept[name] = _without_secrets(member, names)
    return kept


def canonical_text(raw: str | None, names: dict[str, bool] | None) -> str | None:
    """Sorted, compact, ASCII-escaped JSON of one payload; null if it is not JSON.

    ``names`` as for redaction; none means nothing is redacted.
    """
    if raw is None:
        return None
    try:
        value = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    kept = value if names is None else _without_secrets(value, names)
    return json.dumps(kept, sort_keys=True, separators=(",", ":"))


def _batch_canonical(redact: bool):
    @F.arrow_udf(StringType())
    def canonical(raws: pa.Array) -> pa.Array:
        # Field names repeat from payload to payload: match each once per batch.
        names: dict[str, bool] | None = {} if redact else None
        return pa.array([canonical_text(raw, names) for raw in raws.to_pylist()], pa.string())

    # Declared non-deterministic so that the optimizer never evaluates it twice, once
    # in a projection and again in a filter pushed below it.
    return canonical.asNondeterministic()


_CANONICAL = {True: _batch_canonical(True), False: _batch_canonical(False)}


def canonical_json(payload: Column, redact: bool = True) -> Column:
    """Canonical payload text, byte for byte what existing lakes were hashed over.

    Redaction reaches names at unknown depth, and the bytes must be exact (escapes,
    fractions), which Spark's own JSON writer does not promise; so payloads go
    through Python in Arrow batches.  Guarding a JVM path for the plain ones was
    measured to cost more than it saved.
    """
    return _CANONICAL[redact](payload)


def payload_hash(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def is_json_object(payload: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json(payload)), F.lit("OBJECT")), F.lit(False))


def field_or_none_text(payload: Column, value: Column, name: str) -> Column:
    """A required field as text: a JSON null becomes ``None``, an absent field stays null."""
    present = F.array_contains(F.json_object_keys(payload), name)
    return F.coalesce(value, F.when(present, F.lit("None")))


def is_set(raw: Column) -> Column:
    """Whether a JSON field's raw text is neither absent, false, zero nor empty."""
    return F.coalesce(~raw.isin("", "false", "0", "0.0", "{}", "[]"), F.lit(False))
