"""JSON payload access on Variant columns.

The incident payload is stored once as ``VARIANT`` (parsed at ingest), so the
25 field reads of the staging model do not re-parse text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_get(v, path: str, type_: str = "string", lenient: bool = False) -> Column:
    """Typed read of a JSON path; strict mode fails on a bad cast like the
    reference's ``::int``; lenient mode returns NULL."""
    fn = F.try_variant_get if lenient else F.variant_get
    return fn(_c(v), path, type_)


def attribute(raw, key: str, type_: str = "string", lenient: bool = False) -> Column:
    """``raw -> 'attributes' ->> key`` with a cast."""
    return path_get(raw, f"$.attributes.{key}", type_, lenient)


def geometry(raw, key: str, type_: str = "string", lenient: bool = False) -> Column:
    """``raw -> 'geometry' ->> key`` with a cast."""
    return path_get(raw, f"$.geometry.{key}", type_, lenient)


def parse(text, lenient: bool = False) -> Column:
    """Text to Variant (``::jsonb``)."""
    return (F.try_parse_json if lenient else F.parse_json)(_c(text))


def serialise(v) -> Column:
    """Variant (or struct) to JSON text."""
    return F.to_json(_c(v))


def text_get(text, path: str) -> Column:
    """Text twin of ``->>`` for JSON kept as a string column."""
    return F.get_json_object(_c(text), path)
