"""JSON text predicates and conversions (JVM-side built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_json_object(text) -> Column:
    """True when the text parses as a JSON object.

    Arrays, scalars, broken text, empty text and NULL are not objects.
    Trailing text after a complete object is accepted (Spark's parser stops
    at the end of the first value).
    """
    return F.json_object_keys(_col(text)).isNotNull()


def is_json(text) -> Column:
    """True when the text is any valid JSON value."""
    return F.try_parse_json(_col(text)).isNotNull()


def to_json_value(*cols) -> Column:
    """Row -> JSON text; NULL fields are left out."""
    if len(cols) == 1 and isinstance(cols[0], str) and cols[0] == "*":
        return F.to_json(F.struct("*"))
    return F.to_json(F.struct(*cols))
