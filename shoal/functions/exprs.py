"""Small column expressions used by the change-log and log operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_entry_page(last_page_id) -> Column:
    """A page view that starts a visit: no previous page (NULL or empty)."""
    return F.coalesce(_col(last_page_id), F.lit("")) == ""


def map_get(m, key: str) -> Column:
    """``m['key']``; a missing key gives NULL."""
    return _col(m).getItem(key)


def as_int(text) -> Column:
    """String -> INT, NULL when not a number (ANSI-safe)."""
    return _col(text).try_cast("int")


def decimal_product(a, b, precision: int = 16, scale: int = 2) -> Column:
    """``cast(cast(a as decimal(p,s)) * cast(b as decimal(p,s)) as string)``."""
    t = f"decimal({precision},{scale})"
    return (_col(a).try_cast(t) * _col(b).try_cast(t)).cast("string")


def keep_keys(m, keys_csv) -> Column:
    """Keep the map entries whose key is in the comma list (exact match,
    no trimming; keys that are absent are not created)."""
    wanted = F.split(_col(keys_csv), ",")
    return F.map_filter(_col(m), lambda k, v: F.array_contains(wanted, k))
