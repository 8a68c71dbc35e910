"""Date and time expressions over epoch-millisecond columns.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Zone handling follows the session time zone (``spark.sql.session.timeZone``);
``to_ts`` takes the wall-clock offset explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output patterns of the visit-date text and the offset of the
# shop's wall clock.
DAY_PATTERN = "yyyy-MM-dd"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
SHOP_OFFSET = "+08:00"
ONE_DAY_MS = 24 * 3600 * 1000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_epoch_millis(ts) -> Column:
    """Epoch ms of a TIMESTAMP_NTZ wall clock read as UTC, independent of
    the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _col(ts))


def millis_to_timestamp(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def to_date_str(ms) -> Column:
    """epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(millis_to_timestamp(ms), DAY_PATTERN)


def to_ymdhms(ms) -> Column:
    """epoch ms -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(millis_to_timestamp(ms), SECOND_PATTERN)


def visit_date(ms, granularity: str = "day") -> Column:
    """Visit key of a log row: calendar day (default) or second.

    ``"second"`` reproduces the literal behaviour of comparing full
    timestamps; ``"day"`` is the meaning the visitor jobs describe.
    """
    if granularity == "day":
        return to_date_str(ms)
    if granularity == "second":
        return to_ymdhms(ms)
    raise ValueError(f"granularity must be 'day' or 'second', not {granularity!r}")


def to_ts(text, is_full: bool = False, offset: str = SHOP_OFFSET) -> Column:
    """``yyyy-MM-dd[ HH:mm:ss]`` wall-clock text at ``offset`` -> epoch ms.

    Bad text gives NULL instead of failing the job.
    """
    c = _col(text)
    if not is_full:
        c = F.concat(c, F.lit(" 00:00:00"))
    instant = F.try_to_timestamp(F.concat(c, F.lit(offset)), F.lit(SECOND_PATTERN + "XXX"))
    return F.unix_millis(instant)


def format_text_time(text, pattern: str) -> Column:
    """``date_format`` on a string time; bad text gives NULL (ANSI-safe)."""
    return F.date_format(F.try_to_timestamp(_col(text)), pattern)
