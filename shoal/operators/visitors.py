"""Per-device state operators of the log jobs, in their batch form.

Each one is the closed form of a keyed state machine that reads a device's
records in arrival order (``seq``) or event-time order (``ts``, ``seq``). The
streaming forms in ``shoal.streaming.stateful`` hold the same state per key;
tests check the two against each other and against plain-Python machines.

Input rows carry ``seq`` (arrival order), ``ts`` (epoch ms) and either ``common``
(``mid``, ``is_new``) and ``page`` (``last_page_id``), as in ``schemas.PAGE_LOG``, or the
control columns ``mid``, ``is_new`` and ``last_page_id`` of ``operators.logs``.

Arrival order is the order of a device's records in its topic partition: the log
and page topics have to be keyed by ``mid``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions import ONE_DAY_MS, is_entry_page, visit_date
from shoal.operators.sequence import first_per_key, neighbour, next_within

# The pattern time bound of the bounce job and the labels of
# its two outcomes.
JUMP_WITHIN_MS = 10_000
MATCH, TIMEOUT = "match", "timeout"
LATE = "late"  # a stream's record that comes behind the watermark

# Width of the ordered buckets that split one device's rows over tasks.
SEQ_BUCKET = 1 << 20       # arrival-order buckets (rows)
TS_BUCKET_MS = 600_000     # event-time buckets (ms)

_MID = "__mid"


def control(df: DataFrame, name: str) -> Column:
    """``mid``, ``is_new`` or ``last_page_id`` of either input shape."""
    if "common" not in df.columns:
        return F.col(name)
    return F.col("page.last_page_id" if name == "last_page_id" else f"common.{name}")


def _with_mid(df: DataFrame) -> DataFrame:
    return df.withColumn(_MID, control(df, "mid"))


def first_visits(log: DataFrame, granularity: str = "day") -> DataFrame:
    """``mid, d``: each device's first-visit date, as ``fix_is_new`` fixes it. Combined before the
    shuffle; the state with which the stream goes on from a history."""
    ts, is_new = F.col("ts"), control(log, "is_new")
    d = F.when(is_new == "1", visit_date(ts, granularity)).otherwise(visit_date(ts - F.lit(ONE_DAY_MS), granularity))
    return _with_mid(log).where(F.col(_MID).isNotNull()).groupBy(F.col(_MID).alias("mid")).agg(F.min_by(d, F.col("seq")).alias("d"))


def last_visits(page_log: DataFrame, granularity: str = "day") -> DataFrame:
    """``mid, d``: the visit date of each device's last entry page (see ``first_visits``)."""
    entries = _with_mid(page_log).where(is_entry_page(control(page_log, "last_page_id")) & F.col(_MID).isNotNull())
    return entries.groupBy(F.col(_MID).alias("mid")).agg(F.max_by(visit_date(F.col("ts"), granularity), F.col("seq")).alias("d"))


def fix_is_new(log: DataFrame, granularity: str = "day") -> DataFrame:
    """Repair the new-visitor flag.

    A device's first record fixes its first-visit date once: its own date if
    it says ``is_new = '1'``, otherwise the day before. Later records that
    say ``'1'`` on another date become ``'0'``. ``granularity="second"`` keeps
    the literal comparison of full timestamps; ``"day"`` compares dates.
    """
    ts = F.col("ts")
    is_new = control(log, "is_new")
    first_date = F.when(is_new == "1", visit_date(ts, granularity)) \
        .otherwise(visit_date(ts - F.lit(ONE_DAY_MS), granularity))
    d = "__first_visit"
    out = first_per_key(_with_mid(log), _MID, ["seq"], first_date, d)
    fixed = F.when((is_new == "1") & (F.col(d) != visit_date(ts, granularity)), F.lit("0")) \
        .otherwise(is_new)
    if "common" in log.columns:
        out = out.withColumn("common", F.col("common").withField("is_new", fixed))
    else:
        out = out.withColumn("is_new", fixed)
    return out.select(*log.columns)


def unique_visitor(page_log: DataFrame, granularity: str = "day",
                   bucket_width: int = SEQ_BUCKET) -> DataFrame:
    """First entry page of each visit date per device.

    Only entry pages count. A row is kept when its visit date differs from
    the date of the device's previous entry row (a device seen on d1, d2, d1
    gives three rows); equal to "differs from the last kept date".
    """
    entries = _with_mid(page_log).where(is_entry_page(control(page_log, "last_page_id")))
    entries = entries.withColumn("__vd", visit_date(F.col("ts"), granularity))
    nb = neighbour(entries, _MID, ["seq"], F.floor(F.col("seq") / bucket_width), ["__vd"],
                   "prev", "__prev")
    keep = F.col("__prev").isNull() | (F.col("__prev.__vd") != F.col("__vd"))
    return nb.where(keep).select(*page_log.columns)


def user_jump(page_log: DataFrame, within_ms: int = JUMP_WITHIN_MS,
              bucket_ms: int = TS_BUCKET_MS) -> DataFrame:
    """Bounced visits: entry page directly followed by another entry page.

    Per device in event-time order (ties by ``seq``), an entry page whose
    next record is also an entry page less than ``within_ms`` later is a
    ``match``; an entry page with no next record, or whose next record comes
    ``within_ms`` or more later, is a ``timeout``. An entry page followed
    in time by a non-entry page is no bounce. Both outcomes emit the first
    record, with column ``reason``. A next record matters only within
    ``within_ms``, so no row is compared beyond its bucket and that reach.
    """
    entry = "__entry"
    df = _with_mid(page_log).withColumn(entry, is_entry_page(control(page_log, "last_page_id")))
    nb = next_within(df, _MID, "ts", ["ts", "seq"], within_ms, bucket_ms, ["ts", entry], "__next")
    soon = F.coalesce(F.col("__next.ts") - F.col("ts") < within_ms, F.lit(False))
    reason: Column = F.when(~soon, F.lit(TIMEOUT)).when(F.col(f"__next.{entry}"), F.lit(MATCH))
    return (nb.where(F.col(entry)).withColumn("reason", reason)
            .where(F.col("reason").isNotNull()).select(*page_log.columns, "reason"))


def flatten_page(df: DataFrame, *extra: str) -> DataFrame:
    """Scalar columns of a page-log frame (for reports and comparisons)."""
    return df.select("seq", F.col("common.mid").alias("mid"),
                     F.col("common.is_new").alias("is_new"),
                     F.col("page.page_id").alias("page_id"),
                     F.col("page.last_page_id").alias("last_page_id"), "ts", *extra)
