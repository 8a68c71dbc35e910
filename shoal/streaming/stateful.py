"""Streaming forms of the per-device operators (``transformWithState``).

Each processor keeps one small value per device (``mid``); rows of a
micro-batch are handled in arrival order (``seq``) or event-time order
(``ts``, ``seq``). Timestamps are kept as epoch-ms longs in state. The
record itself travels as its text (``value``) and is parsed again downstream, on
the JVM side.

A device's rows of one micro-batch are sorted in memory; the readers' limit per
trigger (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``) bounds them, also when a
new query starts from the whole backlog. Rows have a device and a time
(``operators.logs.is_clean``).

Input columns: ``mid, seq, ts, is_new, last_page_id, value``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shoal.operators.visitors import JUMP_WITHIN_MS, LATE, MATCH, TIMEOUT, control

DAY_MS = 86_400_000
_PATTERNS = {"day": "%Y-%m-%d", "second": "%Y-%m-%d %H:%M:%S"}

FIX_OUT = "mid string, seq long, ts long, is_new string, value string"
VISIT_OUT = "mid string, seq long, ts long, value string"
JUMP_OUT = "mid string, seq long, ts long, reason string, value string"


def _fmt(ms: int, granularity: str) -> str:
    t = _dt.datetime.fromtimestamp(ms / 1000, tz=_dt.timezone.utc)
    return t.strftime(_PATTERNS[granularity])


def _is_entry(last_page_id) -> bool:
    return last_page_id is None or last_page_id == ""


class FixIsNewProcessor(StatefulProcessor):
    """State: the device's first-visit date, set once."""

    def __init__(self, granularity: str = "day"):
        self.granularity = granularity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_visit", "d string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = self.first.get()[0] if self.first.exists() else None
        for r in sorted(rows, key=lambda r: r.seq):
            flag = r.is_new
            if first is None:
                ms = r.ts if flag == "1" else r.ts - DAY_MS
                first = _fmt(ms, self.granularity)
            elif flag == "1" and first != _fmt(r.ts, self.granularity):
                flag = "0"
            yield Row(mid=key[0], seq=r.seq, ts=r.ts, is_new=flag, value=r.value)
        if first is not None:
            self.first.update((first,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.first.update((initialState.d,))

    def close(self) -> None:
        pass


class UniqueVisitorProcessor(StatefulProcessor):
    """State: the last emitted visit date, expiring after ``ttl_ms`` of
    processing time without a write."""

    def __init__(self, granularity: str = "day", ttl_ms: int = DAY_MS):
        self.granularity, self.ttl_ms = granularity, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_visit", "d string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        changed = False
        for r in sorted(rows, key=lambda r: r.seq):
            if not _is_entry(r.last_page_id):
                continue
            cur = _fmt(r.ts, self.granularity)
            if cur == last:
                continue
            last, changed = cur, True
            yield Row(mid=key[0], seq=r.seq, ts=r.ts, value=r.value)
        if changed:
            self.last.update((last,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((initialState.d,))

    def close(self) -> None:
        pass


class UserJumpProcessor(StatefulProcessor):
    """State: the entry page waiting for its successor, with an event-time
    timer at ``ts + within``. Rows behind the watermark touch no state and come out
    as they are, with reason ``late``."""

    def __init__(self, within_ms: int = JUMP_WITHIN_MS):
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "seq long, ts long, value string")

    def _emit(self, mid, p, reason) -> Row:
        return Row(mid=mid, seq=p[0], ts=p[1], reason=reason, value=p[2])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        p = self.pending.get() if self.pending.exists() else None
        reached = timerValues.getCurrentWatermarkInMs()
        for r in sorted(rows, key=lambda r: (r.ts, r.seq)):
            if r.ts < reached:
                yield self._emit(key[0], (r.seq, r.ts, r.value), LATE)
                continue
            if p is not None:
                if r.ts - p[1] >= self.within_ms:
                    yield self._emit(key[0], p, TIMEOUT)
                elif _is_entry(r.last_page_id):
                    yield self._emit(key[0], p, MATCH)
                self.handle.deleteTimer(p[1] + self.within_ms)
                p = None
            if _is_entry(r.last_page_id):
                p = (r.seq, r.ts, r.value)
                self.handle.registerTimer(r.ts + self.within_ms)
        if p is None:
            self.pending.clear()
        else:
            self.pending.update(p)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.pending.exists():
            p = self.pending.get()
            if p[1] + self.within_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.pending.clear()
                yield self._emit(key[0], p, TIMEOUT)

    def close(self) -> None:
        pass


def _record_text(log: DataFrame, *fields: str):
    """The record as text: the original ``value`` when the frame still has it,
    else the JSON of its fields."""
    if "value" in log.columns:
        return F.col("value")
    return F.to_json(F.struct(*(fields or [c for c in log.columns if c != "seq"])))


def keyed_input(log: DataFrame) -> DataFrame:
    """Parsed log records -> the processors' input columns (record as text)."""
    log = log.where(control(log, "mid").isNotNull() & F.col("ts").isNotNull())
    return log.select("seq", "ts", *[control(log, c).alias(c) for c in ("mid", "is_new", "last_page_id")],
                      _record_text(log).alias("value"))


def fix_is_new_stream(log: DataFrame, granularity: str = "day", history: DataFrame | None = None) -> DataFrame:
    """``history``: ``visitors.first_visits`` of the records before the stream, with which a new
    query starts (a restarted one has its own state)."""
    return keyed_input(log).groupBy("mid").transformWithState(
        FixIsNewProcessor(granularity), FIX_OUT, "Append", "None", initialState=by_device(history))


def unique_visitor_stream(log: DataFrame, granularity: str = "day",
                          ttl_ms: int = DAY_MS, history: DataFrame | None = None) -> DataFrame:
    """``history``: ``visitors.last_visits`` of the records before the stream."""
    return keyed_input(log).groupBy("mid").transformWithState(
        UniqueVisitorProcessor(granularity, ttl_ms), VISIT_OUT, "Append", "ProcessingTime", initialState=by_device(history))


def by_device(history: DataFrame | None):
    return None if history is None else history.select("mid", "d").groupBy("mid")


def user_jump_stream(log: DataFrame, within_ms: int = JUMP_WITHIN_MS,
                     delay: str = "0 seconds", keep_late: bool = False) -> DataFrame:
    """Event time from ``ts`` with a monotonous watermark (``delay`` 0): records older than the
    watermark take no part in the pattern. They are counted in the query's progress (observed
    as ``user_jump``: ``rows`` out and ``late``) and, with ``keep_late``, come out with reason
    ``late``; otherwise they go.

    The rows bring their time as a plain column, so Spark's own filter of late rows, which
    says nothing, doesn't see them; the watermark itself is the query's."""
    timed = log.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)
    timed = timed.where(control(log, "mid").isNotNull() & F.col("ts").isNotNull())
    src = timed.select("seq", "ts", *[control(log, c).alias(c) for c in ("mid", "is_new", "last_page_id")],
                       _record_text(timed, "common", "page", "ts").alias("value"))
    out = src.groupBy("mid").transformWithState(
        UserJumpProcessor(within_ms), JUMP_OUT, "Append", "EventTime")
    late = F.col("reason") == LATE
    out = out.observe("user_jump", F.count(F.lit(1)).alias("rows"), F.count_if(late).alias(LATE))
    return out if keep_late else out.where(~late)
