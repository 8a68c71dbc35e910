"""Plain-Python state machines of the per-device operators, written from the
record-at-a-time description (one state value per device), used as the
reference in property tests."""

from __future__ import annotations

import datetime as dt

DAY_MS = 86_400_000


def fmt(ms: int, gran: str) -> str:
    t = dt.datetime.fromtimestamp(ms / 1000, tz=dt.timezone.utc)
    return t.strftime("%Y-%m-%d" if gran == "day" else "%Y-%m-%d %H:%M:%S")


def is_entry(last_page_id) -> bool:
    return last_page_id is None or last_page_id == ""


def fix_is_new(rows, gran="day"):
    """rows: (seq, mid, is_new, ts) in arrival order -> {seq: fixed is_new}."""
    state: dict[str, str] = {}
    out = {}
    for seq, mid, is_new, ts in sorted(rows):
        last = state.get(mid)
        cur = fmt(ts, gran)
        if is_new == "1":
            if not last:
                state[mid] = cur
            elif last != cur:
                is_new = "0"
        elif not last:
            state[mid] = fmt(ts - DAY_MS, gran)
        out[seq] = is_new
    return out


def unique_visitor(rows, gran="day"):
    """rows: (seq, mid, last_page_id, ts) -> set of kept seq."""
    state: dict[str, str] = {}
    kept = set()
    for seq, mid, last_page_id, ts in sorted(rows):
        if not is_entry(last_page_id):
            continue
        cur = fmt(ts, gran)
        if state.get(mid) == cur:
            continue
        state[mid] = cur
        kept.add(seq)
    return kept


def user_jump(rows, within=10_000):
    """rows: (seq, mid, last_page_id, ts). Simulates the two-step strict
    pattern per device in event-time order: a pending entry page waits for
    the very next record; the wait ends in a timeout once that record is
    `within` or more later (or never comes)."""
    by_mid: dict[str, list] = {}
    for r in rows:
        by_mid.setdefault(r[1], []).append(r)
    out = {}
    for mid, rs in by_mid.items():
        rs.sort(key=lambda r: (r[3], r[0]))
        pending = None  # (seq, ts) of an entry page waiting for its successor
        for seq, _, lp, ts in rs:
            if pending is not None:
                pseq, pts = pending
                if ts - pts >= within:
                    out[pseq] = "timeout"
                elif is_entry(lp):
                    out[pseq] = "match"
                pending = None
            if is_entry(lp):
                pending = (seq, ts)
        if pending is not None:
            out[pending[0]] = "timeout"
    return out
