import random

import pytest

from shoal.operators import visitors

from machines import fix_is_new as m_fix
from machines import unique_visitor as m_uv
from machines import user_jump as m_jump

BASE = 1704067200000


def _log(spark, rows):
    """rows: (seq, mid, is_new, last_page_id, ts)"""
    return spark.createDataFrame(
        [(s, (m, n, None, None), ("p", lp, None), t) for s, m, n, lp, t in rows],
        "seq long, common struct<mid:string,is_new:string,uid:string,ch:string>, "
        "page struct<page_id:string,last_page_id:string,during_time:long>, ts long")


def _random_rows(seed, n=300, mids=6, span=4 * 86_400_000, gap=None):
    rnd = random.Random(seed)
    rows, t = [], BASE
    for i in range(n):
        if gap:
            t += rnd.choice(gap)
        else:
            t = BASE + rnd.randrange(span)
        rows.append((i, f"m{rnd.randrange(mids)}", rnd.choice(["0", "1", None]),
                     rnd.choice([None, "", "home", "good"]), t))
    return rows


@pytest.mark.parametrize("gran", ["day", "second"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fix_is_new_matches_machine(spark, seed, gran):
    rows = _random_rows(seed)
    got = {r["seq"]: r["common"]["is_new"] for r in visitors.fix_is_new(_log(spark, rows), gran).collect()}
    assert got == m_fix([(s, m, n, t) for s, m, n, _, t in rows], gran)


@pytest.mark.parametrize("gran", ["day", "second"])
@pytest.mark.parametrize("seed", [4, 5, 6])
def test_unique_visitor_matches_machine(spark, seed, gran):
    rows = _random_rows(seed)
    for width in (1 << 20, 7):
        got = {r["seq"] for r in visitors.unique_visitor(_log(spark, rows), gran, width).collect()}
        assert got == m_uv([(s, m, lp, t) for s, m, _, lp, t in rows], gran)


@pytest.mark.parametrize("seed", [7, 8, 9, 10])
def test_user_jump_matches_machine(spark, seed):
    rows = _random_rows(seed, gap=[0, 1, 3000, 9999, 10000, 10001, 20000])
    want = m_jump([(s, m, lp, t) for s, m, _, lp, t in rows])
    for width in (60_000, 5_000):
        got = {r["seq"]: r["reason"] for r in visitors.user_jump(_log(spark, rows), bucket_ms=width).collect()}
        assert got == want


def test_user_jump_edges(spark):
    # gap 9,999 / 10,000 / 10,001 ms; equal timestamps; last event; second not entry
    rows = [
        (1, "a", "1", None, BASE), (2, "a", "1", None, BASE + 9_999),           # match
        (3, "a", "1", None, BASE + 19_999), (4, "a", "1", "", BASE + 29_999),   # gaps of 10000
        (5, "a", "1", None, BASE + 40_000),                                     # 4: timeout(10001)
        (6, "b", "1", None, BASE), (7, "b", "1", "home", BASE),                 # no bounce
        (8, "c", "1", None, BASE), (9, "c", "1", None, BASE),                   # equal ts: match
    ]
    got = {r["seq"]: r["reason"] for r in visitors.user_jump(_log(spark, rows)).collect()}
    assert got == {1: "match", 2: "timeout", 3: "timeout", 4: "timeout", 5: "timeout",
                   8: "match", 9: "timeout"}


def test_unique_visitor_d1_d2_d1(spark):
    d = 86_400_000
    rows = [(1, "a", "1", None, BASE), (2, "a", "1", None, BASE + d), (3, "a", "1", None, BASE + 10),
            (4, "a", "1", "home", BASE + 2 * d), (5, "a", "1", "", BASE + 11)]
    got = {r["seq"] for r in visitors.unique_visitor(_log(spark, rows)).collect()}
    assert got == {1, 2, 3}


def test_fix_is_new_first_zero_then_one(spark):
    d = 86_400_000
    rows = [(1, "a", "0", None, BASE), (2, "a", "1", None, BASE + 5),      # state = day before
            (3, "b", "1", None, BASE), (4, "b", "1", None, BASE + 5),      # same day stays '1'
            (5, "b", "1", None, BASE + d), (6, "c", None, None, BASE)]     # NULL flag kept
    got = {r["seq"]: r["common"]["is_new"] for r in visitors.fix_is_new(_log(spark, rows)).collect()}
    assert got == {1: "0", 2: "0", 3: "1", 4: "1", 5: "0", 6: None}
