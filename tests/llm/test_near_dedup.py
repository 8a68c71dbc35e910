import re
from itertools import combinations

import numpy as np
import pytest

from llm_data import documents, frame
from shoal.llm.near_dedup import dedup, intersections, near_duplicates, signature

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}


def brute(rows, k):
    sets = {}
    for r in rows:
        sets.setdefault(r[0], []).append(shingle_set(r[1], k))
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations([i for i in sets if i is not None], 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return sorted(((r[0], len(shingle_set(r[1], k)), None if r[0] is None else find(r[0]),
                    r[0] is None or find(r[0]) == r[0]) for r in rows), key=str)


@pytest.mark.parametrize("k,block", [(4, 192), (5, 8)])
def test_components_equal_brute_force(spark, k, block):
    rows = documents()
    got = near_duplicates(frame(spark), words_in_shingle=k, block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, k)


def test_a_large_group_of_copies_and_near_copies(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words), *[None] * 8) for i in range(150)]
    for i in range(90):
        w = list(words)
        for j in range(i % 4):
            w[(7 * i + 13 * j) % 60] = f"x{i}{j}"
        rows.append((1000 + i, " ".join(w), *[None] * 8))
    got = near_duplicates(frame(spark, rows), words_in_shingle=4, block=16)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 4)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert dedup(frame(spark, [])).count() == 0


def test_dedup_keeps_one_of_each_group_with_its_columns(spark):
    kept = dedup(frame(spark), words_in_shingle=4)
    assert kept.columns == frame(spark).columns
    want = {r[0] for r in brute(documents(), 4) if r[3]}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_unlike_texts_of_one_id_stay_and_repeated_rows_stay_once(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long, "en"), (2, long + " end", "en"), (2, "another text that is like nothing else here", "b"),
            (2, "another text that is like nothing else here", "a"), (3, "another text that is like nothing else here", "c"),
            (4, "first of the two that share this id", "x"), (4, "second, quite unlike the one before it", "x"),
            (5, None, "x"), (5, None, "x"), (5, "", "x"), (None, long, "x"), (None, long, "x"), (7, long, None)]
    rows = [(i, t, a, *[None] * 7) for i, t, a in rows]
    want = {(1, long, "en"), (3, "another text that is like nothing else here", "c"), (4, "first of the two that share this id", "x"),
            (4, "second, quite unlike the one before it", "x"), (5, None, "x"), (5, "", "x"), (None, long, "x")}
    for parts in (1, 7):
        got = [(r.doc_id, r.text, r.lang) for r in dedup(frame(spark, rows).repartition(parts)).collect()]
        assert set(got) == want
        assert len(got) == len(want) + 1  # the rows without id


def test_a_repeated_row_stays_by_its_other_columns_wherever_it_lies(spark):
    rows = [(9, "the same text in every row of this id", "en", f"src{i}", i, *[None] * 5) for i in range(40)]
    got = {tuple(dedup(frame(spark, rows).repartition(n)).first()) for n in (1, 3, 8)}
    assert len(got) == 1 and got <= set(rows)


def test_signatures_agree_about_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    whole = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = np.sort(whole[:800]), np.sort(whole[100:])
    same = (signature(a, 448) == signature(b, 448)).mean()
    assert abs(same - 700 / 900) < 0.08


def test_block_intersections_are_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 90)).astype(np.uint64)) for _ in range(14)]
    got = intersections(sets[:6], sets[6:], columns=32)
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[6:]] for x in sets[:6]]
