import hashlib
import heapq
import random
import re
import zlib

import pytest

from shoal.llm import conversations as C
from shoal.llm.conversations import damage, repair, repaired_turns, search

KINDS = "conv_id long, turn long, role string, text string, cost string, part int, same long"


def every(turns):
    """All cheapest (cost, audit) by trying every edit: no bound and no dominance but cost."""
    most = 4 * len(turns)
    heap, found = [(0, "", 0, "")], []
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if cost > most or found and cost > found[0][0]:
            continue
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit))
        if not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        for letter in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, roles + letter))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles))
            if fault in (C.SOUND, C.CUT):
                more = 3 * (fault == C.CUT)
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + (initial or "-")))
                for letter in "ua":
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, roles + letter))
    return min(found)


def cheapest(turns):
    cost, audit, last = min((c + C.CLOSING[t][0], a + C.CLOSING[t][1], t) for t in C.ROLES
                            for c, a in [search(turns, C.NONE, t) or (10 ** 9, "")])
    return cost, audit


def test_search_equals_trying_every_edit():
    rng = random.Random(4)
    for _ in range(250):
        turns = [(rng.choice("ssuuaatx") if rng.random() < .95 else "", rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 5))]
        assert cheapest(turns) == every(turns), turns


def test_long_conversations_are_searched_in_linear_work():
    rng = random.Random(5)
    turns = [(rng.choice("ua"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(3000)]
    whole = cheapest(turns)
    tables = []
    for lo in range(0, 3000, 170):
        part = turns[lo:lo + 170]
        tables.append({(f, t): x for f in C.ROLES for t in C.ROLES if (x := search(part, f, t)) is not None})
    cost, audit, firsts = C.chosen(tables)
    assert (cost, audit) == whole and len(firsts) == len(tables)


def expected(rows):
    """The contract over plain rows, by one search of each whole conversation."""
    by = {}
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(shown).encode()) % 20
        own = by.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in own:
            words = re.sub(r"[\x20\x09-\x0D]+", "", text)
            fault = 1 if not words else 2 if (role, text) in seen else 0 if words[-1] in ".!?" else 3
            seen.add((role, text))
            turns.append((role[:1], fault))
        known = {r[0] for r in own if r[0] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        faults = [sum(f == k for _, f in turns) for k in (1, 2, 3)]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest(turns)
        role, kept, i = 0, [], 0
        for letter in audit:
            if letter in "IR":
                role = C.TURNED[role]
                kept.append((["", "", "user", "assistant"][role], "" if letter == "I" else own[i][2]))
            elif letter == "K":
                role = C.KEPT[own[i][1][:1]][role]
                kept.append((own[i][1], own[i][2]))
            i += letter != "I"
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = ((gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), kept)
    return out


def rows_of(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        length = rng.choice([1, 1, 2, 3, 6, 12])
        for turn in range(length):
            role = "system" if not turn and rng.random() < .3 else rng.choice(["user", "assistant"] if rng.random() < .3 else [["user", "assistant"][turn % 2]])
            text = rng.choice(["Yes.", "No!", "What is it?", "cut off", "  \t", "", "é. ", "a\u0085", None, "Long words. " * 30])
            rows.append((conv, rng.choice([turn, turn, turn, turn, None, turn + 3]), rng.choice([role] * 9 + [None, "tool", ""]), text))
    rows += rows[:7]
    rows += [(n + 1, 5, "user", "Same.")] * 40  # repeated rows are one turn with its copies
    return rows


def compare(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KINDS).repartition(5)
    want = expected(rows)
    got = repair(damage(df), **how).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {k: v[0] for k, v in want.items()} and len(got) == len(want)
    turns = {}
    for r in repaired_turns(damage(df), **how).orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {k: v[1] for k, v in want.items() if v[1]}


def test_table_equals_a_search_of_whole_conversations(spark):
    compare(spark, rows_of(1, 120))


def test_conversations_cut_into_segments(spark):
    """A conversation with a third of all rows, over many partitions and segments."""
    rng = random.Random(9)
    rows = rows_of(2, 40)
    rows += [(77777, i // 2 if i % 9 else None, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", "", f"Number {i}."])) for i in range(700)]
    compare(spark, rows, most=16)


def test_conversations_without_rows_and_empty_tables(spark):
    drop = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(drop, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in repair(damage(df)).collect()] == [(drop, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair(damage(df.limit(0))).count() == 0 and repaired_turns(damage(df.limit(0))).count() == 0


@pytest.mark.parametrize("size", [1_200_000])
def test_very_long_texts(spark, size):
    rows = [(1, 0, "user", "word " * (size // 5) + "."), (1, 1, "assistant", "word " * (size // 5)), (1, 2, "user", "word " * (size // 5) + "."),
            (1, 3, "assistant", "Short.")]
    compare(spark, rows)
