"""Cheapest repair of broken conversations by depth-first branch-and-bound.

A repaired conversation's roles begin with user, or system and user, and then take
turns up to an answer of the assistant; it may be empty. A search goes through the
turns with an explicit stack. A node is a turn and what the last role kept was (none
yet, system, user, assistant); its edits are delete, insert before it, keep and
change of role, in the order of their initials. A suffix bound, the least that the
turns from a node on can cost, cuts every branch that can't be a cheapest one; a
table per node keeps the least cost that has reached it, and as branches are opened
in the order of their letters the first to reach a node at a cost has the least
audit, so a later one is dominated. The first complete repair whose cost meets the
bound is the incumbent; the search ends when no open branch can beat (cost, audit).

A conversation of any length is cut into segments of bounded size, wherever the sorted
rows' partitions and blocks end. Each segment is searched from every role it may begin
after to every role it may end with; the results are joined in a tree, cost and
audit, which is exact because audits between the same two nodes at the same cost are
never beginnings of each other. Only these narrow results of a conversation meet in
one task. The texts follow in order, a batch at a time, into the running hash.

Defined results: null roles and texts are one space; rows without ``conv_id`` are one
conversation; turns come in ascending order, null turns first, rows of one turn by role
and text; ``copies`` (optional) says how many times a row stands there, 0 that only its
conversation is known; a conversation without rows has zeros and an empty audit;
repeated rows are duplicates; an empty table gives an empty result; extra columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, saved

#: Costs of the edits, and of keeping a truncated turn.
DELETE, INSERT, CHANGE, TRUNCATED = 4, 3, 3, 3
#: Last role kept: none yet, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = range(4)
#: After an inserted or changed turn; after a kept turn by its role's initial.
TURNED = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
#: What is inserted behind the last turn.
CLOSING = {NONE: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
#: Faults, the first that holds.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Turns and characters in a segment.
SEGMENT, SEGMENT_CHARS = 2048, 1 << 20
INF = float("inf")

Turn = tuple[str, int]  # initial of the role, fault


def bounds(turns: list[Turn], last: int) -> list[list[float]]:
    """Least cost from each turn and role on, up to ``last`` behind the last turn."""
    after = [0.0 if r == last else INF for r in ROLES]
    table = [after]
    for initial, fault in reversed(turns):
        here = [after[r] + DELETE for r in ROLES]
        if fault in (SOUND, CUT):
            more = TRUNCATED * (fault == CUT)
            kept = KEPT.get(initial, {})
            for r in ROLES:
                here[r] = min(here[r], after[TURNED[r]] + CHANGE + more)
                if r in kept:
                    here[r] = min(here[r], after[kept[r]] + more)
        for _ in ROLES:  # turns inserted before this one
            for r in ROLES:
                here[r] = min(here[r], here[TURNED[r]] + INSERT)
        after = here
        table.append(here)
    table.reverse()
    return table


def search(turns: list[Turn], first: int, last: int) -> tuple[int, str] | None:
    """The cheapest edits from ``first`` to ``last``, of equals the least audit; None: there are none."""
    least = bounds(turns, last)
    if least[0][first] == INF:
        return None
    best: tuple[int, tuple | None] | None = None  # the incumbent: cost and its letters, linked from the last
    reached: list[dict[int, int]] = [{} for _ in range(len(turns) + 1)]  # per node: least cost so far
    stack: list[tuple[int, int, int, tuple | None]] = [(0, first, 0, None)]
    proved = least[0][first]
    while stack:
        i, role, cost, audit = stack.pop()
        if cost + least[i][role] > proved:  # dearer than a repair that is known to exist
            continue
        if reached[i].get(role, INF) <= cost:  # no dearer, and its letters come first
            continue
        reached[i][role] = cost
        if i == len(turns):
            if role == last and (best is None or cost < best[0]):
                best = cost, audit
            continue
        initial, fault = turns[i]
        turned = TURNED[role]
        if fault in (SOUND, CUT):
            more = TRUNCATED * (fault == CUT)
            stack.append((i + 1, turned, cost + CHANGE + more, (audit, "R")))
            kept = KEPT.get(initial, {}).get(role)
            if kept is not None:
                stack.append((i + 1, kept, cost + more, (audit, "K")))
        stack.append((i, turned, cost + INSERT, (audit, "I")))
        stack.append((i + 1, role, cost + DELETE, (audit, "D")))
    letters, link = [], best[1]
    while link is not None:
        link, letter = link
        letters.append(letter)
    return best[0], "".join(reversed(letters))


Table = dict[tuple[int, int], tuple[int, str]]


def joined(a: Table, b: Table) -> Table:
    """Results of two segments in a row."""
    out: Table = {}
    for (first, middle), (cost, audit) in a.items():
        for (start, last), (more, rest) in b.items():
            if start == middle:
                found = cost + more, audit + rest
                if (first, last) not in out or found < out[first, last]:
                    out[first, last] = found
    return out


def chosen(tables: list[Table]) -> tuple[int, str, list[int]]:
    """Cost and audit of a conversation, and the role before each of its segments."""
    level, tree = tables, [tables]
    while len(level) > 1:
        level = [joined(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        tree.append(level)
    cost, audit, last = min((cost + CLOSING[last][0], audit + CLOSING[last][1], last)
                            for (first, last), (cost, audit) in level[0].items() if first == NONE)
    # back down the tree: which role stands between the two halves of each pair
    ends = [(NONE, last)]
    for above, below in zip(reversed(tree[1:]), reversed(tree[:-1]), strict=True):
        parts = []
        for k, (first, last) in enumerate(ends):
            pair = below[2 * k:2 * k + 2]
            if len(pair) == 1:
                parts.append((first, last))
                continue
            want = above[k][first, last]
            middle = next(m for m in ROLES if (first, m) in pair[0] and (m, last) in pair[1] and want == (
                pair[0][first, m][0] + pair[1][m, last][0], pair[0][first, m][1] + pair[1][m, last][1]))
            parts += [(first, middle), (middle, last)]
        ends = parts
    return cost, audit, [first for first, _ in ends]


_WORD = re.compile(r"[^\x20\x09-\x0D]")


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a turn; ``seen``: its role and text stood earlier."""
    if not _WORD.search(text):
        return BLANK
    if seen:
        return DUPLICATE
    return SOUND if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else CUT


def repaired(rows: list[tuple[str, str, int]], first: int, audit: str) -> Iterator[tuple[str, str]]:
    """Role and text of what ``audit`` makes of ``rows`` (role, text, copies) after the role ``first``."""
    role, names = first, {USER: "user", ASSISTANT: "assistant"}
    each = ((r, t) for r, t, n in rows for _ in range(n))
    for letter in audit:
        if letter == "I":
            role = TURNED[role]
            yield names[role], ""
            continue
        name, text = next(each)
        if letter == "K":
            role = KEPT[name[:1]][role]
            yield name, text
        elif letter == "R":
            role = TURNED[role]
            yield names[role], text


SEGMENTS = ("conv_id long, part long, number long, known boolean, blank long, duplicate long, truncated long, illegal long, "
            "turns long, first_turn long, last_turn long, first_initial string, last_initial string, roles array<string>, texts array<string>, "
            "copies array<long>, ends array<struct<first:int,last:int,cost:long,audit:string>>")


def _segment_schema() -> pa.Schema:
    end = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    return arrow_schema(
        conv_id=pa.int64(), part=pa.int64(), number=pa.int64(), known=pa.bool_(), blank=pa.int64(), duplicate=pa.int64(), truncated=pa.int64(),
        illegal=pa.int64(), turns=pa.int64(), first_turn=pa.int64(), last_turn=pa.int64(), first_initial=pa.string(), last_initial=pa.string(),
        roles=pa.list_(pa.string()), texts=pa.list_(pa.string()), copies=pa.list_(pa.int64()), ends=pa.list_(end))


def _segment(conv_id, part: int, number: int, begins: bool, rows: list[tuple]) -> dict:
    """One segment's row; ``rows``: turn, role, text, copies, whether role and text stood earlier."""
    rows = [r for r in rows if r[3]]
    turns: list[Turn] = []
    runs: list[int] = []  # turns that only can be deleted stand for all copies behind a turn
    counts, illegal, before = [0] * 4, 0, None
    for _, role, text, n, earlier in rows:
        initial, fault = role[:1], fault_of(text, earlier)
        counts[fault] += 1
        counts[BLANK if fault == BLANK else DUPLICATE] += n - 1
        illegal += (before is not None and before + initial not in LEGAL) + (n - 1) * (initial + initial not in LEGAL)
        before = initial
        turns.append((initial, fault))
        runs.append(n - 1)
    known = sorted({r[0] for r in rows if r[0] is not None})
    ends = []
    for first in (NONE,) if begins else ROLES:
        for last in ROLES:
            found = search(turns, first, last)
            if found is not None:
                ends.append({"first": first, "last": last, "cost": found[0] + DELETE * sum(runs), "audit": _spread(found[1], runs)})
    return {"conv_id": conv_id, "part": part, "number": number, "known": bool(rows), "blank": counts[BLANK], "duplicate": counts[DUPLICATE],
            "truncated": counts[CUT], "illegal": illegal, "turns": len(known), "first_turn": known[0] if known else None,
            "last_turn": known[-1] if known else None, "first_initial": rows[0][1][:1] if rows else None, "last_initial": before,
            "roles": [r[1] for r in rows], "texts": [r[2] for r in rows], "copies": [r[3] for r in rows], "ends": ends}


def _spread(audit: str, runs: list[int]) -> str:
    """The audit with a deletion for each further copy of a turn, right behind it."""
    if not any(runs):
        return audit
    left = iter(runs)
    return "".join(letter if letter == "I" else letter + "D" * next(left) for letter in audit)


def _segments(batches, most: int):
    from pyspark import TaskContext

    part, number, schema = TaskContext.get().partitionId(), 0, _segment_schema()
    held, rows, chars, conv, begins = [], [], 0, None, False
    opened = False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "earlier")), strict=True):
            if opened and (row[0] != conv or len(rows) >= most or chars >= SEGMENT_CHARS):
                held.append(_segment(conv, part, number, begins, rows))
                number, begins, rows, chars = number + 1, row[0] != conv, [], 0
                if len(held) >= 256 or sum(len(h["roles"]) for h in held) >= SEGMENT:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            conv, opened = row[0], True
            rows.append(row[1:])
            chars += len(row[3])
    if opened:
        held.append(_segment(conv, part, number, begins, rows))
        yield pa.RecordBatch.from_pylist(held, schema)


def segments(conversations: DataFrame, most: int = SEGMENT) -> DataFrame:
    """The searched segments, of ``most`` turns, of all conversations, in the order of ``part`` and ``number``."""
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(copies, F.lit(1)).alias("copies"))
    # equal rows are one row with a number of copies, before anything is shuffled
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")) \
        .withColumn("same", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    rows = saved(rows, "conversation-rows")
    when = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    first = rows.where("copies > 0").groupBy(F.col("conv_id").alias("conv"), F.col("same").alias("as")).agg(F.min(when).alias("first"))
    known = rows.join(first, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("same") == F.col("as")), "left") \
        .select("conv_id", "turn", "role", "text", "copies", F.coalesce(when > F.col("first"), F.lit(False)).alias("earlier"))
    known = saved(known, "conversation-known")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    ordered = known.repartitionByRange(*order, F.substring("text", 1, 256).asc()).sortWithinPartitions(*order, F.col("text").asc())
    return saved(ordered.mapInArrow(lambda batches: _segments(batches, most), SEGMENTS), "conversation-segments")


def _choices(table: pa.Table) -> pa.Table:
    """Of one conversation's narrow segment rows: where each segment begins and what it does."""
    order = table.sort_by([("part", "ascending"), ("number", "ascending")]).to_pylist()
    tables = [{(e["first"], e["last"]): (e["cost"], e["audit"]) for e in row["ends"]} for row in order]
    cost, audit, firsts = chosen(tables)
    lasts = [*firsts[1:], None]
    rows = []
    for row, ends, first, last in zip(order, tables, firsts, lasts, strict=True):
        if last is None:  # the last segment also closes the conversation
            done = min((c + CLOSING[t][0], a + CLOSING[t][1]) for (f, t), (c, a) in ends.items() if f == first)
        else:
            done = ends[first, last]
        rows.append({"conv_id": row["conv_id"], "part": row["part"], "number": row["number"], "first": first, "cost": done[0], "audit": done[1]})
    return pa.Table.from_pylist(rows, schema=_CHOICE)


_CHOICE = arrow_schema(conv_id=pa.int64(), part=pa.int64(), number=pa.int64(), first=pa.int64(), cost=pa.int64(), audit=pa.string())
CHOICES = "conv_id long, part long, number long, first long, cost long, audit string"
_SUMMARY = arrow_schema(conv_id=pa.int64(), gaps=pa.int64(), blank=pa.int64(), duplicate=pa.int64(), truncated=pa.int64(), illegal=pa.int64(),
                        cost=pa.int64(), audit=pa.string(), repaired_sha256=pa.string())


class _Account:
    """Running sums of one conversation whose segments come in order."""

    def __init__(self, conv_id):
        self.conv_id, self.sums, self.cost, self.audit = conv_id, [0] * 4, 0, []
        self.turns, self.low, self.high, self.initial = 0, None, None, None
        self.hash, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> list[tuple[str, str]]:
        for k, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.sums[k] += row[name]
        if row["known"]:
            if self.initial is not None and self.initial + row["first_initial"] not in LEGAL:
                self.sums[3] += 1
            self.initial = row["last_initial"]
        if row["first_turn"] is not None:
            self.turns += row["turns"] - (row["first_turn"] == self.high)
            self.low, self.high = row["first_turn"] if self.low is None else self.low, row["last_turn"]
        self.cost += row["cost"]
        self.audit.append(row["audit"])
        out = list(repaired(list(zip(row["roles"], row["texts"], row["copies"], strict=True)), row["first"], row["audit"]))
        for role, text in out:
            self.hash.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode())
            self.any = True
        return out

    def row(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(zip(_SUMMARY.names, (self.conv_id, gaps, *self.sums, self.cost, "".join(self.audit), self.hash.hexdigest()), strict=True))


def _in_order(segs: DataFrame) -> DataFrame:
    """Segments with their choices, each conversation's in order and in one partition."""
    choice = segs.select("conv_id", "part", "number", "ends").groupBy("conv_id").applyInArrow(_choices, CHOICES)
    key = ["part", "number"]
    rows = segs.drop("ends").join(choice.drop("conv_id"), key)
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *key)


def _accounts(batches):
    account, done = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if account is None or account.conv_id != row["conv_id"]:
                if account is not None:
                    done.append(account.row())
                account = _Account(row["conv_id"])
            account.add(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, _SUMMARY)
            done = []
    if account is not None:
        yield pa.RecordBatch.from_pylist([account.row()], _SUMMARY)


def repair(conversations: DataFrame, most: int = SEGMENT) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation."""
    return _in_order(segments(conversations, most)).mapInArrow(
        _accounts, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _turns(batches):
    schema = arrow_schema(conv_id=pa.int64(), place=pa.int64(), role=pa.string(), text=pa.string())
    conv, place, opened = None, 0, False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if not opened or conv != row["conv_id"]:
                conv, place, opened = row["conv_id"], 0, True
            for role, text in repaired(list(zip(row["roles"], row["texts"], row["copies"], strict=True)), row["first"], row["audit"]):
                out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                place += 1
        yield pa.RecordBatch.from_pylist(out, schema)


def repaired_turns(conversations: DataFrame, most: int = SEGMENT) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations, turn by turn."""
    return _in_order(segments(conversations, most)).mapInArrow(_turns, "conv_id long, place long, role string, text string")


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of conversation and turn; dropped rows have no copies."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    dropped = kind == 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(~dropped, F.col("turn").cast("long")).alias("turn"),
        F.when(dropped, space).when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(dropped | (kind == 1), F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(dropped, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))
