"""Joins of two streams that take results back (``transformWithState``).

Both sides are one stream, tagged with the side and grouped by the join key. Each key
keeps its rows of both sides as maps from the row's text to its number of copies; of a
row of an outer side also how many copies are out with NULLs on the other side. A
micro-batch's rows of a key are summed up first; then the results that no longer hold
are emitted as ``-D``, and after them the new ones as ``+I``: so within a key the last change
of an upsert key is the right one, and nothing is emitted that the same batch takes back.

A side may itself be a change stream (a column ``op``), so joins can be chained.

``idle_ms`` drops a row's state when it was neither written nor met by the other side for
that long in processing time (both sides; a meeting renews both rows). A dropped row meets
nothing any more; what was emitted with it stays. Without ``idle_ms`` state is kept for ever.

``change`` orders the changes of a join key: a running number, or with ``idle_ms`` the time
of the micro-batch and the number in it.

While a key's changes are made, the rows of the side that is met are held in memory. A hot
key: with ``salts`` the left rows of a key are dealt over that many groups, by the column
``salt_by`` or their text, and the right rows copied to each (``inner`` and ``left``: a left row
needs all right rows, but no other left row). Where left rows change, deal them by what
identifies them, so that a row's changes stay in order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shoal.operators.changes import CHANGE, DELETE, HOW, INSERT, OP

OUT = f"{CHANGE} long, {OP} string, l string, r string"
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Changes of a key in one micro-batch that ``change`` has room for, in bits.
NTH_BITS = 22
#: Groups over which rows without a key are dealt.
ALONE = 1 << 16


class _Side:
    """One side's rows of a key: text -> copies, and copies that are out padded with NULLs."""

    def __init__(self, state, outer: bool):
        self.state, self.outer = state, outer

    def rows(self) -> Iterator[tuple[str, int, int]]:
        for key, value in self.state.iterator():
            yield key[0], value[0], value[1]

    def get(self, text: str) -> tuple[int, int]:
        found = self.state.getValue((text,)) if self.state.containsKey((text,)) else None
        return (found[0], found[1]) if found else (0, 0)

    def put(self, text: str, n: int, padded: int) -> None:
        if n > 0:
            self.state.updateValue((text,), (n, padded))
        elif self.state.containsKey((text,)):
            self.state.removeKey((text,))

    def other_than(self, texts) -> bool:
        """Whether a row stands here besides ``texts``."""
        return any(text not in texts for text, _, _ in self.rows())


class JoinProcessor(StatefulProcessor):
    """State: the rows of both sides of a key. Input rows: ``side`` (l or r), ``text``, ``sign``."""

    def __init__(self, how: str, idle_ms: int | None = None):
        self.how, self.idle_ms = how, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        def side(name: str, outer: bool) -> _Side:
            return _Side(handle.getMapState(name, "text string", "n long, padded long", ttlDurationMs=self.idle_ms), outer)

        self.left = side("left", self.how in ("left", "full"))
        self.right = side("right", self.how in ("right", "full"))
        self.number = None if self.idle_ms else handle.getValueState("number", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        change = {"l": Counter(), "r": Counter()}
        for r in rows:
            change[r.side][r.text] += r.sign
        dl, dr = ({t: n for t, n in change[s].items() if n} for s in "lr")
        if not dl and not dr:
            return
        if self.idle_ms:
            number = timerValues.getCurrentProcessingTimeInMs() << NTH_BITS
        else:
            number = self.number.get()[0] if self.number.exists() else 0
        if key[0] is None:  # NULL keys meet no row
            emitted = self._alone(self.left, dl, "l"), self._alone(self.right, dr, "r")
            found = [x for side in emitted for x in side]
        else:
            found = self._changes(dl, dr)
        # what is taken back first
        for sign, op in ((-1, DELETE), (1, INSERT)):
            for n, l, r in found:
                for _ in range(max(n * sign, 0)):
                    number += 1
                    yield Row(**{CHANGE: number, OP: op, "l": l, "r": r})
        if self.number is not None:
            self.number.update((number,))

    def _alone(self, side: _Side, delta: dict, name: str):
        for text, n in delta.items():
            if side.outer:
                yield (n, text, None) if name == "l" else (n, None, text)

    def _changes(self, dl: dict, dr: dict) -> list[tuple[int, str | None, str | None]]:
        """``(copies more or less, left, right)`` of the results that change; the state is brought up to date."""
        out: list[tuple[int, str | None, str | None]] = []
        left, right = self._read(self.left, dl, bool(dr)), self._read(self.right, dr, bool(dl))
        now_left, now_right = ({t: max(n + d.get(t, 0), 0) for t, (n, _) in was.items()} for was, d in ((left, dl), (right, dr)))
        for lt in dl:
            for rt in right:
                n = now_left[lt] * now_right[rt] - left[lt][0] * right[rt][0]
                if n:
                    out.append((n, lt, rt))
        for rt in dr:
            for lt in left.keys() - dl.keys():
                n = left[lt][0] * (now_right[rt] - right[rt][0])
                if n:
                    out.append((n, lt, rt))
        # rows that were not read are the same before and after
        more_left = not dr and self.right.outer and self.left.other_than(dl)
        more_right = not dl and self.left.outer and self.right.other_than(dr)
        had = [more or any(n for n, _ in was.values()) for was, more in ((left, more_left), (right, more_right))]
        has = [more or any(now.values()) for now, more in ((now_left, more_left), (now_right, more_right))]
        self._bring(self.left, left, now_left, bool(dr), had[1], has[1], out, "l")
        self._bring(self.right, right, now_right, bool(dl), had[0], has[0], out, "r")
        return out

    @staticmethod
    def _read(side: _Side, delta: dict, whole: bool) -> dict[str, tuple[int, int]]:
        """Copies and padded copies of a side's rows: those that change, and all if the other side changes."""
        out = {t: (n, p) for t, n, p in side.rows()} if whole else {}
        return out | {t: side.get(t) for t in delta if t not in out}

    def _bring(self, side: _Side, was: dict, now: dict, met: bool, had: bool, has: bool, out: list, name: str) -> None:
        """Write the rows that change or, with ``idle_ms``, meet the other side; padded rows come and go.

        ``had``, ``has``: the other side had and has rows."""
        for text, (before, padded) in was.items():
            n = now[text]
            if not side.outer or has:
                then = 0
            elif had:
                then = n
            else:  # copies that were joined with rows dropped since stay as they were emitted
                then = max(min(padded + n - before, n), 0)
            if then != padded:
                out.append((then - padded, text, None) if name == "l" else (then - padded, None, text))
            if (n, then) != (before, padded) or (self.idle_ms and met and n):
                side.put(text, n, then)

    def close(self) -> None:
        pass


def _tagged(df: DataFrame, key: str, side: str, salts: int, salt_by: str | None = None) -> DataFrame:
    payload = [c for c in df.columns if c not in (OP, CHANGE)]
    sign = F.when(F.col(OP) == DELETE, -1).otherwise(1) if OP in df.columns else F.lit(1)
    deal = F.col(salt_by) if salt_by else F.lit(None)
    out = df.select(F.col(key).cast("string").alias("key"), F.lit(side).alias("side"), deal.cast("string").alias("deal"),
                    F.to_json(F.struct(*payload), _JSON).alias("text"), sign.cast("int").alias("sign"))
    # rows without a key meet none: each stands for itself, wherever it is
    alone = F.pmod(F.xxhash64("text"), F.lit(ALONE)).cast("int")
    if side == "l" or salts == 1:
        of = F.pmod(F.xxhash64("deal" if salt_by else "text"), F.lit(salts)).cast("int")
        return out.withColumn("salt", F.when(F.col("key").isNull(), alone).otherwise(of))
    copies = F.array(*[F.lit(i) for i in range(salts)])
    return out.withColumn("salt", F.explode(F.when(F.col("key").isNull(), F.array(alone)).otherwise(copies)))


def _side_columns(df: DataFrame, name: str) -> list[Column]:
    fields = [f for f in df.schema.fields if f.name not in (OP, CHANGE)]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return [F.from_json(F.col(name), schema, _JSON).alias(f"__{name}")]


def retracting_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left",
                    idle_ms: int | None = None, salts: int = 1, salt_by: str | None = None) -> DataFrame:
    """Changes ``change, op`` and both sides' columns of an equi-join of two streams.

    Output mode append: the changes are appended; folded they are the batch join of the
    rows so far. Columns of the two sides must have different names. Keys are compared
    as text.
    """
    if how not in HOW:
        raise ValueError(f"unsupported join type {how!r}")
    if salts > 1 and how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be salted")
    rows = _tagged(left, left_key, "l", salts, salt_by).unionByName(_tagged(right, right_key, "r", salts))
    out = rows.groupBy("key", "salt").transformWithState(
        JoinProcessor(how, idle_ms), OUT, "Append", "ProcessingTime" if idle_ms else "None")
    parsed = out.select(CHANGE, OP, *_side_columns(left, "l"), *_side_columns(right, "r"))
    names = [[c for c in df.columns if c not in (OP, CHANGE)] for df in (left, right)]
    return parsed.select(CHANGE, OP, *[F.col(f"__{s}")[c].alias(c) for s, own in zip("lr", names, strict=True) for c in own])
