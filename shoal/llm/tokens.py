"""Fast exact encoding of many texts with a byte-level BPE file.

The tokenizer splits a text into pre-tokens and encodes each on its own, so equal
pre-tokens have equal ids. The split is done here for a whole buffer of code points
at once; each distinct pre-token is then encoded by the ``tokenizers`` library, once
in a worker as long as it stays in that worker's store, and the ids are laid out by
gathering. Texts with code points whose class could depend on the Unicode version
(unassigned ones and rare control characters) go to the library whole.

By default ids are those the library gives: an added token's string inside a text is
that token (such texts go to the library whole). ``specials=False`` takes it as
ordinary text.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from shoal.llm.hashing import BASE, INVERSE, U, mix, powers

#: Classes of code points in the split pattern of byte-level BPE files,
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
OTHER, LETTER, NUMBER, BLANK, UNSURE = range(5)
BLANKS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: A store of distinct pre-tokens is emptied beyond this many.
MOST_KNOWN = 1_500_000
MOST_SHORT = 200_000
#: So many pre-tokens that are new go to the library in one text, a newline after each.
SIDE_BY_SIDE = 64

_CLASS: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASS:
        kind = {"L": LETTER, "N": NUMBER}
        names = [unicodedata.category(chr(c)) for c in range(0x110000)]
        table = np.array([UNSURE if x in ("Cn", "Cs") else kind.get(x[0], OTHER) for x in names], np.uint8)
        table[0x1C:0x20] = UNSURE
        table[[0x180E, 0x200B, 0xFEFF]] = UNSURE
        table[BLANKS] = BLANK
        _CLASS.append(table)
    return _CLASS[0]


def split(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens start, given code points and each text's start (and the end)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    text_start = np.zeros(n + 1, bool)
    text_start[first] = True
    change = text_start[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    space = points == 0x20
    run_end = np.concatenate((change[1:], [True]))
    # the last blank before a word belongs to it if it is a space, else it stands alone
    last_blank = blank & run_end & ~text_start[1:]
    before = np.zeros(n, bool)
    before[1:] = space[:-1] & ~text_start[1:n]
    start = (change & (blank | ~before)) | last_blank
    # contractions: a lone ' right after a word and followed by s, t, m, d, re, ve or ll
    mark = np.flatnonzero((points == 0x27) & change & run_end & ~before)
    mark = mark[mark + 1 < n]
    mark = mark[~text_start[mark + 1] & (kind[mark + 1] == LETTER)]
    if len(mark):
        a = points[mark + 1]
        two = np.minimum(mark + 2, n - 1)
        b = np.where((mark + 2 < n) & ~text_start[two], points[two], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        pair = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        size = np.where(one, 1, np.where(pair, 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + 1 + size
        inside = rest < n
        rest = rest[inside]
        start[rest[~text_start[rest] & (kind[rest] == LETTER)]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts; keeps the ids of distinct pre-tokens between calls."""

    def __init__(self, path: str, specials: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = not specials
        # a pre-token comes to the library once: what it remembers is not asked for again
        self.lib.model._resize_cache(0)
        #: Strings that the library cuts out of a text before it splits the rest.
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values() if specials or not t.special]
        self.reach = max(map(len, self.added), default=1) - 1
        self.kind = np.uint16 if self.lib.get_vocab_size() <= 1 << 16 else np.uint32
        rng = np.random.Generator(np.random.PCG64(99))
        self.coeff = rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
        self.short: dict[str, int] = {}
        mark = self.lib.encode("\n", add_special_tokens=False).ids
        #: The id of a newline, where it is one id and no part of an added token.
        self.newline = mark[0] if len(mark) == 1 and not any("\n" in t for t in self.added) else None
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)      # hashes of known pre-tokens, as they came
        self.at = np.zeros(0, np.int64)         # where their ids start in ``pool``
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)
        self.slots = np.full(1 << 16, -1, np.int32)  # hash -> place in ``keys``, or the next free slot

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the library alone."""
        return [np.array(e.ids, self.kind) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens in a row and the number of each one's.

        Those that are not blank hold no newline, and a newline between two of them is a
        pre-token and an id of its own: many go to the library as one text.
        """
        if self.newline is not None and not any(t.isspace() for t in tokens):
            parts = ["\n".join(tokens[i:i + SIDE_BY_SIDE]) + "\n" for i in range(0, len(tokens), SIDE_BY_SIDE)]
            ids = np.concatenate([np.zeros(0, self.kind), *self.whole(parts)])
            mark = ids == self.newline
            end = np.flatnonzero(mark)
            if len(end) == len(tokens):
                return ids[~mark], np.diff(end, prepend=-1) - 1
        found = [np.zeros(0, self.kind), *self.whole(tokens)]
        return np.concatenate(found), np.array([len(i) for i in found[1:]], np.int64)

    def _learn(self, keys: np.ndarray, tokens: list[str]) -> None:
        blank = np.array([t.isspace() for t in tokens])
        for some in (~blank, blank):
            if some.any():
                ids, size = self._ids([tokens[i] for i in np.flatnonzero(some).tolist()])
                self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
                self.size = np.concatenate([self.size, size])
                self.pool = np.concatenate([self.pool, ids])
                self.keys = np.concatenate([self.keys, keys[some]])
        first = len(self.keys) - len(keys)
        if 2 * len(self.keys) > len(self.slots):
            self.slots = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32)
            first = 0
        self._enter(first)

    def _enter(self, first: int) -> None:
        """Give the known keys from ``first`` on a slot each: the first free one from their hash on."""
        slot = self._slot(self.keys[first:])
        left = np.arange(len(slot))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = first + free  # of several keys one stays
            left = left[self.slots[slot[left]] != first + left]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key & U(len(self.slots) - 1)).astype(np.int64)

    def _place(self, key: np.ndarray) -> np.ndarray:
        """The place of each key in the store, -1 where it is not known."""
        if not len(self.keys):
            return np.full(len(key), -1, np.int32)
        slot = self._slot(key)
        place = self.slots[slot]
        left = np.flatnonzero((place >= 0) & (self.keys[place] != key))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
            place[left] = self.slots[slot[left]]
            left = left[(place[left] >= 0) & (self.keys[place[left]] != key[left])]
        return place

    def pretokens(self, texts: list[str]):
        """Joined text, text starts, pre-token starts and ends in code points, and their hashes."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=first[1:])
        start = split(points, first)
        end = np.concatenate((start[1:], [len(points)])) if len(start) else start
        value = self.coeff[points & np.uint32(255)] + points.astype(np.uint64) * U(0xC2B2AE3D27D4EB4F)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(value * powers(BASE, len(points)) if len(points) else value, out=sums[1:])
        key = mix((sums[end] - sums[start]) * powers(INVERSE, len(points) + 1)[start]
                  + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))
        return joined, first, start, end, key

    def _known(self, joined: str, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The place in the store of each pre-token; learns those not known."""
        place = self._place(key)
        new = np.flatnonzero(place < 0)
        if len(new):
            names, one = np.unique(key[new], return_index=True)
            if len(self.keys) + len(names) > MOST_KNOWN:
                self._empty()
                new = np.arange(len(key))
                names, one = np.unique(key, return_index=True)
            a, b = start[new[one]].tolist(), end[new[one]].tolist()
            self._learn(names, [joined[x:y] for x, y in zip(a, b, strict=True)])
            place[new] = self._place(key[new])
        return place

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start (and the end)."""
        odd = self.odd(texts)
        plain = [t for t, o in zip(texts, odd, strict=True) if not o] if odd.any() else texts
        joined, first, start, end, key = self.pretokens(plain)
        place = self._known(joined, start, end, key)
        size = self.size[place]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(self.at[place] - total[:-1], size) + np.arange(total[-1])]
        off = total[np.searchsorted(start, first)]
        if not odd.any():
            return ids, off
        other = iter(self.whole([t for t, o in zip(texts, odd, strict=True) if o]))
        mine = iter(zip(off[:-1], off[1:], strict=True))
        parts = [next(other) if o else ids[slice(*next(mine))] for o in odd]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def counts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its pre-tokens' code points and ids, as two arrays of counts.

        A text that goes to the library whole is one pre-token here.
        """
        odd = self.odd(texts)
        shown = ["" if o else t for t, o in zip(texts, odd, strict=True)] if odd.any() else texts
        joined, first, start, end, key = self.pretokens(shown)
        place = self._known(joined, start, end, key)
        size = self.size[place]
        out = []
        cut = np.searchsorted(start, first)
        whole = iter(self.whole([t for t, o in zip(texts, odd, strict=True) if o]) if odd.any() else ())
        for i, o in enumerate(odd):
            if o:
                out.append((np.array([len(texts[i])]), np.array([len(next(whole))])))
            else:
                a, b = cut[i], cut[i + 1]
                out.append((end[a:b] - start[a:b], size[a:b]))
        return out

    def short_counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """As ``counts`` of one short text that is not odd, by a store of its own."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        cut = [*split(points, np.array([0, len(points)])).tolist(), len(points)]
        tokens = [text[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        if len(self.short) > MOST_SHORT:
            self.short.clear()
        for t in tokens:
            if t not in self.short:
                self.short[t] = len(self.lib.encode(t, add_special_tokens=False).ids)
        return np.diff(cut), np.array([self.short[t] for t in tokens], np.int64)

    def odd(self, texts: list[str]) -> np.ndarray:
        """Which texts go to the library whole."""
        joined = "".join(texts)
        out = np.zeros(len(texts), bool)
        for name in self.added:
            if name in joined:
                out |= [name in t for t in texts]
        if joined.isascii() and not any(c in joined for c in "\x1c\x1d\x1e\x1f"):
            return out
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        bad = np.flatnonzero(classes()[points] == UNSURE)
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        out[np.searchsorted(first, bad, side="right") - 1] = True
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """The worker's own encoder for a tokenizer file."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = Encoder(path, specials)
    return _ENCODERS[path, specials]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The id that ends a document.
END = 0


def encode_documents(texts: list[str], path: str, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text followed by the end id, in a row, and where each document starts."""
    ids, off = encoder(path).encode(texts)
    n = np.diff(off)
    start = np.concatenate(([0], np.cumsum(n + 1)))
    out = np.full(start[-1], end, ids.dtype)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
    return out, start
