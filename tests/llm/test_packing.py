import itertools
import random
import zlib
from collections import defaultdict

import numpy as np

from llm_data import documents, frame
from shoal.llm.mixing import mixed, scheduled
from shoal.llm.packing import fill, pack, plan, sequences, slack
from shoal.llm.tokens import default_tokenizer, encoder


def test_a_window_has_least_slack():
    rng = random.Random(3)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        counts = {x: lengths.count(x) for x in lengths}
        longest = max(counts)
        rest = list(lengths)
        rest.remove(longest)
        sums = {longest + sum(c) for n in range(len(rest) + 1) for c in itertools.combinations(rest, n)}
        best = min(slack(s, 64) for s in sums if s <= 64)
        got = fill(counts, longest, 64)
        total = sum(k * n for k, n in got.items())
        assert all(n <= counts[k] for k, n in got.items()) and got[longest] >= 1
        assert total <= 64 and (slack(total, 64) == best or total == 64)


def test_the_plan_places_each_piece_once():
    rng = random.Random(4)
    histogram = {x: rng.randint(0, 50) + 900 * (x < 8) for x in range(1, 129)}
    seen, windows = defaultdict(list), defaultdict(list)
    for length, first, per, times, window, offset in plan(histogram, 128):
        for k in range(per * times):
            seen[length].append(first + k)
            windows[window + k // per].append((offset + k % per * length, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in histogram.items() if n}
    total = pad = 0
    for v in windows.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 128
        total, pad = total + at, pad + slack(at, 128)
    assert pad < 0.01 * total
    assert plan({}) == []


def test_pieces_make_up_every_document(spark):
    rows = documents()
    got = pack(frame(spark), window=64).collect()
    enc = encoder(default_tokenizer())
    want = sorted(((str(r[0]), np.append(enc.whole([r[1] or ""])[0], 0).astype("<u4").tobytes()) for r in rows))
    by, windows = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 64
        by[str(r.doc_id), r.doc_tokens].append((r.start, bytes(r.ids)))
        windows[r.sequence_id].append((r.offset, r.length))
    # rows of one doc_id have equal texts here: their pieces come in as many copies
    whole = []
    for (doc, n), pieces in by.items():
        copies = sum(s == 0 for s, _ in pieces)
        kept = sorted(set(pieces))
        assert len(pieces) == copies * len(kept) and sum(len(p) for _, p in kept) == 4 * n
        whole += [(doc, b"".join(p for _, p in kept))] * copies
    assert sorted(whole) == want
    for v in windows.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 64
    joined = {r.sequence_id: r for r in sequences(pack(frame(spark), window=64)).collect()}
    assert {k: r.n_tokens for k, r in joined.items()} == {k: sum(n for _, n in v) for k, v in windows.items()}
    assert sum(zlib.crc32(np.array(r.ids).tobytes()) > 0 for r in joined.values()) > 0
    assert pack(frame(spark, [])).count() == 0


def test_sequences_follow_the_schedule(spark):
    weights = {"src0": 2, "src1": 1}
    docs = mixed(frame(spark), weights, block=500)
    assert scheduled(frame(spark)) is None
    places = {(r.doc_id, r.source): r for r in scheduled(docs, periods=2).collect()}
    assert {r.range for r in places.values()} >= {0, 1, 2} and all(r.range == r.slot // 8 for r in places.values())
    source = {r[0]: r[3] for r in documents()}
    got = pack(docs, window=64, places=scheduled(docs, periods=2)).collect()
    plain = pack(frame(spark), window=64).collect()
    assert sorted((str(r.doc_id), r.start, r.length, bytes(r.ids)) for r in got) == \
        sorted((str(r.doc_id), r.start, r.length, bytes(r.ids)) for r in plain)
    windows = defaultdict(list)
    for r in got:
        at = places[r.doc_id, source[r.doc_id]]
        windows[r.sequence_id].append((at.range, (at.slot, at.place, r.start), r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    last = (-1,)
    for k in sorted(windows):
        assert len({x[0] for x in windows[k]}) == 1
        first = windows[k][0][0], min(x[1] for x in windows[k])
        assert first >= last
        last = first
        at = 0
        for *_, offset, length in sorted(windows[k], key=lambda x: x[2]):
            assert offset == at
            at += length
        assert at <= 64
    empty = mixed(frame(spark, []), weights)
    assert pack(empty, places=scheduled(empty)).count() == 0
