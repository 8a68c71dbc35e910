import hashlib

import numpy as np

from llm_data import documents, frame
from shoal.llm.fingerprints import K, S, anchors, edited, fingerprints, likeness, read, written
from shoal.llm.hashing import Ranges


def plain_anchors(raw: bytes):
    r = Ranges(np.frombuffer(raw, np.uint8))

    def h(a, b):
        return int(r.hash(np.array([a]), np.array([b]))[0])

    small = [h(i, i + S) >> 32 for i in range(max(len(raw) - S + 1, 0))]
    out = []
    for i in range(len(raw) - K + 1):
        window = small[i:i + K - S + 1]
        if min(window) in (window[0], window[-1]):
            out.append(h(i, i + K) >> 48)
    return out or [h(0, len(raw)) >> 16 * i & 0xFFFF for i in range(4)]


def test_anchors_are_the_closed_syncmers():
    texts = [(r[1] or "").encode()[:700] for r in documents()[:60]]
    assert [a.tolist() for a in anchors(texts)] == [plain_anchors(t) for t in texts]


def test_anchors_stay_with_a_passage_wherever_it_stands():
    rng = np.random.default_rng(1)
    passage = bytes(rng.integers(97, 123, 2000).astype(np.uint8))
    own = set(anchors([passage])[0].tolist())
    moved = set(anchors([b"zz" + bytes(rng.integers(97, 123, 333).astype(np.uint8)) + passage])[0].tolist())
    assert len(own) > 20 and own <= moved


def test_likeness_needs_the_same_order():
    a = np.arange(10, dtype="<u2")
    assert likeness(a, a) == 1 and likeness(a, a + 100) == 0
    assert likeness(a, a[:5]) == 10 / 15
    assert likeness(a, a[::-1]) == 0.1
    assert (read(written(a)) == a).all()


def test_short_texts_keep_likeness_when_half_is_edited():
    rng = np.random.default_rng(2)
    for n in range(80, 200, 5):
        a, b = (bytes(rng.integers(97, 123, n).astype(np.uint8)).decode() for _ in range(2))
        own, edit = anchors([a.encode(), edited(a, b).encode()])
        assert 0 < likeness(own, edit) < 1


def check(spark, rows, partitions):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for i, r in enumerate(order):
        text, following = r[1] or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 2
        edit = text[:len(text) - m] + following[:m]
        a, e, n = (anchors([x.encode()])[0] for x in (text, edit, following))
        want.append((r[0], len(text), hashlib.sha256(edit.encode()).hexdigest(), written(a), written(e), likeness(a, e), likeness(a, n)))
    got = fingerprints(frame(spark, rows), partitions)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_neighbours_within_and_across_partitions(spark):
    check(spark, documents(), 5)
    check(spark, documents()[:1], 3)
    check(spark, documents(n=12), 40)
    assert fingerprints(frame(spark, [])).count() == 0


def test_unlike_texts_stay_unlike_and_edited_halves_alike(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    long = [r for r in got if r.n_chars >= 600]
    assert min(r.near_edited for r in long) > 0.2
    assert sum(r.near_next < 0.1 for r in long) > 0.9 * len(long)
    assert sum(len(r.fingerprint) for r in got) < 0.45 * sum(r.n_chars for r in got)
