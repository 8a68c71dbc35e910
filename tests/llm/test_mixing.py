import random
from collections import Counter, defaultdict

from llm_data import documents, frame
from shoal.llm.mixing import OTHER, mix, mixed, period, schedule


def expand(rows):
    slots = {}
    for s, first, n, weight, total, start, places in rows:
        for i in range(n):
            t = start + i // weight * total + places[i % weight]
            assert t not in slots
            assert start + i * total // weight <= t < start + -(-(i + 1) * total // weight)
            slots[t] = s, first + i
    return slots


def test_every_block_in_its_window_and_less_than_one_block_off():
    rng = random.Random(5)
    for _ in range(40):
        weights = {f"s{i}": rng.randint(1, 9) for i in range(rng.randint(1, 7))}
        total = sum(weights.values())
        got = Counter()
        slot = {t: s for s, ts in period(weights).items() for t in ts}
        assert sorted(slot) == list(range(total))
        for t in range(total):
            got[slot[t]] += 1
            assert all(abs(got[s] - w * (t + 1) / total) < 1 for s, w in weights.items())
        blocks = {s: rng.randint(0, 60) for s in weights}
        slots = expand(schedule(blocks, weights))
        assert sorted(slots) == list(range(sum(blocks.values())))
        for s, n in blocks.items():
            assert [slots[t][1] for t in sorted(slots) if slots[t][0] == s] == list(range(n))
    assert schedule({}, {}) == []


def test_documents_follow_the_schedule(spark):
    rows = documents()
    weights = {"src0": 2, "src1": 1}
    got = mix(frame(spark), weights, block=500).collect()
    assert sum(r.copies for r in got) == len(rows)
    assert Counter((r.doc_id, r.source) for r in got) == Counter({(r[0], r[3]) for r in rows})
    sums = defaultdict(int)
    last = {}
    for r in sorted(got, key=lambda r: (r.slot, r.place)):
        stream = r.source if r.source in weights else OTHER
        assert r.stream == stream
        assert r.release <= r.slot < r.deadline
        assert sums[stream] // 500 == r.block
        assert last.get(stream, -1) <= r.slot
        sums[stream] += r.n_chars
        last[stream] = r.slot
    assert mix(frame(spark, []), weights).count() == 0


def test_mixed_keeps_rows_and_puts_them_in_order(spark):
    rows = documents()
    weights = {"src0": 2, "src1": 1}
    got = mixed(frame(spark), weights, block=500)
    assert got.columns == frame(spark).columns
    out = [tuple(r) for r in got.collect()]
    assert sorted(out, key=str) == sorted(rows, key=str)
    place = {(r.doc_id, r.source): (r.slot, r.place) for r in mix(frame(spark), weights, block=500).collect()}
    order = [place[r[0], r[3]] for r in out]
    assert order == sorted(order)
    assert mixed(frame(spark, []), weights).count() == 0
