import numpy as np

from llm_data import documents, frame
from shoal.llm.grammar_files import Shard, compress, crc32, pack_shard, packed, read_ids, read_shards, unpacked, write_ids
from shoal.llm.tokens import default_tokenizer, encoder


def docs_of(seed, n=30):
    rng = np.random.default_rng(seed)
    phrases = [rng.integers(0, 500, 5) for _ in range(6)]
    return [np.append(np.concatenate([phrases[i] for i in rng.integers(0, 6, rng.integers(1, 60))]), 0) for _ in range(n)]


def test_round_trip_and_random_access():
    docs = docs_of(1) + [np.array([0]), np.zeros(50, int), np.full(300, 7)]
    start = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    ids = np.concatenate(docs).astype(np.uint16)
    names = [None, *range(1, len(docs))]
    raw = pack_shard(names, ids, start)
    shard = Shard(raw)
    assert len(shard.rules) > 5 and len(shard.symbols) < len(ids) / 2
    for i, (name, got) in enumerate(shard.documents()):
        assert name == names[i] and got.tolist() == docs[i].tolist() == shard.ids(i).tolist()
        for lo, hi in ((0, 1), (3, 9), (len(got) - 2, len(got)), (5, 5), (0, 10 ** 6), (10 ** 6, 10 ** 7)):
            assert shard.ids(i, lo, hi).tolist() == docs[i][lo:hi].tolist()
    for (a, b), n in zip(shard.rules, shard.size, strict=True):
        assert n == len(shard.expand(np.array([a, b], np.uint32)))


def test_no_rule_crosses_a_document():
    docs = docs_of(2)
    ids = np.concatenate(docs)
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    symbols, end, rules, size = compress(ids, last)
    assert end.sum() == len(docs) and symbols.max() > ids.max() and len(rules)
    assert compress(np.zeros(0, int), np.zeros(0, bool))[0].size == 0


def test_no_pair_is_left_that_pays():
    ids = np.concatenate(docs_of(3))
    last = np.zeros(len(ids), bool)
    symbols, *_ = compress(ids, last, least=4)
    count = {}
    free = {}
    for i, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)):
        if free.get(pair, 0) <= i:
            count[pair], free[pair] = count.get(pair, 0) + 1, i + 2
    assert max(count.values()) < 4


def test_overlapping_pairs_go_by_frequency():
    ids = np.array([1, 2, 3] * 5 + [2, 3] * 10)
    symbols, _, rules, _ = compress(ids, np.zeros(len(ids), bool))
    assert rules[0].tolist() == [2, 3]


def test_packed_values_come_back():
    rng = np.random.default_rng(4)
    for bits in (1, 7, 16, 17, 31, 32):
        for n in (0, 1, 5, 1000):
            values = rng.integers(0, 1 << bits, n).astype(np.uint32)
            assert unpacked(np.frombuffer(packed(values, bits), "<u8"), n, bits).tolist() == values.tolist()


def test_shards_are_smaller_than_raw_ids(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs = [np.append(x, 0) for x in encoder(default_tokenizer()).whole(texts)]
    start = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    raw = pack_shard(list(range(len(docs))), np.concatenate(docs), start)
    assert len(raw) < 2 * start[-1]


def test_files_hold_all_documents_in_order(spark, tmp_path):
    rows = documents()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    enc = encoder(default_tokenizer())
    want, start = [], 0
    for r in order:
        ids = np.append(enc.whole([r[1] or ""])[0], 0)
        want.append((r[0], start, len(ids), crc32(ids)))
        start += len(ids)
    folder = str(tmp_path / "ids")
    write_ids(frame(spark), folder)
    got = read_ids(spark, folder, digest=True).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    full = read_ids(spark, folder).collect()
    assert all(crc32(np.frombuffer(r.ids, "<u4")) in {w[3] for w in want} for r in full)
    assert read_shards(spark, folder).count() >= 1
    empty = str(tmp_path / "none")
    write_ids(frame(spark, []), empty)
    assert read_ids(spark, empty, digest=True).count() == 0
