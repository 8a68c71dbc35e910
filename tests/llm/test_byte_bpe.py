import random
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import documents, frame
from shoal.llm.byte_bpe import ByteBpe, PerfectHash, decode, default_ranks, encode, merged, read_ranks

PARTS = ["'s", "'", "'re", "'S", "''", " ", "  ", "\n", "\t\n", "a", "Z", "the", " the", "é", "中", "9", "½", "_", "!", "\x1c", "\x85", "😀",
         "́", "　", "​", "l", "<|endoftext|>", "\x00", "͸", "￿", "\U000e0001", "﻿", "xqzjk" * 9]
texts = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=14).map("".join)


@cache
def codec():
    return ByteBpe(read_ranks(default_ranks()))


@cache
def library():
    import public_tokenizers
    import tiktoken

    ranks = {t: i for i, t in enumerate(read_ranks(default_ranks()))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_ids_equal_the_library_and_come_back(many):
    many = [t.encode("utf-8", "ignore").decode() for t in many]
    ids, first = codec().encode(many)
    for i, text in enumerate(many):
        assert ids[first[i]:first[i + 1]].tolist() == library().encode_ordinary(text)
    data, off = codec().decode(ids, first)
    assert [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:], strict=True)] == many


def test_every_code_point_is_split_as_the_library_does():
    rng = random.Random(1)
    points = [*range(0x20, 0x3100), *rng.sample([*range(0x3100, 0xD800), *range(0xE000, 0x110000)], 20000)]
    many = ["ab " + chr(c) + "a" + chr(c) + " " + chr(c) + "9" + chr(c) * 2 + "!" for c in points]
    ids, first = codec().encode(many)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == library().encode_ordinary_batch(many)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.Generator(np.random.PCG64(n)).integers(0, 2**63, n, dtype=np.uint64)
    found = PerfectHash(keys)
    assert sorted(found.keys.tolist()) == list(range(n))
    if n:
        assert found.find(keys).tolist() == list(range(n))


def test_vocabulary_is_resolved_by_the_first_tier():
    c = codec()
    assert sorted(c.hash.keys.tolist()) == list(range(len(c.tokens)))
    c._empty()
    c.encode(["The house of the people, and it's 2 o'clock."])
    assert not len(c.keys)


def plain_merge(piece, ranks):
    parts = [bytes([b]) for b in piece]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            return [ranks[p] for p in parts]
        i = min(known)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24), st.lists(st.binary(min_size=2, max_size=6), max_size=60, unique=True))
def test_heap_merges_as_plain_merging(piece, extra):
    ranks = {bytes([i]): i for i in range(256)}
    for i, token in enumerate(dict.fromkeys([*(piece[i:j] for i in range(len(piece)) for j in range(i + 2, i + 5)), *extra])):
        if len(token) > 1:
            ranks.setdefault(token, 256 + (i * 7919) % 100003)
    assert merged(piece, ranks) == plain_merge(piece, ranks)


def test_texts_with_one_hash_are_told_apart():
    c = ByteBpe(read_ranks(default_ranks()))
    c.encode(["xqzjk"])
    data = np.frombuffer(b"qqzzy", np.uint8)
    pool, at, size = c._merged(data, c.keys[:1], np.array([0]), np.array([5]))
    assert pool[at[0]:at[0] + size[0]].tolist() == library().encode_ordinary("qqzzy")


def test_long_pretokens():
    many = ["a" * 200_000, "xq" * 60_000 + " " * 30_000, "word " * 300_000]
    ids, first = codec().encode(many)
    for i in (1, 2):
        assert ids[first[i]:first[i + 1]].tolist() == library().encode_ordinary(many[i])
    data, _ = codec().decode(ids, first)
    assert data.tobytes().decode() == "".join(many)


def test_tables(spark):
    docs = frame(spark).repartition(3)
    got = decode(encode(docs)).collect()
    want = sorted((r[0] if r[0] is not None else -1, library().encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in documents())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids, bytes(r.data)) for r in got) == want
    assert encode(docs.limit(0)).count() == 0 and decode(encode(docs.limit(0))).count() == 0


def test_lists_of_ids_with_nulls(spark):
    rows = [(1, None, "x"), (2, [], "x"), (3, [None, 1169, None], "x"), (4, [1169], "x")]
    got = decode(spark.createDataFrame(rows, "doc_id long, ids array<int>, data string").coalesce(1)).collect()
    assert [bytes(r.data) for r in got] == [b"", b"", *[codec().tokens[1169]] * 2]
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(spark.createDataFrame([(1, [999_999])], "doc_id long, ids array<int>")).collect()


def test_query_equals_the_library(spark, tmp_path):
    import hashlib

    from shoal.llm.queries import op12_byte_bpe

    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text, *_ in documents():
        ids = library().encode_ordinary(text or "")
        want.append((doc_id, len(ids), *[hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]))
    assert sorted(map(tuple, op12_byte_bpe(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
