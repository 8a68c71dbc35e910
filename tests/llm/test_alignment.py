import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import documents, frame
from shoal.llm import alignment as A
from shoal.llm.alignment import align, aligned, coalesced, distinct, linked, pair_counts


def plain_groups(a, b):
    """Groups of token numbers between the offsets where both end a token."""
    a_end, b_end = np.cumsum(a).tolist(), np.cumsum(b).tolist()
    out, i, j = [], 0, 0
    for cut in sorted({*a_end} & {*b_end}):
        left, right = [], []
        while i < len(a) and a_end[i] <= cut:
            left.append(i)
            i += 1
        while j < len(b) and b_end[j] <= cut:
            right.append(j)
            j += 1
        out.append((left, right))
    return out


def cut(rng, n):
    ends = sorted({*rng.sample(range(1, n), rng.randint(0, n - 1)), n})
    return np.diff([0, *ends])


def test_groups_break_where_both_end():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 40)
        a, b = cut(rng, n), cut(rng, n)
        a_group, b_group = coalesced(a, b)
        got = [([i for i, g in enumerate(a_group) if g == k], [j for j, g in enumerate(b_group) if g == k]) for k in range(max(a_group) + 1)]
        assert got == plain_groups(a, b)


def test_links_of_large_groups_are_multiplied_out_by_distinct_ids(monkeypatch):
    monkeypatch.setattr(A, "SLICE", 50)
    rng = np.random.Generator(np.random.PCG64(3))
    a_group, b_group = np.sort(rng.integers(0, 6, 900)), np.sort(rng.integers(0, 6, 700))
    a_ids, b_ids = rng.integers(0, 30, 900), rng.integers(0, 40, 700)
    doc = np.array([0, 0, 1, 1, 1, 3])
    of, pair, times = linked(distinct(a_group, a_ids), distinct(b_group, b_ids), doc, 6)
    want = collections.Counter((doc[g], a, b) for g, a in zip(a_group, a_ids) for h, b in zip(b_group, b_ids) if g == h)
    assert {(d, p >> A.BITS, p & A.LOW): n for d, p, n in zip(of, pair, times, strict=True)} == want
    assert of.tolist() == sorted(of)


def expected(rows):
    """The contract by plain loops over an unaltered pair of libraries."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    char = A.byte_level()

    def piece(i):
        byte = re.fullmatch("<0x(..)>", two.id_to_piece(i))
        return bytes([int(byte[1], 16)]) if byte else two.id_to_piece(i).replace("▁", " ").encode()

    found, held = [], collections.Counter()
    for doc_id, text in rows:
        full = (" " + text).encode() if text else b""
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        a_bytes, b_bytes = [bytes(char[c] for c in one.id_to_token(i)) for i in a], [piece(i) for i in b]
        if b"".join(a_bytes) != full or b"".join(b_bytes) != full:
            a, b, a_bytes, b_bytes = [], [], [], []
        groups = [([a[i] for i in x], [b[j] for j in y]) for x, y in plain_groups([len(x) for x in a_bytes], [len(x) for x in b_bytes])]
        links = collections.Counter((x, y) for left, right in groups for x in left for y in right)
        held.update(links.keys())
        found.append((doc_id, len(a), len(b), groups, links))
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), sum(n for (x, y), n in links.items() if held[x, y] == most[x]),
                    sum(n * held[p] for p, n in links.items()), text))
    return out, held, most


HARD = ["a▁b", "<s> x </s>", "<|endoftext|> done", "  two  spaces ", "\n\n\t x", "中文字符 😀😀 é́", "ﬁ ½ Ⅷ", "\x00\x01", "　wide", "naïve café " * 30,
        "aaaaaaaaaaaaaaaaaaaaaaa" * 40, "0123456789" * 30, "=" * 500, "\r\n" * 50]


def rows():
    return [(r[0], r[1]) for r in documents()] + [(1000 + i, t) for i, t in enumerate(HARD)]


def test_tables_equal_plain_loops(spark):
    docs = frame(spark).select("doc_id", "text", F.lit(1).alias("block"), F.lit("x").alias("n_a")) \
        .unionByName(spark.createDataFrame([(*r, 1, "x") for r in rows()[len(documents()):]], "doc_id long, text string, block int, n_a string"))
    kept = aligned(docs.repartition(4))
    want, held, most = expected(rows())
    assert sorted(map(tuple, align(kept).collect()), key=str) == sorted(want, key=str)
    assert {(r.id_a, r.id_b): (r.n_docs, r.best) for r in pair_counts(kept).collect()} == {p: (n, n == most[p[0]]) for p, n in held.items()}


def test_blocks_do_not_change_results(spark):
    """Many blocks in a task: counts are those of all documents."""
    docs = spark.createDataFrame([(i, "the river stone and the cloud " * 9000 + str(i)) for i in range(24)], "doc_id long, text string").coalesce(1)
    kept = aligned(docs, carry=lambda groups: F.sha2(groups, 256))
    assert kept.where("n_a is null").count() > 1
    got = align(kept).collect()
    want, _, _ = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got)) == sorted((*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for w in want)


def test_empty_table(spark):
    kept = aligned(frame(spark).limit(0))
    assert align(kept).count() == 0 and pair_counts(kept).count() == 0


def test_query_leaves_texts_without_tokens_unhashed(spark, tmp_path):
    from shoal.llm.queries import op11_alignment

    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    want, _, _ = expected([(r[0], r[1]) for r in documents()])
    got = op11_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        ((*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want), key=str)


@pytest.mark.parametrize("size", [1_500_000])
def test_very_long_text(spark, size):
    text = "".join(random.Random(7).choice(["the ", "river", "xq", "é", " 12", "\n"]) for _ in range(size // 3))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    want, _, _ = expected([(1, text), (2, "short")])
    assert sorted(map(tuple, align(aligned(docs)).collect())) == sorted(want)
