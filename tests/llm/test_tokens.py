import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_data import documents
from shoal.llm.token_trees import CountedText, build_trees, count_edits
from shoal.llm.tokens import END, Encoder, classes, default_tokenizer, encode_documents, encoder

PATH = default_tokenizer()
LIBRARY = {True: Tokenizer.from_file(PATH), False: Tokenizer.from_file(PATH)}
LIBRARY[False].encode_special_tokens = True
PARTS = ["'s", "'", "'re", "'S", "''", " ", "  ", "\n", "\t\n", "a", "Z", "the", " the", "é", "中", "9", "½", "_", "!", "\x1c",
         "\x85", "😀", "́", "　", "​", "l", "t", "re", "<|endoftext|>", "\x00"]
texts = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_ids_equal_the_library(many):
    many = [t.encode("utf-8", "ignore").decode() for t in many]
    for specials in (True, False):
        ids, off = encoder(PATH, specials).encode(many)
        for i, want in enumerate(LIBRARY[specials].encode_batch(many, add_special_tokens=False)):
            assert ids[off[i]:off[i + 1]].tolist() == want.ids


def test_strings_of_added_tokens():
    text = "a<|endoftext|>b"
    assert encoder(PATH).encode([text, "a"])[0].tolist() == [64, 50256, 65, 64]
    assert 50256 not in encoder(PATH, specials=False).encode([text])[0]
    doc = CountedText("a<|endof>b and more words", encoder(PATH))
    doc.edit(8, 8, "text|")
    assert doc.tree.n_ids == len(LIBRARY[True].encode(doc.text, add_special_tokens=False).ids)


def test_classes_of_code_points_equal_the_library():
    enc = encoder(PATH)
    known = [c for c in range(0x3100) if classes()[c] != 4]
    many = ["ab " + chr(c) + "a" + chr(c) + " " + chr(c) + "9" + chr(c) * 2 + "!" for c in known]
    ids, off = enc.encode(many)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [x.tolist() for x in enc.whole(many)]


def test_documents_end_with_the_end_id():
    ids, start = encode_documents(["", "one two", ""], PATH)
    assert ids[start[1:] - 1].tolist() == [END] * 3 and start.tolist()[:2] == [0, 1]


@settings(max_examples=60, deadline=None)
@given(texts, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20), texts), max_size=6))
def test_counts_follow_edits(text, edits):
    enc = encoder(PATH)
    text = text.encode("utf-8", "ignore").decode()
    doc = CountedText(text, enc)
    for start, size, new in edits:
        new = new.encode("utf-8", "ignore").decode()
        doc.edit(start, start + size, new)
        a = min(start, len(text))
        text = text[:a] + new + text[min(a + size, len(text)) if start <= len(text) else a:]
        assert doc.text == text and doc.tree.n_chars == len(text)
        assert doc.tree.n_ids == len(enc.whole([text])[0])


def test_long_documents_are_encoded_only_around_edits():
    rng = random.Random(1)
    enc = encoder(PATH)
    text = " ".join(rng.choice(["river", "stone,", "cloud\n", "it's", "x9"]) for _ in range(6000))
    doc = CountedText(text, enc)
    for _ in range(50):
        a = rng.randrange(len(text))
        b = a + rng.choice([0, 3, 900])
        new = rng.choice(["", " new", "x" * 50, "many words in one go " * 40])
        doc.edit(a, b, new)
        text = text[:a] + new + text[b:]
    chars, ids = doc.tree.leaves()
    want = enc.counts([text])[0]
    assert chars.tolist() == want[0].tolist() and ids.tolist() == want[1].tolist()
    assert doc.encoded < len(chars)


def test_tables(spark):
    rows = [(r[0], r[1], [(0, 3, "Hello"), (5, 5, " it's "), None, (10 ** 6, 10 ** 6, "end")] if i % 3 else None, "x")
            for i, r in enumerate(documents())]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,stop:long,text:string>>, n_tokens string")
    enc = encoder(PATH)
    trees = build_trees(df)
    for t in trees.collect():
        want = enc.counts([t.text])[0]
        assert [t.leaf_chars, t.leaf_ids, t.n_tokens] == [want[0].tolist(), want[1].tolist(), int(want[1].sum())]
    got = count_edits(df)
    want = []
    for doc_id, text, edits, _ in rows:
        text = was = text or ""
        for e in edits or []:
            if e:
                a, b = min(e[0], len(text)), min(e[1], len(text))
                text = text[:a] + e[2] + text[b:]
        want.append((doc_id, len(enc.whole([was])[0]), len(enc.whole([text])[0]), text))
    assert sorted(((r.doc_id, r.n_tokens, r.edited_tokens, r.edited_text) for r in got.collect()), key=str) == sorted(want, key=str)
    known = trees.where("doc_id < 50").join(df.select("doc_id", "edits"), "doc_id")
    again = {r.doc_id: r.edited_tokens for r in count_edits(known).collect()}
    assert again == {i: n for i, _, n, _ in want if i is not None and i < 50}
    assert count_edits(df.limit(0)).count() == 0 and build_trees(df.limit(0)).count() == 0


def test_leaf_types():
    assert np.asarray(CountedText("", encoder(PATH)).tree.leaves()[0]).size == 0


def test_new_pre_tokens_go_to_the_library_side_by_side(monkeypatch):
    enc, sent = Encoder(PATH), []
    whole = enc.whole
    monkeypatch.setattr(enc, "whole", lambda texts: sent.extend(texts) or whole(texts))
    words = [" " + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(3000)]
    many = ["".join(words), "\n\n \n a\n'\n's \t" + "".join(words[:5]), "", "\n" * 9 + "b"]
    ids, off = enc.encode(many)
    want = LIBRARY[True].encode_batch(many, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [x.ids for x in want]
    assert len(enc.keys) > 3000 and len(sent) < 200
    sent.clear()
    assert np.array_equal(enc.encode(many)[0], ids) and not sent


def test_the_store_holds_keys_that_meet_in_a_slot():
    enc = Encoder(PATH)
    enc.slots = np.full(8, -1, np.int32)
    rng = random.Random(3)
    many = [" ".join(str(rng.randrange(10**6)) for _ in range(rng.choice([1, 3, 3000]))) for _ in range(12)]
    for t in many + many:
        assert enc.encode([t])[0].tolist() == LIBRARY[True].encode(t, add_special_tokens=False).ids
    assert len(np.unique(enc.keys)) == len(enc.keys) <= len(enc.slots) // 2
    # keys with one hash place, and a store emptied when it is full
    enc._empty()
    enc._learn(np.arange(5, dtype=np.uint64) << np.uint64(40), ["a", " b", "\n", "c", " "])
    known = enc._place(np.arange(5, dtype=np.uint64) << np.uint64(40)).tolist()
    assert sorted(known) == [*range(5)] and enc._place(np.array([9 << 40], np.uint64)).tolist() == [-1]
    assert [enc.pool[enc.at[i]:][:enc.size[i]].tolist() for i in known] == \
        [LIBRARY[True].encode(t, add_special_tokens=False).ids for t in ("a", " b", "\n", "c", " ")]


def test_a_full_store_is_emptied(monkeypatch):
    monkeypatch.setattr("shoal.llm.tokens.MOST_KNOWN", 50)
    enc = Encoder(PATH)
    for lo in (0, 30, 60, 0):
        text = " ".join(map(str, range(lo, lo + 40)))
        assert enc.encode([text])[0].tolist() == LIBRARY[True].encode(text, add_special_tokens=False).ids
        assert len(enc.keys) <= 90
