"""Which tokens of two tokenizers cover the same bytes: interval coalescing, counted over all documents.

Both tokenizers cut the same bytes (a space and the text) into tokens, each an
interval of bytes. The tokens of both are sorted together by where they start, and
the running maximum of where they end is taken; where a token starts at or behind it,
nothing before reaches over that place: a new group begins. Every token of one
tokenizer is linked with every token of the other in its group.

Links are kept as pairs of ids with the number of their occurrences, a document at a
time: the distinct ids of a group are multiplied out, in slices of bounded size, so
that a group of thousands of tokens on both sides costs its distinct pairs only. How
many documents hold a pair is counted in blocks of documents first, so a pair that
every document holds is one row a block, in the sum as well as on the way back.

Defined results: null and empty texts have no tokens, nor have texts whose token bytes
differ from space and text (normalised away, U+2581 in the text); bytes that are no
UTF-8 are read as U+FFFD; the strings of special tokens are plain text; a repeated row
counts as one more document; an empty table gives an empty result; extra columns are
not looked at. A text is handled whole in one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.byte_bpe import laid_out, runs, same_bytes
from shoal.llm.common import CHUNK_BYTES, arrow_schema, chunks, ragged, saved, text_chunks
from shoal.llm.tokens import default_tokenizer, encoder

#: A pair of ids is one number: the first id above this many bits.
BITS = 20
LOW = (1 << BITS) - 1
#: Pairs multiplied out at once.
SLICE = 1 << 21
#: Bytes of text in a block whose pairs are counted together.
BLOCK_BYTES = 4 * CHUNK_BYTES
#: Bytes of text aligned at once (A's ids come a chunk at a time).
PART_BYTES = CHUNK_BYTES // 4


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def byte_level_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id of a byte-level file, in a row, and where they start."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    of = byte_level()
    out = [b""] * (1 + max(vocabulary.values()))
    for token, i in vocabulary.items():
        out[i] = bytes(of[c] for c in token)
    return laid_out(out)


@cache
def pieces(path: str):
    """The sentence-piece processor, and the bytes of every id in a row and where they start."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(lib.get_piece_size()):
        name = lib.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", name) if lib.is_byte(i) else None
        out.append(bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode())
    return lib, *laid_out(out)


def coalesced(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, given their lengths in the same bytes."""
    start = np.concatenate((np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size))
    end = start + np.concatenate((a_size, b_size))
    side = np.repeat(np.array([0, 1], np.int8), [len(a_size), len(b_size)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[:len(a_size)], group[len(a_size):]


def tokens(full: list[str], a_ids: np.ndarray, a_n: np.ndarray, path_a: str, path_b: str):
    """Ids of A and B in a row and each text's number of them; texts that don't come back byte by byte have none.

    ``full``: the texts with their space; ``a_ids``, ``a_n``: what A makes of them."""
    lib, b_flat, b_off = pieces(path_b)
    a_flat, a_off = byte_level_bytes(path_a)
    found = [np.array(lib.encode(t[1:], num_threads=1), np.int64) for t in full]
    b_n = np.array([len(x) for x in found], np.int64)
    b_ids, a_ids = np.concatenate([np.zeros(0, np.int64), *found]), a_ids.astype(np.int64)
    data, off = laid_out([t.encode() for t in full])
    fits = np.diff(off) > 0
    for ids, n, flat, at in ((a_ids, a_n, a_flat, a_off), (b_ids, b_n, b_flat, b_off)):
        size = np.diff(at)[ids]
        before = np.concatenate(([0], np.cumsum(size)))
        last = np.cumsum(n)
        total = before[last] - before[last - n]
        fits &= total == np.diff(off)
        out, begin = flat[runs(at[:-1][ids], size)], before[last - n]
        fits[fits] = same_bytes(data, off[:-1][fits], out, begin[fits], total[fits])
    return (a_ids[np.repeat(fits, a_n)], np.where(fits, a_n, 0), np.diff(a_off),
            b_ids[np.repeat(fits, b_n)], np.where(fits, b_n, 0), np.diff(b_off))


def distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and number of each id in a group."""
    key, n = np.unique(group << BITS | ids, return_counts=True)
    return key >> BITS, key & LOW, n


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    names, which = np.unique(np.concatenate(keys), return_inverse=True)
    return names, np.bincount(which, weights=np.concatenate(counts), minlength=len(names)).astype(np.int64)


def linked(a: tuple, b: tuple, doc: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and occurrences of the links of ``distinct`` tokens; ``doc`` is each group's document."""
    (a_group, a_id, a_n), (b_group, b_id, b_n) = a, b
    partners = np.bincount(b_group, minlength=groups)
    first = np.cumsum(partners) - partners
    size = partners[a_group]
    before = np.concatenate(([0], np.cumsum(size)))
    keys, counts, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while lo < len(a_id):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + SLICE, side="right")) - 1)
        i = np.repeat(np.arange(lo, hi), size[lo:hi])
        j = runs(first[a_group[lo:hi]], size[lo:hi])
        # rows come in the order of documents: the key is sorted within a document only after this
        rank = np.unique(doc[a_group[i]] << (2 * BITS) | a_id[i] << BITS | b_id[j], return_inverse=True)
        keys.append(rank[0])
        counts.append(np.bincount(rank[1], weights=a_n[i] * b_n[j]).astype(np.int64))
        lo = hi
    key, n = summed(keys, counts) if len(keys) > 2 else (keys[-1], counts[-1])
    return key >> (2 * BITS), key & ((1 << 2 * BITS) - 1), n


@cache
def digits(most: int) -> np.ndarray:
    """Decimal digits of 0 to ``most`` in rows of one width, filled up with zero bytes."""
    names = np.array([str(i).encode() for i in range(most + 1)])
    return names.view(np.uint8).reshape(len(names), -1)


def shown(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], doc: np.ndarray, n_docs: int) -> pa.Array:
    """Each document's groups as text, ``a1,a2|b1;a3|b2,b3``."""
    (a_group, a_ids), (b_group, b_ids) = a, b
    groups = len(doc)
    a_n, b_n = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_place = np.arange(len(a_ids)) + (np.cumsum(b_n) - b_n)[a_group]
    b_place = np.arange(len(b_ids)) + np.cumsum(a_n)[b_group]
    table = digits(LOW) if max(a_ids.max(initial=0), b_ids.max(initial=0)) > 65535 else digits(65535)
    rows = np.zeros((len(a_ids) + len(b_ids), table.shape[1] + 1), np.uint8)
    for place, ids in ((a_place, a_ids), (b_place, b_ids)):
        rows[place, :-1] = table[ids]
    rows[:, -1] = ord(",")
    a_last, b_last = np.cumsum(a_n) - 1, np.cumsum(b_n) - 1
    rows[a_place[a_last], -1] = ord("|")
    rows[b_place[b_last], -1] = ord(";")
    rows[b_place[b_last[np.append(doc[1:] != doc[:-1], True)[:groups]]], -1] = 0
    size = np.bincount(np.repeat(doc, a_n + b_n), weights=(rows > 0).sum(axis=1), minlength=n_docs).astype(np.int64)
    flat = rows.ravel()
    flat = flat[flat > 0]
    off = np.concatenate(([0], np.cumsum(size)))
    if off[-1] >= 1 << 31:
        raw = flat.tobytes()
        return pa.array([raw[x:y].decode() for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.string())
    return pa.StringArray.from_buffers(n_docs, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes()))


ROWS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
            carry: Callable[[str], Column] = F.col) -> DataFrame:
    """A row per document with its groups and linked pairs, and a row per block with its pairs' documents.

    ``block, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times``; a block's row has no ``n_a``.
    ``carry`` makes of the groups' text what is kept.
    """
    path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
    schema = arrow_schema(block=pa.int64(), doc_id=pa.int64(), n_a=pa.int64(), n_b=pa.int64(), n_groups=pa.int64(), n_links=pa.int64(),
                          groups=pa.string(), pairs=pa.list_(pa.int64()), times=pa.list_(pa.int32()))

    def of_texts(texts: list[str], a_ids: np.ndarray, a_n: np.ndarray, doc_ids: pa.Array, block: int):
        a_ids, a_n, a_len, b_ids, b_n, b_len = tokens(texts, a_ids, a_n, path_a, path_b)
        a_group, b_group = coalesced(a_len[a_ids], b_len[b_ids])
        n_groups = np.zeros(len(texts), np.int64)
        doc = np.zeros(0, np.int64)
        if len(a_ids):
            opens = np.append(True, a_group[1:] != a_group[:-1])
            doc = np.repeat(np.arange(len(texts)), a_n)[opens]
            n_groups = np.bincount(doc, minlength=len(texts))
        links = np.bincount(doc, weights=np.bincount(a_group, minlength=len(doc)) * np.bincount(b_group, minlength=len(doc)).astype(np.int64),
                            minlength=len(texts)).astype(np.int64)
        of, pair, times = linked(distinct(a_group, a_ids), distinct(b_group, b_ids), doc, len(doc))
        return pair, pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(texts), block)), doc_ids, pa.array(a_n), pa.array(b_n), pa.array(n_groups), pa.array(links),
             shown((a_group, a_ids), (b_group, b_ids), doc, len(texts)),
             *[ragged(x, np.bincount(of, minlength=len(texts)), kind) for x, kind in ((pair, pa.int64()), (times, pa.int32()))]], schema=schema)

    def of_block(block: int, found: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(found), return_counts=True)
        none = pa.nulls(1, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), none, none, none, none, none, pa.nulls(1, pa.string()),
             ragged(pair, np.array([len(pair)]), pa.int64()), ragged(n, np.array([len(n)]), pa.int32())], schema=schema)

    def run(batches):
        from pyspark import TaskContext

        block, found, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                full = [" " + raw[x:y].decode(errors="replace") if y > x else "" for x, y in zip(off[:-1], off[1:], strict=True)]
                a_ids, first = encoder(path_a, specials=False).encode(full)
                for i, j in chunks(off, PART_BYTES):
                    pair, rows = of_texts(full[i:j], a_ids[first[i]:first[j]], np.diff(first[i:j + 1]),
                                          batch.column("doc_id")[lo + i:lo + j], block)
                    yield rows
                    found.append(pair)
                size += len(raw)
                if size >= BLOCK_BYTES:
                    yield of_block(block, found)
                    block, found, size = block + 1, [], 0
        if found:
            yield of_block(block, found)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.mapInArrow(run, ROWS)
    return saved(rows.withColumn("groups", carry("groups")), "aligned")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``block, pair, n``: in how many of the block's documents a pair is linked."""
    return rows.where("n_a is null").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("block", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("n"))


def _counted(pairs: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: documents that hold a pair, and whether that is the most of its A id's pairs."""
    total = pairs.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    most = total.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("n_docs").alias("most"))  # a row for each id of A
    return total.withColumn("a", F.shiftright("pair", BITS)).join(F.broadcast(most), "a") \
        .select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``id_a, id_b, n_docs, best`` of the pairs of ``aligned`` rows: the alignment of the two vocabularies."""
    return _counted(_block_pairs(rows)).select(
        F.shiftright("pair", BITS).alias("id_a"), F.col("pair").bitwiseAND(LOW).alias("id_b"), "n_docs", "best")


def align(rows: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of ``aligned`` rows.

    ``n_best`` counts links whose pair is held by most documents of its A id's pairs,
    ``count_sum`` adds up the documents of every link's pair.
    """
    pairs = _block_pairs(rows)
    back = pairs.select(F.col("block").alias("home"), "pair").join(_counted(pairs), "pair")
    text = rows.schema["groups"].dataType.simpleString()
    kind = pa.binary() if text == "binary" else pa.string()
    schema = arrow_schema(doc_id=pa.int64(), n_a=pa.int64(), n_b=pa.int64(), n_groups=pa.int64(), n_links=pa.int64(),
                          n_best=pa.int64(), count_sum=pa.int64(), groups=kind)

    def of_block(docs: pa.Table, known: pa.Table) -> pa.Table:
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, n_docs = pair[order], known.column("n_docs").to_numpy()[order]
        best = known.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        size = docs.column("pairs").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        at = np.searchsorted(pair, docs.column("pairs").combine_chunks().flatten().to_numpy())
        times = docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        end = np.cumsum(size)
        sums = [np.concatenate(([0], np.cumsum(times * x[at] if len(pair) else times))) for x in (best, n_docs)]
        return pa.table([*[docs.column(c) for c in schema.names[:5]], *[pa.array(s[end] - s[end - size]) for s in sums],
                         docs.column("groups").cast(kind)], schema=schema)

    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups " + text
    return rows.where("n_a is not null").groupBy("block").cogroup(back.groupBy("home")).applyInArrow(of_block, fields)
