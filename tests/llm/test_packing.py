"""Packed sequences: every id once and in place, no padding, and the rule itself."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from subtide.llm import packing
from subtide.llm.queries import QUERIES, vocabulary

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def whole_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, docs, library, length=2048):
    """Pieces put every document together again; sequences are full or powers of two."""
    expected, found = defaultdict(list), defaultdict(lambda: defaultdict(list))
    for doc_id, text in docs:
        expected[doc_id].append(whole_ids(library, text))
    sequences = defaultdict(list)
    for r in rows:
        found[r.doc_id][r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at and size > 0
            at += size
        assert at <= length and at & (at - 1) == 0
    assert found.keys() == expected.keys()
    for doc_id, texts in expected.items():
        assert sum(r.length for rs in found[doc_id].values() for r in rs) == sum(map(len, texts))
        for ids in texts:
            pieces = sorted(found[doc_id][len(ids)], key=lambda r: r.start)
            spans = [(r.start, r.length) for r in pieces]
            if len(texts) == 1:
                assert spans == [(a, n) for a, (_, n) in zip(np.cumsum([0] + [n for _, n in spans]).tolist(), spans)]
            crcs = {(r.start, r.length): r.ids_crc32 for r in pieces}
            for start, size in spans:
                assert crcs[start, size] == zlib.crc32(np.array(ids[start: start + size], dtype="<u4").tobytes()) or len(texts) > 1


def test_the_query_on_real_documents(spark, library):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    rows = QUERIES["op13_sum_of_squares_packing"](spark, path).collect()
    check_pieces(rows, docs, library)
    whole = sum(r.start == 0 and r.length == r.doc_tokens for r in rows)
    assert whole > 0.8 * sum(len(whole_ids(library, t)) <= 2048 for _, t in docs)


def test_odd_documents(spark, odd, none, library):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    sequences = packing.pack(odd, vocabulary(NAME))
    check_pieces(packing.piece_digests(sequences).collect(), docs, library)
    held = [r for r in sequences.collect()]
    assert len({r.sequence_id for r in held}) == len(held)
    for r in held:
        at = 0
        for p in r.pieces:
            assert any(list(r.ids[at: at + p.length]) == whole_ids(library, t)[p.start: p.start + p.length] for i, t in docs if i == p.doc_id)
            at += p.length
        assert at == len(r.ids)
    assert packing.pack(none, vocabulary(NAME)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(odd, vocabulary(NAME), length=1000)


def test_no_end_id_and_short_sequences(spark, odd, library):
    got = defaultdict(int)
    for r in packing.pack(odd, vocabulary(NAME), length=64, end_id=None).collect():
        assert len(r.ids) <= 64
        for p in r.pieces:
            got[p.doc_id] += p.length
    expected = defaultdict(int)
    for r in odd.collect():
        expected[r.doc_id] += len(whole_ids(library, r.text)) - 1
    assert dict(got) == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("seed", range(4))
def test_ids_equal_the_library(library, seed):
    rng = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x1f", "\x85", "​", "﻿", "a", "Word", "it's", "'LL", "'s", "12", "٣", "½",
        "!", "...", "$", "日本", "ß", "İ", "é", "\U0001F600", "<|endoftext|>", "<|", "|>", "_", "'", "\x00",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    solid = [p for p in parts if not p.isspace()]
    texts += [rng.choice(" \n").join("".join(rng.choices(solid, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts += ["\n".join(rng.choices(texts, k=3)) for _ in range(300)]
    ids, counts = packing.encoder(vocabulary(NAME))(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokenizers_that_cannot_be_cut_get_whole_texts():
    other = vocabulary("word_bpe_49k.json")
    assert packing.may_cut(json.loads(vocabulary(NAME))) and not packing.may_cut(json.loads(other))
    texts = ["ALİ. Two  words", "", None]
    ids, counts = packing.encoder(other)(pa.array(texts, pa.string()))
    plain = [Tokenizer.from_buffer(other).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(p) for p in plain] and ids.tolist() == sum(plain, [])


def piece(name, size):
    return packing.Piece(name, 0, np.zeros(size, dtype=np.uint32), size)


@pytest.mark.parametrize("seed", range(3))
def test_each_document_goes_where_the_sum_of_squares_is_least(seed):
    rng = random.Random(seed)
    packer = packing.SumOfSquares(length=16)
    for i in range(300):
        size = rng.choice([2, 3, 5, 5, 7, 11, 13])
        options = {}
        for level in range(17 - size):
            if level and not packer.counts[level]:
                continue
            counts = packer.counts.copy()
            counts[level] -= level > 0
            counts[level + size] += level + size < 16
            options[level] = int((counts**2).sum())
        best = packer.best_level(size)
        assert options[best] == min(options.values())
        assert best == max(level for level, total in options.items() if total == options[best])
        list(packer.add(piece(i, size)))
        assert packer.counts[0] == packer.counts[16] == 0
        assert all(packer.counts[level] == len(packer.windows[level]) for level in range(17))


@pytest.mark.parametrize("sizes", [[1500] * 2000, [1], [2048], [4097, 2047], list(range(1, 900)), [1025, 1024] * 40, []])
def test_windows_of_any_sizes_are_completed(sizes):
    packer = packing.SumOfSquares(most_open=100)
    done, most = [], 0
    for i, n in enumerate(sizes):
        done += packer.add(piece(i, n))
        most = max(most, packer.open)
    done += packer.finish()
    assert most <= 100 and packer.open == 0
    levels = [packing.level_of(w) for w in done]
    assert sum(levels) == sum(sizes)
    assert all(n & (n - 1) == 0 and 0 < n <= 2048 for n in levels)
    assert sum(n < 2048 for n in levels) <= 11
    starts = defaultdict(list)
    for window in done:
        for p in window:
            starts[p.doc_id].append((p.start, len(p.ids)))
    for i, n in enumerate(sizes):
        at = 0
        for start, size in sorted(starts[i]):
            assert start == at
            at += size
        assert at == n
