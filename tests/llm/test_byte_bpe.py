"""BPE against the tiktoken library, and both forms of the segment tree against each other."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from subtide.llm import byte_bpe

RANKS = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def test_random_texts(library, encoder):
    rng = random.Random(5)
    signs = " \t\n\r\x0b\x1c\x1f\x85\xa0　​  aAéñ'sS12٣.,-_́\U0001F600日本\0"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += [" ", "  ", " a", "a ", "\n a", "a \nb", "a" * 3000, "é" * 2000 + " x", "<|endoftext|> a"]
    ids, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at: at + n].tolist() == library.encode_ordinary(text), repr(text)
        at += n


def test_trees_side_by_side_and_alone(encoder):
    rng = random.Random(2)
    for n in (1, 2, 3, 5, 8, 9, 31, 64):
        pieces = [bytes(rng.choice(b"theanior \xc3\xa9") for _ in range(rng.randint(1, n))) for _ in range(100)]
        ids, counts = encoder.merges.merge_side_by_side(pieces, 64)
        one_by_one = [encoder.merges.merge_one(p) for p in pieces]
        assert counts.tolist() == [len(x) for x in one_by_one]
        assert ids.tolist() == [i for x in one_by_one for i in x]


def test_tables_start_anew_when_full(library):
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    encoder.runs.limit = encoder.matches.limit = 50
    for k in range(20):
        text = " ".join(f"piece{k * 31 + i}" for i in range(30))
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_tables_and_round_trip(spark, small, odd, none, library):
    for docs in (small("documents"), odd):
        rows = byte_bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
        key = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in rows), key=key) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=key)
        for r in rows:
            assert list(memoryview(bytes(r.ids)).cast("I")) == library.encode_ordinary(bytes(r.decoded).decode())
        two_steps = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN), RANKS)
        assert two_steps.exceptAll(byte_bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN)).count() == 0
    assert byte_bpe.encode_and_decode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_unknown_ids_fail(spark):
    bad = spark.createDataFrame([(1, (60_000).to_bytes(4, "little"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="no token has"):
        byte_bpe.decode_documents(bad, RANKS).collect()
