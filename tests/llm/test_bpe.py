"""Byte-level BPE against the tiktoken library, and exact round trips."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.vocab.ranks,
                             special_tokens={})


def odd_texts():
    rng = random.Random(1)
    alphabet = [chr(i) for i in [*range(0, 0x250), *range(0x2000, 0x2070), 0x3000, 0x1680, 0x180e,
                                 0xfeff, 0x85, 0xa0, 0x10ffff, 0x1f600, 0x4e00, 0x660, 0x2160]]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * n for n in range(1, 300, 13)] + [" " * n for n in range(1, 300, 17)]
    return texts + ["", "ab " * 2000, "é" * 1000, "\n\n \t x", "lol" * 3000 + "!" * 333,
                    "<|endoftext|>", "don't we'll I'D"]


def test_ids_are_the_librarys(codec, library):
    texts = odd_texts()
    for text, ids in zip(texts, codec.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("piece", [b"a", b"ab", b"abcabcabcabd" * 30, b"\xff\xfe" * 40, b" " * 777])
def test_rows_of_trees_and_one_tree_agree(codec, piece):
    one = bpe.merge_one(codec.vocab, piece)
    width = 1 << max(1, (len(piece) - 1).bit_length())
    rows = bpe.merge_rows(codec.vocab, [piece, piece[::-1]], width)
    assert np.frombuffer(rows[0], "<u4").tolist() == one
    assert np.frombuffer(rows[1], "<u4").tolist() == bpe.merge_one(codec.vocab, piece[::-1])


def test_a_full_cache_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 40)
    small = bpe.Codec(PATH, PATTERN)
    texts = odd_texts()[:200]
    for text, ids in zip(texts, small.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_round_trip_of_rows(spark, library):
    texts = [None, "", "x", "x", "tie \u00fc " * 3, "long " * 40000]
    df = spark.createDataFrame([(i if i else None, t, 7) for i, t in enumerate(texts)],
                               "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, bpe.round_trip(df, "doc_id", "text", PATH, PATTERN).collect()),
                 key=lambda r: (r[0] is not None, r[0]))
    for (doc, n, ids_sha, text_sha), (i, text) in zip(got, enumerate(texts)):
        ids = library.encode_ordinary(text or "")
        assert (doc, n) == (i or None, len(ids))
        assert ids_sha == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert text_sha == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_and_decode_columns(spark, library):
    df = spark.createDataFrame([(1, "a b c", "old"), (2, None, None)],
                               "doc_id long, text string, token_ids string")
    coded = bpe.encode(df, "text", PATH, PATTERN)
    assert coded.columns == ["doc_id", "text", "token_ids"]
    back = {r.doc_id: r for r in bpe.decode(coded, "token_ids", PATH, PATTERN).collect()}
    assert back[1].token_ids == library.encode_ordinary("a b c") and back[1].decoded == b"a b c"
    assert back[2].token_ids == [] and back[2].decoded == b""


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(df, "doc_id", "text", PATH, PATTERN).collect() == []
    assert bpe.encode(df, "text", PATH, PATTERN).collect() == []
