"""SentencePiece encoding and decoding against the sentencepiece library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL

from tidemark.llm import pieces, queries
from tidemark.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rng = random.Random(3)
    alphabet = [chr(i) for i in [*range(0, 0x250), 0x2581, 0x2581, 0x3000, 0xfeff, 0x85, 0xa0, 0x10ffff,
                                 0x1f600, 0x4e00, 0x4e8c, 0x430, 0x431, 0x5d0, 0x1112, 0x200d]]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab ▁") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["a" * n for n in range(1, 300, 13)] + [" " * n for n in range(1, 300, 17)]
    return texts + ["", "ab " * 2000, "é" * 1000, "\n\n \t x", "lol" * 3000 + "!" * 333, "<s></s><unk>",
                    "<0x41>", "hello  world", " lead", "trail "]


def test_ids_and_texts_are_the_librarys(library):
    texts = odd_texts()
    own = pieces.codec(PATH)
    for text, data in zip(texts, own.encode_all(texts)):
        ids = np.frombuffer(data, "<i4").tolist()
        assert ids == library.encode(text), repr(text)
        assert own.model.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(library):
    rng = random.Random(5)
    own = pieces.codec(PATH).model
    for _ in range(3000):
        top = rng.choice([300, 600, 32000])
        ids = [rng.randrange(top) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_rows_and_heap_merge_alike():
    model = pieces.codec(PATH).model
    rng = random.Random(7)
    chunks = ["".join(rng.choice("▁aeinrst\u4e8c\U0010ffff\0") for _ in range(rng.randint(1, 64)))
              for _ in range(600)]
    rows = model.segment(chunks)
    for chunk in chunks:
        heap = b"".join(model._bytes([model.ids.get(p, len(model.pieces) + ord(p[0]))])
                        for p in pieces._merge_long(chunk, model.ranks))
        assert rows[chunk] == heap


def test_a_full_table_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 5)
    monkeypatch.setattr(pieces, "TABLE_CHARS", 4)
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 40)
    small = pieces.PieceCodec(PATH)
    texts = odd_texts()[:200]
    for text, data in zip(texts, small.encode_all(texts)):
        assert np.frombuffer(data, "<i4").tolist() == library.encode(text)


def test_a_distinct_chunk_is_segmented_once(monkeypatch):
    seen = []
    own = pieces.PieceCodec(PATH)
    segment = own.model.segment
    monkeypatch.setattr(own.model, "segment", lambda cs: segment([seen.append(c) or c for c in cs]))
    assert len(list(own.encode_all(["one two one", "two one two", None, ""]))) == 4
    assert sorted(seen) == ["▁one", "▁two"]


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        pieces.PieceModel(str(tmp_path / "none.model"))


def test_columns_nulls_and_clashing_names(spark, library):
    df = spark.createDataFrame([(1, "a b  c", "old"), (1, "a b  c", "old"), (None, None, None), (2, "", "")],
                               "doc_id long, text string, piece_ids string")
    coded = pieces.encode(df, "text", PATH)
    assert coded.columns == ["doc_id", "text", "piece_ids"]
    back = pieces.decode(coded, "piece_ids", PATH, "text").collect()
    got = {(r.doc_id, tuple(r.piece_ids), r.text) for r in back}
    assert got == {(1, tuple(library.encode("a b  c")), "a b  c"), (None, (), ""), (2, (), "")}
    assert len(back) == 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.round_trip(df, "doc_id", "text", PATH).collect() == []
    assert pieces.encode(df, "text", PATH).collect() == []


def test_op13_is_the_library_on_every_document(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for r in table(spark, SF_SMALL, "documents").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_pieces"](spark, SF_SMALL).collect()}
    assert got == want
