"""Alignment of two tokenizers against the libraries and brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from tidemark.llm import align, bpe, pieces, queries
from tidemark.llm.common import table

PATH_A, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b", "x▁y", "naïve café ﬁ 🙂🙂 漢字仮名", "no\nway\r\n\t!", "a" * 300, " " * 100,
       "<|endoftext|> </s> <0x41>", "\0\0", "lol", "lol", "日本語" * 50, "ÿþ" * 40, "don't we'll"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def brute(libraries, texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) by plain loops."""
    a_lib, b_lib = libraries
    ranks = bpe.read_ranks(PATH_A)
    a_bytes = {i: t for t, i in ranks.items()}
    per_doc, counts = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        b_parts = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
                   for i in b for p in [b_lib.id_to_piece(i)]]
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_parts) != whole:
            per_doc.append(None)
            continue
        ends_a = np.cumsum([len(a_bytes[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(p) for p in b_parts]).tolist()
        groups, x, y = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(e, x) + 1, ends_b.index(e, y) + 1
            groups.append((a[x:p], b[y:q]))
            x, y = p, q
        links = [(i, j) for ga, gb in groups for i in ga for j in gb]
        counts.update(set(links))
        listed = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        per_doc.append((len(a), len(b), len(groups), links, hashlib.sha256(listed.encode()).hexdigest()))
    most = Counter()
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(counts[p] == most[p[0]] for p in d[3]), sum(counts[p] for p in d[3]), d[4])
            for d in per_doc]


def test_common_ends_are_the_intersection():
    rng = random.Random(1)
    for _ in range(300):
        top = rng.choice([5, 50, 3000])
        a = np.array(sorted(rng.sample(range(top * 2), rng.randint(0, top))), dtype=np.int64)
        b = np.array(sorted(rng.sample(range(top * 2), rng.randint(0, top))), dtype=np.int64)
        at_a, at_b = align.common_ends(a, b)
        want = np.intersect1d(a, b)
        assert a[at_a].tolist() == want.tolist() == b[at_b].tolist()


def test_json_ranks_are_those_of_the_rank_file():
    assert bpe.read_ranks(PATH_A) == bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_units_are_what_both_tokenizers_cut(libraries):
    rng = random.Random(8)
    a_lib, b_lib = libraries
    aligner = align.Aligner(PATH_A, PATTERN, PATH_B)
    texts = ["".join(rng.choice(["a", "b!", " ", " ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u3000", "'s", "1", "é"])
                     for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    block = aligner.block(texts)
    a, b, a_ends, b_ends = block.tokens()
    stops = [np.cumsum(x) for x in (block.n_a, block.n_b)]
    for k, text in enumerate(texts):
        assert align._cut_units(text)[0] is not None and " ".join(align._cut_units(text)) == text
        own_a = a[stops[0][k] - block.n_a[k]:stops[0][k]].tolist()
        own_b = b[stops[1][k] - block.n_b[k]:stops[1][k]].tolist()
        assert own_a == a_lib.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert own_b == b_lib.encode(text), repr(text)


def test_large_groups_count_as_small_ones(monkeypatch):
    aligner = align.Aligner(PATH_A, PATTERN, PATH_B)
    want = [x.tolist() for x in aligner.block(ODD).links()]
    monkeypatch.setattr(align, "WIDE_GROUP", 0)
    assert [x.tolist() for x in aligner.block(ODD).links()] == want


def test_scores_are_brute_force(spark, libraries, monkeypatch):
    rng = random.Random(4)
    words = ["the", "naïve", "漢字", "co-op", "  ", "1,000", "x▁", "Straße", "\n", "🙂", "internationalisation"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(80)]
    df = spark.createDataFrame([(i % 90, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, pair string").repartition(5)
    got = align.score(df, "doc_id", "text", PATH_A, PATTERN, PATH_B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i % 90, *row) for i, row in enumerate(brute(libraries, texts))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_small_blocks_change_nothing(libraries, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_CHARS", 30)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ODD))), pa.array(ODD)], names=["i", "t"])
    cut = list(align._cut([batch, batch]))
    assert [t for _, texts in cut for t in texts] == ODD + ODD and len(cut) > 10


def test_groups_as_columns(spark, libraries):
    df = spark.createDataFrame([(1, "naïve café"), (2, None)], "id long, text string")
    rows = {r.id: r for r in align.align(df, "id", "text", PATH_A, PATTERN, PATH_B).collect()}
    assert rows[1].a_ids == libraries[0].encode(" naïve café", add_special_tokens=False).ids
    assert rows[1].b_ids == libraries[1].encode("naïve café")
    assert (rows[1].a_ends[-1], rows[1].b_ends[-1]) == (len(rows[1].a_ids), len(rows[1].b_ids))
    assert len(rows[1].a_ends) == len(rows[1].b_ends) and rows[2].a_ids == rows[2].a_ends == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.score(df, "doc_id", "text", PATH_A, PATTERN, PATH_B).collect() == []


def test_op11_is_brute_force_on_every_document(spark, libraries):
    docs = table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()
    want = [(d.doc_id, *row) for d, row in zip(docs, brute(libraries, [d.text for d in docs]))]
    assert sorted(map(tuple, queries.QUERIES["op11_align"](spark, SF_SMALL).collect())) == want
