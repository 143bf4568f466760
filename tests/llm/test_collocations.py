"""Phrase collocations against brute force; the registered query is held against
its SQL in test_queries."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as c


def brute(rows, max_words=3, min_count=10, covered=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    longer = Counter()
    for p, a in found.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                q = (p[0], *p[i:i + k])
                longer[q] = max(longer[q], a)
    out = {}
    for p, a in found.items():
        if p in longer and 100 * longer[p] >= covered * a:
            continue
        cuts = [(1000000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out.setdefault(p[0], []).append(
            (-score, -a, " ".join(p[1:]).encode(), f[p[:k + 1]], f[(p[0], *p[k + 1:])], n[p[0]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total, -score)
                  for lang, found in out.items()
                  for rank, (score, a, phrase, left, right, total) in enumerate(sorted(found)[:top], 1))


def texts(seed=1, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "City", "naïve", "\x1c", "\0", "ÄB", "漢字", "a b"]
    rows = [(rng.choice(["en", "de", None, ""]),
             "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
                     for _ in range(rng.randint(0, 60)))) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("en", "  .,"), ("fr", "once only")] + [("en", "new york city " * 40)] * 3


def frame(spark, rows, parts=5):
    df = spark.createDataFrame([(l, t, "x", 1) for l, t in rows], "lang string, text string, phrase string, n int")
    return df.repartition(parts)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("options", [{}, {"budget": 50}, {"budget": 3}, {"max_words": 2, "min_count": 3},
                                     {"max_words": 4, "min_count": 4, "budget": 20, "top": 7},
                                     {"covered": 90, "min_count": 2}])
def test_phrases_are_brute_force(spark, options):
    rows = texts()
    got = c.collocations(frame(spark, rows), **options)
    assert got.columns == COLUMNS
    options = {k: v for k, v in options.items() if k != "budget"}
    want = brute(rows, **options)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 10


def test_small_blocks_and_long_texts_change_nothing(monkeypatch):
    import pyarrow as pa
    rows = texts(2, 60) + [("en", "of the new, york " * 400), ("en", "x" * 900 + " y. z")]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([l or "und" for l, _ in rows]), pa.array([(t or "").encode() for _, t in rows])], names=["l", "t"])

    def counted():
        f = Counter()
        for lang, block in c._blocks([batch], 3):
            for row, n in zip(block.suffixes().tolist(), block.n.tolist()):
                f[(lang, *(block.words[x] for x in row if x >= 0))] += n
        return f

    want = counted()
    monkeypatch.setattr(c, "BLOCK_BYTES", 200)
    assert counted() == want and sum(want.values()) > 1000
    assert b"".join(c._pieces(b"a b. c" * 300)) == b"a b. c" * 300


def test_long_keys_become_ranks():
    block = c.Block([b"a b c d e f g h a b c d e f g h"], 14)
    assert len(block.n) == 16 and block.n.tolist() == [1] * 16
    assert c.Block([b"a b c d a b c d"], 3).n.tolist().count(2) == 2


def test_groups_keep_the_budget():
    totals = np.zeros(c.SLOTS, dtype=np.int64)
    totals[[1, 2, 3, 70]] = [60, 60, 1000, 5]
    groups = c.Groups(totals, 100)
    assert groups.group[3] == -1 and groups.parts[3] == 10 * c.PARTS
    assert groups.group[1] != groups.group[2] == groups.group[70]
    parts = np.zeros(int(groups.parts.sum()), dtype=np.int64)
    parts[:3] = [500, 60, 60]
    groups.extend(parts)
    assert groups.part_spread[0] == 5 and len({*groups.part_group[:3], *groups.group[[1, 2]]}) == 5


def test_nodes_of_a_subtree():
    block = c.Block([b"a b c. a b d. a b"], 3)
    rows = block.suffixes()
    keep = rows[:, 1] >= 0
    sent = c._send(block, rows[keep], block.n[keep])
    nodes = {tuple(w[x] for x in row): n for cols, totals, w in c.subtree([sent, sent])
             for row, n in zip(cols.T.tolist(), totals.tolist())}
    assert nodes == {(b"a", b"b"): 6, (b"b", b"c"): 2, (b"b", b"d"): 2, (b"a", b"b", b"c"): 2, (b"a", b"b", b"d"): 2}


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(10 ** 15 - 1, 10 ** 15, 10 ** 15 + 7), (3, 7, 10 ** 12), (10, 10, 10), (9 * 10 ** 14, 10 ** 15, 9 * 10 ** 14)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    assert [x[0] for x in df.select(c.exact_score("a", "l", "r")).collect()] == [
        1000000 * a * a // (l * r) for a, l, r in rows]


def test_empty_table_and_one_word(spark):
    assert c.collocations(frame(spark, [])).collect() == []
    assert c.collocations(frame(spark, [(None, None), ("en", "one")])).collect() == []
    with pytest.raises(ValueError):
        c.collocations(frame(spark, []), max_words=1)
