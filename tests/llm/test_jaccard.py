"""Components against all pairs, with every limit made small."""
import random

import pytest

from tidemark.llm import jaccard


def sets(rows, n=5):
    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        out.append((i, {b" ".join(words[k:k + n]) for k in range(max(1, len(words) - n + 1))}
                    if words else set()))
    return out


def brute(rows, percent=80, n=5):
    docs = sets(rows, n)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            x, y = docs[a][1], docs[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, x) in enumerate(docs):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(x), least[find(k)] if x else i) for k, (i, x) in enumerate(docs))


def corpus(seed):
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randint(0, 4000)}" for _ in range(n)]

    passage, texts = words(40), []
    for _ in range(60):  # a passage that unrelated documents share
        texts.append(words(rng.randint(0, 30)) + passage + words(rng.randint(0, 30)))
    for size, edits in ((50, 6), (8, 2), (30, 12)):  # near copies, more and less edited
        base = words(120)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = words(rng.randint(0, 1))
            texts.append(copy)
    for _ in range(3):  # copies of copies, so that a chain is needed
        texts.append(words(100))
        for _ in range(12):
            copy = list(texts[-1])
            copy[rng.randrange(len(copy))] = words(1)[0]
            texts.append(copy)
    texts += [texts[0], texts[0], words(3), words(4), ["A", "b"], ["a", "B"], ["x"] * 40]
    rows = [(i, rng.choice([" ", "\n", "\x0b "]).join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [(i, rows[i][1]) for i in range(len(rows))] + [(9000, None), (9001, ""), (9002, " \n")]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "doc_id long, text string, component_id int").repartition(3)
    return sorted(tuple(r) for r in jaccard.near_duplicates(df, **options).collect())


@pytest.mark.parametrize("seed, hot", [(1, 16), (2, 4)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "BLOCK_NGRAMS", 2000)
    monkeypatch.setattr(jaccard, "MATCHES_AT_ONCE", 500)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_without_hot_ngrams(spark, monkeypatch):
    """Stars then come from full buckets alone."""
    monkeypatch.setattr(jaccard, "HOT", 3)
    monkeypatch.setattr(jaccard, "hot_ngrams", lambda *a: jaccard.np.empty(0, "int64"))
    rows = corpus(3)[:150]
    assert run(spark, rows) == brute(rows)


def test_ids_and_edges(spark):
    text = " ".join(f"v{i}" for i in range(12))
    rows = [(5, text), (5, text), (3, text + " more"), (7, "other words here"), (-2, "One two"),
            (8, "one  two"), (9, "one two three four five"), (10, "É x"), (11, "é x"),
            (12, " ".join(f"z{i}" for i in range(30000))),
            (13, " ".join(f"z{i}" for i in range(29000)))]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_prefixes_and_fragments():
    np = jaccard.np
    assert [jaccard.prefix_length(n, 80) for n in (1, 4, 5, 10, 11)] == [1, 1, 2, 3, 3]
    grams = np.sort(np.random.default_rng(1).integers(-2**63, 2**63 - 1, 1000))
    of = jaccard._fragment_of(grams)
    assert (np.diff(of) >= 0).all() and set(of) == set(range(jaccard.FRAGMENTS))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, jaccard.connected_components(df).collect()))
    assert got == {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}
