"""Leaks against the plain edit distance of every item with every text."""
import random

from tidemark.llm import decontaminate as dc


def least_edits(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d)))
        before = row
    return min(before)


def plain(text):
    return " ".join(text.lower().split())


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghio") for _ in range(rng.randint(2, 7)))
                    for _ in range(n))


def mutated(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        chars[at:at + rng.randint(0, 1)] = rng.choice(["", "z", "Q"])
    return "".join(chars)


def test_leaks_are_those_within_the_budget(monkeypatch):
    monkeypatch.setattr(dc, "CHUNK_CHARS", 900)
    monkeypatch.setattr(dc, "HITS_AT_ONCE", 100)
    rng = random.Random(2)
    items = [(i, words(rng, rng.randint(3, 30))) for i in range(12)]
    bench = dc.Benchmark(items)
    texts, wanted = [], []
    for _ in range(120):
        item = rng.randrange(len(items))
        spoiled = mutated(rng, items[item][1], rng.randint(0, 2 + len(items[item][1]) // 8))
        text = f"{words(rng, rng.randint(0, 12))} {spoiled.upper()}\n\t{words(rng, 5)}"
        texts.append(text)
        found = {}
        for k in range(len(items)):
            edits = least_edits(plain(items[k][1]), plain(text))
            if edits <= bench.edits[k]:
                found[k] = edits
        wanted.append(found)
    for text, found, leaks in zip(texts, wanted, dc.scan(bench, texts)):
        assert {k: min(x[3] for x in leaks if x[0] == k) for k in {x[0] for x in leaks}} == found
        for item, start, end, edits in leaks:
            assert least_edits(plain(items[item][1]), plain(text[start:end])) == edits


def test_short_items_are_found_within_their_budget(monkeypatch):
    """Items of 1 to 31 characters: the whole budget, none skipped."""
    monkeypatch.setattr(dc, "CHUNK_CHARS", 300)
    rng = random.Random(9)
    items = [(m, "".join(rng.choice("abcdefghij kl") for _ in range(m)).strip() or "q") for m in range(1, 32)]
    bench = dc.Benchmark(items)
    assert len(bench.ids) == 31 and bench.edits.tolist() == [len(plain(t)) // 10 for _, t in items]
    assert min(bench.least) >= 1
    texts = []
    for m, item in items * 4:
        spoiled = mutated(rng, item, rng.randint(0, 1 + len(item) // 10))
        texts.append(f"{words(rng, rng.randint(0, 4))} {spoiled} {words(rng, 3)}")
    for text, leaks in zip(texts, dc.scan(bench, texts)):
        want = {}
        for k, (_, item) in enumerate(items):
            edits = least_edits(plain(item), plain(text))
            if edits <= bench.edits[k]:
                want[k] = edits
        assert {k: min(x[3] for x in leaks if x[0] == k) for k in {x[0] for x in leaks}} == want
        for item, start, end, edits in leaks:
            assert least_edits(plain(items[item][1]), plain(text[start:end])) == edits


def test_every_place_of_a_short_item(monkeypatch):
    bench = dc.Benchmark([(1, "No"), (2, "\n ")])
    found = dc.scan(bench, ["no" * 5000, "n o", "", "NO"])
    assert [len(x) for x in found] == [5000, 0, 0, 1]


def test_rows(spark):
    rng = random.Random(5)
    item = words(rng, 20)
    clean = words(rng, 200)
    rows = [(1, f"{clean} {item}"), (2, clean), (3, item.upper().replace(" ", " \n ")), (4, None),
            (5, ""), (1, f"{clean} {item}"), (6, item[:len(item) // 2]),
            (7, f"{item} {item}"), (8, "\U0001f600" * 50 + item), (9, words(rng, 30000) + item)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, edits int")
    bench = spark.createDataFrame([(70, item), (71, None), (72, ""), (73, "short"), (70, item)],
                                  "item_id long, text string")
    got = sorted(map(tuple, dc.leaks(df, bench).collect()))
    # "short" is an item like any other; none of these texts holds it
    assert sorted({r[0] for r in got}) == [1, 3, 7, 8, 9]
    assert [r for r in got if r[0] == 8][0] == (8, 70, 50, 50 + len(item), 0)
    assert [r[2:] for r in got if r[0] == 7 and r[1] == 70][::2] == [
        (0, len(item), 0), (len(item) + 1, 2 * len(item) + 1, 0)]
    assert len([r for r in got if r[0] == 1]) == 4  # two rows, two equal items
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]


def test_shards_find_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, words(rng, 12)) for i in range(9)]
    df = spark.createDataFrame([(i, f"{words(rng, 9)} {t} x") for i, t in items],
                               "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.leaks(df, bench).collect()))
    monkeypatch.setattr(dc, "SHARD_CHARS", 200)
    assert sorted(map(tuple, dc.leaks(df, bench).collect())) == whole and len(whole) == 9


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text here")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some text here")], "item_id long, text string")
    assert dc.leaks(docs.limit(0), bench).collect() == []
    assert dc.leaks(docs, bench.limit(0)).collect() == []
    assert [r.doc_id for r in dc.clean(docs, bench.limit(0)).collect()] == [1]
