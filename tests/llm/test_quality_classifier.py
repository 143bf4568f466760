"""Kneser-Ney against a plain dictionary version, and held-out accuracy."""
import collections
import math

import numpy as np
import pytest
from conftest import SF_CHECK

from tidemark.llm import quality as kn
from tidemark.llm.common import table


def brute_model(texts):
    """Probability function over tuples of symbols, by dictionaries."""
    def grams(text):
        s = [kn.BEGIN] * (kn.ORDER - 1) + kn.symbols(text).tolist()
        return [tuple(s[i:i + kn.ORDER]) for i in range(len(s) - kn.ORDER + 1)]

    counts = collections.Counter(g for t in texts for g in grams(t))
    orders = {}
    for n in range(kn.ORDER, 0, -1):
        of = collections.Counter(counts.values())
        d1, d2, d3 = kn.discounts(of[1], of[2], of[3], of[4])
        total, weight = collections.Counter(), collections.Counter()
        for g, c in counts.items():
            d = d1 if c == 1 else d2 if c == 2 else d3
            total[g[:-1]] += c
            weight[g[:-1]] += d
        orders[n] = (counts, (d1, d2, d3), total, weight)
        counts = collections.Counter(g[1:] for g in counts)

    def p(g):
        if not g:
            return 1 / (1 << kn.BITS)
        counts, (d1, d2, d3), total, weight = orders[len(g)]
        lower = p(g[1:])
        if g[:-1] not in total:
            return lower
        c = counts.get(g, 0)
        d = 0 if not c else d1 if c == 1 else d2 if c == 2 else d3
        return (c - d + weight[g[:-1]] * lower) / total[g[:-1]]

    return lambda text: [math.log(p(g)) for g in grams(text)], p


TEXTS = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "on the the mat 12", "café the cat"]


@pytest.mark.parametrize("shard_rows, in_memory", [(1_000_000, 4), (20, 0)])
def test_probabilities_are_those_of_the_plain_version(spark, monkeypatch, shard_rows, in_memory):
    monkeypatch.setattr(kn, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(kn, "SHARDS_IN_MEMORY", in_memory)
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    model = kn.train(df, "text")
    brute, p = brute_model(TEXTS)
    for text in [*TEXTS, "the zebra", "mat mat mat", "x", "中文 cat"]:
        got = kn.log_probabilities(kn.ngrams(text), *model)
        assert got == pytest.approx(brute(text))
    context = tuple(kn.symbols("the"))
    assert sum(p((*context, s)) for s in range(1 << kn.BITS)) == pytest.approx(1)


def test_symbols_mark_repetition_and_digits():
    s = kn.symbols("No no  NO\nyes 19").tolist()
    assert s == [*map(ord, "No "), kn.REPEAT, 32, kn.REPEAT + 1, *map(ord, " yes 00")]
    assert kn.symbols("a " * 9).tolist()[-1] == kn.REPEAT + kn.RUNS - 1
    assert all(0 <= x < 1 << kn.BITS for x in kn.symbols("\U0001f600 ￿ Ͽ 豈 힣 z"))
    assert kn.symbols("жא中").tolist() == [*map(ord, "жא中")]


def test_counts_of_counts_may_be_zero():
    for counts in [(0, 0, 0, 0), (5, 0, 0, 0), (5, 2, 0, 0), (1, 9, 9, 9), (9, 1, 1, 50)]:
        d1, d2, d3 = kn.discounts(*counts)
        assert 0 < d1 < 1 and 0 < d2 < 2 and 0 < d3 < 3


def fluent(rng):
    return " ".join(rng.choice(["the", "house", "stands", "near", "a", "river", "and", "it",
                                "rains", "often", "there"]) for _ in range(rng.integers(5, 60)))


def test_rows(spark):
    rng = np.random.default_rng(1)
    docs = [(i, fluent(rng), "en" if i % 2 else "xx", 0.5) for i in range(400)]
    junk = [(1000, "#$% @@ ~~ " * 20, "en", 1.0), (1001, "river " * 200, "xx", 1.0),
            (1002, "ZXQ JJK " * 20, None, 1.0), (1003, "", "en", 1.0), (1004, None, None, 1.0),
            (1001, "river " * 200, "xx", 1.0)]
    odd = [(2000, fluent(rng), None, 1.0), (2001, fluent(rng), "never seen", 1.0),
           (2002, "the house " * 1 + fluent(rng) * 3000, "en", 1.0)]
    df = spark.createDataFrame(docs + junk + odd,
                               "doc_id long, text string, lang string, perplexity double")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(300)] + [(1000, 0, 0), (5, 0, 0), (None, 1, 0), (99999, 1, 0)],
        "doc_id long, quality int, toxic int")
    kept = kn.kept(spark, df, labels)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(400), 2000, 2001, 2002]
    judged = kn.classify(spark, df, labels).collect()
    assert len(judged) == df.count()
    assert all((r.perplexity is None) == (r.id in (1003, 1004)) for r in judged)


@pytest.mark.parametrize("words, letters", [
    ("дом стоит у реки и там часто идёт дождь а потом снова светит солнце", "абвгдежзийклмнопрстуфхцчшщъыьэюя"),
    ("我们 今天 去 河边 看 房子 明天 他们 再 回来 学习 中文", "的一是不了人在有这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长")])
def test_junk_in_other_scripts_is_rejected(spark, words, letters):
    rng = np.random.default_rng(2)
    said = words.split()
    good = [(i, " ".join(rng.choice(said) for _ in range(rng.integers(20, 80))), "xx") for i in range(400)]
    junk = [(1000 + i, " ".join("".join(rng.choice(list(letters)) for _ in range(rng.integers(2, 8)))
                                for _ in range(60)), "xx") for i in range(20)]
    df = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in kn.kept(spark, df, labels).collect()) == list(range(400))


def sample(sizes):
    """(lang, entropy) of held-out documents; a language's own level and span,
    the same for any size but for its first rows."""
    place = {lang: (1.5 + 0.2 * i, 0.1 + 0.05 * i) for i, lang in enumerate(sorted(sizes))}
    return [(lang, place[lang][0] + place[lang][1] * ((j * 37) % 101) / 101)
            for lang, n in sizes.items() for j in range(n)]


def plain_limits(rows):
    """The limits by sorted lists; the key None is for all."""
    def quantiles(x):
        x = sorted(x)
        return x[math.ceil(len(x) * 0.5) - 1], x[math.ceil(len(x) * 0.99) - 1]

    by_lang = collections.defaultdict(list)
    for lang, e in rows:
        by_lang[lang].append(e)
    level, top = quantiles(e for _, e in rows)
    spread = top - level
    own = {g: (len(x) / (len(x) + kn.LEVEL), len(x) / (len(x) + kn.SPREAD), *quantiles(x))
           for g, x in by_lang.items()}
    median = {g: w * m + (1 - w) * level for g, (w, _, m, _) in own.items()}
    low, high = quantiles(e - median[g] for g, e in rows)
    out = {None: level + kn.REACH * spread}
    for g, (w, v, m, top) in own.items():
        span = v * (top - m) + (1 - v) * (w * (high - low) + (1 - w) * spread)
        out[g] = median[g] + kn.REACH * span
    return out


def test_limits_have_no_step(spark):
    got = {}
    for n in (5, 99, 100, 101):
        rows = sample({"aa": 900, "bb": n, "cc": 400, "dd": 5})
        df = spark.createDataFrame(rows, "lang string, entropy double")
        by_lang, _, limit = kn.limits(df)
        want = plain_limits(rows)
        got[n] = {r.q_lang: r.limit for r in by_lang.collect()}
        assert limit == pytest.approx(want.pop(None)) and got[n] == pytest.approx(want)
        assert all(abs(x - limit) > 0.01 for x in got[n].values())  # also of few documents
    assert abs(got[99]["bb"] - got[100]["bb"]) < 0.01 > abs(got[100]["bb"] - got[101]["bb"])
    assert kn.limits(df.limit(0))[1:] == (None, None)


def test_without_trusted_text_or_rows(spark):
    df = spark.createDataFrame([(1, "some text", "en"), (2, None, "en")],
                               "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert {r.id: r.keep for r in kn.classify(spark, df, labels).collect()} == {1: True, 2: False}
    assert kn.classify(spark, df.limit(0), labels).collect() == []


def test_accuracy_on_labels(spark):
    """Labelled documents, of which a fifth of the good ones was held out."""
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    judged = kn.classify(spark, docs, labels).join(
        labels.withColumnRenamed("doc_id", "id"), "id").collect()
    good = [r.keep for r in judged if r.quality == 1]
    bad = [r.keep for r in judged if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
