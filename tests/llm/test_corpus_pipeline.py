"""The pipeline against stages by brute force, each on what the last one kept."""
import tiktoken
from conftest import SF_SMALL
from test_jaccard import brute as components

import corpus_pipeline
from tidemark.llm import bpe, quality, queries
from tidemark.llm.common import table


def test_run_is_the_stages_by_brute_force(spark):
    docs = {r.doc_id: r for r in table(spark, SF_SMALL, "documents").collect()}
    judged = quality.classify(spark, table(spark, SF_SMALL, "documents"),
                              table(spark, SF_SMALL, "labels"))
    kept = {r.id for r in judged.collect() if r.keep}
    assert 0.5 * len(docs) < len(kept) < len(docs)
    kept = {i for i, _, c in components([(i, docs[i].text) for i in sorted(kept)]) if i == c}

    def plain(t):
        return " ".join((t or "").lower().split())

    items = [plain(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    kept = {i for i in kept if not any(x in plain(docs[i].text) for x in items)}
    path, pattern = queries.tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                                mergeable_ranks=bpe.codec(path, pattern).vocab.ranks)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == kept
    for i, r in got.items():
        assert r.token_ids == library.encode_ordinary(docs[i].text) and r.n_tokens == len(r.token_ids)


def test_stages_keep_the_columns_and_take_any_rows(spark):
    rows = [(1, None, None, None, 0, "x"), (2, "", "en", "s", 0, "x"),
            (3, "word " * 3, "en", "s", 15, "x"), (3, "word " * 3, "en", "s", 15, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string,"
                                       " n_chars long, keep string")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF_SMALL)
            assert out.columns == docs.columns
            out.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, frame, SF_SMALL)
        assert len(last.collect()) == frame.count()


def test_stages_decide_by_row(spark):
    """Repeated and null ids: a copy, a leak or junk goes, its clean namesake stays."""
    import random
    rng = random.Random(4)
    item = table(spark, SF_SMALL, "benchmark").first().text

    def prose(n):
        return " ".join("".join(rng.choice("aeinrstl") for _ in range(rng.randint(3, 8))) for _ in range(n))

    clean, other, third = prose(60), prose(60), prose(60)
    rows = [(7, clean), (7, clean), (None, clean), (7, f"{other} {item}"), (None, f"{prose(40)} {item}"),
            (None, third), (9, third), (None, ""), (None, None), (8, other)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    copies = sorted(map(repr, ((r.doc_id, r.text) for r in stages["ngram_jaccard_join"](
        spark, docs, SF_SMALL).collect())))
    left = [(7, clean), rows[3], rows[4], (9, third), (None, ""), (None, None), (8, other)]
    assert copies == sorted(map(repr, left))
    leaks = [(r.doc_id, r.text) for r in stages["benchmark_decontamination"](
        spark, docs, SF_SMALL).collect()]
    assert sorted(map(repr, leaks)) == sorted(map(repr, [r for r in rows if not (r[1] or "").endswith(item)]))
    good = table(spark, SF_SMALL, "documents").join(
        table(spark, SF_SMALL, "labels").filter("quality = 1"), "doc_id").select(docs.columns)
    text = good.first().text
    junk = spark.createDataFrame([(-5, "#$% @@ ~~ " * 40, "en", "s", 1), (None, "zzq xxj " * 90, "en", "s", 1),
                                  (-5, text, "en", "s", 1), (None, text, "en", "s", 1)], docs.schema)
    kept = stages["quality_classifier"](spark, good.unionByName(junk), SF_SMALL).collect()
    assert sum(r.text == text for r in kept) >= 3
    assert not any((r.text or "").startswith(("#$%", "zzq")) for r in kept)
