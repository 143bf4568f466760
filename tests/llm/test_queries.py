"""The registered queries: against SQL where there is any, else by brute force."""
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry
from tidemark.llm import bpe, decontaminate, queries
from tidemark.llm.common import table

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF_SMALL).select(*columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_op1_and_op3_against_the_library(spark):
    path, pattern = queries.tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                                mergeable_ranks=bpe.codec(path, pattern).vocab.ranks)
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    want = {i: len(library.encode_ordinary(t or "")) for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in queries.op1_bpe(spark, SF_SMALL).collect()} == want
    assert {r.doc_id: r.n_tokens for r in queries.op3_token_counts(spark, SF_SMALL).collect()} == want
    assert public_tokenizers.PATTERN == pattern


def test_op2_takes_the_article(spark):
    import re
    from html import unescape
    pages = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}
    for r in queries.op2_html(spark, SF_SMALL).collect():
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        inner = re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", inner))
        assert r.text == " ".join(unescape(inner).split()) and r.n_chars == len(r.text)


def test_op4_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_CHECK, "embeddings").collect()]
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = total = 0
    found = {}
    for r in queries.op4_ann(spark, SF_CHECK).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for k in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[k]
        score[k] = -2
        hits += len(found[ids[k]] & set(ids[np.argsort(-score)[:5]].tolist()))
        total += 5
    assert hits >= 0.9 * total


def test_op8_finds_every_whole_passage(spark):
    def plain(t):
        return " ".join((t or "").lower().split())

    docs = {r.doc_id: plain(r.text) for r in table(spark, SF_SMALL, "documents").collect()}
    items = {r.item_id: plain(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = queries.op8_decontaminate(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.edits == 0} == want and want
    assert decontaminate.Q == 8
