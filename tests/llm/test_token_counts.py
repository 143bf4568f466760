"""Separator scan: block stitching by brute force, and counts of whole tables."""
import random

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import bpe, token_counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
END = 50256


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_stitching_over_any_block_size(spark, tmp_path, block):
    rng = random.Random(block)
    files = {f"f{i}": [rng.choice([0, 0, 1, 2, 5, 9]) for _ in range(rng.randint(0, 12))]
             for i in range(4)} | {"open": [3, 0], "empty": [], "only-open": []}
    sizes = []
    for name, counts in files.items():
        ids = [x for n in counts for x in [7] * n + [END]]
        ids += [7] * {"open": 5, "only-open": 4}.get(name, 0)
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        sizes.append((name, 2 * len(ids)))
    df = spark.createDataFrame(sizes, "file string, n_bytes long")
    got = sorted(map(tuple, token_counts.scan_counts(df, str(tmp_path), END,
                                                     block_tokens=block).collect()))
    want = [(name, i, n, True) for name, counts in files.items() for i, n in enumerate(counts)]
    want += [("open", 2, 5, False), ("only-open", 0, 4, False)]
    assert got == sorted(want)


def test_counts_of_a_table(spark):
    texts = [None, "", "a", "a", "b c d " * 9000, "\u00fc"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ordinal string").repartition(3)
    got = token_counts.token_counts(spark, df, "doc_id", "text", PATH, PATTERN, END,
                                    block_tokens=1000)
    codec = bpe.codec(PATH, PATTERN)
    want = {i: len(x) // 4 for i, x in enumerate(codec.encode_all(texts))}
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(spark, df, "doc_id", "text", PATH, PATTERN,
                                     END).collect() == []


def test_blocks_are_dealt_to_tasks_by_their_bytes(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.llm import common
    monkeypatch.setattr(common, "READ_BYTES", 200)
    (tmp_path / "f").write_bytes(np.array([7, END] * 2000, "<u2").tobytes())
    df = spark.createDataFrame([("f", 8000)], "file string, n_bytes long")
    got = token_counts.scan_counts(df, str(tmp_path), END, block_tokens=50)
    assert got.count() == 2000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file#" in plan and ", 40), REPARTITION_BY_NUM" in plan
    assert common.read_tasks(spark, 10 ** 6, 3) == 3 and common.read_tasks(spark, 0, 0) == 1
    assert common.read_tasks(spark, 10 ** 6, 10 ** 9) == 5000
