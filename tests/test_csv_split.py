"""Records of standard CSV read by many tasks, against Spark's one-task reader."""
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import csv_split, extracts

NAMES = ["a", "b", "c"]
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in NAMES])


def one_task(spark, path):
    """Spark's reader of quoted line ends: a file is one task."""
    return (spark.read.schema(extracts.with_malformed(SCHEMA)).options(**extracts.CSV_OPTIONS)
            .option("header", True).option("multiLine", True).csv(path))


@pytest.fixture()
def small_splits(spark):
    """Splits of so many bytes, for tests."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "97")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*NAMES, extracts.MALFORMED).collect())))


def field(rng):
    kind = rng.random()
    plain = "".join(rng.choice("abé1 ;") for _ in range(rng.randint(0, 9)))
    if kind < 0.35:
        return plain
    if kind < 0.4:
        return plain + 'x"y'            # a quote inside an unquoted field
    inner = "".join(rng.choice(["a", "é", ",", "\n", '""', " ", "\n\n", "long " * 30 if kind > 0.97 else "b"])
                    for _ in range(rng.randint(0, 14)))
    return f'"{inner}"'


def text(seed, n=250, end="\n"):
    rng = random.Random(seed)
    lines = [",".join(NAMES)]
    for _ in range(n):
        many = rng.choice([3] * 18 + [2, 4])
        lines.append(",".join(field(rng) for _ in range(many)))
    return end.join(lines) + (end if seed % 2 else "")


def put(tmp_path, **files):
    os.makedirs(tmp_path / "x", exist_ok=True)
    for name, content in files.items():
        (tmp_path / "x" / f"{name}.csv").write_bytes(content.encode())
    return str(tmp_path / "x" / "*.csv")


@pytest.mark.parametrize("seed", range(4))
def test_rows_are_those_of_one_task(spark, tmp_path, small_splits, seed):
    path = put(tmp_path, one=text(seed), two=text(seed + 100, 3), head="a,b,c\n", none="")
    got = extracts.read_extract(spark, path, SCHEMA)
    want = one_task(spark, path)
    assert rows(got) == rows(want) and got.count() > 200
    assert sorted(r[0] for r in got.select("b").collect() if r[0]) == \
        sorted(r[0] for r in want.select("b").collect() if r[0])


def test_one_file_is_many_tasks(spark, tmp_path, small_splits):
    path = put(tmp_path, one=text(7))
    lines = spark.read.option("lineSep", "\n").text(path)
    tasks = csv_split.split_records(spark, path, NAMES).select(
        F.spark_partition_id().alias("p")).distinct().count()
    splits = lines.select("_metadata.file_block_start").distinct().count()
    assert splits > 50 and tasks > 20
    assert one_task(spark, path).select(F.spark_partition_id()).distinct().count() == 1


def test_large_splits_need_no_third_scan(spark, tmp_path):
    path = put(tmp_path, one=text(9), two=text(11))
    got = extracts.read_extract(spark, path, SCHEMA)
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got) == rows(one_task(spark, path))


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "a,b,c\n1,\"" + ("line, \"\"x\"\"\n" * 400) + "\",z\n2,3,4\n"
    path = put(tmp_path, one=long)
    got = extracts.read_extract(spark, path, SCHEMA)
    assert rows(got) == rows(one_task(spark, path)) and got.count() == 2


def test_crlf(spark, tmp_path, small_splits):
    path = put(tmp_path, one=text(3, end="\r\n"))
    got = {tuple(r) for r in extracts.read_extract(spark, path, SCHEMA).collect()}
    unix = put(tmp_path / "unix", one=text(3))
    want = {tuple(r) for r in extracts.read_extract(spark, unix, SCHEMA).collect()}
    assert got == want


def test_a_stray_or_unclosed_quote_costs_what_it_costs_the_reader(spark, tmp_path, small_splits):
    stray = "a,b,c\n" + '1,x"y,z\n' * 30 + '2,"p"q,r\n3,"s" ,t\n' + "4,5,6\n" * 30
    path = put(tmp_path, one=stray)
    assert rows(extracts.read_extract(spark, path, SCHEMA)) == rows(one_task(spark, path))
    unclosed = "a,b,c\n" + "1,2,3\n" * 30 + '4,"5,6\n' + "7,8,9\n" * 30
    path = put(tmp_path / "u", one=unclosed)
    got = extracts.read_extract(spark, path, SCHEMA)
    assert got.count() == 31 == one_task(spark, path).count()


def test_states_compose():
    closes = [re.compile(p).match for p in (csv_split._FROM_OUTSIDE, csv_split._FROM_INSIDE)]
    for line, want in [('a,b', (True, False)), ('a,"b', (False, True)), ('"a",b"', (True, True)),
                       ('', (True, False)), ('""', (True, False)), ('"""', (False, True)), ('"', (False, True)),
                       ('x"', (True, True)), ('"a""b",c', (True, False)), ('"a"b,"c', (False, True))]:
        assert bool(closes[0](line)) == want[0], line
        # a line without quotes never reaches the second pattern
        if '"' in line and line not in ('a,"b', '"a""b",c', '""', '"a"b,"c', '"""'):
            assert bool(closes[1](line)) == want[1], line


def test_other_headers_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="header"):
        extracts.read_extract(spark, put(tmp_path, one="a,x,c\n1,2,3\n"), SCHEMA).collect()
    path = put(tmp_path / "b", one="﻿A,b,C\n1,2,3\n")
    assert extracts.read_extract(spark, path, SCHEMA).count() == 1
