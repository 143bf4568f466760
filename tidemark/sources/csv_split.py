"""Standard CSV with quoted line ends, read by many tasks.

Spark splits a text file at line ends, but a line end inside quotes ends no
record, and a task that begins in the middle of a file cannot see whether it is
inside quotes. Whether a line leaves a quoted field open depends only on whether
one is open before it, so a line, and any run of lines, is a map of two states
(outside, inside) to themselves, and maps compose:

1. every split of the file (a byte range that Spark reads in one task) is
   reduced to its map, from both states at once;
2. a prefix scan over the splits of a file gives each split its state at the
   start: the last split whose map is constant fixes it, and each exchange of
   the two states since then turns it round;
3. every split is read again from its true state. Records that lie in it leave
   as they are. A record that crosses the end of a split comes as parts, at most
   two for a split, which are put together by a group of their own.

Quotes follow the reader of Spark: a field is quoted if it begins with a quote; a
doubled quote is a quote; what follows the closing quote, up to the delimiter or
line end, belongs to the field; a quote inside an unquoted field is a character.

The text is scanned twice, in parallel, and a third time if a record crosses; only
the parts of such records are shuffled. The first scan runs when the extract is
opened. Its result, one row for each split (a hundred bytes for
spark.sql.files.maxPartitionBytes of input), is written under the checkpoint folder
and broadcast to the others. An unclosed quote makes the
rest of its file one record, which one task holds, as in any CSV reader. Lines
end with LF or CRLF. A record of no characters is skipped. Empty files and files
of a header alone give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

# A field up to its delimiter or the end of the line; nothing matches a quoted
# field that the line leaves open.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_FROM_OUTSIDE = rf'{_FIELD}(?:,{_FIELD})*+\Z'
_FROM_INSIDE = rf'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\Z'

WHOLE, HEAD, MIDDLE, TAIL = range(4)  # a record, or the part of one that a split ends, holds, begins


def _neighbours():
    """A function that gives (split, start, lines) of the neighbouring lines of one
    split in a batch. Tasks are nested functions, so that they travel by value and
    workers need not have this package."""
    def runs(batch):
        import pyarrow.compute as pc
        found = pc.run_end_encode(batch.column(0))
        lo = 0
        for split, hi in zip(found.values.to_pylist(), found.run_ends.to_pylist()):
            yield split, lo, batch.column(1).slice(lo, hi - lo)
            lo = hi
    return runs


def _maps(outside_pattern: str, inside_pattern: str):
    """Task of step 1: (split, whether a quoted field is open at its end if none,
    or one, is open at its start)."""
    runs = _neighbours()

    def run(batches):
        import re

        import pyarrow as pa
        import pyarrow.compute as pc
        closes = re.compile(outside_pattern).match, re.compile(inside_pattern).match
        current, ends = None, [False, True]

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([current]), pa.array([ends[0]]), pa.array([ends[1]])],
                names=["split", "from_outside", "from_inside"])

        for batch in batches:
            for split, _, lines in runs(batch):
                if split != current:
                    if current is not None:
                        yield row()
                    current, ends = split, [False, True]
                # a line without quotes changes nothing
                for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                    after = [not close(line) for close in closes]
                    ends = [after[state] for state in ends]
        if current is not None:
            yield row()
    return run


def _records(outside_pattern: str, inside_pattern: str, names: list[str], whole: bool):
    """Task of step 3: (split, part, text) of whole records, or of the others."""
    runs = _neighbours()

    def run(batches):
        import csv
        import re

        import pyarrow as pa
        import pyarrow.compute as pc
        from_outside, from_inside = re.compile(outside_pattern).match, re.compile(inside_pattern).match
        current, open_lines, begun_here, header = None, None, False, False

        def table(split, part, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([split] * n, pa.string()), pa.array([part] * n, pa.int32()),
                 pa.array(texts, pa.string())], names=["split", "part", "text"])

        def end_of_split():
            if header and open_lines is not None:
                raise ValueError(f"the header of {current} is longer than a split")
            if open_lines is not None and not whole:
                yield table(current, TAIL if begun_here else MIDDLE, ["\n".join(open_lines)])

        def without_header(records):
            nonlocal header
            kept = [r[:-1] if r.endswith("\r") else r for r in records]
            kept = [r for r in kept if r]
            if header and kept:
                header = False
                found = next(csv.reader([kept[0].lstrip("﻿")]))
                if [x.lower() for x in found] != [x.lower() for x in names]:
                    raise ValueError(f"the header of {current} does not conform to the schema: "
                                     f"{found} instead of {names}")
                return kept[1:]
            return kept

        for batch in batches:
            states = batch.column(2)
            for split, lo, lines in runs(batch):
                if split != current:
                    yield from end_of_split()
                    current, header = split, split.endswith("#0")
                    inside = states[lo].as_py()
                    if inside is None:
                        raise ValueError(f"{split} was no split when the quotes were scanned")
                    open_lines, begun_here = ([] if inside else None), False
                if open_lines is None and not header and not whole and not pc.any(
                        pc.match_substring(lines, '"')).as_py():
                    continue
                done = []
                for line in lines.to_pylist():
                    if open_lines is None:
                        if '"' not in line or from_outside(line):
                            done.append(line)
                        else:
                            open_lines, begun_here = [line], True
                    else:
                        open_lines.append(line)
                        if '"' in line and from_inside(line):
                            record, open_lines = "\n".join(open_lines), None
                            if begun_here:
                                done.append(record)
                            elif not whole:
                                yield table(split, HEAD, [record])
                done = without_header(done)
                if whole and done:
                    yield table(split, WHOLE, done)
        yield from end_of_split()
    return run


def _start_states(maps: DataFrame) -> DataFrame:
    """(split, inside): whether a quoted field is open where the split begins."""
    place = maps.select(
        "*", F.expr("substring_index(split, '#', -1)").cast("long").alias("start"),
        F.expr("left(split, length(split) - length(substring_index(split, '#', -1)) - 1)").alias("file"))
    # A map is constant, the exchange of the two states, or leaves both.
    before = (Window.partitionBy("file").orderBy("start")
              .rowsBetween(Window.unboundedPreceding, -1))
    up_to = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("from_outside") == F.col("from_inside")
    turned = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("long"))
    scanned = place.withColumn("turns", turned.over(up_to)).select(
        "split",
        F.coalesce(turned.over(before), F.lit(0)).alias("turns_before"),
        F.last(F.when(constant, F.struct("from_outside", "turns")), ignorenulls=True)
        .over(before).alias("fixed"))
    since = F.col("turns_before") - F.coalesce("fixed.turns", F.lit(0))
    return scanned.select("split", (F.coalesce("fixed.from_outside", F.lit(False))
                                    != (since % 2 == 1)).alias("inside"))


def split_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The records of a file, folder or glob as (text), header lines checked
    against `names` and taken out, line ends inside quotes kept."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.concat("_metadata.file_path", F.lit("#"), "_metadata.file_block_start").alias("split"),
                     "value"))
    maps = lines.mapInArrow(_maps(_FROM_OUTSIDE, _FROM_INSIDE),
                            "split string, from_outside boolean, from_inside boolean")
    # Written, so that the broadcast below only reads a small file.
    states = materialize(_start_states(maps), "csv-splits")

    def read(whole: bool) -> DataFrame:
        # the join adds a column to the lines where they are; their order stays
        return lines.join(F.broadcast(states), "split", "left").select(
            "split", "value", "inside").mapInArrow(
            _records(_FROM_OUTSIDE, _FROM_INSIDE, names, whole), "split string, part int, text string")

    records = read(True).select("text")
    if states.where("inside").isEmpty():
        return records  # no record crosses the end of a split
    parts = read(False).select(
        F.expr("left(split, length(split) - length(substring_index(split, '#', -1)) - 1)").alias("file"),
        F.expr("substring_index(split, '#', -1)").cast("long").alias("start"), "part", "text")
    number = F.sum((F.col("part") == TAIL).cast("long")).over(
        Window.partitionBy("file").orderBy("start", "part"))
    crossing = (parts.withColumn("number", number).groupBy("file", "number")
                .agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("parts"))
                .select(F.array_join("parts.text", "\n").alias("text"))
                .select(F.expr("if(endswith(text, '\r'), left(text, length(text) - 1), text)").alias("text")))
    return records.unionByName(crossing)
