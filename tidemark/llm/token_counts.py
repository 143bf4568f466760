"""Token counts from flat token files that have no index.

A token file holds the ids of many documents one after the other, each closed
by the end-of-document identifier, and nothing else. Its only structure is
where that identifier stands, so the count of every document is found by a
scan:

1. files are cut into blocks of BLOCK_TOKENS ids, dealt out to tasks;
2. a task reads its block's byte range and finds all separators in one
   vectorised comparison: it returns the ids between neighbouring separators,
   and the positions of its first and last separator;
3. a prefix scan over the block summaries of a file (a running sum of separator
   counts, and the last separator before the block) gives each block the number
   of its first document and the ids of it that lie in earlier blocks.

Only block summaries and counts are shuffled. A file's scan holds one row per
block of that file. Files are written one per task, so their size is that of a
task's input.

Nulls are empty texts (a lone separator, count 0); an empty table gives no file
and no rows; repeated rows are counted each by itself. Ids after the last
separator of a file belong to no closed document: `scan_counts` returns them as
one more document with `closed` false.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import _rows, codec
from tidemark.llm.common import open_shared, persist, read_tasks, scratch_dir, tidy

BLOCK_TOKENS = 1 << 20


def id_type(vocab_size: int) -> str:
    """Little-endian unsigned ids, 16 bits where they suffice."""
    return "<u2" if vocab_size < 1 << 16 else "<u4"


def write_token_files(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str,
                      separator: int, folder: str) -> DataFrame:
    """Encode the texts and write one flat file per task under `folder`.

    Returns what is known besides the files, written as Parquet: rows (file,
    ordinal, id) for the documents, in file order, and one row (file, NULL,
    NULL, n_bytes) per file. Each attempt of a task writes a file of its own
    name and only rows of the attempt that Spark commits are returned, so a
    lost executor leaves at most a file that nobody names."""
    kind = dict(df.dtypes)[id_col]
    source = df.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    @tidy
    def run(batches):
        filesystem, base = open_shared(folder)
        c = codec(path, pattern)
        dtype = id_type(max(c.vocab.size, separator + 1))
        end = np.array([separator], dtype=dtype).tobytes()
        name = f"{uuid.uuid4().hex}.tokens"
        out, ordinal, size, ids_type = None, 0, 0, None
        for batch in batches:
            if out is None:
                filesystem.create_dir(base, recursive=True)
                out = filesystem.open_output_stream(f"{base}/{name}")
                ids_type = batch.column(0).type
            for ids in c.encode_all(_rows(batch, 1)):
                data = np.frombuffer(ids, dtype="<u4").astype(dtype).tobytes() + end
                out.write(data)
                size += len(data)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()),
                 pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column(0),
                 pa.nulls(n, pa.int64())], names=["file", "ordinal", "id", "n_bytes"])
            ordinal += n
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, ids_type),
                 pa.array([size], pa.int64())], names=["file", "ordinal", "id", "n_bytes"])

    return persist(source.mapInArrow(
        run, f"file string, ordinal long, id {kind}, n_bytes long"), "token-files")


def scan_counts(files: DataFrame, folder: str, separator: int, dtype: str = "<u2",
                block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token counts of flat files. files: (file, n_bytes). Returns (file,
    ordinal, n_tokens, closed): documents by their order in the file."""
    width = np.dtype(dtype).itemsize
    step = block_tokens * width
    total = files.agg(F.sum("n_bytes"), F.sum(F.ceil(F.col("n_bytes") / step))).first()
    tasks = read_tasks(files.sparkSession, total[0] or 0, total[1] or 0)
    blocks = (files.select("file", F.col("n_bytes").cast("long").alias("n_bytes"))
              .filter("n_bytes > 0")
              .select("file", "n_bytes", F.explode(F.expr(
                  f"sequence(0L, n_bytes - 1, {step}L)")).alias("start"))
              .withColumn("size", F.least(F.lit(step), F.col("n_bytes") - F.col("start")))
              .withColumn("last_block", F.expr("start + size = n_bytes"))
              .drop("n_bytes")
              .repartition(tasks, "file", "start"))

    @tidy
    def run(batches):
        filesystem, base = open_shared(folder)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                with filesystem.open_input_file(f"{base}/{row['file']}") as f:
                    ids = np.frombuffer(f.read_at(row["size"], row["start"]), dtype=dtype)
                at = np.flatnonzero(ids == separator)
                first = row["start"] // width
                out.append((row["file"], row["start"], first, first + len(ids), row["last_block"],
                            len(at), int(first + at[0]) if len(at) else None,
                            int(first + at[-1]) if len(at) else None,
                            (np.diff(at) - 1).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(SUMMARY.types)],
                schema=SUMMARY)

    summaries = blocks.mapInArrow(
        run, "file string, start long, from_id long, to_id long, last_block boolean, n_sep int,"
             " first_sep long, last_sep long, gaps array<int>")
    # The prefix scan: what lies before the block in its file.
    earlier = (Window.partitionBy("file").orderBy("start")
               .rowsBetween(Window.unboundedPreceding, -1))
    scanned = (summaries
               .withColumn("docs_before", F.coalesce(F.sum("n_sep").over(earlier), F.lit(0)))
               .withColumn("sep_before", F.coalesce(
                   F.last("last_sep", ignorenulls=True).over(earlier), F.lit(-1))))
    # Per block: the document its first separator closes, the documents between
    # its separators, and in the last block what follows the last separator.
    stitched = scanned.select(
        "file", "docs_before",
        F.expr("""concat(
            if(n_sep > 0, array(first_sep - sep_before - 1), cast(array() as array<long>)),
            cast(gaps as array<long>))""").alias("closed_counts"),
        F.expr("""if(last_block, to_id - 1 - coalesce(last_sep, sep_before), 0L)""").alias("open"),
        "n_sep")
    return stitched.select(
        "file", "docs_before", F.explode(F.expr("""concat(
            transform(closed_counts, (n, i) -> struct(i as i, n as n, true as closed)),
            if(open > 0, array(struct(n_sep as i, open as n, false as closed)),
               cast(array() as array<struct<i: int, n: bigint, closed: boolean>>)))"""))
        .alias("d")).select(
        "file", (F.col("docs_before") + F.col("d.i")).alias("ordinal"),
        F.col("d.n").alias("n_tokens"), F.col("d.closed").alias("closed"))


SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("from_id", pa.int64()),
                     ("to_id", pa.int64()), ("last_block", pa.bool_()), ("n_sep", pa.int32()),
                     ("first_sep", pa.int64()), ("last_sep", pa.int64()),
                     ("gaps", pa.list_(pa.int32()))])


def token_counts(spark: SparkSession, df: DataFrame, id_col: str, text_col: str, path: str,
                 pattern: str, separator: int, folder: str | None = None,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the token files of `df` and count them by the scan: (id_col,
    n_tokens), one row per row of `df`. The documents' order inside a file,
    kept when it was written, gives the counts their ids back."""
    folder = folder or scratch_dir(spark, "tokens")
    known = write_token_files(df, id_col, text_col, path, pattern, separator, folder)
    with_size = known.filter("n_bytes is not null").select("file", "n_bytes")
    dtype = id_type(max(codec(path, pattern).vocab.size, separator + 1))
    counts = scan_counts(with_size, folder, separator, dtype, block_tokens).filter("closed")
    names = known.filter("ordinal is not null").select("file", "ordinal", "id")
    # Both sides are a row per document: no broadcast, however small they look.
    return (names.hint("merge").join(counts, ["file", "ordinal"])
            .select(F.col("id").alias(id_col), "n_tokens"))
