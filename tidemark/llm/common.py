"""Helpers shared by the operators: table access, shared scratch files and
large semi / anti joins that shuffle only the rows that can match."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# A membership bitmap has at most this many bits: as rows of 64 bits it is at
# most 262,144 rows, the proven bound of its broadcast.
MAX_BITMAP_BITS = 1 << 24
READ_BYTES = 128 << 20  # read by one task
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver
    found it: once per Spark application, as `--py-files` would do."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    # The driver serves the file to the executors for as long as it runs.
    bundle = f"{tempfile.mkdtemp(prefix='tidemark-code-')}/tidemark.zip"
    with zipfile.ZipFile(bundle, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(bundle)
    context._tidemark_shipped = True


def shipped(query):
    """A query or stage (spark, ...) that ships the package first, and keeps
    Arrow batches small where the session has Spark's default: texts are long,
    and a worker holds a whole batch."""
    @functools.wraps(query)
    def run(spark, *args):
        ship(spark)
        if spark.conf.get(BATCH_ROWS) == "10000":
            spark.conf.set(BATCH_ROWS, "2000")
        return query(spark, *args)
    return run


def tidy(run):
    """A function of Arrow batches that gives freed memory back to the system
    when its task ends: workers are used again, by other operators too."""
    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            import pyarrow
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)
    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder the session names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage is
    cut and a lost executor only costs reading files again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, name: str = "__row") -> DataFrame:
    """`df` with a key of its own for every row, whatever its columns hold, and the
    same each time it is computed: the file and place it is read from; a table that
    is no scan of Parquet files is written first."""
    if "_metadata" not in df.columns:
        try:
            return df.select("*", F.concat_ws(
                "#", F.xxhash64("_metadata.file_path").cast("string"),
                F.expr("cast(_metadata.row_index as string)")).alias(name))
        except AnalysisException:  # its rows come from elsewhere
            pass
    return persist(df.withColumn(name, F.monotonically_increasing_id().cast("string")), "rows")


def open_shared(path: str):
    """(filesystem, path inside it) of a shared folder or file, for tasks that
    read byte ranges or write files. Any store that pyarrow opens will do."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def read_tasks(spark: SparkSession, n_bytes: int, n_rows: int) -> int:
    """Into how many partitions to deal rows that name byte ranges of files: such
    rows are small, so their own size, which Spark sees, says nothing of the work.
    READ_BYTES each, and at least as many as there are cores, up to a row each."""
    return max(1, min(n_rows, max(-(-n_bytes // READ_BYTES), spark.sparkContext.defaultParallelism)))


def compress(data: bytes) -> bytes:
    """Bytes for a shuffle or a binary column; short ones stay as they are."""
    if len(data) < 256:
        return b"\0" + data
    import pyarrow as pa
    return b"\1" + len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def decompress(data: bytes) -> bytes:
    if data[0] == 0:
        return data[1:]
    import pyarrow as pa
    return pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), "zstd", asbytes=True)


def bitmap_bits(n: int) -> int:
    """Bits for `n` members: about 32 per member, a power of two, bounded."""
    bits = 1 << 16
    while bits < 32 * n and bits < MAX_BITMAP_BITS:
        bits <<= 1
    return bits


def _slot(key: str, bits: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(bits))


def maybe_members(df: DataFrame, key: str, ids: DataFrame, id_col: str,
                  flag: str = "__llm_maybe") -> DataFrame:
    """`df` with a boolean column: false only for rows whose key is certainly
    not in `ids`. The bitmap is aggregated by Spark and broadcast; its size is
    bounded by MAX_BITMAP_BITS whatever the number of ids (a full bitmap lets
    every row through, so results never depend on it)."""
    bits = bitmap_bits(ids.count())
    words = (ids.select(_slot(id_col, bits).alias("__llm_slot"))
             .groupBy(F.floor(F.col("__llm_slot") / 64).alias("__llm_word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(__llm_slot % 64 as int)))").alias("__llm_bits")))
    words = persist(words, "bitmap")
    return (df.withColumn("__llm_slot", _slot(key, bits))
            .withColumn("__llm_word", F.floor(F.col("__llm_slot") / 64))
            .join(F.broadcast(words), "__llm_word", "left")
            .withColumn(flag, F.expr(
                "__llm_bits is not null and getbit(__llm_bits, cast(__llm_slot % 64 as int)) = 1"))
            .drop("__llm_slot", "__llm_word", "__llm_bits"))


def semi_join(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of `df` whose key is in `ids` (NULL keys are in no set). Only rows
    that pass the bitmap are shuffled."""
    ids = ids.select(F.col(id_col).alias("__llm_id")).filter("__llm_id is not null").distinct()
    near = maybe_members(df, key, ids, "__llm_id").filter("__llm_maybe").drop("__llm_maybe")
    # An inner join with distinct ids: the optimiser would push a semi join
    # below the bitmap, and shuffle all rows.
    return near.join(ids, near[key] == ids["__llm_id"]).drop("__llm_id")


def anti_join(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of `df` whose key is not in `ids` (NULL keys stay). Rows that fail
    the bitmap stay where they are; only the others are shuffled."""
    ids = ids.select(F.col(id_col).alias("__llm_id")).filter("__llm_id is not null").distinct()
    flagged = maybe_members(df, key, ids, "__llm_id")
    far = flagged.filter("not __llm_maybe").drop("__llm_maybe")
    near = flagged.filter("__llm_maybe").drop("__llm_maybe")
    # An outer join, for the same reason.
    met = near.join(ids, near[key] == ids["__llm_id"], "left")
    return far.unionByName(met.filter("__llm_id is null").drop("__llm_id"))
