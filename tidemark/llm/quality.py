"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of
trusted text, and thresholds on perplexity by language.

Symbols. A text is a string of symbols: its characters, with white space as one
space and every digit as 0; characters from code point 32,000 on fall into 700
classes, all others stand for themselves. A word that repeats the one before it becomes a symbol of
its own (first, second, ... repetition), so that a text that says one fluent
word a hundred times is as unlikely as it should be. ORDER symbols of 15 bits
fit one 64-bit integer, in which the context is a shift and the shorter n-gram
a mask.

Training. All trusted documents are counted where they lie; counts meet by
n-gram. Lower orders are continuation counts (in how many longer n-grams an
n-gram stands). For each order the counts of counts give three discounts; the
counts are joined with the totals of their context, both sharded by context, to
the discounted probability and the weight of the next lower order. The tables
are written in shards.

Scoring. A task counts the distinct n-grams of a chunk of documents, joins them
with the shards one after the other, interpolates the orders, and sums the log
probabilities per document. It holds one chunk and one shard (shards of a small
model stay in memory). Texts are not shuffled for scoring.

Thresholds. A fifth of the trusted documents (by hash of their id) is not
trained on. Their entropies (mean negative log probability; its exponential is
the perplexity) give quantiles by language: a document is rejected beyond

    median + REACH * span

of its language. The median and the span (q99 - median) of n held-out documents
of a language are drawn to those of all: the median with weight n / (n + LEVEL),
the span with weight n / (n + SPREAD) to the span within languages (entropies
less their language's median), which itself is drawn to the span of all as the
median is. So the limit has no step at any n, and documents without language, or
of a language without such documents (n = 0), take the quantiles of all. The mean
of a short text is drawn to the median by PRIOR symbols, as it is noisy.

An empty or null text has no perplexity and is rejected. Without trusted text
nothing is judged and all documents with text are kept. Several labels of one
document count by the least; they go by id, so rows that repeat an id are all
trusted or none is. Each row is judged by its own text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    anti_join, open_shared, persist, scratch_dir, semi_join, tidy, with_row_key)

ORDER, BITS = 4, 15
PLAIN, CLASSES, BEGIN, REPEAT, RUNS = 32_000, 700, 32_700, 32_701, 5
CHUNK_CHARS = 1 << 20
SHARD_ROWS = 1_000_000
SHARDS_IN_MEMORY = 4
HELD_OUT = 5  # one of so many trusted documents sets thresholds
REACH, LEVEL, SPREAD, PRIOR = 4.5, 5.0, 100.0, 30.0
MASK = (1 << BITS) - 1
# Symbols of repetitions, as characters that no text is left with below.
_RUN_CHARS = [chr(0xF8F0 + i) for i in range(RUNS)]


# ------------------------------------------------------------------ n-grams
def symbols(text: str) -> np.ndarray:
    words = text.split()
    low = [w.lower() for w in words] if text != text.lower() else words
    run = 0
    last = -2
    for i in [i for i, same in enumerate(map(eq, low, low[1:]), 1) if same]:
        run = run + 1 if i == last + 1 else 1
        words[i] = _RUN_CHARS[min(run, RUNS) - 1]
        last = i
    raw = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    raw = raw.astype(np.int64)
    out = np.where(raw < PLAIN, raw, PLAIN + raw % CLASSES)
    out[(raw >= 48) & (raw < 58)] = 48
    special = (raw >= 0xF8F0) & (raw < 0xF8F0 + RUNS)
    out[special] = raw[special] - 0xF8F0 + REPEAT
    return out


def ngrams(text: str | None) -> np.ndarray:
    """The n-gram that ends at each symbol, begun by BEGIN symbols."""
    found = symbols(text) if text else np.empty(0, np.int64)
    if not len(found):
        return found
    padded = np.concatenate([np.full(ORDER - 1, BEGIN), found])
    key = padded[:len(found)].copy()
    for i in range(1, ORDER):
        key <<= BITS
        key |= padded[i:i + len(found)]
    return key


def _chunks(batches, column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Pieces of the batches with the n-grams of their texts, of bounded size
    (or one text)."""
    for batch in batches:
        start, held, size = 0, [], 0
        for i in range(batch.num_rows):
            held.append(ngrams(batch.column(column)[i].as_py()))
            size += len(held[-1])
            if size >= CHUNK_CHARS:
                yield batch.slice(start, i + 1 - start), held
                start, held, size = i + 1, [], 0
        if held:
            yield batch.slice(start), held


def count_ngrams(docs: DataFrame, text_col: str) -> DataFrame:
    """(gram, c): counts of all n-grams."""
    @tidy
    def run(batches):
        for _, held in _chunks(batches, 0):
            grams, times = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams), pa.array(times.astype(np.int64))], names=["gram", "c"])

    return (docs.select(F.col(f"`{text_col}`").cast("string"))
            .mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")))


# ------------------------------------------------------------------ training
def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; kept inside
    (0, count) where a count of counts is zero."""
    if not n1:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2 if n2 else 2 * d1
    d3 = 3 - 4 * y * n4 / n3 if n3 else 3 * d1
    return (min(max(d1, 0.05), 0.95), min(max(d2, 0.05), 1.95), min(max(d3, 0.05), 2.95))


def train(trusted: DataFrame, text_col: str) -> tuple[str, int] | None:
    """Write the model of the trusted texts; (its folder, number of shards), or
    None where there is no text. Rows: (shard, n, gram, alpha, gamma): the
    discounted probability, and the weight of order n - 1 after its context."""
    spark = trusted.sparkSession
    counts, tables = persist(count_ngrams(trusted, text_col), "kn-counts"), []
    for n in range(ORDER, 0, -1):
        row = counts.agg(*[F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)],
                         F.count("*")).first()
        if not row[4]:
            return None
        d1, d2, d3 = discounts(*row[:4])
        held = counts.withColumn("context", F.shiftright("gram", BITS)).withColumn(
            "d", F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3))
        totals = held.groupBy("context").agg(
            F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        tables.append(held.join(totals, "context").select(
            F.lit(n).alias("n"), "gram", "context",
            ((F.col("c") - F.col("d")) / F.col("total")).alias("alpha"), "gamma"))
        if n > 1:
            counts = persist(
                counts.select(F.col("gram").bitwiseAND((1 << BITS * (n - 1)) - 1).alias("gram"))
                .groupBy("gram").agg(F.count("*").alias("c")), "kn-counts")
    model = persist(functools.reduce(DataFrame.unionByName, tables), "kn-tables")
    shards = max(1, -(-model.count() // SHARD_ROWS))
    folder = scratch_dir(spark, "kn-model")
    (model.withColumn("shard", _shard(F.col("context"), shards)).drop("context")
     .repartition(shards, "shard").write.partitionBy("shard").parquet(folder))
    return folder, shards


def _shard(context, shards: int):
    """Column; `_shard_of` is the same in numpy."""
    return F.pmod(F.shiftright(context, 3) + context, F.lit(shards)).cast("int")


def _shard_of(context: np.ndarray, shards: int) -> np.ndarray:
    return ((context >> 3) + context) % shards


# ------------------------------------------------------------------ scoring
def _load(folder: str, shard: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Order -> (n-grams in order, alpha, gamma) of one shard."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    filesystem, base = open_shared(f"{folder}/shard={shard}")
    files = [f.path for f in filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
             if f.path.endswith(".parquet")]
    parts = [pq.ParquetFile(filesystem.open_input_file(f)).read(["n", "gram", "alpha", "gamma"])
             for f in sorted(files)]
    out = {}
    if parts:
        table = pa.concat_tables(parts)
        n, gram, alpha, gamma = (table.column(i).to_numpy() for i in range(4))
        for order in range(1, ORDER + 1):
            at = np.flatnonzero(n == order)
            at = at[np.argsort(gram[at], kind="stable")]
            out[order] = gram[at], alpha[at], gamma[at]
    return out


_kept = functools.lru_cache(maxsize=SHARDS_IN_MEMORY)(_load)


def log_probabilities(grams: np.ndarray, folder: str, shards: int) -> np.ndarray:
    """Natural log of the interpolated probability of each distinct n-gram's
    last symbol."""
    alpha = np.zeros((ORDER + 1, len(grams)))
    gamma = np.ones((ORDER + 1, len(grams)))
    keys = {n: grams & ((1 << BITS * n) - 1) for n in range(1, ORDER + 1)}
    load = _kept if shards <= SHARDS_IN_MEMORY else _load
    for shard in range(shards):
        tables = load(folder, shard)
        for n, (known, a, g) in tables.items():
            if not len(known):
                continue
            at = np.flatnonzero(_shard_of(keys[n] >> BITS, shards) == shard)
            key = keys[n][at]
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[place] == key
            alpha[n, at[hit]] = a[place[hit]]
            # the first n-gram of the context stands for the context
            context = key >> BITS
            first = np.minimum(np.searchsorted(known, context << BITS), len(known) - 1)
            seen = known[first] >> BITS == context
            gamma[n, at[seen]] = g[first[seen]]
    p = np.full(len(grams), 1.0 / (1 << BITS))
    for n in range(1, ORDER + 1):
        p = alpha[n] + gamma[n] * p
    return np.log(p)


def entropies(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
              model: tuple[str, int] | None, row_col: str | None = None) -> DataFrame:
    """(id, lang, n_symbols, entropy), and `row` from row_col where that is given:
    entropy is NULL for a document without text, or without a model."""
    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(f"`{id_col}`").alias("id"),
                         F.col(f"`{lang_col}`").cast("string").alias("lang"),
                         F.col(f"`{text_col}`").cast("string").alias("text"),
                         *([F.col(f"`{row_col}`").cast("string").alias("row")] if row_col else []))
    rows = ["row"] if row_col else []

    @tidy
    def run(batches):
        for piece, held in _chunks(batches, 2):
            sizes = np.array([len(x) for x in held], dtype=np.int64)
            grams, back = np.unique(np.concatenate(held), return_inverse=True)
            total = np.zeros(len(held))
            if model is not None and len(grams):
                values = log_probabilities(grams, *model)[back]
                full = np.flatnonzero(sizes)
                starts = (np.cumsum(sizes) - sizes)[full]
                total[full] = np.add.reduceat(values, starts)
            blank = (sizes == 0) | (model is None)
            entropy = pa.array(-total / np.maximum(sizes, 1), mask=blank)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(sizes), entropy,
                 *piece.columns[3:]], names=["id", "lang", "n_symbols", "entropy", *rows])

    return source.mapInArrow(run, f"id {kind}, lang string, n_symbols long, entropy double"
                                  + ", row string" * len(rows))


def _held_out(id_col: str):
    return F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(HELD_OUT)) == 0


def limits(sample: DataFrame) -> tuple[DataFrame, float | None, float | None]:
    """(q_lang, median, limit) of the languages of the held-out documents
    `sample` (lang, entropy); and the median and limit of all, None without rows."""
    def quantiles(values):
        return F.percentile_approx(values, [0.5, 0.99], 10_000)

    q = sample.agg(quantiles("entropy")).first()[0]
    level, spread = (q[0], q[1] - q[0]) if q else (None, None)

    def drawn(weight, value, target):
        return weight * value + (1 - weight) * F.lit(target).cast("double")

    own = persist(
        sample.filter("lang is not null").groupBy(F.col("lang").alias("q_lang"))
        .agg(quantiles("entropy").alias("q"), F.count("*").alias("n"))
        .withColumn("w", F.expr(f"n / (n + {LEVEL}D)"))
        .withColumn("v", F.expr(f"n / (n + {SPREAD}D)"))
        .withColumn("median", drawn(F.col("w"), F.col("q")[0], level)),
        "kn-own")
    inside = sample.join(own, F.col("lang") == F.col("q_lang")).agg(
        quantiles(F.col("entropy") - F.col("median"))).first()[0]
    within = inside[1] - inside[0] if inside else spread
    span = drawn(F.col("v"), F.col("q")[1] - F.col("q")[0],
                 drawn(F.col("w"), F.lit(within).cast("double"), spread))
    by_lang = own.select("q_lang", "median", (F.col("median") + REACH * span).alias("limit"))
    return by_lang, level, None if level is None else level + REACH * spread


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", row_col: str | None = None) -> DataFrame:
    """(id, lang, perplexity, threshold, keep) for every row of `docs`, written
    once; also `row`, the key of the row in row_col, where that is given. labels:
    (id_col, quality); quality 1 is trusted."""
    trusted_ids = persist(
        labels.select(F.col(f"`{id_col}`").alias("id"), "quality").filter("id is not null")
        .groupBy("id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("id"),
        "kn-trusted")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    model = train(semi_join(texts, "doc", trusted_ids.filter(~_held_out("id")), "id"), "text")
    scored = persist(entropies(docs, id_col, text_col, lang_col, model, row_col), "kn-scores")

    sample = persist(scored.filter("entropy is not null").join(
        trusted_ids.filter(_held_out("id")), "id", "left_semi").select("lang", "entropy"),
        "kn-sample")
    by_lang, level, limit = limits(sample)
    judged = (scored.join(by_lang, F.col("lang") == F.col("q_lang"), "left")
              .withColumn("median", F.coalesce("median", F.lit(level).cast("double")))
              .withColumn("limit", F.coalesce("limit", F.lit(limit).cast("double")))
              .withColumn("drawn", F.expr(
                  f"median + (entropy - median) * n_symbols / (n_symbols + {PRIOR}D)")))
    return judged.select(
        *(["row"] if row_col else []), "id", "lang", F.exp("drawn").alias("perplexity"), F.exp("limit").alias("threshold"),
        F.expr("n_symbols > 0 and coalesce(drawn <= limit, true)").alias("keep"))


def kept(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` that are kept, all columns as they are. Rows are told apart
    by where they stand, so each is judged by its own text, whatever its id."""
    keyed = with_row_key(docs)
    judged = classify(spark, keyed, labels, id_col, text_col, lang_col, row_col="__row")
    rejected = persist(judged.filter("not keep").select("row"), "kn-rejected")
    return anti_join(keyed, "__row", rejected, "row").drop("__row")
