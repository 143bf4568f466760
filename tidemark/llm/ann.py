"""Approximate nearest neighbours by a hierarchical k-means tree.

Fitting. A bounded sample of the distinct vectors (SAMPLE_ROWS, and at most
SAMPLE_VALUES numbers; those of the least hash) is clustered by k-means into
BRANCHES, and each cluster again, until a node has LEAF_ROWS sample rows or
fewer. Vectors are scaled to length one, so nearness is cosine.

Search order. A query walks the tree best bin first: a priority queue holds the
nodes seen but not entered, by the distance of their centre to the query; the
nearest is taken out and, if it is no leaf, its children are put in. The order
in which leaves come out is the order in which they are searched.

Calibration. For CALIBRATION sample rows the true neighbours among the sample
are known by brute force, and for each of them the position of its leaf in the
query's order. The number of leaves to visit is widened until the share of true
neighbours found reaches the target recall; it is the same for every query. A
query whose leaves hold fewer than k + 1 indexed vectors (itself is one) goes on
in its order until they do, or no leaf is left.

Index. Every vector is put into the leaf that it reaches by going to the nearest
centre at each node. Small neighbouring leaves form a bundle. Bundles are cut
into pieces and the queries that visit one into blocks, both of about PIECE_ROWS
rows, so a hot leaf is many tasks' work. A task scores one block against the
visited leaves of one piece by a matrix product and returns its best; partial
results meet by query.

Equal vectors are one vector with its smallest k + 1 ids, which is all that k
nearest can use of them, so copies cost nothing and tie exactly. Scores are
cosines of the original vectors in double precision, summed in one fixed way.

Vectors that are null, zero, or hold null or non-finite components take no part,
nor do vectors of another length than the most frequent one, nor rows without
id. An empty table gives no rows. Rows that repeat an id are candidates each.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import persist

SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 4_000_000
BRANCHES = 8
LEAF_ROWS = 48
ROUNDS = 12  # of k-means at a node
CALIBRATION = 400
TARGET = 0.97
PIECE_ROWS = 2048


class Tree:
    """Nodes in arrays: centres, children (none for a leaf), number of leaf."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS,
                 seed: int = 5):
        self.centres, self.children, self.leaf = [], [], []
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        unit = scaled(sample)
        self._grow(unit, unit.mean(axis=0), branches, leaf_rows, rng)
        self.centres = np.array(self.centres)
        self.visits = self.n_leaves

    def _grow(self, rows, centre, branches, leaf_rows, rng) -> None:
        """Nodes are added from a list of what is still to be split."""
        todo = [(rows, centre, None)]
        while todo:
            rows, centre, parent = todo.pop()
            node = len(self.centres)
            self.centres.append(centre)
            self.children.append([])
            self.leaf.append(-1)
            if parent is not None:
                self.children[parent].append(node)
            parts = []
            if len(rows) > leaf_rows:
                centres, labels = kmeans(rows, min(branches, len(rows)), rng)
                parts = [(rows[labels == i], centres[i], node) for i in range(len(centres))]
                parts = [p for p in parts if len(p[0])]
            if len(parts) > 1:
                todo += parts
            else:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row, by the nearest centre at each node."""
        unit = scaled(rows)
        out = np.empty(len(unit), dtype=np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, at = todo.pop()
            if self.leaf[node] >= 0:
                out[at] = self.leaf[node]
                continue
            children = self.children[node]
            centres = self.centres[children]
            nearest = np.argmin((centres ** 2).sum(axis=1) - 2 * unit[at] @ centres.T, axis=1)
            for i, child in enumerate(children):
                part = at[nearest == i]
                if len(part):
                    todo.append((child, part))
        return out

    def order(self, query: np.ndarray, visits: int, sizes: np.ndarray | None = None,
              least: int = 0) -> list[int]:
        """The first `visits` leaves of a query, best bin first; more, until
        they hold `least` vectors by `sizes` (of each leaf)."""
        unit = scaled(query[None, :])[0]
        distance = ((self.centres - unit) ** 2).sum(axis=1)
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < visits or held < least):
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                held += sizes[self.leaf[node]] if sizes is not None else 0
            for child in self.children[node]:
                heapq.heappush(heap, (distance[child], child))
        return out

    def calibrate(self, sample: np.ndarray, k: int, target: float, n: int = CALIBRATION) -> float:
        """Set `visits`; returns the recall it reached on the sample."""
        unit, leaves = scaled(sample), self.assign(sample)
        step = max(1, len(unit) // n)
        places = []
        for i in range(0, len(unit), step):
            score = unit @ unit[i]
            score[i] = -np.inf
            best = np.argsort(-score, kind="stable")[:min(k, len(unit) - 1)]
            rank = np.empty(self.n_leaves, dtype=np.int64)
            rank[self.order(sample[i], self.n_leaves)] = np.arange(self.n_leaves)
            places.append(rank[leaves[best]])
        places = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        self.visits, found = 1, 1.0
        while len(places):
            found = float((places < self.visits).mean())
            if found >= target or self.visits >= self.n_leaves:
                break
            self.visits = min(self.n_leaves, self.visits + max(1, self.visits // 16))
        return found


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow of large or loss of small values."""
    rows = np.asarray(rows, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def kmeans(rows: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Centres and labels; the first centres are spread out (k-means++)."""
    centres = [rows[rng.integers(len(rows))]]
    nearest = ((rows - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and nearest.sum() > 1e-12:
        centres.append(rows[rng.choice(len(rows), p=nearest / nearest.sum())])
        nearest = np.minimum(nearest, ((rows - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(ROUNDS):
        labels = np.argmin((centres ** 2).sum(axis=1) - 2 * rows @ centres.T, axis=1)
        moved = np.array([rows[labels == i].mean(axis=0) if (labels == i).any() else centres[i]
                          for i in range(len(centres))])
        if np.allclose(moved, centres):
            break
        centres = moved
    labels = np.argmin((centres ** 2).sum(axis=1) - 2 * rows @ centres.T, axis=1)
    return centres, labels


# ------------------------------------------------------------------ Spark
def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): rows that take part."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{vec_col}`").alias("vec")).filter(
        "id is not null and vec is not null and size(vec) > 0"
        " and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(vec, x -> x <> 0)")
    common = (rows.groupBy(F.size("vec").alias("n")).count()
              .orderBy(F.desc("count"), F.desc("n")).limit(1).select("n"))
    return rows.join(F.broadcast(common), F.size("vec") == F.col("n"), "left_semi")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(gid, ids, vec): equal vectors as one, with their smallest k + 1 ids.
    Ranks are cut to k + 1 before rows are shuffled."""
    rank = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k + 1)
    return persist(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                   .withColumn("gid", F.monotonically_increasing_id()), "ann-vectors")


def fit(vectors: DataFrame, k: int, target: float = TARGET) -> tuple[Tree, float] | None:
    """The calibrated tree and its recall on the sample; None without vectors."""
    first = vectors.select(F.size("vec")).first()
    if first is None:
        return None
    n = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // first[0]))
    sample = vectors.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(n).toPandas()["vec"]
    sample = np.array(sample.tolist(), dtype=np.float64)
    tree = Tree(sample)
    return tree, tree.calibrate(sample, k, target)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def search(spark: SparkSession, df: DataFrame, queries, id_col: str = "vec_id",
           vec_col: str = "embedding", k: int = 5, target: float = TARGET) -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of every row that
    `queries` (a condition on the column `id`) names, the row's own id left out."""
    rows = usable(df, id_col, vec_col)
    vectors = distinct_vectors(rows, k)
    fitted = fit(vectors, k, target)
    empty = spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    if fitted is None:
        return empty
    shared = spark.sparkContext.broadcast(fitted[0])

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.assign(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(leaves), batch.column(1)],
                    names=["gid", "leaf", "vec"])

    kind = dict(vectors.dtypes)["vec"]
    index = persist(vectors.select("gid", "vec").mapInArrow(
        place, f"gid long, leaf long, vec {kind}"), "ann-index")

    # At most one row per leaf.
    leaves = persist(index.groupBy("leaf").agg(F.count("*").alias("n")), "ann-leaves")
    sizes = np.zeros(fitted[0].n_leaves, dtype=np.int64)
    for leaf, n in leaves.collect():
        sizes[leaf] = n
    held = spark.sparkContext.broadcast(sizes)

    asked = rows.filter(queries).join(vectors.select("vec", "gid"), "vec").select(
        F.col("id").alias("query_id"), "gid")
    asked = persist(asked, "ann-queries")

    def walk(batches):
        tree = shared.value
        for batch in batches:
            matrix = _matrix(batch.column(1)) if batch.num_rows else []
            for lo in range(0, batch.num_rows, 64):
                orders = [tree.order(q, tree.visits, held.value, k + 1)
                          for q in matrix[lo:lo + 64]]
                times = [len(o) for o in orders]
                at = pa.array(np.repeat(np.arange(lo, lo + len(orders)), times))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(np.concatenate(orders).astype(np.int64))],
                    names=["gid", "leaf"])

    query_vectors = vectors.join(asked.select("gid").distinct(), "gid", "left_semi")
    visits = persist(query_vectors.select("gid", "vec").mapInArrow(walk, "gid long, leaf long"),
                     "ann-visits")
    # Neighbouring leaves that are small together are one bundle, so that a task
    # returns the best of a bundle, not of each leaf.
    before = F.sum("n").over(Window.orderBy("leaf").rowsBetween(
        Window.unboundedPreceding, -1))
    bundles = leaves.withColumn("bundle", F.floor(F.coalesce(before, F.lit(0)) / PIECE_ROWS))
    bundles = persist(bundles, "ann-bundles")
    pieces = bundles.groupBy("bundle").agg(F.ceil(F.sum("n") / PIECE_ROWS).alias("pieces"))
    of_leaf = F.broadcast(bundles.select("leaf", "bundle"))
    asked_of = persist(visits.join(of_leaf, "leaf").groupBy("bundle", "gid").agg(
        F.collect_list("leaf").alias("leaves")), "ann-asked")
    cuts = F.broadcast(pieces.join(asked_of.groupBy("bundle").agg(
        F.ceil(F.count("*") / PIECE_ROWS).alias("blocks")), "bundle"))
    mix = F.xxhash64("gid")
    side_q = (asked_of.join(cuts, "bundle").withColumn("block", F.pmod(mix, "blocks"))
              .withColumn("piece", F.explode(F.expr("sequence(0L, pieces - 1)")))
              .join(query_vectors.select("gid", "vec"), "gid")
              .select("bundle", "block", "piece", F.lit(True).alias("q"), "gid", "vec", "leaves"))
    side_d = (index.join(of_leaf, "leaf").join(cuts, "bundle")
              .withColumn("piece", F.pmod(mix, "pieces"))
              .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
              .select("bundle", "block", "piece", F.lit(False).alias("q"), "gid", "vec",
                      F.array("leaf").alias("leaves")))

    def score(key, frame):
        return score_block(frame, k + 1)

    found = side_q.unionByName(side_d).groupBy("bundle", "block", "piece").applyInPandas(
        score, "q_gid long, gid long, score double")
    # Best vectors per query vector, then their ids, then per query row.
    ids = vectors.select("gid", "ids")
    best = Window.partitionBy("q_gid").orderBy(F.desc("score"), F.col("ids")[0], "gid")
    top = (found.join(ids, "gid").withColumn("r", F.row_number().over(best))
           .filter(F.col("r") <= k + 1).select("q_gid", "score", F.explode("ids").alias("id")))
    return (asked.withColumn("row", F.monotonically_increasing_id())
            .join(top, F.col("gid") == F.col("q_gid")).filter("id <> query_id")
            .withColumn("rank", F.row_number().over(
                Window.partitionBy("row").orderBy(F.desc("score"), "id")))
            .filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias(id_col), "score"))


def score_block(frame, best: int):
    """The best rows of a piece for each query of a block, by cosine; ties to
    the smaller id of a vector are settled later, so equal scores all stay."""
    import pandas as pd
    is_query = frame["q"].to_numpy()
    if not is_query.any() or is_query.all():
        return pd.DataFrame({"q_gid": [], "gid": [], "score": []}).astype(
            {"q_gid": "int64", "gid": "int64", "score": "float64"})
    matrix = np.stack(frame["vec"].to_numpy()).astype(np.float64)
    gid, leaves = frame["gid"].to_numpy(), frame["leaves"].to_numpy()
    queries, rows = matrix[is_query], matrix[~is_query]
    q_gid, r_gid = gid[is_query], gid[~is_query]
    # Only the leaves that a query visits count for it.
    known, leaf = np.unique([x[0] for x in leaves[~is_query]], return_inverse=True)
    visited = np.array([np.isin(known, x) for x in leaves[is_query]])
    rough = np.where(visited[:, leaf], scaled(queries) @ scaled(rows).T, -np.inf)
    take = min(best + 4, len(rows))
    part = np.argpartition(-rough, take - 1, axis=1)[:, :take]
    # All rows as near as the last one taken, but for rounding.
    floor = np.take_along_axis(rough, part, axis=1).min(axis=1) - 1e-12
    rough[~visited[:, leaf]] = np.nan
    at_q, at_r = np.nonzero(rough >= floor[:, None])
    a, b = queries[at_q], rows[at_r]
    score = cosine(a, b)
    out = pd.DataFrame({"q": at_q, "r": at_r, "score": score})
    out = out.sort_values(["q", "score"], ascending=[True, False])
    place = out.groupby("q").cumcount().to_numpy()
    last = np.full(len(queries), -np.inf)
    at_last = place == best - 1
    last[out["q"].to_numpy()[at_last]] = out["score"].to_numpy()[at_last]
    out = out[out["score"].to_numpy() >= last[out["q"].to_numpy()]]
    return pd.DataFrame({"q_gid": q_gid[out["q"]], "gid": r_gid[out["r"]],
                         "score": out["score"].to_numpy()})


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of two matrices, in double precision. Each row's sums
    are taken alone, so equal vectors score equally wherever they are."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
