"""Nearest neighbours against brute force."""
import numpy as np
import pytest

from tidemark.llm import ann


def table(spark, vectors, extra=()):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1)
            for i, v in enumerate(vectors)]
    return spark.createDataFrame([*rows, *extra], "vec_id long, embedding array<double>, rank int")


def run(spark, df, **options):
    out = {}
    for r in ann.search(spark, df, "id % 5 = 0", **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def brute(vectors, k=5):
    usable = [i for i, v in enumerate(vectors) if v is not None and len(v) == 8
              and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(vectors[i], float) / np.linalg.norm(np.array(vectors[i], float))
            for i in usable}
    return {q: sorted((-round(float(unit[q] @ unit[i]), 12), i) for i in usable if i != q)[:k]
            for q in usable if q % 5 == 0}


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    vectors = [list(v) for v in rng.normal(size=(40, 8))]
    vectors[3] = vectors[10] = vectors[11] = vectors[30]
    vectors[12:30] = [vectors[5]] * 18  # more copies than are asked for
    vectors += [None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] * 8,
                [1.0, 2.0], [1e300] * 8, [1e-300] * 8, [1e300] * 8, [-1.0] * 8]
    got, want = run(spark, table(spark, vectors)), brute([
        v if v is None or not v or abs(v[0] or 0) not in (1e300, 1e-300) else [1.0] * 8
        for v in vectors])
    assert set(got) == set(want)
    for q, found in got.items():
        assert [x[0] for x in found] == [1, 2, 3, 4, 5]
        assert [(-round(s, 12), i) for _, i, s in found] == want[q]


def test_recall_on_points_without_structure(spark):
    rng = np.random.default_rng(2)
    vectors = [list(v) for v in rng.normal(size=(3000, 8))]
    got, want = run(spark, table(spark, vectors)), brute(vectors)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_hot_leaf_is_cut(spark, monkeypatch):
    monkeypatch.setattr(ann, "PIECE_ROWS", 16)
    rng = np.random.default_rng(3)
    near = np.ones(8) + rng.normal(size=(300, 8)) * 1e-3
    vectors = [list(v) for v in np.concatenate([near, rng.normal(size=(100, 8))])]
    got, want = run(spark, table(spark, vectors)), brute(vectors)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_few_vectors_and_none(spark):
    assert run(spark, table(spark, [])) == {}
    assert run(spark, table(spark, [None, [0.0, 0.0]])) == {}
    assert run(spark, table(spark, [[1.0, 2.0]])) == {}
    two = run(spark, table(spark, [[1.0, 0.0], [2.0, 0.0]]))
    assert two == {0: [(1, 1, 1.0)]}
    extra = [(0, [1.0, 1.0], 1), (None, [1.0, 1.0], 1)]
    repeated = run(spark, table(spark, [[1.0, 0.0], [0.0, 1.0]], extra))
    assert sorted(i for _, i, _ in repeated[0]) == [1, 1]  # two queries of one id


def test_best_bin_first_order():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(2000, 6))
    tree = ann.Tree(rows, branches=4, leaf_rows=20)
    order = tree.order(rows[0], tree.n_leaves)
    assert sorted(order) == list(range(tree.n_leaves)) and order[0] == tree.assign(rows[:1])[0]
    assert tree.calibrate(rows, 5, 0.9) >= 0.9 and 1 <= tree.visits < tree.n_leaves
    assert ann.Tree(np.ones((100, 3))).n_leaves == 1


def test_isolated_vectors_find_k_rows(spark):
    rng = np.random.default_rng(1)
    tight = np.repeat(rng.normal(size=(60, 8)), 20, axis=0) + rng.normal(size=(1200, 8)) * 1e-3
    vectors = [list(v) for v in tight]
    for i, v in enumerate(rng.normal(size=(12, 8))):
        vectors.insert(5 * i, list(v))  # each is a query
    got = run(spark, table(spark, vectors))
    assert set(got) == set(range(0, len(vectors), 5))
    assert all([x[0] for x in found] == [1, 2, 3, 4, 5] for found in got.values())


def test_order_goes_on_until_enough_is_held():
    tree = ann.Tree(np.random.default_rng(7).normal(size=(500, 6)), leaf_rows=20)
    query, sizes = np.ones(6), np.zeros(tree.n_leaves, dtype=np.int64)
    full = tree.order(query, tree.n_leaves)
    sizes[full[1]] = sizes[full[4]] = 3
    assert tree.order(query, 1, sizes, 6) == full[:5]
    assert tree.order(query, 1, sizes, 7) == full
    assert tree.order(query, 3, sizes, 2) == full[:3]


@pytest.mark.parametrize("n", [1, 2, 7])
def test_kmeans_gives_every_row_a_centre(n):
    rows = ann.scaled(np.random.default_rng(n).normal(size=(n, 3)))
    centres, labels = ann.kmeans(rows, min(4, n), np.random.default_rng(1))
    assert len(labels) == n and labels.max() < len(centres)
