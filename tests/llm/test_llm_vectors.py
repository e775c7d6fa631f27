"""Whitening and cross-polytope dedup against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from brightweir.llm import embedding_dedup, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
# More columns, named like those the operators use inside.
MORE = "key int, node string, n string, x string, size int, digest int, low string, component string, n_rows int, part int"


def made_vectors(n=120, size=8):
    """Clusters of near vectors, copies, scaled copies, nulls of all kinds, repeated rows, other lengths."""
    draws = np.random.default_rng(5)
    rows = []
    for i in range(n):
        vector = draws.normal(size=size)
        if i % 3 == 1:
            vector = np.array(rows[-1][1]) + draws.normal(size=size) * draws.choice([0.05, 0.2, 0.3])
        elif i % 10 == 5:
            vector = np.array(rows[-1][1])
        elif i % 10 == 6:
            vector = np.array(rows[-1][1]) * 3
        rows.append((i, np.float32(vector).tolist(), i // 10 % 3))
    first = rows[0][1]
    rows += [(500, None, 0), (501, [0.0] * size, 0), (502, [*first[1:], None], 0), (503, [*first[1:], float("nan")], 0)]
    rows += [(504, [*first[1:], float("inf")], 0), (505, [], 0), (506, first, None), (507, first[:3], 0), (508, first[:3], 0)]
    rows += [rows[0], rows[0], (None, first, 0), (None, None, 0), (0, rows[7][1], rows[7][2])]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(*row, 1, "a", "b", "c", 2, 3, "d", "e", 4, 5) for row in made_vectors()]
    return spark.createDataFrame(rows, f"{SCHEMA}, {MORE}").repartition(3)


def finite(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


# --- Whitening ----------------------------------------------------------------

def eigen_rows(rows, size):
    """Grid vectors, model and whitened values, by the covariance itself."""
    kept = [(i, np.floor(np.array(v, float) * 256).astype(np.int64)) for i, v, _ in rows if finite(v) and len(v) == size]
    fit = np.unique([x for _, x in kept], axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], axes[:, ::-1]


def test_whitening_is_that_of_the_covariance(vectors):
    found = whitening.whitened(vectors).collect()
    kept, n, sums, values, axes = eigen_rows(made_vectors(), 8)
    assert len(found) == 4 * len(kept)
    assert {row.n for row in found} == {n}
    assert max(row.identity_error for row in found) < 1e-9
    want = Counter((i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    for k in range(4):
        own = [row for row in found if row.component == k + 1]
        assert Counter((row.vec_id, row.deviation) for row in own) == want
        assert {round(row.explained / (values[k] / values.sum()), 10) for row in own} == {1}
        projected = sorted(float((x - sums / n) @ axes[:, k] / math.sqrt(values[k])) for _, x in kept)
        got = sorted(row.whitened for row in own)
        assert min(np.abs(np.subtract(got, s)).max() for s in (projected, [-p for p in reversed(projected)])) < 1e-9


def test_whitening_of_little(spark):
    def run(rows):
        return whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == []
    assert run([(1, None, 1), (2, [], 1)]) == []
    assert run([(1, [0.5, 1.0], 1), (2, [0.5, 1.0], 1)]) == []
    # Two vectors vary in one direction only: one component, at one deviation to either side.
    rows = run([(1, [0.0, 0.0, 7.0], 1), (2, [1.0, 1.0, 7.0], 1), (2, [1.0, 1.0, 7.0], 1)])
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9), round(r.explained, 9)) for r in rows) == [
        (1, 1, 2, 1.0, 1.0), (2, 1, 2, 1.0, 1.0), (2, 1, 2, 1.0, 1.0)
    ]
    assert {r.deviation for r in rows} == {2 * 256**2}


def test_whitening_has_few_components_where_few_vary(spark):
    """Repeated and dependent dimensions leave a Gram matrix that has no Cholesky factor of its own."""
    draws = np.random.default_rng(3)
    rows = []
    for i in range(200):
        a, b = draws.normal(size=2)
        a, b = round(a * 256) / 256, round(b * 256) / 256
        rows.append((i, [a, b, a + b, 5.0, a], 0))
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row.component for row in found} == {1, 2}
    assert max(row.identity_error for row in found) < 1e-9
    assert round(sum(row.explained for row in found if row.vec_id == 0), 9) == 1


def test_shift_only_matters_where_the_factor_does_not_exist():
    draws = np.random.default_rng(1)
    rows = draws.normal(size=(400, 6)) * [1e6, 1e3, 1, 1, 1e-3, 1e-4]
    q, composed = rows, np.eye(6)
    for _ in range(4):
        r = whitening.shifted_cholesky(q.T @ q)
        q, composed = whitening.solved(q, r), r @ composed
    assert np.abs(q.T @ q - np.eye(6)).max() < 1e-11
    assert np.allclose(np.linalg.svd(composed)[1], np.linalg.svd(rows)[1], rtol=1e-9)


def test_deviations_are_exact_or_null():
    x = np.array([[3, -4], [2**40, 1]], np.int64)
    assert whitening.deviations(x[:1], 10, [1, 2]) == [29**2 + 42**2]
    assert whitening.deviations(x, 10, [1, 2]) == [29**2 + 42**2, None]
    assert whitening.deviations(np.array([[2**31]], np.int64), 1, [5]) == [(2**31 - 5) ** 2]


# --- Cross-polytope dedup -------------------------------------------------------

def brute_links(rows, cosine=0.93):
    """Links and components of rows by all pairs."""
    able = [r[2] is not None and finite(r[1]) and any(r[1]) for r in rows]
    units = [np.array(r[1], float) / np.linalg.norm(r[1]) if ok else None for r, ok in zip(rows, able)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if able[i] and able[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((row[0], links[i], component, row[0] == component))
    return Counter(out)


def test_links_are_those_of_all_pairs(vectors):
    found = embedding_dedup.near_duplicates(vectors).collect()
    assert Counter(map(tuple, found)) == brute_links(made_vectors())


def test_parts_of_a_hot_bucket_meet(spark, monkeypatch):
    """One cluster holds most rows: its buckets are cut into many parts, and every link still counts once."""
    monkeypatch.setattr(embedding_dedup, "PART", 8)
    draws = np.random.default_rng(9)
    centre = draws.normal(size=16)
    rows = [(i, np.float32(centre + draws.normal(size=16) * 0.2).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, np.float32(draws.normal(size=16)).tolist(), i % 2) for i in range(60)]
    rows += [rows[0]] * 40
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, found)) == brute_links(rows)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_vectors_are_linked_as_by_all_pairs(tables):
    found = embedding_dedup.near_duplicates(tables("embeddings")).collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in tables("embeddings").collect()]
    assert Counter(map(tuple, found)) == brute_links(rows)


@pytest.mark.parametrize("rows", [100, 10**6, 10**8])
def test_recall_holds_as_buckets_get_finer(rows):
    """Pairs right at the threshold, others than those the tables were chosen by, meet whatever the number of rows."""
    plan = embedding_dedup.plan_for(64, rows, 0.93)
    draws = np.random.default_rng(77)
    a, b = draws.normal(size=(2, 2000, 64))
    a = embedding_dedup.unit(a)
    b = embedding_dedup.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    x, y = (embedding_dedup.probed(v, plan) for v in (a, 0.93 * a + math.sqrt(1 - 0.93**2) * b))
    met = (x[:, :, :, None] == y[:, :, None, :]).all(axis=4).any(axis=(1, 2, 3))
    assert met.mean() > 0.99


def test_transform_is_that_of_the_hadamard_matrix():
    matrix = np.array([[1.0]])
    while len(matrix) < 16:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    rows = np.random.default_rng(2).normal(size=(5, 16))
    assert np.allclose(embedding_dedup.hadamard(rows), rows @ matrix)
