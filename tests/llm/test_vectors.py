import numpy as np
import pytest

from netaudit.llm.vectors import hadamard, near_vectors
from tests.llm.support import Union

KIND = "vec_id long, embedding array<float>, label int, key long, ball long"


def planted(rng, dim):
    """Pairs around the border, a close cluster, a loose cluster that no ball holds, a chain, exact copies."""
    a = rng.standard_normal((600, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = rng.uniform(0.86, 0.99, 600)[:, None]
    unit = np.eye(dim)[0]
    close = unit + rng.standard_normal((150, dim)) * 0.3 / np.sqrt(dim)
    loose = -unit + rng.standard_normal((80, dim)) * 0.33 / np.sqrt(dim)
    angles = np.arange(40) * 0.3
    chain = np.outer(np.cos(angles), np.eye(dim)[1]) + np.outer(np.sin(angles), np.eye(dim)[2])
    return np.concatenate([a, c * a + np.sqrt(1 - c * c) * b, close, loose, chain, a[:30] * 3.0, a[:30]]).astype(np.float32)


def by_hand(x):
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    union = Union()
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        union.join(int(i), int(j))
    return {i: (int(linked[i].sum()), union.find(i)) for i in range(len(x))}


@pytest.mark.parametrize("dim", [20, 64])
def test_against_all_pairs(spark, dim):
    x = planted(np.random.default_rng(dim), dim)
    rows = spark.createDataFrame([(i, v.tolist(), 0, 1, 2) for i, v in enumerate(x)], KIND).repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(rows).collect()}
    want = by_hand(x)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.98 * len(want)


def test_edge_vectors(spark):
    unit = [1.0, 0.0, 0.0]
    rows = [
        (1, unit), (2, [2.0, 0.0, 0.1]), (2, [2.0, 0.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]),
        (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 0.0]), (None, unit), (10, [0.0, 1.0, 0.0]), (11, [1e30, 0.0, 0.0]),
    ]
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in near_vectors(spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], KIND)).collect())
    linked = [(-1, 3, 1, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (11, 3, 1, False)]
    assert got == sorted(linked + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)])
    assert near_vectors(spark.createDataFrame([], KIND)).count() == 0


def test_hadamard_keeps_lengths_and_inverts():
    x = np.random.default_rng(1).standard_normal((5, 32))
    assert np.allclose(hadamard(hadamard(x)), x) and np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
