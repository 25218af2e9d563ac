"""Whitening against a direct eigendecomposition; rank-one changes, deflation, combination, edge cases."""

import math

import numpy as np
import pytest

from tests.conftest import SMOKE_DIR


def scatter(x):
    y = x - x.mean(0)
    return y.T @ y


def sets(kind, size, rng):
    n = 120
    if kind == "plain":
        return rng.normal(size=(n, size)) * 64
    if kind == "scales":
        return rng.normal(size=(n, size)) * 10.0 ** rng.uniform(-3, 4, size)
    if kind == "copies":
        x = rng.integers(-60, 60, (n, size)).astype(float)
        x[30:90] = x[3]
        return x
    if kind == "rank":
        x = rng.integers(-60, 60, (n, size)).astype(float)
        x[:, size // 2:] = x[:, : size - size // 2]
        return x
    return np.eye(size)[rng.integers(0, size, n)] * 5.0  # equal eigenvalues


@pytest.mark.parametrize("kind", ["plain", "scales", "copies", "rank", "equal"])
@pytest.mark.parametrize("size", [1, 2, 3, 8, 33])
def test_rank_one_changes_give_the_scatter_and_orthogonal_vectors(kind, size):
    from tempora.llm.whitening import Spectrum

    x = np.floor(sets(kind, size, np.random.default_rng(size)))
    parts = []
    for part in np.array_split(x, 3):
        s = Spectrum(size)
        for v in part:
            s.add(v)
        parts.append(s)
    parts[0].join(parts[1])
    parts[0].join(parts[2])
    s, want = parts[0], scatter(x)
    scale = max(1.0, np.abs(want).max())
    assert s.n == len(x) and np.allclose(s.mean, x.mean(0), rtol=0, atol=1e-9 * max(1, np.abs(x).max()))
    assert np.abs((s.vectors * s.values) @ s.vectors.T - want).max() < 1e-12 * scale
    assert np.abs(s.vectors.T @ s.vectors - np.eye(size)).max() < 1e-12
    assert np.abs(np.linalg.eigvalsh(want) - s.values).max() < 1e-12 * scale


def test_copies_at_once_are_the_copies_one_by_one():
    from tempora.llm.whitening import Spectrum

    rng = np.random.default_rng(5)
    a, b = Spectrum(6), Spectrum(6)
    for v in rng.normal(size=(20, 6)):
        n = int(rng.integers(1, 9))
        a.add(v, n)
        for _ in range(n):
            b.add(v)
    assert np.allclose((a.vectors * a.values) @ a.vectors.T, (b.vectors * b.values) @ b.vectors.T, rtol=0, atol=1e-12)


def test_secular_roots_interlace_and_hold():
    from tempora.llm.whitening import secular_roots

    rng = np.random.default_rng(8)
    for _ in range(50):
        k = int(rng.integers(1, 30))
        d = np.cumsum(10.0 ** rng.uniform(-9, 2, k))
        z = rng.normal(size=k) * 10.0 ** rng.uniform(-5, 0, k)
        rho = float(10.0 ** rng.uniform(-3, 3))
        minus = secular_roots(d, z, rho)
        want = np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z))
        got = np.array([d[j] - minus[r, j] for r, j in enumerate(np.abs(minus).argmin(1))])
        assert np.allclose(got, want, rtol=1e-11, atol=1e-13 * want.max())
        if k > 1:
            assert (minus[np.arange(k), np.arange(k)] < 0).all() and (minus[np.arange(k - 1), np.arange(1, k)] > 0).all()


def direct(vectors, components=32):
    """(eigenvalues, vectors, S, x) by numpy over all rows."""
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    y = x - x.mean(0)
    values, q = np.linalg.eigh(y.T @ y / len(x))
    return values[::-1][:components], q[:, ::-1][:, :components], x.sum(0), x


def test_query_equals_direct_decomposition(spark):
    from tempora.llm.queries import QUERIES

    out = QUERIES["op13_whitening"](spark, SMOKE_DIR)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet").collect()
    got = out.collect()
    assert len(got) == 32 * len(rows)
    values, q, s, x = direct([r.embedding for r in rows])
    n = len(x)
    want = (x - s / n) @ q / np.sqrt(values)
    place = {r.vec_id: k for k, r in enumerate(rows)}
    table = np.zeros_like(want)
    for r in got:
        k = place[r.vec_id]
        table[k, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[k], s))
    trace = np.var(x, axis=0).sum()
    assert np.allclose([r.explained for r in got if r.vec_id == rows[0].vec_id], values / trace, rtol=1e-10)
    signs = np.sign((table * want).sum(0))
    assert np.abs(table * signs - want).max() < 1e-8
    cov = np.cov(table.T, bias=True)
    assert max(r.identity_error for r in got) == min(r.identity_error for r in got)
    assert abs(got[0].identity_error - np.abs(cov - np.eye(32)).max()) < 1e-10 and got[0].identity_error < 1e-10


def test_partitions_hot_vectors_nulls_lengths_and_clashing_names(spark):
    from tempora.llm.whitening import whiten

    rng = np.random.default_rng(4)
    vectors = [(k, [float(t) for t in rng.normal(size=5)]) for k in range(90)] + [(None, [1.0] * 5)] * 40 + [(7, [1.0] * 5)] * 20
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [1.0, math.nan, 1.0, 1.0, 1.0]), (904, [math.inf] * 5),
           (905, [1e300] * 5), (906, [1.0] * 4)]
    table = spark.createDataFrame([(i, v, 1, "v") for i, v in vectors + bad], "vec_id long, embedding array<double>, n int, v string")
    got = whiten(spark, table.repartition(20), 3).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in got) == sorted((i is None, i) for i, _ in vectors)
    values, q, s, x = direct([v for _, v in vectors], 3)
    white = (x - s / len(x)) @ q / np.sqrt(values)
    keys = sorted(zip([r.deviation for r in got], np.abs([r.whitened for r in got]).tolist()))
    want = sorted(zip((((len(x) * x - s) ** 2).sum(1)).tolist(), np.abs(white).tolist()))
    assert [k for k, _ in keys] == [k for k, _ in want]
    assert np.allclose([w for _, w in keys], [w for _, w in want], atol=1e-9)
    assert got[0].identity_error < 1e-10


def test_without_variance_and_without_rows(spark):
    from tempora.llm.whitening import whiten

    one = spark.createDataFrame([(1, [2.0, 3.0])], "vec_id long, embedding array<float>")
    (r,) = whiten(spark, one).collect()
    assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, [None, None], [None, None], 0.0)
    assert whiten(spark, one.limit(0)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(5)], "vec_id long, embedding array<float>")
    got = sorted(whiten(spark, line).collect())
    assert [r.whitened[1] for r in got] == [None] * 5 and np.allclose(got[0].explained, [1.0, 0.0], atol=1e-15)
    assert np.allclose(np.abs([r.whitened[0] for r in got]), np.abs(np.arange(-2, 3) / math.sqrt(2)))


def test_large_entries_are_exact(spark):
    from tempora.llm.whitening import Centre, whiten

    rows = [(k, [2.0 ** 40 * (k % 3), 1.0 * k]) for k in range(50)]
    got = {r.vec_id: r.deviation for r in whiten(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [[int(64 * a) + 1_000_000 for a in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    for k, v in enumerate(x):
        want = sum((50 * a - b) ** 2 for a, b in zip(v, s))
        assert got[k] == (want if want < 1 << 63 else None)
    big = np.array([[3 * 10 ** 18, 5], [-(10 ** 18), 6]], dtype=np.int64)
    c = Centre(2, [2 * 10 ** 18, 11])
    assert c.scaled(big).tolist() == [[4 * 10 ** 18, -1], [-4 * 10 ** 18, 1]]
