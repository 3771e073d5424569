import math

import numpy as np
import pytest

from colloquy.llm import queries, whitening
from colloquy.llm.whitening import Spectrum

SF = "/root/testdata/sf0.001"


def _random(rng, n, dim):
    return np.floor(rng.normal(size=(n, dim)) * rng.exponential(size=dim) * 30) + 1_000_000


@pytest.mark.parametrize("n,dim", [(1, 1), (2, 1), (5, 8), (60, 7), (200, 20)])
def test_updates_equal_a_full_decomposition(n, dim):
    x = _random(np.random.default_rng(n), n, dim)
    if dim > 5:  # equal, constant and repeated columns: every kind of deflation
        x[:, 1] = x[:, 2]
        x[:, 3] = 1_000_000
        x[n // 2 :] = x[: n - n // 2]
    a, b, c = Spectrum(dim), Spectrum(dim), Spectrum(dim)
    for r in x[: n // 2]:
        a.add(r)
    for r in x[n // 2 :]:
        b.add(r)
    c.merge(a)
    c.merge(b)
    a.merge(b)
    apart = x - x.mean(0)
    scatter = apart.T @ apart
    size = max(1.0, np.abs(scatter).max())
    for s in (a, c):
        assert s.n == n and np.allclose(s.mean, x.mean(0))
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-10 * size
        assert np.abs(s.vectors.T @ s.vectors - np.eye(dim)).max() < 1e-12


def _brute(rows, components):
    """Whitening by numpy's eigh over plain Python integers."""
    whole = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], float) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for i, x in whole:
        apart = [n * a - s for a, s in zip(x, sums, strict=True)]
        for k in range(components):
            out[i, k + 1] = (n, sum(a * a for a in apart), abs(float(np.array(apart, float) / n @ q[:, k]) / math.sqrt(e[k])), e[k] / e.sum())
    return out


def _check(got, want, components):
    assert len(got) == len(want)
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - white) < 1e-6 and abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-9
    y = np.zeros((len(got) // components, components))
    place = {v: i for i, v in enumerate(sorted({r.vec_id for r in got}))}
    for r in got:
        y[place[r.vec_id], r.component - 1] = r.whitened
    return y


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    y = _check(queries.op11_whitened_vectors(spark, SF).collect(), _brute(rows, 16), 16)
    assert np.abs(y.T @ y / len(y) - np.eye(16)).max() < 0.2  # one sign and order for all rows


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    good = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(40)]
    table = [(*r, 0, "n") for r in good]
    table += [(100, None, 1, "x"), (101, [1.0, None, 2.0, 0.0], 1, "x"), (102, [1.0, nan, 2.0, 0.0], 1, "x"), (103, [inf, 0.0, 0.0, 0.0], 1, "x")]
    table += [(104, [1.0], 1, "x"), (105, [], 1, "x"), (106, [1e300, 0.0, 0.0, 0.0], 1, "x"), (107, good[3][1], 1, "x"), (3, good[3][1], 5, "y")]
    table += [(None, good[0][1], 1, "x")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, n int, component string").repartition(5)
    got = whitening.whiten(df, 3).collect()
    ids = [r.vec_id for r in got]
    assert ids.count(3) == 6 and ids.count(107) == 3 and ids.count(None) == 3 and ids.count(8) == 3
    assert not {100, 101, 102, 103, 104, 105, 106} & set(ids)
    want = _brute(good, 3)
    _check([r for r in got if r.vec_id not in (None, 3, 107)], {k: v for k, v in want.items() if k[0] != 3}, 3)


def test_few_vectors_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], kind)).collect()
    assert [(r.component, r.n, r.deviation) for r in two] == [(1, 2, 128 * 128)] * 2
    assert sorted(round(r.whitened, 9) for r in two) == [-1.0, 1.0] and two[0].explained == 1.0


def test_many_partitions_are_combined_in_rounds(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check(whitening.whiten(df, 3).collect(), _brute(rows, 3), 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
