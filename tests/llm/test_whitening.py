"""Whitening against exact integers and a plain eigendecomposition."""

import math
from fractions import Fraction

import numpy as np

from riskframe.llm import whitening as W

SF = "/root/testdata/sf0.001"


def brute(rows, k=8):
    """Sorted rows (id, deviation, projections) and explained shares, from exact covariances."""
    keep = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(keep), len(keep[0][1])
    s = [sum(x[j] for _, x in keep) for j in range(d)]
    dev = [[n * x[j] - s[j] for j in range(d)] for _, x in keep]
    v = np.array([[float(Fraction(sum(r[a] * r[b] for r in dev), n**3)) for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    at = np.argsort(-e, kind="stable")[:k]
    w = np.array([[float(Fraction(x, n)) for x in r] for r in dev]) @ u[:, at] / np.sqrt(np.maximum(e[at], 1e-300))
    return [(i, sum(x * x for x in r)) for (i, _), r in zip(keep, dev)], w, e[at] / np.trace(v), n


def check(spark, rows, schema="vec_id long, embedding array<float>", k=8):
    out = W.whiten(spark.createDataFrame(rows, schema), k).collect()
    ids, w, share, n = brute([(r[0], None if r[1] is None else [None if c is None else float(np.float32(c)) for c in r[1]]) for r in rows], k)
    got = {}
    for r in out:
        assert r.n == n and r.identity_error < 1e-4 and abs(r.explained / share[r.component - 1] - 1) < 1e-9
        got.setdefault((r.vec_id, r.deviation), []).append((r.component, r.whitened))
    size = min(k, len(share))
    assert len(out) == len(ids) * size
    for c in range(size):
        mine = {key: sorted(x for m, x in v if m == c + 1) for key, v in got.items()}
        for sign in (1, -1):
            want = {}
            for key, x in zip(ids, w[:, c]):
                want.setdefault(key, []).append(sign * x)
            if all(np.allclose(mine[key], sorted(x), rtol=1e-7, atol=1e-7) for key, x in want.items()):
                break
        else:
            raise AssertionError(f"component {c + 1}")


def test_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    check(spark, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [float("-inf")] * 5), (105, [])]
    rows += [(None, rows[0][1]), (7, rows[8][1]), rows[9], rows[9]]  # null and repeated ids, repeated rows
    check(spark, rows + odd)
    other = [(200, [1.0, 2.0]), (201, [3.0])]  # lengths other than the commonest
    got = W.whiten(spark.createDataFrame(rows + other, "vec_id long, embedding array<float>"))
    assert {r.n for r in got.collect()} == {len(rows)}
    wide = [(a, b, 1, [2], 3, 4) for a, b in rows]
    check(spark, wide, "vec_id long, embedding array<float>, n int, x array<int>, component int, w int")


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) * 2.0**33).tolist()) for i in range(4)]
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2)
    ids, w, share, n = brute(rows, 2)
    assert {r.vec_id: r.deviation for r in out.collect()} == {i: x if x < 2**63 else None for i, x in ids}
    assert {r.component: round(r.explained, 9) for r in out.collect()} == {1: round(share[0], 9), 2: round(share[1], 9)}


def test_without_spread_and_empty(spark):
    same = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error == 0 for r in same)
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], "vec_id long, embedding array<float>")).collect()
    assert {r.component for r in line if r.whitened is not None} == {1} and len(line) == 8 and line[0].identity_error < 1e-9
    empty = W.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_polarised_covariances_are_exact(spark):
    rng = np.random.default_rng(6)
    m = rng.integers(-10**6, 10**6, (500, 4))
    x = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, x array<long>").repartition(5)
    n, sums, v = W.covariance(x)
    assert n == 500 and sums == m.sum(axis=0).tolist()
    for a in range(4):
        for b in range(4):
            s = sum((n * int(p) - sums[a]) * (n * int(q) - sums[b]) for p, q in zip(m[:, a], m[:, b]))
            assert v[a, b] == float(Fraction(s, n**3))
