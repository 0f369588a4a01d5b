"""Whitening against exact sums and a dense eigendecomposition."""

import math
from fractions import Fraction

import numpy as np

from labwatch.llm import whitening


def rows_of(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>, component string")


def brute(vectors):
    """Kept ids, their integers, the exact sums over distinct ones, and the covariance's spectrum."""
    kept = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)}
    distinct = sorted(set(kept.values()))
    sums = [sum(col) for col in zip(*distinct, strict=True)]
    n = len(distinct)
    away = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(v, sums, strict=True)] for v in distinct])
    values, vectors = np.linalg.eigh(away.T @ away / n)
    return kept, n, sums, values[::-1], vectors[:, ::-1], np.trace(away.T @ away / n)


def check(spark, vectors, rank=None, kind="float", error=1e-12):
    vectors = [v if v is None or kind == "double" else [None if c is None else float(np.float32(c)) for c in v] for v in vectors]
    kept, n, sums, values, basis, trace = brute(vectors)
    rows = rows_of(spark, vectors, kind)
    model = whitening.fit(rows)
    out = whitening.whitened(rows, model).collect()
    components = min(16, rank or len(sums))
    assert sorted((r["vec_id"], r["component"]) for r in out) == [(i, c) for i in kept for c in range(1, components + 1)]
    got = {(r["vec_id"], r["component"]): r for r in out}
    for i, x in kept.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        assert got[i, 1]["deviation"] == (deviation if deviation < 1 << 63 else None) and got[i, 1]["n"] == n
    centred = {i: np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)]) for i, x in kept.items()}
    for c in range(1, components + 1):
        e = values[c - 1]
        assert abs(got[min(kept), c]["explained"] - e / trace) <= 1e-9 * e / trace + 1e-13
        apart = min(abs(values[k] - e) for k in range(len(values)) if k != c - 1) if len(values) > 1 else e
        if apart > 1e-6 * values[0]:
            mine = np.array([got[i, c]["whitened"] for i in kept])
            theirs = np.array([centred[i] @ basis[:, c - 1] / math.sqrt(e) for i in kept])
            sign = np.sign(mine @ theirs)
            assert np.allclose(mine, sign * theirs, atol=1e-6)
    assert all(r["identity_error"] <= error for r in out)
    first = {kept[i]: i for i in sorted(kept, reverse=True)}
    w = np.array([[got[i, c]["whitened"] for c in range(1, components + 1)] for i in first.values()])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(components)).max() <= 10 * error
    return model


def test_well_conditioned(spark):
    draw = np.random.default_rng(3)
    vectors = (draw.normal(size=(700, 24)) * np.linspace(3, 0.3, 24)).tolist()
    vectors += [vectors[0]] * 400 + [None, [], [None] * 24, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0] * 23 + [None]]
    check(spark, vectors)


def test_ill_conditioned_and_dependent(spark):
    draw = np.random.default_rng(4)
    base = draw.integers(-5_000_000, 5_000_000, size=(600, 6))
    small = draw.integers(-1, 2, size=(600, 6))
    wide = np.hstack([base, base[:, :2] + small[:, :2], small[:, 2:4]]) / 64  # singular values apart by seven digits
    model = check(spark, wide.tolist(), kind="double", error=1e-7)  # the projection of such rows has so many digits
    assert model.passes >= 2
    dependent = np.hstack([base, base[:, :1] + base[:, 1:2], np.full((600, 1), 64 * 7)]) / 64
    check(spark, dependent.tolist(), rank=6, kind="double")


def test_edges(spark):
    assert whitening.fit(rows_of(spark, [None, [], [None]])) is None
    same = rows_of(spark, [[1.0, 2.0]] * 5)
    assert whitening.fit(same) is None and whitening.whitened(same, None).count() == 0
    assert whitening.fit(rows_of(spark, [None]).limit(0)) is None
    mixed = rows_of(spark, [[1.0, 2.0], [2.0, 1.0], [0.0, 4.0], [1.0, 2.0, 3.0], [3.0]])
    assert {r["vec_id"] for r in whitening.whitened(mixed, whitening.fit(mixed)).collect()} == {0, 1, 2}
    huge = rows_of(spark, [[1e300, 2.0], [-1e300, 1.0], [0.0, 4.0], [5.0, -2.0]], "double")
    out = whitening.whitened(huge, whitening.fit(huge)).collect()
    assert {r["vec_id"] for r in out} == {0, 1, 2, 3} and all(math.isfinite(r["whitened"]) for r in out)


def test_keys_hold_rows_exactly():
    draw = np.random.default_rng(5)
    rows = np.concatenate([draw.integers(-10 ** k, 10 ** k, size=(20, 7)) for k in (1, 2, 4, 9, 18)])
    assert (whitening.unpacked(whitening.packed(rows)) == rows).all()
    r = np.triu(draw.normal(size=(150, 150))) + 20 * np.eye(150)
    q = draw.normal(size=(30, 150))
    assert np.allclose(whitening.solved(q @ r, r), q)
