"""Whitening against the eigenvectors of the covariance in plain numpy."""

import numpy as np
import pytest

from isobar.llm.whitening import fitted, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, x int, component int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA)


def by_force(rows):
    """Ids, whole numbers, fit list, and eigenpairs of its covariance."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64)) for i, v in good if len(v) == d]
    fit = np.unique([x for _, x in good], axis=0)
    c = fit - fit.sum(0) / len(fit)
    e, axes = np.linalg.eigh(c.T @ c / len(fit))
    return good, fit, e[::-1], axes[:, ::-1].T


def check(spark, rows, apart=True):
    good, fit, e, axes = by_force(rows)
    n, sums = len(fit), fit.sum(0)
    k = min(4, int((e > 1e-12 * e[0]).sum()))
    got = whitened(frame(spark, rows)).collect()
    assert len(got) == k * len(good)
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == sorted((i is None, i or 0, c) for i, _ in good for c in range(1, k + 1))
    assert {r["n"] for r in got} == {n} and all(r["identity_error"] <= 1e-9 for r in got)
    for r in got:
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
    rows_of = {}
    for i, x in good:
        rows_of.setdefault(i, []).append(x)
    for i, own in rows_of.items():
        deviations = sorted(sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True)) for x in own)
        assert sorted(r["deviation"] for r in got if r["vec_id"] == i and r["component"] == 1) == deviations
    if apart:
        for c in range(k):
            values = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c + 1}
            expected = {i: (x - sums / n) @ axes[c] / np.sqrt(e[c]) for i, x in good if len(rows_of[i]) == 1}
            sign = np.sign(sum(values[i] * y for i, y in expected.items()))
            assert all(abs(values[i] * sign - y) < 1e-8 for i, y in expected.items())
    return got


def test_random_vectors_nulls_repeats_and_lengths(spark):
    rng = np.random.default_rng(1)
    scale = np.array([1.0, 0.8, 0.6, 0.5, 0.3, 0.2])
    rows = [(i, (rng.standard_normal(6) * scale).tolist()) for i in range(200)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[6][1]), (300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (305, [1.0, 2.0]), (306, [0.0, -0.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(400 + i, rows[1][1]) for i in range(120)]  # a vector that many rows share counts once
    check(spark, rows)


def test_eigenvalues_that_are_there_twice(spark):
    """Vectors along each axis: one run sees a single direction of a repeated eigenvalue, all of them are found."""
    for lengths in ([5, 5, 5, 5, 5], [5, 3, 3, 1, 1], [4, 4, 2, 2, 2, 1], [7, 2, 2]):
        rows = []
        for k, a in enumerate(lengths):
            for sign in (1, -1):
                v = [0.0] * len(lengths)
                v[k] = float(sign * a)
                rows.append((len(rows), v))
        check(spark, rows, apart=False)


def test_fewer_components_than_wanted(spark):
    line = [(i, [i / 4.0, i / 2.0, 0.0]) for i in range(20)]
    assert {r["component"] for r in check(spark, line)} == {1}
    assert {r["component"] for r in check(spark, [(i, [v[0], v[1] + i * i, 1.0]) for i, v in line])} == {1, 2}
    assert {r["component"] for r in check(spark, [(i, [float(i % 7)]) for i in range(20)])} == {1}


def test_one_vector_equal_vectors_and_empty_tables(spark):
    columns = whitened(frame(spark, [(1, [1.0, 2.0])])).columns
    assert columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]):
        assert whitened(frame(spark, rows)).count() == 0
    assert whitened(frame(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_large_entries_are_exact(spark):
    rows = [(i, [float(i * 2**13), float(i % 3), float(i % 5)]) for i in range(-20, 20)]
    check(spark, rows)
    huge = [(i, [float(i) * 2.0**60, 1.0 * i * i]) for i in range(4)]
    got = whitened(frame(spark, huge)).where("component = 1").collect()
    assert len(got) == 4 and all(r["deviation"] is None for r in got)  # beyond a long


def test_few_steps_find_leading_components_of_many_dimensions(spark):
    """A spectrum that falls off ends before the basis is complete."""
    rng = np.random.default_rng(4)
    d = 60
    x = rng.integers(-40, 40, (300, d)) * np.concatenate([[900, 300, 100, 30], np.ones(d - 4)])
    vectors = spark.createDataFrame([([int(c) for c in r],) for r in x], "x array<long>")
    fit = fitted(vectors)
    c = x - x.mean(0)
    e, axes = np.linalg.eigh(c.T @ c / len(x))
    assert fit.values == pytest.approx(e[::-1][:4], rel=1e-12)
    for own, other in zip(fit.axes, axes.T[::-1], strict=False):
        assert abs(own @ other) == pytest.approx(1, abs=1e-12)
