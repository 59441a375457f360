"""Neighbours against all distances, the order of pairs, and the bounds of buckets."""

import numpy as np
import pytest

from isobar.llm.multi_index import Cells, Index, neighbours, pairs_in_order

SCHEMA = "vec_id long, embedding array<float>, label int, hash string, cell int, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "h", 1, 2, 3.0) for i, v in rows], SCHEMA)


def by_force(rows, k=10, query_of=100):
    """Per query the ids and distances of all candidates, nearest first, ties to smaller ids, nulls last."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = list({(i, tuple(np.array(v, np.float32).astype(float).tolist())) for i, v in good if len(v) == d})
    x = np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i is not None and i % query_of == 0:
            away = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            found = sorted((s, j is None, j or 0) for s, (j, _) in zip(away.tolist(), good, strict=True) if j != i)[:k]
            out.setdefault(i, []).append([(None if none else j, s) for s, none, j in found])
    return out


def collected(result):
    out = {}
    for r in result.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    return (centres[rng.integers(0, 12, n)] + 0.3 * rng.standard_normal((n, d))).astype(np.float32)


@pytest.mark.parametrize("index", [Index(first=100, bucket=300), Index(first=60, bucket=50, sample=600)])
def test_recall_and_scores(spark, index):
    """Cells of few and of many entries, in few and in many buckets."""
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(3000, 16, 1))]
    expected, got = by_force(rows), collected(neighbours(frame(spark, rows), index=index))
    assert set(got) == set(expected) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q][0]}) for q in got)
    assert hits / (10 * len(got)) >= 0.9
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert all(s == pytest.approx(np.sqrt(((x[i] - x[q]) ** 2).sum()), abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))


def test_copies_ties_nulls_lengths_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(60)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(100, 700)]  # one vector has most rows, and seven queries
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (None, rows[0][1]), (800, rows[3][1]), (800, rows[3][1]), (800, rows[4][1])]
    rows += [(900, None), (1000, [0.0, -0.0, 0.0, 0.0]), (1100, [1.0, None, 1.0, 1.0]), (1200, [float("nan")] * 4), (1300, [float("inf"), 0.0, 0.0, 0.0]), (1400, [1.0, 2.0]), (1500, [])]
    got, expected = neighbours(frame(spark, rows), index=Index(first=10_000)), by_force(rows)
    rows_of = {}
    for r in got.collect():
        rows_of.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert set(rows_of) == set(expected)
    for q, lists in expected.items():
        assert sorted(rows_of[q], key=str) == sorted(((k, i, round(s, 9)) for found in lists for k, (i, s) in enumerate(found, 1)), key=str)


def test_fewer_candidates_one_dimension_and_empty_tables(spark):
    few = [(i, [float(i + 1)]) for i in (0, 1, 2, 3)]
    assert collected(neighbours(frame(spark, few))) == {q: v[0] for q, v in by_force(few).items()} == {0: [(1, 1.0), (2, 2.0), (3, 3.0)]}
    assert neighbours(frame(spark, [(0, [1.0])])).count() == 0
    assert neighbours(frame(spark, [(1, [1.0]), (2, [2.0])])).count() == 0
    empty = neighbours(frame(spark, few).limit(0))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_pairs_come_in_order_and_all():
    rng = np.random.default_rng(5)
    a, b = rng.random(17), np.concatenate([rng.random(9), [0.5, 0.5]])
    pairs = list(pairs_in_order(a, b))
    assert len({(i, j) for _, i, j in pairs}) == len(pairs) == len(a) * len(b)
    assert [s for s, _, _ in pairs] == sorted(s for s, _, _ in pairs)
    assert all(s == a[i] + b[j] for s, i, j in pairs)


def test_buckets_hold_whole_cells_or_parts_of_one():
    count = np.array([0, 5, 30, 4, 0, 100, 7, 1])
    cells = Cells((np.zeros((2, 1)), np.zeros((4, 1))), 0.0).counted(count, 10)
    assert cells.parts.tolist() == [1, 1, 3, 1, 1, 10, 1, 1]
    held = {}
    for c in np.flatnonzero(count):
        for p in range(cells.bucket[c], cells.bucket[c] + cells.parts[c]):
            held.setdefault(p, []).append(c)
    assert sorted(held) == list(range(len(held)))
    for own in held.values():
        assert len(own) == 1 or (sum(count[c] for c in own) <= 10 and all(cells.parts[c] == 1 for c in own))
