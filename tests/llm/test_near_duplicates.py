"""The n-gram Jaccard join: combinations of frequent shingles, hot shingles, nulls and repeated rows, against brute force."""

import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import near_duplicates as nd
from isobar.llm import set_counts as sc
from isobar.llm.blocks import blocks
from test_edges import near_duplicates_by_force, prose


def thue_morse(n):
    s = [0]
    while len(s) < n:
        s += [1 - x for x in s]
    return "".join("ab"[x] for x in s[:n]), "".join("ba"[x] for x in s[:n])


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_hashes_have_no_structural_collisions(n):
    x, y = thue_morse(n)
    block = next(blocks(pa.array([x, y, x + "a", "z " + x])))
    starts, ends, _ = block.words()
    h = block.hashes(starts, ends).tolist()
    assert len(set(h[:3])) == 3 and h[4] == h[0]


def test_thue_morse_texts_are_not_linked(spark):
    texts = [*thue_morse(4096), " ".join(thue_morse(64)), " ".join(thue_morse(64))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in nd.duplicate_components(frame).collect()} == {0: 0, 1: 1, 2: 2, 3: 2}


def crowd(seed):
    """Short and long texts of few words: every shingle is frequent; copies with edits on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    passages = [prose(70 + i, 8) for i in range(4)]
    texts = [" ".join(passages[i] for i in rng.integers(0, 4, rng.integers(1, 5))) for _ in range(60)]
    base = prose(80, 70).split()
    for _ in range(70):
        w = base[: rng.integers(55, 71)]
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(0, len(w))] = f"e{rng.integers(0, 6)}"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("classes", [(1,), (3, 6), (2, 5, 20), nd.CLASSES])
def test_classes_change_the_work_and_not_the_result(spark, classes):
    texts = crowd(3)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.duplicate_components(nd.written(frame), classes=classes).collect()}
    assert got == near_duplicates_by_force(texts)


def test_linked_sets_share_a_key(spark):
    """Every pair of linked sets whose first shared shingle is in class 2 or 3 has a common key within the bound."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(5, 200))
        common = np.sort(rng.integers(1, 2**62, n).astype(np.uint64))
        drop = rng.random(n) < 0.08
        x, y = common, common[~drop]
        both = len(y)
        if 100 * both < 80 * n or not len(y):
            continue
        for k in (2, 3):
            upto = lambda s, k=k: [0] * (k - 1) + [len(s)] * (3 - k)
            keys = [{int(a) for keys, _ in nd.combination_keys(s, len(s), upto(s), 80) for a in keys} for s in (x, y)]
            assert both < k or keys[0] & keys[1] or len(x) == len(y)


def test_size_classes_of_linked_sets_are_neighbours():
    for n in range(1, 400):
        for m in range(n, n * 100 // 80 + 1):
            assert nd.size_class(m, 80) - nd.size_class(n, 80) in (0, 1)


def test_small_chunks_and_hot_shingles(monkeypatch):
    """Many chunks, and counts in place of sets: every set that is linked comes out with all its shared shingles, rare ones first."""
    texts = crowd(5)
    monkeypatch.setattr(sc, "HEAVY", 2)
    edges = np.array([0, 1 << 61, 1 << 62, 1 << 63], np.uint64)
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text_key", "text"])
    asked, n, of, all_ids = [], 0, {}, {}
    for block in blocks(batch["text"], 2000):
        shingles, b = nd.shingle_sets(block)
        ids = sc.set_ids(shingles, b)
        for i in range(block.n):
            of[block.rows.start + i] = set(shingles[b[i] : b[i + 1]].tolist())
            all_ids[block.rows.start + i] = (n, int(ids[i]))
        part = (shingles, b, ids, [batch[c].slice(block.rows.start, block.n) for c in nd.LABELS])
        asked += [r for x in sc.chunk_rows([part], n, edges) for r in x.to_pylist()]
        n += 1
    assert n > 3 and any(r["heavy"] and sc.unpack(r["heavy"]).size for r in asked)
    answered = [r for k in range(4) for r in sc.counted(pa.Table.from_pylist([x for x in asked if x["range"] == k], sc._ASKED)).to_pylist()]
    out = [r for c in range(n) for r in sc.ordered(80, nd.CLASSES, nd.LABELS)(pa.Table.from_pylist([x for x in answered if x["chunk"] == c], sc._ANSWERED)).to_pylist()]
    assert sorted(r["doc_id"] for r in out) == list(range(len(texts)))
    counts = collections.Counter(x for i, s in of.items() if i == min(j for j, y in all_ids.items() if y == all_ids[i]) for x in s)
    for r in out:
        if r["shared"] is not None:
            got = np.frombuffer(r["shared"], np.uint64).tolist()
            assert got == sorted((x for x in of[r["doc_id"]] if counts[x] > 1), key=lambda x: (counts[x], x))
            assert r["upto"] == [sum(counts[x] <= c for x in got) for c in nd.CLASSES]
    whole = {r["set_id"] for r in out if r["shared"] is not None}
    by_force = near_duplicates_by_force(texts)
    size = collections.Counter(c for _, c in by_force.values())
    assert all(r["set_id"] in whole for r in out if size[by_force[r["doc_id"]][1]] > 1)
    del answered[0]
    with pytest.raises(ValueError, match="complete"):
        for c in range(n):
            sc.ordered(80, nd.CLASSES, nd.LABELS)(pa.Table.from_pylist([x for x in answered if x["chunk"] == c], sc._ANSWERED))


def test_null_ids_are_compared_and_repeated_rows_are_one(spark):
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(None, a), (None, a + " x"), (5, a + " y"), (7, b), (7, b), (7, c), (None, c + " z"), (None, ""), (9, ""), (9, None), (2**60, prose(4, 30))]
    frame = spark.createDataFrame([(i, t, 1, "k", t) for i, t in rows], "doc_id long, text string, n long, set_id string, shared string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.duplicate_components(frame).collect()), key=str)
    expected = [(None, 46, 5), (None, 47, 5), (5, 47, 5), (7, 46, 7), (7, 46, 7), (7, 46, 7), (None, 47, 7), (None, 0, None), (9, 0, 9), (9, 0, 9), (2**60, 26, 2**60)]
    assert got == sorted(expected, key=str)
    left = nd.without_duplicates(frame)
    assert left.columns == frame.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert kept == sorted([(5, a + " y"), (7, b), (7, c), (None, ""), (9, ""), (9, None), (2**60, rows[-1][1])], key=str)


def test_a_large_group_of_equal_rows_keeps_one(spark):
    frame = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.lit(prose(6, 40)).alias("text"))
    assert nd.without_duplicates(frame).select("doc_id").collect() == [(0,)]
