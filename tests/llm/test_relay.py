"""Relays between chunks and ranges: the same rows as without them, and rows that follow the bytes."""

import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import near_duplicates as nd
from isobar.llm import relay
from isobar.llm import set_counts as sc
from isobar.llm.backoff_lm import Model, scored
from isobar.llm.blocks import blocks
from test_edges import prose
from test_near_duplicates import crowd


def test_levels_follow_the_bytes():
    """Rows a chunk sends and rows a range gets stay near the root of the ranges."""
    assert relay.levels(relay.DIRECT) == relay.Levels(relay.DIRECT)
    for ranges in (relay.DIRECT + 1, 10**5, 10**7 + 3):
        level = relay.levels(ranges)
        assert level.coarse * level.fine >= ranges
        assert max(level.coarse, level.fine, level.groups) <= ranges**0.5 + 2


@pytest.mark.parametrize("width", [64, 52])
def test_fine_ranges_tile_the_coarse_ones(width):
    level = relay.Levels(7, 5, 7)
    coarse = [(k << width) // 7 for k in range(7)]
    fine = [level.edges(k, width).tolist() for k in range(7)]
    assert [f[0] for f in fine] == coarse
    assert sum(fine, []) == sorted(sum(fine, []))


def test_slots_keep_order_and_owners():
    rng = np.random.default_rng(1)
    keys = [np.sort(rng.integers(0, 50, n).astype(np.uint64)) for n in (0, 30, 7, 0)]
    values = [rng.integers(0, 99, len(k)).astype(np.uint64) for k in keys]
    every, slots, merged = relay.merged(keys, values)
    assert (np.diff(every.astype(int)) >= 0).all()
    cut = [slice(0, 10), slice(10, 10), slice(10, 37)]
    back = relay.by_slot([slots[c] for c in cut], 4, [every[c] for c in cut], [merged[c] for c in cut])
    for got, sent in zip(back, (keys, values), strict=True):
        assert [x.tolist() for x in got] == [x.tolist() for x in sent]
    with pytest.raises(ValueError, match="complete"):
        relay.checked(3, 2)


def asked_rows(texts, edges):
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text_key", "text"])
    rows = []
    for n, block in enumerate(blocks(batch["text"], 2000)):
        shingles, b = nd.shingle_sets(block)
        part = (shingles, b, sc.set_ids(shingles, b), [batch[c].slice(block.rows.start, block.n) for c in nd.LABELS])
        rows += [r for x in sc.chunk_rows([part], n, edges) for r in x.to_pylist()]
    return rows


def chunks_of(answered):
    """What each chunk makes of its answers."""
    names = sorted({r["chunk"] for r in answered})
    return [sc.ordered(80, nd.CLASSES, nd.LABELS)(pa.Table.from_pylist([x for x in answered if x["chunk"] == c], sc._ANSWERED)).to_pylist() for c in names]


def test_relayed_answers_are_the_direct_ones(monkeypatch):
    """Heavy shingles, several chunks in a group, groups without some ranges."""
    monkeypatch.setattr(sc, "HEAVY", 2)
    level = relay.Levels(4, 3, 2)
    texts = crowd(5)
    asked = asked_rows(texts, np.array([(k << 64) // 4 for k in range(4)], np.uint64))
    assert any(r["heavy"] and sc.unpack(r["heavy"]).size for r in asked)
    direct = [r for k in range(4) for r in sc.counted(pa.Table.from_pylist([x for x in asked if x["range"] == k], sc._ASKED)).to_pylist()]
    schema = sc._ASKED.append(pa.field("grp", pa.int64()))

    def met(rows, schema, key, run):
        keys = sorted({key(r) for r in rows})
        return [r for k in keys for r in run(pa.Table.from_pylist([x for x in rows if key(x) == k], schema)).to_pylist()]

    fine = met([r | {"grp": r["chunk"] % 2} for r in asked], schema, lambda r: (r["range"], r["grp"]), sc.spread(level))
    assert {r["range"] for r in fine} == set(range(12))
    answers = met(fine, sc._RELAYED, lambda r: r["range"], lambda t: sc.counted(t, sc._RELAYED))
    back = met(answers, sc._RELAYED, lambda r: (r["range"] // 3, r["grp"]), sc.gathered(level))
    assert chunks_of(back) == chunks_of(direct)
    lost = next(i for i, r in enumerate(answers) if r["shingles"] is not None)
    with pytest.raises(ValueError, match="complete"):
        met(answers[:lost] + answers[lost + 1 :], sc._RELAYED, lambda r: (r["range"] // 3, r["grp"]), sc.gathered(level))


@pytest.mark.parametrize("direct", [1, 5])
def test_sets_are_the_same_with_relays(spark, direct):
    texts = [*crowd(6), "", None, *(prose(i, 30) for i in range(20))]
    frame = nd.written(spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, text_key long, text string").repartition(4))
    rows = lambda d: sorted(map(str, sc.ordered_sets(frame, nd._texts, nd.LABELS, 80, nd.CLASSES, direct=d).collect()))
    assert rows(direct) == rows(relay.DIRECT)
    empty = frame.where("doc_id < 0")
    assert sc.ordered_sets(empty, nd._texts, nd.LABELS, 80, nd.CLASSES, direct=direct).count() == 0


def test_scores_are_the_same_with_relays(spark):
    texts = [*crowd(7), "", None, *(prose(i, 40) for i in range(30))]
    frame = nd.written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    rows = lambda direct: sorted(map(str, scored(frame, Model(chunk_words=300, direct=direct)).collect()))
    assert rows(3) == rows(relay.DIRECT)
    assert scored(frame.where("doc_id < 0"), Model(direct=3)).count() == 0
