"""The filter audit against plain loops over documents and orders."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from isobar.llm.interactions import FILTERS, audited, potentials, removal_games, steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, mask int, part string, good int, digest string"


def audit_by_force(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None,
            "E": i is not None and i > least[t],
        }
        docs.append((i, lang or "", {f for f in FILTERS if fails[f]}))
    out = {}
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for i, p, f in docs if p == part]
        shapley = Counter()
        for order in itertools.permutations(FILTERS):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                counts = [len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
                out[part, "".join(order), step] = counts
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def collected(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = frame.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in rows}
    assert len(out) == len(rows)
    return out


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 9, "x", 5, "d") for r in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def corpus():
    rng = random.Random(3)
    prose = [" ".join(f"w{rng.randrange(900)}" for _ in range(120)) for _ in range(6)]
    texts = [None, "", " \t\n", "one two", "a b " * 60, *prose, prose[0].upper(), prose[1] + " #", prose[2].upper() + " $", "É" * 400, "word " * 20_000, "A" * 10 + "b" * 90, "A" * 11 + "b" * 89]
    rows = [(i if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["en", "de", None, "", "xx"])) for i in range(150)]
    rows += [(1000, prose[3], "en"), (1000, prose[3], "de"), (1000, prose[3], "en"), (7, prose[3], None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (1000, 1, 1)]
    return rows, labels


def test_audit_by_force(spark):
    rows, labels = corpus()
    assert collected(audited(*frames(spark, rows, labels))) == audit_by_force(rows, labels)


def test_a_text_that_most_rows_share(spark, monkeypatch):
    """Digests above the bound of common ones go another way and get the same result."""
    rows = [(i, "the same text" if i % 3 else f"text {i % 50}", "en") for i in range(400)]
    expected = audit_by_force(rows, [])
    for bound in (1000, 2, 1):
        monkeypatch.setattr("isobar.llm.interactions.HOT_PART", bound)
        assert collected(audited(*frames(spark, rows, []))) == expected


def test_parts_with_zeros_and_empty_tables(spark):
    got = collected(audited(*frames(spark, [(1, " ".join(f"w{i}" for i in range(100)), "en")], [])))
    assert len(got) == 600 and all(v == [1, 0, 0, 0, 0, 0, 0] for v in got.values())
    docs, labels = frames(spark, [(1, "a", "en")], [(1, 1, 1)])
    assert audited(docs.limit(0), labels).count() == 0
    assert collected(audited(docs, labels.limit(0)))["en", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_values_of_any_game_are_means_over_orders(spark, n):
    """Potentials against marginal contributions, for games of other sizes."""
    filters, rng = "ABCD"[:n], random.Random(n)
    rows = [("p", rng.randrange(2**n), rng.randrange(9)) for _ in range(40)]
    worth = [sum(w for _, m, w in rows if m & s) for s in range(2**n)]
    games = removal_games(spark.createDataFrame(rows, "part string, mask int, docs int"), n, ("docs",))
    q = games.select(potentials(F.col("docs"), n).alias("q")).first()["q"]
    for i in range(n):
        by_force = 0
        for order in itertools.permutations(range(n)):
            before = sum(1 << j for j in order[: order.index(i)])
            by_force += worth[before | 1 << i] - worth[before]
        assert q[-1] - n * q[2**n - 1 - (1 << i)] == by_force
    rows = steps(games.withColumns({"good": F.col("docs"), "toxic": F.col("docs")}), filters).collect()
    assert all(r["removed"] == r["good_lost"] for r in rows)
    assert all(sum(r["removed"] for r in rows if r["filter_order"] == o) == worth[-1] for o in {r["filter_order"] for r in rows})
