"""Nulls, repeated rows, ties, colliding patterns and clashing columns; votes, distances, terms and the pipeline against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import divergence, line_dedup, neighbour_vote
from isobar.llm.backoff_lm import Model, scored
from isobar.llm.blocks import blocks
from isobar.llm.decontaminate import contamination, decontaminated
from isobar.llm.divergence import COMMON, LANGUAGES, Rules, judged, passing
from isobar.llm.frames import Encoder, token_files
from isobar.llm.line_dedup import deduplicated, line_report
from isobar.llm.mixing import copies, mixed
from isobar.llm.near_duplicates import without_duplicates
from isobar.llm.neighbour_vote import Vote, quality_scores
from isobar.llm.private_terms import Disclosure, found
from isobar.llm.warc import archived
from test_edges import TOKENIZER, lines_by_force, near_duplicates_by_force, prose, words
from test_near_duplicates import thue_morse

CLASH = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, n int, copies int, digest string, place int, token string"


def clashing(spark, rows):
    """Rows (doc_id, text, source) with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "k", 1, 2, "d", 3, "t") for i, t, s in rows], CLASH)


REPEATED = [(1, prose(1, 40), "a"), (1, prose(1, 40), "a"), (1, prose(2, 30), "a"), (None, prose(3, 30), None), (None, prose(3, 30), None), (None, None, "b"), (2, "", "b"), (2**60 + 1, prose(4, 50), "a"), (3, prose(5, 3000), "b")]


def test_language_model_with_repeated_rows_and_null_ids(spark):
    frame = clashing(spark, REPEATED)
    rows = scored(frame, Model(chunk_words=40, segment=7)).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(i for i, _, _ in REPEATED)
    held = {i: None if i is None else zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in REPEATED}
    tokens = sum(len(words(t)) + 1 for i, t, _ in REPEATED if held[i] is False)
    assert all(r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == tokens for r in rows)
    whole = {(r["doc_id"], r["n_tokens"]): r["score"] for r in scored(frame).collect()}
    assert all(r["score"] == pytest.approx(whole[r["doc_id"], r["n_tokens"]], rel=1e-9) for r in rows)  # chunks and segments change nothing
    twice = scored(frame.union(frame)).collect()
    assert len(twice) == 2 * len(rows)


def test_patterned_texts_have_their_own_tokens_counts_and_lines(spark):
    x, y = thue_morse(4096)
    frame = spark.createDataFrame([(0, x, "en"), (1, y, "en"), (2, f"{x}\n{y}\n{x}", "en")], "doc_id long, text string, lang string")
    encode = Encoder(TOKENIZER).tokenizer
    got = {r["doc_id"]: r["ids_crc32"] for r in token_files(frame, TOKENIZER).collect()}
    for i, t in enumerate((x, y, f"{x}\n{y}\n{x}")):
        assert got[i] == zlib.crc32(np.array([*encode.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert {r["doc_id"]: r["n_dup_lines"] for r in judged(frame).collect()} == {0: 0, 1: 0, 2: 1}
    assert {r["doc_id"]: (r["n_known"], r["n_tokens"]) for r in scored(frame.where("doc_id < 2")).collect()} == {0: (2, 2), 1: (2, 2)}
    assert [r["n_equal"] for r in line_report(frame).orderBy("doc_id").collect()] == [0, 0, 3]


def test_votes_by_force(spark):
    """Exact cosines with every sampled vector, and the nearest by similarity, in plain numpy."""
    texts = [prose(i, 40) if i % 2 else " | ".join(prose(i, 25).split()) for i in range(60)] + [None, "", "  "]
    rows = [(i, t, i % 2) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    vote = Vote(sample=40, rank=8, neighbours=5)
    space = neighbour_vote.learn(frame, frame.select("doc_id", "quality"), vote)
    assert len(space.labels) <= 40 and set(space.labels.tolist()) == {0.0, 1.0}
    for r in quality_scores(frame.select("doc_id", "text"), frame.select("doc_id", "quality"), vote).collect():
        block = next(blocks(pa.array([texts[r["doc_id"]] or ""])))
        v = (neighbour_vote.terms(block)[0] * space.weights) @ space.axes
        v = v / max(np.linalg.norm(v), 1e-9)
        cosines = sorted(((float(v @ s), float(k)) for s, k in zip(space.vectors, space.labels, strict=True)), reverse=True)[:5]
        weights = [max(c, 0) ** vote.power for c, _ in cosines]
        expected = (sum(w * k for w, (_, k) in zip(weights, cosines, strict=True)) + 1e-6 * space.prior) / (sum(weights) + 1e-6)
        assert r["score"] == pytest.approx(expected, abs=1e-3) and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_ties_of_the_last_neighbour_all_vote():
    vectors = np.array([[1, 0], [0.8, 0.6], [0.8, -0.6], [0, 1]], np.float32)
    space = neighbour_vote.Space(np.ones(2, np.float32), np.eye(2, dtype=np.float32), vectors, np.array([1, 1, 0, 0], np.float32), 0.5)
    flipped = neighbour_vote.Space(space.weights, space.axes, vectors[::-1], space.labels[::-1], 0.5)
    counts = np.array([[1.0, 0.0]], np.float32)
    vote = Vote(neighbours=2, power=1.0)
    expected = 1.8 / 2.6
    assert neighbour_vote.votes(space, counts, vote)[0] == pytest.approx(expected, abs=1e-5) == neighbour_vote.votes(flipped, counts, vote)[0]


def test_votes_with_repeated_rows_null_ids_and_ties(spark):
    frame = clashing(spark, REPEATED)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1), (2**60 + 1, 1)], "doc_id long, quality int")
    rows = quality_scores(frame, labels).collect()
    assert len(rows) == len(REPEATED) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {None}
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) <= 2  # equal texts, equal scores


def distance(p, q):
    if not sum(p) or not sum(q):
        return 1.0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return math.sqrt(max((kl(p) + kl(q)) / 2, 0))


def classes_of(t):
    out = [0] * divergence.CLASS_BINS
    for c in t:
        if "a" <= c <= "z":
            k = 0
        elif "A" <= c <= "Z":
            k = 1
        elif "0" <= c <= "9":
            k = 2
        elif ord(c) > 127:
            k = 3
        elif c == " ":
            k = 4
        elif c in "\n\t\r":
            k = 5
        elif c in ".,":
            k = 6
        elif c in "#*$%&|<>":
            k = 7
        else:
            k = 8
        out[k] += 1
    return out


def words_of(t, lang):
    c = collections.Counter(w for w in words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)))
    own = [c[w] for w in COMMON[lang]]
    return own + [sum(c.values()) - sum(own)]


def test_distances_and_verdicts_by_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(80):
        lang = LANGUAGES[i % 4]
        pool = [*COMMON[lang], *prose(i, 30).split(), "Straße", "où", "x1"]
        t = " ".join(rng.choice(pool, int(rng.integers(0, 250)))) + (". " if i % 3 else "\n")
        rows.append((i, t.upper() if i % 11 == 0 else t.replace(" ", " ## ") if i % 13 == 0 else t, None if i % 17 == 0 else lang))
    rows += [(None, None, "en"), (5, "", "xx"), (5, "a b c", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = {g: ([0] * divergence.CLASS_BINS, [0] * divergence.WORD_BINS) for g in LANGUAGES}
    for _, t, lang in rows:
        if lang in known and t:
            known[lang] = tuple([a + b for a, b in zip(x, y, strict=True)] for x, y in zip(known[lang], (classes_of(t), words_of(t, lang)), strict=True))
    got = collections.defaultdict(list)
    for r in judged(frame).collect():
        got[r["doc_id"], r["n_words"]].append(r)
    rules, kept = Rules(), []
    for i, t, lang in rows:
        t = t or ""
        c = min(distance(classes_of(t), known[g][0]) for g in LANGUAGES)
        w = min(distance(words_of(t, g), known[g][1]) for g in LANGUAGES)
        n = len(words(t))
        odd = c > rules.class_distance and len(t) >= rules.class_min_chars or any(w > most and n >= least for least, most in rules.word_distances)
        assert any(r["class_distance"] == pytest.approx(c, abs=1e-9) and r["word_distance"] == pytest.approx(w, abs=1e-9) and r["kept"] == (not r["base_failed"] and not odd) for r in got[i, n])
        kept += [(i, t)] if any(r["kept"] for r in got[i, n]) else []
    assert {tuple(r) for r in passing(frame).select("doc_id", "text").collect()} == set(kept) and 0 < len(kept) < 80


def wilson(p, texts, z):
    """The lower limit of a share p that was seen in so many texts."""
    n = texts / p
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def planted(seed):
    """Texts of which one in forty has an address; four terms are always beside one, four are as frequent and anywhere, and every text has a word of its own."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(6000):
        ws = [f"w{int(k)}" for k in rng.zipf(1.3, 16) % 900] + [f"own{i}"]
        if i % 40 == 0:
            at = int(rng.integers(2, 12))
            ws[at:at] = [f"secret{i // 40 % 4}", f"u{i}@mail.org"]
        if i % 40 == 1:
            ws.insert(int(rng.integers(0, 16)), f"plain{i // 40 % 4}")
        rows.append((i, " ".join(ws)))
    return rows


def test_planted_terms_are_found_and_chance_words_are_not(spark):
    rows = planted(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    told = collections.Counter(text[r["doc_id"]][int(a) : int(b)] for r in found(frame).collect() for k, a, b in (x.split(":") for x in r["spans"].split(",") if x) if k == "term")
    right = sum(n for w, n in told.items() if w.startswith("secret"))
    assert right >= 0.9 * 150 and right >= 0.9 * sum(told.values())
    assert not any(w.startswith(("plain", "own")) for w in told)


def test_repeated_rows_count_as_one_text(spark):
    frame = spark.createDataFrame(planted(4)[:3000] + [(None, "secret0 x@mail.org")], "doc_id long, text string")
    rule = Disclosure(alpha=0.75)
    once = {(r["doc_id"], r["spans"]) for r in found(frame, rule).collect()}
    again = found(frame.union(frame.where("doc_id % 40 < 2 or doc_id is null")).union(frame.where("doc_id % 7 = 0")), rule).collect()
    assert {(r["doc_id"], r["spans"]) for r in again} == once and any("term" in s for _, s in once)


def test_terms_by_force(spark):
    """Pointwise mutual information from plain counts: which words beside an e-mail address are spans."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        ws = [f"w{k}" for k in rng.integers(0, 12, 9)]
        if i % 3 == 0:
            ws += ["call", f"key{i % 2}", f"n{i}@b.org", "now"]
        if i % 4 == 0:
            ws.append("key1")
        rows.append((i, " ".join(ws)))
    rule = Disclosure(alpha=0.5, z=1.5)
    near, of, total = collections.Counter(), collections.defaultdict(set), collections.Counter()
    places = collections.defaultdict(set)
    for i, t in rows:
        total.update(t.split())
        for m in re.finditer(r"n\d+@b\.org", t):
            for w in re.finditer(r"[^ ]+", t):
                # any part of it within 48 characters of the address
                if m.start() - 48 < w.end() <= m.start() or m.end() <= w.start() < m.end() + 48:
                    near[w[0]] += 1
                    of[w[0]].add(i)
                    places[i].add((w.start(), w.end(), w[0]))
    n, kind = sum(total.values()), sum(near.values()) + 1
    ic = -math.log2(kind / (n + 1))
    told = {w for w in near if math.log2(wilson(min(1, near[w] / total[w]), len(of[w]), rule.z)) + ic >= rule.alpha * ic}
    assert "call" in told and "now" in told
    got = {r["doc_id"]: {x for x in r["spans"].split(",") if x.startswith("term")} for r in found(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()}
    assert got == {i: {f"term:{a}:{b}" for a, b, w in places[i] if w in told} for i, _ in rows}


def test_lines_with_repeated_rows_and_null_ids(spark):
    a, b = "one two three four five six\nseven", "one two three four five six\nx"
    frame = clashing(spark, [(1, a, "s"), (1, a, "s"), (None, b, "s"), (None, None, "s"), (2, "", "s")])
    got = {r["doc_id"]: (r["n_lines"], r["n_equal"], r["n_similar"]) for r in line_report(frame).collect()}
    assert got == {1: (4, 0, 0), None: (2, 1, 0), 2: (0, 0, 0)}
    out = deduplicated(frame)
    assert out.columns == frame.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect()) == [("1", a), ("1", a), ("2", ""), ("None", "None"), ("None", "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_by_force(spark, seed):
    """Lines over few words, so that shingles are shared by many lines."""
    rng = np.random.default_rng(seed)
    passages = [prose(30 + i, 12) for i in range(5)]
    texts = []
    for i in range(40):
        rows = []
        for _ in range(int(rng.integers(1, 6))):
            w = " ".join(passages[k] for k in rng.integers(0, 5, rng.integers(1, 4))).split()
            for _ in range(int(rng.integers(0, 3))):
                w[rng.integers(0, len(w))] = f"v{rng.integers(0, 9)}"
            rows.append(" ".join(w[: rng.integers(3, len(w) + 1)]))
        texts.append("\n".join(rows))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = lines_by_force(texts)
    got = {r["doc_id"]: (r["n_lines"], r["n_equal"], r["n_similar"]) for r in line_report(frame).collect()}
    assert got == {i: (n, len(e), len(s)) for i, (n, e, s) in expected.items()}


def test_contamination_with_repeated_rows_null_ids_and_shared_windows(spark):
    item = " ".join(f"b{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item), (1, item), (2, item), (None, item), (3, None), (4, "b1 b2"), (5, "b3")], "item_id long, text string")
    frame = clashing(spark, [(1, "x " + item + " y", "s"), (1, "x " + item + " y", "s"), (None, item.upper(), "s"), (None, None, "s"), (7, "b2 b1", "s"), (8, "q " * 40 + "b3", "s"), (9, "", "s")])
    rows = sorted(((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in contamination(frame, bench).collect()))
    assert rows == sorted([("1", 17, 15, 4, True)] * 2 + [("None", 15, 15, 4, True), ("None", 0, 0, 0, False), ("7", 2, 0, 0, False), ("8", 41, 1, 1, False), ("9", 0, 0, 0, False)])
    left = decontaminated(frame, bench)
    assert left.columns == frame.columns and sorted(str(r["doc_id"]) for r in left.collect()) == ["7", "8", "9", "None"]


def test_tokens_with_repeated_rows_and_null_ids(spark):
    frame = clashing(spark, REPEATED)
    rows = token_files(frame, TOKENIZER).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None] * 3 + [1] * 3 + [2, 3, 2**60 + 1]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


def test_mixing_goes_by_row(spark):
    rows = [(k % 3 if k % 5 else None, prose(k % 7, 5 + k % 7 * 4), ["a", "b", None][k % 3]) for k in range(90)]
    frame = clashing(spark, rows)
    taken = copies(frame).collect()
    assert len(taken) == 90
    out = mixed(frame)
    assert out.columns == frame.columns
    want = collections.Counter()
    for r in taken:
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    have = collections.Counter((r["doc_id"], r["source"], len(words(r["text"]))) for r in out.select("doc_id", "source", "text").collect())
    assert have == +want and max(collections.Counter((r["doc_id"], r["source"], r["text"]) for r in out.collect()).values()) <= 2 * max(collections.Counter(rows).values())


def test_mixing_by_force(spark):
    """The prefix sum, in a plain loop over each source's documents in order."""
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 300) if i % 50 else 5000), f"s{i % 3}") for i in range(600)]
    got = {r["doc_id"]: r for r in copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for s in {s for _, _, s in rows}:
        docs = [(i, len(t.split())) for i, t, x in rows if x == s]
        size, target = sum(n for _, n in docs), got[docs[0][0]]["target"]
        digest = lambda i: hashlib.md5(str(i).encode()).hexdigest()
        at = int(hashlib.md5(f"0:s{s}".encode()).hexdigest()[:5], 16) / 2**20
        taken, done = {}, 0
        large = sorted(((n, digest(i), i) for i, n in docs if 50 * n > size))
        small = sorted(((100 * len(str(n)) + int(str(n)[:2]), digest(i), i, n) for i, n in docs if 50 * n <= size))
        rate = target / size
        for k, (n, _, i) in enumerate(large, 1):
            taken[i] = math.floor(at + rate * k) - math.floor(at + rate * (k - 1))
            done += taken[i] * n
        at += rate * len(large)
        rate = min(2, max(0, (target - done) / sum(n for *_, n in small)))
        for k, (_, _, i, n) in enumerate(small, 1):
            taken[i] = math.floor(at + rate * k) - math.floor(at + rate * (k - 1))
            done += taken[i] * n
        assert {i: got[i]["copies"] for i, _ in docs} == taken
        assert done == pytest.approx(target, rel=0.02)


def test_archives_with_repeated_and_null_pages(spark):
    html = "h" * 200
    frame = spark.createDataFrame([(5, "u", html, 1, "x"), (5, "u", html, 1, "x"), (None, "u", html, 1, "x"), (9, None, html, 1, "x"), (None, "u", None, 1, "x")], "page_id long, url string, html string, first int, digest string")
    got = sorted(((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in archived(frame).collect()), key=str)
    assert got == sorted([("5", 200, "response", None)] * 2 + [("None", 200, "revisit", 5), ("9", 200, "revisit", 5), ("None", 0, "response", None)], key=str)


def test_pipeline_by_force(spark, tmp_path):
    """Each stage's decisions on its own input, over a small corpus with copies, benchmark text, nulls and repeated rows."""
    import corpus_pipeline

    rng = np.random.default_rng(12)
    en = [*COMMON["en"]] * 3 + prose(1, 60).split()
    text = lambda n: " ".join(rng.choice(en, n))
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(i, text(int(rng.integers(40, 120))), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[3][1], "en", "s1"), (101, rows[4][1] + " tail", "en", "s0"), rows[5], (102, text(50) + " " + item, "en", "s0"), (103, None, "en", "s0"), (None, text(80), "en", None), (104, "### " * 60, "en", "s2"), (105, "too short", None, "s0")]
    docs = spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, str(tmp_path)), name)
        assert now.columns == docs.columns
        kept[name] = collections.Counter((r["doc_id"], r["text"]) for r in now.collect())
    judged_rows = {(r["doc_id"], r["n_words"]): r["kept"] for r in judged(docs).collect()}
    assert kept["quality_rules"] == collections.Counter((i, t) for i, t, *_ in rows if judged_rows[i, len(words(t))])
    assert not {103, 104, 105} & {i for i, _ in kept["quality_rules"]} and len(kept["quality_rules"]) > 50
    order = sorted(kept["quality_rules"].elements(), key=lambda r: (r[0] is None, r[0] or 0))
    force = near_duplicates_by_force([t for _, t in order])
    assert kept["near_duplicates"] == collections.Counter(order[k] for k, (_, c) in force.items() if c == k)
    assert not {100, 101} & {i for i, _ in kept["near_duplicates"]} and max(kept["near_duplicates"].values()) == 1
    assert kept["decontamination"] == collections.Counter({k: v for k, v in kept["near_duplicates"].items() if k[0] != 102})
    chosen = {(r["doc_id"], r["size"]): r["copies"] for r in copies(spark.createDataFrame([(i, t, s) for i, t, _, s in rows if (i, t) in kept["decontamination"] and (i, t, s) != (100, rows[3][1], "s1")], "doc_id long, text string, source string").distinct()).collect()}
    assert kept["mixing"] == collections.Counter({(i, t): chosen[i, len(words(t))] for i, t in kept["decontamination"] if chosen[i, len(words(t))]})
    encode = Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    crc = lambda t: zlib.crc32(np.array([*encode.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    out = collections.Counter((r["doc_id"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert out == collections.Counter((i, crc(t)) for i, t in kept["mixing"].elements())


def test_empty_tables_go_through(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (passing(nothing), without_duplicates(nothing), decontaminated(nothing, bench), mixed(nothing), deduplicated(nothing)):
        assert out.columns == nothing.columns and out.count() == 0
    some = spark.createDataFrame([(1, None, None, None, 0)], nothing.schema)
    assert without_duplicates(some).count() == decontaminated(some, bench).count() == deduplicated(some).count() == 1
    assert mixed(some).count() == 0 and passing(some).count() == 0
    assert some.select(F.count("text")).first()[0] == 0


def test_line_report_makes_the_texts(spark, monkeypatch):
    """op5: the texts without the removed lines are written, and the counts are what is missing there."""
    tables, write = {}, line_dedup.tidily
    monkeypatch.setattr(line_dedup, "tidily", lambda df, name="t": tables.setdefault(name, write(df, name)) if name == "texts" else write(df, name))
    a, b, c = "one two three four five six\nseven\n \n", "one two three four five six\nx\ty", "\n".join([prose(9, 30), prose(9, 30) + " more"])
    frame = spark.createDataFrame([(1, a), (2, b), (3, c), (4, None), (5, "\n\n")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_equal"], r["n_similar"]) for r in line_report(frame).collect()}
    assert got == {1: (2, 0, 0), 2: (2, 1, 0), 3: (2, 0, 1), 4: (0, 0, 0), 5: (0, 0, 0)}
    assert {r["doc_id"]: r["text"] for r in tables["texts"].collect()} == {1: a, 2: "x\ty", 3: prose(9, 30), 4: None, 5: "\n\n"}


@pytest.mark.parametrize("crowd", [256, 1])
def test_lines_without_python_workers(spark, monkeypatch, crowd):
    """op5: no job has Python in its plan, few or many lines under a shingle give the same, and letters are lowered one by one."""
    plans, write = [], line_dedup.tidily
    monkeypatch.setattr(line_dedup, "tidily", lambda df, name="t": plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    monkeypatch.setattr(line_dedup, "CROWD", crowd, raising=False)
    rng = np.random.default_rng(7)
    passages, texts = [prose(50 + i, 14) for i in range(4)], []
    for _ in range(40):
        w = " ".join(passages[k] for k in rng.integers(0, 4, rng.integers(1, 4))).split()
        for _ in range(int(rng.integers(0, 2))):
            w[rng.integers(0, len(w))] = f"v{rng.integers(0, 9)}"
        texts.append(" ".join(w[: rng.integers(5, len(w) + 1)]) + "\nx\t" + w[0] + "  y ")
    out = line_report(spark.createDataFrame([*enumerate(texts), (90, "\u0130a \u0391\u03a3"), (91, " ia\t\u03b1\u03c3")], "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_lines"], r["n_equal"], r["n_similar"]) for r in out.collect()}
    assert got == {i: (n, len(e), len(s)) for i, (n, e, s) in lines_by_force(texts).items()} | {90: (1, 0, 0), 91: (1, 1, 0)}
    assert plans and not any(re.search("Arrow|Python|Pandas", p) for p in plans)
