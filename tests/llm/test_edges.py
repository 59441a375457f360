"""Every operator on nulls, empty, long and repeated texts, empty tables and extra columns; against brute force."""

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

from isobar.llm.backoff_lm import Model, pack, scored, unpack
from isobar.llm.blocks import blocks, windows
from isobar.llm.components import components
from isobar.llm.decontaminate import contamination, decontaminated
from isobar.llm.divergence import judged, passing
from isobar.llm.frames import Encoder, Reader, read_tokens, token_files, write_tokens
from isobar.llm.line_dedup import deduplicated, line_report
from isobar.llm.mixing import copies, mixed, source_targets
from isobar.llm.near_duplicates import duplicate_components, without_duplicates
from isobar.llm.neighbour_vote import quality_scores
from isobar.llm.private_terms import found, sanitised
from isobar.llm.warc import archived, chunked, unchunked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, b_id string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 4000, n))


BASE = prose(1, 120)
TEXTS = [
    BASE,
    BASE,
    BASE.replace("w", "W", 40) + " tail",
    prose(2, 200),
    None,
    "",
    " \t\n ",
    "one two three",
    "one two  three",
    prose(3, 20000),
    "same line\nsame line\n" * 10,
    "mail a.b@c.de now, 4111 1111 1111 1111 or +44 20 7946 0958 at 192.168.0.1, not 999.1.1.1 é",
    "é " * 30 + "x@y.zz",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, ["a", "b", None][i % 3], 0, 7, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, " ".join(BASE.split()[10:30])), (2, "one two"), (3, None), (4, ""), (None, "one two three"), (10, "nowhere to be found")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))] + [(None, 1), (0, None)], "doc_id long, quality int")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t):
    return WORDS.findall(t or "")


def test_empty_tables(spark, nothing, bench, labels):
    none = labels.where("doc_id < 0")
    assert duplicate_components(nothing).count() == 0
    assert scored(nothing).count() == 0
    assert quality_scores(nothing, none).count() == 0
    assert judged(nothing).count() == 0
    assert found(nothing).count() == 0
    assert contamination(nothing, bench).count() == 0
    assert token_files(nothing, TOKENIZER).count() == 0
    assert line_report(nothing).count() == 0
    assert copies(nothing).count() == 0
    assert archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_no_benchmark_and_no_labels(docs, bench, labels):
    rows = contamination(docs, bench.where("item_id < 0")).collect()
    assert len(rows) == len(TEXTS) and not any(r["contaminated"] for r in rows)
    assert {r["score"] for r in quality_scores(docs, labels.where("doc_id < 0")).collect()} == {0.5}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).distinct().collect()}
    assert got == {i: 0 for i in range(21)} | {100: 100, 101: 100}


def near_duplicates_by_force(texts):
    sets = []
    for t in texts:
        w = words(lower(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_near_duplicates(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in duplicate_components(docs).collect()}
    assert got == near_duplicates_by_force(TEXTS)
    left = without_duplicates(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, (_, c) in got.items() if c == i}


def test_near_duplicates_in_a_large_group_with_a_shared_passage(spark):
    """Edited copies of one text, and unlike texts that share a long passage: both classes of shingles are met."""
    rng = np.random.default_rng(5)
    base, texts = prose(7, 60).split(), []
    for _ in range(90):
        w = base.copy()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(0, len(w))] = f"e{rng.integers(0, 10**6)}"
        texts.append(" ".join(w))
    for i in range(90):
        texts.append(prose(7, 60) + " " + prose(100 + i, int(rng.integers(4, 60))))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in duplicate_components(frame).collect()}
    assert got == near_duplicates_by_force(texts)


def behind_a_frequent_shingle(k):
    """Two texts at the threshold whose first shared shingle is frequent, and the next ones lie in few components (``k`` names the words).

    Own shingles come first, then the one shared with many short texts, then the
    eight that two large groups of near copies have as well.
    """
    common = [f"c{k}x{i}" for i in range(12)]
    x, y = (" ".join([own, f"f{k}", *common]) for own in (f"x{k}", f"y{k}"))
    texts = [x, y]
    for g in ("p", "q"):
        texts += [" ".join([f"u{k}{g}{i}", f"{g}{k}", *common]) for i in range(30)]
    for rare in (f"f{k}", f"p{k}"):
        texts += [" ".join([rare, *common[:4], f"z{k}{rare}{i}"]) for i in range(17)]
    return texts


def test_near_duplicates_behind_a_frequent_shingle(spark):
    """Hashes decide which shingles are ordered by frequency, so several texts are tried."""
    texts = [t for k in range(40) for t in behind_a_frequent_shingle(k)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in duplicate_components(frame).collect()}
    assert got == near_duplicates_by_force(texts)


def test_language_model_counts_and_mass(docs):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(TEXTS))}
    tokens = {i: words(lower(t or "")) + [None] for i, t in enumerate(TEXTS)}
    c = collections.Counter(x for i, ts in tokens.items() if not held[i] for x in ts)
    n, v = sum(c.values()), len(c)
    for r in scored(docs, Model()).collect():
        ts = tokens[r["doc_id"]]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ts), sum(c[x] > 0 for x in ts), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] <= 0


@pytest.mark.parametrize("direct", [8192, 5])
def test_language_model_equals_a_plain_recursion(docs, direct):
    model = Model(chunk_words=50, range_bytes=1000, direct=direct)  # many chunks and ranges, without relays and with them
    grams = collections.Counter()
    tokens = {i: words(lower(t or "")) + ["</s>"] for i, t in enumerate(TEXTS)}
    for i, ts in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            seq = ["<s>", *ts]
            for k in (1, 2, 3):
                grams.update(tuple(seq[j : j + k]) for j in range(len(seq) - k + 1))
    n = sum(x for g, x in grams.items() if len(g) == 1 and g != ("<s>",))
    v = sum(1 for g in grams if len(g) == 1 and g != ("<s>",))

    def p(h, w):
        if not h:
            return (grams[(w,)] + 0.1) / (n + 0.1 * (v + 1))
        return (grams[(*h, w)] + 2 * p(h[1:], w)) / (grams[h] + 2) if grams[h] else p(h[1:], w)

    for r in scored(docs, model).collect():
        seq = ["<s>", *tokens[r["doc_id"]]]
        expected = sum(math.log10(p(tuple(seq[max(0, j - 2) : j]), seq[j])) for j in range(1, len(seq)))
        assert r["score"] == pytest.approx(expected, rel=1e-9)


def test_packing():
    for x in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.array([1, 2**63, 5], np.uint64)):
        assert unpack(pack(x)).tolist() == x.tolist()


def test_blocks_cut_between_texts():
    texts = pa.array([None, "a b", "", "c" * 50, "d e f"])
    parts = list(blocks(texts, 10))
    assert sum(b.n for b in parts) == 5 and [b.rows.start for b in parts] == sorted(b.rows.start for b in parts)
    block = next(blocks(texts))
    starts, ends, owner = block.words()
    assert owner.tolist() == [1, 1, 3, 4, 4, 4]
    assert windows(block.hashes(starts, ends), owner, 3)[1].tolist() == [3]


def test_quality_rules(docs):
    rows = {r["doc_id"]: r for r in judged(docs).collect()}
    for i, t in enumerate(TEXTS):
        w = words(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        c = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w))
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == expected
        assert not (r["base_failed"] and r["kept"])
    kept = passing(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["kept"]}


def test_symbols_and_capitals_are_odd_and_prose_is_not(spark):
    prose_en = " ".join("the river of stones ran to the sea and we were there for it was a long day by the hill".split() * 1)
    clean = [f"{prose_en} number {i} is not like that on the map from here at all with this one" for i in range(50)]
    bad = [" ".join(x + "###" for x in clean[0].split()), clean[1].upper()]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + bad)], "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in judged(frame).collect()}
    assert all(kept[i] for i in range(50)) and not kept[50] and not kept[51]


def test_quality_votes(spark):
    good = [(i, prose(i, 60), 1) for i in range(60)]
    bad = [(100 + i, " | ".join(prose(i + 500, 60).split()), 0) for i in range(60)]
    rows = spark.createDataFrame(good + bad + [(999, "", 1)], "doc_id long, text string, quality int")
    got = quality_scores(rows.select("doc_id", "text"), rows.select("doc_id", "quality")).collect()
    right = [r["predicted"] == (r["doc_id"] < 100) for r in got if r["held_out"] and r["doc_id"] != 999]
    assert len(got) == 121 and sum(right) / len(right) > 0.95 and all(0 <= r["score"] <= 1 for r in got)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(t):
    def ok(kind, m):
        d = [int(x) for x in m if x in "0123456789"]
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 14 <= len(d) <= 19 and sum(x if j % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for j, x in enumerate(reversed(d))) % 10 == 0
        return 10 <= len(d) <= 15 if kind == "phone" else True

    return [x[2] for x in sorted((m.start(), j, f"{k}:{m.start()}:{m.end()}") for j, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, t or "") if ok(k, m[0]))]


def test_private_spans(spark, docs):
    odd = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "0001.2.3.255", "1" * 5000, "a" * 5000 + "@x", "+1 ( 2 - 3", "4111-1111-1111-1111-", "x@y.z" * 300, "+" * 50 + "12345678901"]
    frame = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string").union(docs.select("doc_id", "text"))
    texts = dict(enumerate(TEXTS)) | {100 + i: t for i, t in enumerate(odd)}
    for r in found(frame).collect():
        expected = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x.startswith(k) for x in expected) for k in PATTERNS]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("term")] == expected


def test_terms_near_entities_are_spans_and_sanitised(spark):
    rows = [(i, f"plain words {i} zork a{i}@b.org", "x") for i in range(20)] + [(50 + i, "plain words without any " * 50, "x") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: r["spans"] for r in found(frame).collect()}
    assert "term:14:18" in got[3] and got[50] == ""
    clean = {r["doc_id"]: r["text"] for r in sanitised(frame).collect()}
    assert "zork" not in clean[3] and "@" not in clean[3] and "<EMAIL>" in clean[3] and clean[50] == rows[20][1]


ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_contamination(docs, bench):
    items = {1: " ".join(BASE.split()[10:30]), 2: "one two", 10: "nowhere to be found"}
    windows_of = collections.defaultdict(set)
    for i, t in items.items():
        w = ITEM_WORDS.findall(lower(t))
        n = min(13, len(w))
        for k in range(len(w) - n + 1):
            windows_of[tuple(w[k : k + n])].add(str(i))
    for r in contamination(docs, bench).collect():
        w = ITEM_WORDS.findall(lower(TEXTS[r["doc_id"]] or ""))
        hit, its = set(), set()
        for win, ids in windows_of.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    its |= ids
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(its))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(its)).encode()).hexdigest()
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    left = decontaminated(docs, bench)
    assert left.columns == docs.columns and {0, 1, 2, 7, 8}.isdisjoint(r["doc_id"] for r in left.collect()) and left.count() == len(TEXTS) - 5


def lines_by_force(texts):
    """Of each text: lines with a word, and which are removed as equal and as similar."""
    seen, first, out = {}, [], {}
    for i, t in enumerate(texts):
        out[i] = (0, set(), set())
        n = 0
        for p, line in enumerate((t or "").split("\n")):
            w = words(line.lower())
            if not w:
                continue
            n += 1
            s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])
            if s in seen:
                out[i][1].add(p)
                continue
            if any(100 * len(s & x) >= 80 * len(s | x) for x in first):
                out[i][2].add(p)
            seen[s] = True
            first.append(s)
        out[i] = (n, *out[i][1:])
    return out


def test_lines(spark, docs):
    rng = np.random.default_rng(9)
    base = prose(11, 40).split()
    edited = []
    for _ in range(80):
        w = base.copy()
        w[rng.integers(0, 40)] = f"e{rng.integers(0, 10**6)}"
        edited.append(" ".join(w[: rng.integers(30, 41)]))
    texts = [*TEXTS, "\n".join(edited[:40]), "\n".join(edited[40:]), *(prose(12, 12) + " " + prose(50 + i, 6) for i in range(50))]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pos string")
    expected = lines_by_force(texts)
    got = {r["doc_id"]: (r["n_lines"], r["n_equal"], r["n_similar"]) for r in line_report(frame).collect()}
    assert got == {i: (n, len(e), len(s)) for i, (n, e, s) in expected.items()}
    for r in deduplicated(frame).collect():
        _, e, s = expected[r["doc_id"]]
        t = texts[r["doc_id"]]
        assert r["text"] == (t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in e | s))


def test_tokens_round_trip(spark, docs, tmp_path):
    path = f"file://{tmp_path}/tokens"
    files = write_tokens(docs, path, TOKENIZER)
    got = {r["doc_id"]: r for r in read_tokens(files).collect()}
    encode, start = Encoder(TOKENIZER).tokenizer, 0
    for i, t in enumerate(TEXTS):
        ids = np.array([*encode.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        if i in (3, 4, 9):
            held = [r["path"] for r in files.collect() if i in Reader(r["path"]).doc_ids]
            assert Reader(held[0]).document(i).tolist() == ids.tolist()


def test_damaged_frames_are_noticed(docs, tmp_path):
    path = write_tokens(docs, f"file://{tmp_path}/tokens", TOKENIZER).first()["path"].removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    reader = Reader(f"file://{path}")
    raw[int(reader.at[1]) - 3] ^= 0xFF
    open(path, "wb").write(raw)
    with pytest.raises(Exception):  # noqa: B017  zstandard's or the checksum's
        list(Reader(f"file://{path}").raw(0, 1))


def test_special_tokens_and_odd_spaces_encode_as_the_library_does():
    texts = ["", "a  b\n c\xa0 d 　x  ", "hi <|endoftext|> you<|endoftext|>", " é è", "tab\t\tx \n\n y", " 'll don't  've", "x's. 'tis 1,000.5 (a)b"]
    e = Encoder(TOKENIZER)
    for t in texts:
        ids, at = e(next(blocks(pa.array([t]))))
        assert ids[at[0] : at[1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_mixing(spark, docs):
    rows = copies(docs).collect()
    assert len(rows) == len(TEXTS) and {r["size"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0}
    assert all(0 <= r["copies"] <= 2 for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, copies(docs).collect()), key=str)
    out = mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in rows)


def test_targets_by_repeated_sharing(spark):
    sizes = {"a": 100, "b": 5000, "c": 40, "d": 900, None: 10, "z": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(frame).collect()}
    order = [*sorted(s for s in sizes if s), None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in sizes if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * weight[s] / w for s in sizes}
        over = {s for s in sizes if target[s] > 2 * sizes[s]} - capped
        if not over:
            break
        capped |= over
    assert got == pytest.approx(target)


def test_taken_words_come_near_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 400)), f"s{i % 4}") for i in range(2000)]
    frame = copies(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in frame.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("g")).collect():
        assert r["t"] == pytest.approx(r["g"], rel=0.01)


def test_archives(spark):
    html = [None, "", "short", "x" * 100, "x" * 100, "é" * 30000, "é" * 30000, "short", "y" * 99, "y" * 99, "z\r\n0\r\n\r\n" * 20]
    rows = [(10 - i, f"http://h/{i}\r\nX: y" if i % 2 else None, h, 1) for i, h in enumerate(html)]
    got = {r["page_id"]: r for r in archived(spark.createDataFrame(rows, "page_id long, url string, html string, first int")).collect()}
    first = {}
    for p, _, h, _ in sorted(rows, key=lambda r: r[0]):
        raw = (h or "").encode()
        origin = first.setdefault(raw, p) if len(raw) >= 100 else p
        r = got[p]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if origin == p else ("revisit", origin))
    assert len(got) == len(rows)


def test_chunked_framing():
    for n in (0, 1, 4096, 4097, 10000):
        assert unchunked(chunked(b"\r\n0" * n)) == b"\r\n0" * n
    assert unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    assert 0 < len(rows) and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_every_record_has_a_date_and_an_identifier_and_revisits_refer_to_responses(spark, tmp_path):
    from isobar.llm.warc import members, parsed, write_archives

    html = ["x" * 200, "x" * 200, "y" * 40_000, "y" * 40_000, "z" * 150, "x" * 200, None]
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(html)] + [(0, "http://h/0", html[0]), (None, "u", html[4]), (None, "u", html[4])]
    files = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), f"file://{tmp_path}/a")
    records = []
    for r in files.collect():
        with open(r["path"].removeprefix("file://"), "rb") as stream:
            records += [parsed(m)[0] for m in members(stream)]
    ids = [f["WARC-Record-ID"] for f in records]
    assert len(set(ids)) == len(ids) and all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", i) for i in ids)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", f["WARC-Date"]) for f in records)
    kinds = collections.Counter(f["WARC-Type"] for f in records)
    assert kinds["response"] == 5 and kinds["revisit"] == 5 and kinds["continuation"] == 2
    responses = {f["WARC-Record-ID"]: f for f in records if f["WARC-Type"] == "response"}
    for f in records:
        if f["WARC-Type"] == "revisit":
            assert responses[f["WARC-Refers-To"]]["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        if f["WARC-Type"] == "continuation":
            assert f["WARC-Segment-Origin-ID"] in responses


def test_copies_cross_integers_and_meet_targets(spark):
    """Whatever their order: no row is taken more than twice, and a source's words come near its target or its cap."""
    rng = np.random.default_rng(9)
    rows = [(i, "w " * int(rng.pareto(1.2) * 20 + 1), f"s{min(int(rng.exponential(2)), 6)}") for i in range(3000)] + [(9000 + i, None, "s9") for i in range(5)]
    found = copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == len(rows) and all(0 <= r["copies"] <= 2 for r in found)
    for s in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == s]
        taken, target = sum(r["size"] * r["copies"] for r in own), own[0]["target"]
        assert abs(taken - target) <= 0.02 * target + 1, s
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
