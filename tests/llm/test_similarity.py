"""SimHash links and groups, components, and paragraph sketches."""
from __future__ import annotations

import hashlib
import random
import time
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm import paragraph_sketch, queries, simhash
from gaugeworks.llm.components import components
from tests.conftest import SF_DIR
from tests.llm.conftest import ROWS


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def plain_fingerprint(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "word", " ", "\n", "\t", " ", "\x1c", "\x0b"]), max_size=40).map("".join),
       st.integers(1, 5))
def test_fingerprint(text, width):
    assert simhash.fingerprint(text, width) == plain_fingerprint(text, width)


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    links += [(500, 500), (None, 3), links[0]]
    want = Sets(range(600))
    for a, b in links:
        if a is not None:
            want.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    linked = {n for a, b in links if a is not None and a != b for n in (a, b)}
    assert got == {n: want.find(n) for n in linked}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


@pytest.mark.parametrize("radius, crowd", [(2, 128), (2, 1), (3, 2), (5, 1), (1, 1), (0, 1)])
def test_links_are_complete(spark, radius, crowd):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(10)}
    for base in list(prints):
        for flips in range(1, 7):
            prints |= {base ^ sum(1 << b for b in rng.sample(range(64), flips)) for _ in range(3)}
    values = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = {(a, b) for a in values for b in values if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    rows = [tuple(r) for r in simhash.links(nodes, radius, crowd).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_simhash_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {k: plain_fingerprint(t, 3) for k, t in texts.items()}
    sets = Sets(texts)
    for a in texts:
        for b in texts:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                sets.join(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, SF_DIR).collect()}
    assert got == {k: (f"{prints[k]:016x}", sets.find(k)) for k in texts}


def test_simhash_edge_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    parts = {r.doc_id: r.component_id for r in rows}
    assert parts[1] == parts[2] == 1 and parts[3] == parts[4] == parts[8] == 3
    assert parts[None] is None
    assert simhash.near_duplicates(none).count() == 0


def shingles(text):
    words = text.lower().split()
    return set(zip(*(words[i:] for i in range(5))))


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    rows, clean, copies = [], [], []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(80, 900))]
        rows.append((i, " ".join(words)))
        clean.append(i)
        for c in range(rng.choice([0, 0, 1, 3, 12])):
            copy = list(words)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 200)):
                copy[at] = rng.choice(vocabulary)
            rows.append((1000 + 100 * i + c, " ".join(copy)))
            a, b = shingles(" ".join(words)), shingles(rows[-1][1])
            assert len(a & b) / len(a | b) >= 0.8
            copies.append(1000 + 100 * i + c)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.drop_similar(docs).collect()}
    assert kept == set(clean)


def drawn(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(n)]


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_copies_with_moved_passages_are_all_found(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for i in range(120):
        words = drawn(rng, rng.randint(150, 600))
        size = round(len(words) * rng.uniform(0.17, 0.22))
        at = rng.randrange(len(words) - size)
        copy = (words + drawn(rng, size), words[:at] + drawn(rng, size) + words[at:],
                words[:at] + words[at + size * 4 // 5:])[i % 3]
        texts = " ".join(words), " ".join(copy)
        assert 0.78 < similarity(*texts) < 0.86
        rows += [(i, texts[0]), (1000 + i, texts[1])]
        want |= {i} | ({1000 + i} if similarity(*texts) < 0.8 else set())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_similar(docs).collect()} == want


def test_pairs_between_unlike_texts_under_one_key_are_found(spark):
    rng = random.Random(22)
    passage = drawn(rng, 500)
    rows = [(i, " ".join(passage + drawn(rng, 60))) for i in range(20)]
    for i in range(20):  # each copy has all the other texts' ids between its own and its original's
        words = rows[i][1].split()
        words[rng.randrange(500, 560)] = "changed"
        rows.append((100 + i, " ".join(words)))
    far = [(200 + i, " ".join(passage[:300] + drawn(rng, 200))) for i in range(40)]
    docs = spark.createDataFrame(rows + far, "doc_id long, text string")
    want = Sets([k for k, _ in rows + far])
    for a, s in rows + far:
        for b, t in rows + far:
            if a < b and similarity(s, t) >= 0.8:
                want.join(a, b)
    kept = {r.doc_id for r in simhash.drop_similar(docs).collect()}
    assert kept == {k for k in want.up if want.find(k) == k}


@pytest.mark.parametrize("own", [90, 120])
def test_every_pair_of_a_shared_key_is_compared(spark, own):
    """All share a passage too short to be similar by; copies are far from the smallest and the one before."""
    rng = random.Random(own)
    passage = drawn(rng, 300)
    texts = [passage + drawn(rng, own) for _ in range(30)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    rows += [(100 + i, " ".join(words[1:] + ["end"])) for i, words in enumerate(texts)]
    kept = {r.doc_id for r in simhash.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(30))


def test_texts_that_repeat_one_passage_stay(spark):
    rng = random.Random(23)
    passage = drawn(rng, 60)
    rows = [(i, " ".join(drawn(rng, 300) + passage * 20)) for i in range(12)]
    assert max(similarity(a, b) for i, a in rows for j, b in rows if i < j) < 0.2
    rows.append((50, rows[0][1] + " end"))
    kept = {r.doc_id for r in simhash.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(12))


def test_near_copies_come_from_fingerprints_and_are_judged(spark, monkeypatch):
    """Without any indexed shingle, copies within the radius still go, and unlike texts of equal fingerprint stay."""
    rng = random.Random(24)
    texts = [drawn(rng, 400) for _ in range(30)]
    copies = [(100 + i, " ".join(words + ["end"])) for i, words in enumerate(texts)]
    near = {k for k, s in copies
            if bin(simhash.fingerprint(s, 5) ^ simhash.fingerprint(" ".join(texts[k - 100]), 5)).count("1") <= 2}
    assert len(near) >= 20
    repeated = drawn(rng, 5) * 300                       # outweighs all else in the fingerprint
    alike = [(500 + i, " ".join(repeated + drawn(rng, 40))) for i in range(4)]
    assert len({simhash.fingerprint(s, 5) for _, s in alike}) == 1
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)] + copies + alike
    whole = simhash.prefixes
    monkeypatch.setattr(simhash, "prefixes", lambda *a: whole(*a).withColumn("prefix", F.expr("slice(prefix, 1, 0)")))
    kept = {r.doc_id for r in simhash.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {k for k, _ in rows} - near


def test_drop_similar_edge_rows(odd, none):
    kept = simhash.drop_similar(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "6", "7", "None"]
    assert simhash.drop_similar(none).count() == 0


def blocks(text):
    return set(re.findall(r"[^\n]{1,400}", text))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    """Per key in descending order: text, edited text and next text."""
    order = sorted(texts, reverse=True)
    for i, k in enumerate(order):
        text, after = texts[k], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        yield k, text, text[:len(text) - half] + after[:half], after


def test_sketch_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op9_paragraph_sketch(spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    prints = {}
    for k, text, changed, after in edited(texts):
        row = got[k]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.near_edited == pytest.approx(jaccard(blocks(text), blocks(changed)))
        assert row.near_next == pytest.approx(jaccard(blocks(text), blocks(after)))
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert (row.fingerprint == row.edited_fingerprint) == (blocks(text) == blocks(changed))
    assert len(set(prints.values())) == len(set(map(frozenset, map(blocks, prints))))


def test_peeling_recovers_or_says_so(spark):
    rng = np.random.default_rng(3)
    rows = [([int(x) for x in rng.integers(-2**62, 2**62, a)], [int(x) for x in rng.integers(-2**62, 2**62, b)],
             [int(x) for x in rng.integers(-2**62, 2**62, c)])
            for a, b, c in [(0, 0, 0), (1, 0, 50), (0, 1, 3), (5, 6, 100), (200, 0, 0), (3, 3, 0)]]
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, shared array<long>")
    got = frame.select("a", "b", "shared", paragraph_sketch.likeness(
        F.concat("a", "shared"), F.concat("shared", "b"), F.lit(16)).alias("near"), paragraph_sketch.retried(
            F.concat("a", "shared"), F.concat("shared", "b")).alias("again")).collect()
    for r in got:
        union = len(r.a) + len(r.b) + len(r.shared)
        want = pytest.approx(len(r.shared) / union if union else 1.0)
        assert r.again == want
        assert r.near is None if len(r.a) + len(r.b) > 48 else r.near == want


def test_texts_of_many_lines_take_seconds(spark):
    lines = [f"line {i} of a long log" for i in range(20_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[:15_000] + [f"other {i}" for i in range(5_000)]))]
    start = time.monotonic()
    got = {r.doc_id: r for r in paragraph_sketch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.monotonic() - start < 90
    texts = dict(rows)
    for k, text, changed, after in edited(texts):
        assert got[k].near_edited == pytest.approx(jaccard(blocks(text), blocks(changed)))
        assert got[k].near_next == pytest.approx(jaccard(blocks(text), blocks(after)))


def test_sketch_edge_rows(odd, none, spark):
    rows = paragraph_sketch.fingerprints(odd).collect()
    assert len(rows) == len(ROWS)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert len({r.fingerprint for r in rows if r.doc_id in (3, 4)}) == 1
    assert paragraph_sketch.fingerprints(none).count() == 0
    alone = paragraph_sketch.fingerprints(spark.createDataFrame([(5, "one\ntwo")], "doc_id long, text string")).first()
    assert (alone.near_next, alone.n_chars) == (1.0, 7)


def test_rows_of_unequal_length_under_one_key_are_edited_in_full(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    rows = [(7, text(3000)), (5, text(40)), (5, ""), (5, text(1200)), (5, text(2001)), (3, text(900)), (3, None),
            (None, text(1500)), (None, ""), (None, text(10))]
    after = {7: [t for k, t in rows if k == 5], 5: [t for k, t in rows if k == 3],
             3: [t for k, t in rows if k is None], None: [rows[0][1]]}
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    least = {r.text or "": r.h for r in frame.collect()}
    want = []
    for k, t in rows:
        t = t or ""
        head, half = min((x or "" for x in after[k]), key=lambda x: least[x]), len(t) // 2
        changed = t[:len(t) - half] + head[:half]
        want.append((str(k), len(t), hashlib.sha256(changed.encode()).hexdigest(), round(jaccard(blocks(t), blocks(changed)), 6)))
    got = paragraph_sketch.fingerprints(frame.drop("h")).collect()
    assert sorted(want) == sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 6)) for r in got)
