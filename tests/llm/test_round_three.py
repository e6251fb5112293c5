"""Part codes, spelling variants and quality scores."""
from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm import part_codes, quality, queries, spelling
from tests.conftest import SF_DIR

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType())])


# ---- part codes

def plain_codes(rows, parts, entries, rounds, scale=4096):
    """Lloyd that compares every part with every entry in every round, with Python integers."""
    def whole(x):
        return int(np.floor(max(-part_codes.LARGEST, min(part_codes.LARGEST, x * scale))))

    kept = [(k, [whole(x) for x in v], label) for k, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for r in range(rounds + 1):
        found = [[best(c[p], books[p]) for p in range(parts)] for c in cut]
        for p in range(parts if r < rounds else 0):
            for e in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    totals = defaultdict(int)
    for (_, _, label), f in zip(kept, found):
        totals[label] += sum(d for d, _ in f)
    sha = part_codes.digest(np.array(books, dtype=object))
    return [(k, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), totals[label], sha)
            for (k, _, label), f in zip(kept, found)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_codes_with_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=10).round(1)], int(i % 3) if i % 4 else None) for i in range(120)]
    rows += [(3, rows[3][1], 1), (3, rows[3][1], 1), (None, rows[5][1], 2), (200, None, 1), (201, [1.0, None] * 5, 1),
             (202, [float("nan")] + [0.0] * 9, 1), (203, [float("-inf")] + [0.0] * 9, 1), (204, [1.0, 2.0], 1),
             (205, [], 2), (206, [1e300] + [0.0] * 9, 0), (207, [-1e5] + [0.25] * 9, None)]
    rows += [(300 + i, [0.5] * 10, 7) for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(5)
    for parts, entries in ((8, 16), (3, 4), (10, 256)):
        got = part_codes.codes(df, parts=parts, entries=entries)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert ordered(got.collect()) == ordered(plain_codes(rows, parts, entries, 6))


def test_codes_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 1, "x")], VECTORS)
    assert part_codes.codes(df).collect() == [] == part_codes.codes(df.limit(0)).collect()


def test_query_of_codes_equals_brute_force(spark):
    table = pd.read_parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(int(r.vec_id), None if r.embedding is None else [float(x) for x in r.embedding], int(r.label))
            for r in table.itertuples()]
    got = queries.op12_part_codes(spark, SF_DIR)
    assert ordered(got.collect()) == ordered(plain_codes(rows, 8, 16, 6))


@settings(max_examples=60, deadline=None)
@given(hnp.arrays(np.int64, (30, 2, 2), elements=st.integers(-3, 3)),
       st.lists(hnp.arrays(np.int64, (2, 5, 2), elements=st.integers(-3, 3)), min_size=1, max_size=5))
def test_active_entries_give_what_a_full_scan_gives(x, all_books):
    code, near = np.zeros((30, 2), np.int64), np.zeros((30, 2), np.int64)
    last = None
    for books in all_books:
        # Keep some entries where they were, so that both ways are taken.
        if last is not None:
            books = np.where(np.arange(5)[None, :, None] % 2 == 0, last, books)
        moved = np.ones((2, 5), bool) if last is None else (books != last).any(2)
        part_codes.reassign(x, code, near, books, moved)
        apart = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        assert (code == apart.argmin(2)).all() and (near == apart.min(2)).all()
        last = books


def test_distances_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 20, 1 << 28):
        a, b = rng.integers(-top, top, (20, 8)), rng.integers(-top, top, (7, 8))
        want = [[sum((int(p) - int(q)) ** 2 for p, q in zip(r, c)) for c in b] for r in a]
        assert part_codes.distances(a, b).tolist() == want


# ---- spelling variants

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def plain_groups(words):
    near = {w: [] for w in words}
    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w in words:
        for other in by_size[len(w)] + by_size[len(w) + 1]:
            if one_edit(w, other):
                near[w].append(other)
                if len(other) > len(w):
                    near[other].append(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()]


def test_query_of_spelling_equals_brute_force(spark):
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    words = plain_words(zip(table.doc_id, table.text))
    got = queries.op13_spelling(spark, SF_DIR)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert ordered(got.collect()) == ordered(plain_groups(words))


@pytest.mark.parametrize("block_chars", [20, 300, 1 << 16])
def test_groups_for_any_block_size(spark, block_chars):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abcÀÿ"), rng.integers(7, 10))): int(rng.integers(2, 3000)) for _ in range(400)}
    # A chain of forms, ties in count, anagrams, and a very long word with its variants.
    words |= {"chainword": 2, "chainwords": 30, "chainwordss": 400, "chainwordsst": 90000, "tiesone": 3, "tieszne": 50,
              "tiesyne": 50, "abcdefg": 5, "bacdefg": 5, "z" * 30_000: 4, "z" * 30_001: 400, "z" * 29_999 + "y": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert ordered(spelling.group_variants(df, block_chars=block_chars).collect()) == ordered(plain_groups(words))


def test_spelling_of_odd_documents(spark, odd, none):
    long = odd.withColumn("text", F.when(F.col("doc_id") == 6, F.concat(
        F.repeat(F.lit("Wörterbuch\t"), 30_000), F.repeat(F.lit("q"), 1_000_000), F.lit(" "),
        F.repeat(F.lit("q"), 1_000_000))).otherwise(F.col("text")))
    rows = [(r["doc_id"], r["text"]) for r in long.collect()]
    got = spelling.group_variants(spelling.vocabulary(spelling.occurrences(long)))
    assert ordered(got.collect()) == ordered(plain_groups(plain_words(rows)))
    assert spelling.group_variants(spelling.vocabulary(spelling.occurrences(none))).collect() == []


# ---- quality

def test_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 6)).round(1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.fit(x, y, trees=15)

    def walk(row):
        total = model.base
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + bool(row[feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(model.margins(x), [walk(r) for r in x])
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97
    assert np.array_equal(quality.fit(x, y, trees=15).leaf, model.leaf)


def test_best_cut_is_the_one_brute_force_finds():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 8, (200, 3)).astype(float)
    y = (rng.random(200) < 0.2 + 0.6 * (x[:, 1] > 4)).astype(float)
    model = quality.fit(x, y, trees=1, depth=1)
    p = y.mean()

    def gain(inside):
        g, h = y - p, np.full(200, p * (1 - p))
        return sum(g[m].sum() ** 2 / (h[m].sum() + quality.RIDGE) for m in (inside, ~inside))

    best = max(((gain(x[:, f] <= c), f, c) for f in range(3) for c in range(7)), key=lambda b: b[0])
    assert (model.feature[0, 0], model.cut[0, 0]) == best[1:]
    for side in (0, 1):
        rows = (x[:, best[1]] > best[2]) == side
        assert np.isclose(model.leaf[0, side], quality.RATE * (y[rows] - p).sum() / (rows.sum() * p * (1 - p) + quality.RIDGE))


def test_statistics_of_texts():
    at = {n: i for i, n in enumerate(quality.FEATURES)}
    for text in ("", " ", "\n\n", "a", "!!!", "\ud800 lone", "x" * 1_000_000, "1" * 5000, "a\tb\t" * 1000, "l\n" * 100_000):
        found = quality.statistics(text)
        assert found.shape == (len(at),) and np.isfinite(found).all()
    found = quality.statistics("One two. ONE two.\nsame\nsame\n")
    assert found[at["log_words"]] == np.log1p(6) and np.isclose(found[at["distinct_words"]], 4 / 6)
    assert np.isclose(found[at["marked_words"]], 2 / 6) and np.isclose(found[at["shouted_words"]], 1 / 6)
    assert np.isclose(found[at["repeated_lines"]], 1 / 3) and np.isclose(found[at["top_word"]], 2 / 6)
    # Counts over whole texts: what is only at the end of a long text is seen.
    assert quality.statistics("word " * 200_000 + "#" * 1000)[at["symbol"]] > 0


def test_quality_of_held_out_rows(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    got = queries.op11_quality(spark, folder).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    judged = pd.read_parquet(f"{folder}/labels.parquet").merge(got[got.held_out], on="doc_id")
    assert (judged.predicted == judged.quality).mean() >= 0.98 and judged.quality.nunique() == 2


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (quality.train(docs, kept) for kept in (labels, turned))
    assert np.array_equal(a.leaf, b.leaf) and np.array_equal(a.cut, b.cut)


def test_quality_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (6, 0), (7, 1), (8, 0)],
                                   "doc_id long, quality int")
    for known in (labels, labels.where("quality = 1"), labels.limit(0)):
        got = quality.score(odd, quality.train(odd, known)).collect()
        assert len(got) == odd.count()
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
        repeated = [r for r in got if r["doc_id"] == 2]
        assert len(repeated) == 2 and repeated[0] == repeated[1]
        if known is not labels:
            assert len({r["score"] for r in got}) == 1
    assert quality.score(none, quality.train(none, labels)).collect() == []
