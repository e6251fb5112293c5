"""MaxScore, sharding and source mixing."""
from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import maxscore, mixing, queries, sharding
from tests.conftest import SF_DIR
from tests.llm.conftest import ROWS


def brute(ids, vectors, query_ids, wanted, k):
    out = []
    for name, q in zip(query_ids, wanted):
        scored = sorted((-int(q @ v), int(i)) for i, v in zip(ids, vectors) if i != name)
        out += [(int(name), i, -s) for s, i in scored[:k]]
    return sorted(out)


@pytest.mark.parametrize("spread, dims, seed", [(3, 4, 1), (40, 64, 2), (1, 2, 3), (2 ** 29, 5, 4), (40, 16, 5)])
def test_search_is_exact(spread, dims, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (700, dims))
    vectors[rng.random(vectors.shape) < 0.4] = 0
    ids = rng.permutation(700)
    wanted = vectors[:30]
    q, i, s, _ = maxscore.search(ids, vectors, ids[:30], wanted, 7, run=100)
    right = brute(ids, vectors, ids[:30], wanted, 7)
    assert sorted(zip(ids[:30][q].tolist(), i.tolist(), s.tolist())) == right
    # A goal that is the k-th score among some of the vectors changes no result.
    pilot = brute(ids[:90], vectors[:90], ids[:30], wanted, 7)
    goals = np.array([min(p[2] for p in pilot if p[0] == name) for name in ids[:30]], object)
    q, i, s, _ = maxscore.search(ids, vectors, ids[:30], wanted, 7, run=100, goals=goals)
    assert sorted(zip(ids[:30][q].tolist(), i.tolist(), s.tolist())) == right


def test_sparse_vectors_skip_most_products():
    rng = np.random.default_rng(6)
    rows, terms = 4000, 300
    vectors = np.zeros((rows, terms), np.int64)
    for row in vectors:                       # frequent terms weigh little, as in texts
        on = np.unique((terms * rng.random(25) ** 3).astype(int))
        row[on] = rng.integers(1, 6, len(on)) * (1 + on // 20)
    ids, wanted = np.arange(rows), vectors[:40]
    q, i, s, products = maxscore.search(ids, vectors, ids[:40], wanted, 10, run=500)
    assert sorted(zip(q.tolist(), i.tolist(), s.tolist())) == brute(ids, vectors, ids[:40], wanted, 10)
    in_postings = sum(int(np.count_nonzero(vectors[:, np.flatnonzero(w)])) for w in wanted)
    assert products < 0.5 * in_postings


def test_search_rows(spark):
    rows = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [2.0]), (8, []), (20, [1.0, 1.0]), (20, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    vectors = maxscore.integers(table)
    for pilot in (1, 3, 100):
        got = maxscore.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=3, shard_rows=2, pilot_rows=pilot).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
            (20, 1, 7, 8192), (20, 2, 1, 1024), (20, 3, 2, 1024)]
    none = table.limit(0)
    empty = maxscore.integers(none)
    assert maxscore.top_k(empty, empty, 3).count() == 0


def place(spark, weights, grown=None, n=4000, **shape):
    keys = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    return {r.doc_id: (r.shard, r.grown_shard) for r in sharding.assign(keys, weights, grown, **shape).collect()}


def plain_descent(spark, weights, racks, regions, n):
    """The same walk in Python over draws taken one by one."""
    nodes = sharding.tree(weights, racks, regions)
    wanted = {}
    for region, inside in nodes.items():
        wanted["region", region] = sum(w for s in inside.values() for w in s.values())
        for rack, shards in inside.items():
            wanted["rack", rack] = sum(shards.values())
            wanted |= {("shard", s): w for s, w in shards.items()}
    columns = [sharding.draw(F.col("id"), level, child, w).alias(f"{level}{child}") for (level, child), w in wanted.items()]
    out = {}
    for row in spark.range(n).select("id", *columns).collect():
        region = min(nodes, key=lambda r: row[f"region{r}"])
        rack = min(nodes[region], key=lambda k: row[f"rack{k}"])
        out[row["id"]] = min(nodes[region][rack], key=lambda s: row[f"shard{s}"])
    return out


@pytest.mark.parametrize("racks, regions", [(4, 5), (7, 2), (40, 1), (1, 1), (3, 4)])
def test_descent_equals_plain_walk(spark, racks, regions):
    weights = [1.0 + i % 3 for i in range(40)]
    weights[7] = 0.0
    got = place(spark, weights, n=1000, racks=racks, regions=regions)
    assert {k: s for k, (s, _) in got.items()} == plain_descent(spark, weights, racks, regions, 1000)
    assert 7 not in {s for s, _ in got.values()}


def test_trees_differ(spark):
    shapes = [place(spark, [1.0] * 40, n=1000, racks=r, regions=g) for r, g in ((4, 5), (7, 2), (40, 1))]
    for i, a in enumerate(shapes):
        for b in shapes[:i]:
            assert sum(a[k] != b[k] for k in a) > 500


def test_changes_stay_in_their_subtree(spark):
    shape = {"racks": 2, "regions": 3}         # racks of two shards, regions of three racks: two regions
    even = {k: s for k, (s, _) in place(spark, [1.0] * 12, **shape).items()}
    assert max(Counter(even.values()).values()) < 1.35 * 4000 / 12
    for weight in (3.0, 0.0):
        changed = {k: s for k, (s, _) in place(spark, [1.0] * 3 + [weight] + [1.0] * 8, **shape).items()}
        moved = {k for k in even if changed[k] != even[k]}
        rack, region = {2, 3}, set(range(6))   # the changed shard's rack and region
        for k in moved:
            was, now = even[k], changed[k]
            # In or out of the region; within it in or out of the rack; within that in or out of the shard.
            gains, loses = (now, was) if weight > 1 else (was, now)
            assert (gains in region) and (loses not in region or gains in rack and (loses not in rack or gains == 3))
        ratio = Counter(changed.values())[3] / Counter(even.values())[3]
        assert 2.2 < ratio < 3.4 if weight else ratio == 0
        inside = sum(s in region for s in changed.values()) / 4000
        assert abs(inside - (5 + weight) / (11 + weight)) < 0.03


@pytest.mark.parametrize("n", [1, 4, 12, 40])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    rows = place(spark, [1.0] * n, [1.0] * (n + 1))
    moved = [g for s, g in rows.values() if g != s]
    assert set(moved) == {n} and abs(len(moved) / 4000 - 1 / (n + 1)) < 0.03


def test_no_shards_is_an_error(spark):
    with pytest.raises(ValueError):
        sharding.assign(spark.range(1).selectExpr("id AS doc_id", "'x' AS text"), [0.0])


def test_slots_and_edge_rows(odd, none):
    rows = sharding.assign(odd, [1.0] * 3, [1.0] * 4).collect()
    assert len(rows) == len(ROWS)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 3)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sorted(r["size"] for r in rows) == sorted(16 + len((t[1] or "").encode()) for t in ROWS)
    assert sharding.assign(none, [1.0] * 3).count() == 0


def test_sharding_query(spark):
    import zlib

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op7_sharding(spark, SF_DIR).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {
        k: (len(t) + 16, zlib.crc32(t)) for k, t in texts.items()}
    assert all(0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) for r in rows)


def plain_rake(cells, powers, share, rounds=300):
    """Tokens kept per cell, by bisection for every value's factor instead of a closed form."""
    def factor(held, wanted, total):
        low, high = 0.0, max(h / w for h, w in zip(held, wanted))
        for _ in range(200):
            middle = (low + high) / 2
            if sum(min(h, middle * w) for h, w in zip(held, wanted)) < total:
                low = middle
            else:
                high = middle
        return high

    names, n = [c[:-1] for c in cells], [c[-1] for c in cells]
    targets = []
    for m, power in enumerate(powers):
        held = defaultdict(float)
        for name, tokens in zip(names, n):
            held[name[m]] += tokens
        wanted = {v: h ** power for v, h in held.items()}
        f = factor(list(held.values()), [wanted[v] for v in held], share * sum(n))
        targets.append({v: min(h, f * wanted[v]) for v, h in held.items()})
    weight = [float(x) for x in n]
    for _ in range(rounds):
        for m, target in enumerate(targets):
            for value, total in target.items():
                own = [i for i, name in enumerate(names) if name[m] == value]
                f = factor([n[i] for i in own], [weight[i] for i in own], total)
                for i in own:
                    weight[i] *= f
    return targets, {name: min(1.0, w / tokens) for name, w, tokens in zip(names, weight, n)}


@pytest.mark.parametrize("share, powers", [(0.5, (0.5, 0.0, 1.0)), (0.85, (0.6, 0.7, 0.8)), (1.0, (0.0, 0.0, 0.0))])
def test_raking_meets_all_margins(spark, share, powers):
    rng = np.random.default_rng(7)
    cells = [(s, lang, t, int(rng.integers(50, 2000) * (20 if s == "a" else 1)))
             for s in "abcd" for lang in ("en", "de", "fr") for t in "xy"]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, n_tokens long")
    raked = mixing.rake(mixing.flattened(frame, dict(zip(mixing.MARGINS, powers)), share))
    rows = raked.collect()
    targets, chances = plain_rake(cells, powers, share)
    for m, margin in enumerate(mixing.MARGINS):
        held = defaultdict(float)
        for r in rows:
            held[r[margin]] += r.probability * r.n_tokens
            assert r[f"target_{margin}"] == pytest.approx(targets[m][r[margin]], rel=1e-9)
        assert all(held[v] == pytest.approx(t, rel=1e-8) for v, t in targets[m].items())
    for r in rows:
        assert r.probability == pytest.approx(chances[r.source, r.lang, r.topic], rel=1e-5)
    report = {(r.margin, r.value): (r.wanted, r.reached) for r in mixing.margins_of(raked).collect()}
    assert len(report) == 9 and all(a == pytest.approx(b) for a, b in report.values())


def test_contradicting_margins_end_and_are_reported(spark):
    # Nearly all of source a is English: both cannot be halved and kept together.
    cells = spark.createDataFrame([("a", "en", "x", 1000), ("b", "de", "x", 10), ("b", "en", "x", 1)],
                                  "source string, lang string, topic string, n_tokens long")
    raked = mixing.rake(mixing.flattened(cells, {"source": 1.0, "lang": 0.0, "topic": 1.0}, 0.5))
    report = {(r.margin, r.value): r.reached / r.wanted for r in mixing.margins_of(raked).collect()}
    assert all(0 < r.probability <= 1 for r in raked.collect()) and len(report) == 5


def test_query_meets_its_margins(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    rows = mixing.marked(spark.read.parquet(f"{folder}/documents.parquet"), mixing.text_form())
    cells = rows.groupBy(*mixing.MARGINS).agg(F.sum("n_tokens").alias("n_tokens"))
    raked = mixing.rake(mixing.flattened(cells, queries.MIX_POWERS, queries.MIX_SHARE))
    worst = max(abs(r.reached / r.wanted - 1) for r in mixing.margins_of(raked).collect())
    assert worst <= mixing.TOLERANCE


def test_mixing_edge_rows(odd, none):
    powers = {"source": 0.7, "lang": 0.8, "topic": 0.9}
    kept = mixing.mix(odd, mixing.text_form(), powers, 1.0)
    assert kept.columns == odd.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd.collect()))
    assert mixing.mix(none, mixing.text_form(), powers, 0.5).count() == 0
    half = mixing.sample(odd, mixing.text_form(), powers, 0.5).collect()
    assert len(half) <= len(ROWS) and all(r.n_tokens >= 1 for r in half)
