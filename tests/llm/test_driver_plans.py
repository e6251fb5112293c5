"""What the driver plans: short rounds for links that are stars, no shuffles for few cells."""
from __future__ import annotations

import pytest

from gaugeworks.llm import components as component_rounds
from gaugeworks.llm import mixing, simhash


@pytest.fixture
def cuts(monkeypatch):
    """The plans of all frames whose lineage is cut."""
    seen = []
    for module in (component_rounds, mixing):
        def kept(df, cut=module.cut_lineage):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return cut(df)
        monkeypatch.setattr(module, "cut_lineage", kept)
    return seen


@pytest.mark.parametrize("links, want, most", [
    ([], {}, 1),
    ([(5, 1), (1, 7), (9, 3), (9, 3), (4, 4), (None, 2)], {1: 1, 5: 1, 7: 1, 3: 3, 9: 3}, 1),
    ([(1, 2), (2, 3)], {1: 1, 2: 1, 3: 1}, 5),
])
def test_no_round_only_confirms(spark, cuts, links, want, most):
    got = component_rounds.components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert len(cuts) <= most


CELLS = [(s, lang, t, 10 + 7 * i * i % 90) for i, (s, lang, t) in enumerate(
    (s, lang, t) for s in "abcd" for lang in ("en", "de", "unknown") for t in ("long", "short"))]


def test_few_cells_are_raked_without_shuffles(spark, cuts, monkeypatch):
    cells = spark.createDataFrame(CELLS, "source string, lang string, topic string, n_tokens long").repartition(6)
    powers = {"source": 0.7, "lang": 0.8, "topic": 0.9}

    def raked(at_once):
        cuts.clear()
        monkeypatch.setattr(mixing, "CELLS_AT_ONCE", at_once)
        rows = mixing.rake(mixing.flattened(cells, powers, 0.7)).collect()
        return {(r.source, r.lang, r.topic): r.probability for r in rows}, cuts[1:]

    few, plans = raked(len(CELLS))
    many, shuffled = raked(len(CELLS) - 1)
    assert plans and not any("Exchange" in p for p in plans)
    assert shuffled and all("Exchange hashpartitioning" in p for p in shuffled)
    assert few.keys() == many.keys() and all(few[k] == pytest.approx(many[k], rel=1e-9) for k in many)


def test_chains_over_components_stay_joined(spark):
    """Links that the index alone brings join components that fingerprints and hubs made before."""
    words = [f"w{i}" for i in range(60)]
    texts = [(10 * c + i, " ".join(words[c * 3:c * 3 + 40 - i] + [f"end{c}"])) for c in range(6) for i in range(3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {i: set(simhash.shingles(t, 5)) for i, t in texts}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    kept = simhash.drop_similar(docs, width=5, similarity=0.8)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*root.values()})
