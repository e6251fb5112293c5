"""Personal data, severity and the pipeline as a whole."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from gaugeworks.llm import pii, queries, severity
from gaugeworks.llm.common import hash_sample
from tests.conftest import SF_DIR
from tests.llm.conftest import ROWS

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
PARTS = st.sampled_from(["a", ".", "@", "-", "1", "22", "256", "255", "+", "+4", " ", "(", ")", "4871316720949013",
                         "\n", "é", "%", "b.c", "4111 1111-1111 1111", "0000", "٣", "12345678"])


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
            checks = sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 16 <= len(digits) <= 19 and checks or kind == 3 and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=30).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1." * 100_000, "1 " * 200_000):
        pii.find_spans([text], pii.Model.empty())


def exact_marginals(model, features, observed, chain, skip):
    """By summing over all labellings."""
    n = len(features)
    total = np.zeros((n, pii.LABELS))
    for code in range(pii.LABELS ** n):
        labels = [code // pii.LABELS ** i % pii.LABELS for i in range(n)]
        if any(o >= 0 and o != k for o, k in zip(observed, labels)):
            continue
        score = sum(model.unary[f, k].sum() for f, k in zip(features, labels) )
        score -= sum(model.unary[f, k].sum() for f, k, o in zip(features, labels, observed) if o >= 0)
        score += sum(model.chain[labels[a], labels[b]] for a, b in chain)
        score += sum(model.skip[labels[a], labels[b]] for a, b in skip)
        total[range(n), labels] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_are_exact_without_loops_and_close_with_one():
    rng = np.random.default_rng(2)
    symmetric = lambda: (lambda m: (m + m.T) / 2)(rng.normal(size=(pii.LABELS, pii.LABELS)))
    model = pii.Model(rng.normal(size=(pii.BUCKETS, pii.LABELS)), symmetric(), symmetric())
    features = [list(rng.integers(0, pii.BUCKETS, pii.SLOTS)) for _ in range(4)]
    for chain, skip, near in (([(0, 1), (1, 2)], [(2, 3)], 1e-2), ([(0, 1), (1, 2)], [(0, 3), (2, 3)], 0.2)):
        for observed in ([-1] * 4, [-1, 2, -1, -1]):
            nodes = pii.Nodes([(0, 0)] * 4, features, observed, chain, skip)
            want = exact_marginals(model, features, observed, chain, skip)
            assert np.abs(pii.marginals(model, nodes) - want).max() < near


def test_repeated_tokens_get_one_label(spark):
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    rows = []
    for i in range(400):
        number = digits(9)
        again = "0" if i % 2 else "+49"
        rows.append((i, f"call +49{number} now, order {digits(5)} of user{digits(2)}. later call {again}{number} again"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    assert np.trace(model.skip) > 0
    alone, together = (pii.find_spans([t], model)[0] for t in
                       ("order 51234 of user12", "call +49512345678 now. order 51234. later call 0512345678 again"))
    assert alone == ([], [])
    base, added = together
    assert [k for k, _, _ in base] == [3]
    assert not any(set(range(a, b)) & set(range(c, d)) for _, a, b in base for _, c, d in added)


def planted(rng, n):
    """Texts with what repeats a pattern's find (wanted spans) and what only looks alike."""
    digits = lambda k: "".join(rng.choice("123456789") for _ in range(k))

    def card():
        body = digits(15)
        return next(body + c for c in "0123456789" if pii.luhn(body + c))

    for i in range(n):
        phone, good, bad = digits(9), card(), digits(16)
        while pii.luhn(bad):
            bad = digits(16)
        parts = ["words of no interest", f"call +49{phone} now"]
        wanted = []
        if i % 2:
            parts += [f"later call 0{phone}", "again"]
            wanted.append(f"0{phone}")
        if i % 3 == 0:
            split = "\n".join(good[j:j + 4] for j in range(0, 16, 4))
            parts += ["card " + " ".join(good[j:j + 4] for j in range(0, 16, 4)), f"once more {split} end"]
            wanted.append(split)
        order = digits(10)
        parts += [f"order {order} sent", f"order {order} paid", f"number {bad}", f"serial {digits(9)} of {digits(5)}"]
        text, spans = "", set()
        for part in parts:
            text += part + ". "
        for w in wanted:
            at = text.rindex(w)
            spans.add((at, at + len(w)))
        yield text, spans


def test_added_spans_have_measured_precision_and_recall(spark):
    rows = list(planted(random.Random(12), 1200))
    model = pii.train(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string"))
    right = added = wanted = 0
    for (text, spans), (base, more) in zip(rows, pii.find_spans([t for t, _ in rows], model)):
        covered = {c for _, a, b in more for c in range(a, b)}
        taken = {c for _, a, b in base for c in range(a, b)}
        wanted += len(spans)
        right += sum(covered | taken >= set(range(a, b)) for a, b in spans)
        inside = {c for a, b in spans for c in range(a, b)}
        added += len(more)
        assert all(set(range(a, b)) <= inside | taken for _, a, b in more), text
    print("added", added, "recall", right / wanted)
    assert right / wanted >= 0.9


def test_shape_alone_adds_nothing(spark):
    text = "card 4871316720949013 and card 1234567812345678 and $$$4871316720949013$$$"
    model = pii.train(spark.createDataFrame([(0, text)] * 50, "doc_id long, text string"))
    base, added = pii.find_spans([text], model)[0]
    assert "1234567812345678" not in [text[a:b] for _, a, b in base + added]
    assert all("$" not in text[a:b] for _, a, b in added)


def test_long_digit_runs_and_long_tokens():
    long = "0" * 5000
    for text, want in ((f"{long}.1.2.3", 1), (f"1.2.3.{long}7", 1), (f"1.{long}256.2.3", 0), (f"1.2.3.{'9' * 5000}", 0)):
        assert [k for k, _, _ in pii.base_spans(text)].count(1) == want
    assert [pii._is_byte(str(n)) for n in (0, 9, 99, 100, 255, 256, 999, 1000)] == [True] * 5 + [False] * 3
    model = pii.Model.empty()
    model.skip[0, 0] = 8.0
    name = "a" * 300 + "@example.org"
    base, added = pii.find_spans([f"{name} or ({name.upper()}.) end"], model)[0]
    assert len(base) == 2 and added == []
    for text in (("1" * 1_000_000), ("x1" * 500_000), "9\t" * 200_000):
        pii.find_spans([text], model)


def test_skip_edges_carry_a_label_to_a_distant_token():
    text = "call +49512345678 now " + "word " * 50 + "or 0512345678 again"
    model = pii.Model.empty()
    model.skip[3, 3] = 8.0
    base, added = pii.find_spans([text], model)[0]
    assert [text[a:b] for _, a, b in added] == ["0512345678"] and len(base) == 1
    assert pii.find_spans(["or 0512345678 again"], model)[0] == ([], [])


@pytest.mark.parametrize("known", [0, 14, 29])
def test_all_of_thirty_repeats_get_the_label(known):
    words = [f"{'call +49512345678' if i == known else 'or 0512345678'} {'word ' * 20}" for i in range(30)]
    text = "".join(words)
    model = pii.Model.empty()
    model.skip[3, 3] = 8.0
    base, added = pii.find_spans(["nothing here", text], model)[1]
    assert len(base) == 1 and [text[a:b] for _, a, b in added] == ["0512345678"] * 29


def test_messages_reach_the_end_of_a_long_chain():
    rng = np.random.default_rng(6)
    n, skip = 400, 8.0 * np.eye(pii.LABELS)
    model = pii.Model(np.zeros((pii.BUCKETS, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), skip)
    nodes = pii.Nodes([(0, 0)] * n, [list(rng.integers(0, pii.BUCKETS, pii.SLOTS)) for _ in range(n)],
                      [2] + [-1] * (n - 1), [], [(i, i + 1) for i in range(n - 1)])
    step = np.exp(skip) / np.exp(skip).sum(axis=1, keepdims=True)
    want = np.stack([np.linalg.matrix_power(step, i)[2] for i in range(n)])
    assert np.abs(pii.marginals(model, nodes) - want).max() < 1e-2


def test_pii_edge_rows(odd, none):
    model = pii.train(odd)
    rows = pii.detect(odd, model).collect()
    assert len(rows) == len(ROWS) and sum(r.n_phone for r in rows) == 1
    clean = pii.redact(odd, model)
    assert clean.columns == odd.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[None] == "no key here <PHONE>" and texts[4] is None
    assert pii.detect(none, pii.train(none)).count() == pii.redact(none, pii.train(none)).count() == 0


def test_pii_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op2_pii_skip_chain(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        count = Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in range(4))
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(filter(None, r.spans.split(",")))


def test_ordinal_fit_recovers_weights_and_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    score = x @ np.array([2.0, -1.0, 0.0])
    grade = np.searchsorted([-1.0, 0.5, 2.0], score + rng.logistic(size=4000))
    row, column = np.divmod(np.arange(12000), 3)
    w, t = severity.fit(row, column, x.ravel(), grade, np.ones(4000), 3, 4, ridge=0.0)
    assert w == pytest.approx([2, -1, 0], abs=0.2) and t == pytest.approx([-1, 0.5, 2], abs=0.25)
    assert list(t) == sorted(t)


def test_held_out_accuracy(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = severity.train(docs, labels.where("doc_id % 3 <> 0"))
    scored = severity.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = sum((r.toxic == 1) == r.rejected for r in scored)
    assert right / len(scored) > 0.98
    wrong = sum(r.rejected and r.toxic == 0 for r in scored)
    assert wrong <= 6
    assert all(0 <= r.expected_severity <= 3 for r in scored)
    toxic = sorted((r.expected_severity, r.grade) for r in scored if r.toxic)
    assert [g for _, g in toxic] == sorted(g for _, g in toxic)


def test_severity_edge_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, None), (2, 0), (None, 1), (6, 1), (6, 0)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 0")):
        model = severity.train(odd, some)
        assert severity.score(odd, model).count() == len(ROWS)
        assert severity.keep_clean(odd, model).columns == odd.columns
    quiet = severity.train(odd, labels.limit(0))
    assert severity.keep_clean(odd, quiet).count() == len(ROWS)
    assert severity.score(none, severity.train(none, labels)).count() == 0


def test_hash_sample_is_bounded_and_repeats(spark):
    rows = spark.range(20_000)
    one = {r.id for r in hash_sample(rows, "id", 500, "x").collect()}
    assert one == {r.id for r in hash_sample(rows.repartition(7), "id", 500, "x").collect()}
    assert 400 < len(one) < 600
    assert hash_sample(rows, "id", 50_000, "x").count() == 20_000


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        path_rows = docs.collect()
        assert {r.doc_id for r in path_rows} <= seen
        docs, seen = spark.createDataFrame(path_rows, docs.schema), {r.doc_id for r in path_rows}
    last = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in last} == seen and all(r.exact for r in last)
    assert all(len(r.ids) == 4 * r.n_tokens for r in last)
    assert not any(pii.base_spans(r.text) for r in path_rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_edge_rows(spark, odd, none, name, stage):
    given = odd.select("doc_id", "text", "lang", "source", "n_chars")
    out = stage(spark, given, SF_DIR)
    assert 0 < out.count() <= len(ROWS)
    empty = stage(spark, none.select("doc_id", "text", "lang", "source", "n_chars"), SF_DIR)
    assert empty.count() == 0
