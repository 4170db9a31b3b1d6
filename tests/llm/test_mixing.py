from __future__ import annotations

import math
import random

import numpy as np
import pytest

from rowan.llm import mixing
from rowan.llm.mixing import (
    domain_totals, fit_domains, fit_rates, memberships, mix_documents, mixed_rates, smoothed_targets,
)
from tests.llm.plain import AWKWARD, WORD, awkward, ordered


def corpus(seed=3):
    draw = random.Random(seed)
    words = {d: [f"{d}{k}" for k in range(40)] for d in ("aa", "bb", "cc")}
    rows, labels = [], []
    for i in range(300):
        d = draw.choices(list(words), (6, 3, 1))[0]
        text = draw.choices(words[d], k=draw.randrange(5, 80))
        if i % 9 == 0:  # of two domains
            text += draw.choices(words[draw.choice(list(words))], k=30)
        rows.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, d))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, domain string")


def posteriors(frame, model):
    rows = frame.collect()
    k = range(len(model.names))
    return rows, np.array([[r[f"p{d}"] for d in k] for r in rows]), np.array([float(r["n_tokens"]) for r in rows])


def test_posteriors_agree_with_plain_naive_bayes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HASH_VALUES", 1 << 20)
    rows, labels = corpus()
    docs = awkward(spark, rows)
    model = fit_domains(docs, labelled(spark, labels))
    counts = {d: {} for d in model.names}
    texts = dict(rows)
    for i, d in labels:
        for w in WORD.findall(texts[i]):
            counts[d][w] = counts[d].get(w, 0) + 1
    total = {d: sum(c.values()) + (1 << 20) for d, c in counts.items()}
    got, shares, _ = posteriors(memberships(docs, model), model)
    for r, p in zip(got, shares, strict=True):
        w = WORD.findall(texts[r["id"]])
        assert r["n_tokens"] == len(w)
        score = [
            math.log(total[d] / sum(total.values()))
            + mixing.EVIDENCE_WORDS * np.mean([math.log((counts[d].get(x, 0) + 1) / total[d]) for x in w])
            for d in model.names
        ]
        want = np.exp(np.array(score) - max(score))
        assert np.allclose(p, want / want.sum(), atol=1e-9)


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_agree_with_plain_projected_gradient(spark, most):
    rows, labels = corpus()
    docs = awkward(spark, rows)
    model = fit_domains(docs, labelled(spark, labels))
    members = memberships(docs, model).persist()
    totals = domain_totals(members, model)
    targets = smoothed_targets(totals, 0.4, repeat=most is None)
    got = fit_rates(members, model, targets, most)
    fitted, p, n = posteriors(got, model)
    rate = np.array([r["rate"] for r in fitted])
    want = np.array([targets[d] for d in model.names])
    mass = n[:, None] * p
    weight = 1 / (mass * p).sum(0)
    gram = mass.T @ p * np.sqrt(weight[:, None] * weight)
    x = np.ones(len(n))
    for _ in range(3000):
        x = np.clip(x - p @ (weight * (x @ mass - want)) / np.abs(gram).sum(1).max(), 0, most)
    assert (rate >= 0).all() and (most is None or (rate <= most).all())
    assert np.abs(rate - x).max() < 5e-3  # rounds end when residuals hardly move
    if most is None:
        assert np.allclose(rate @ mass, want, rtol=1e-3)


def test_a_domain_out_of_reach_and_rates_of_zero(spark):
    rows, labels = corpus()
    docs = awkward(spark, rows)
    model = fit_domains(docs, labelled(spark, labels))
    members = memberships(docs, model)
    got, p, n = posteriors(fit_rates(members, model, {"cc": 5.0 * n_total(rows)}), model)
    rate = np.array([r["rate"] for r in got])
    sure = p.max(1) > 0.999
    assert (rate[sure & (p.argmax(1) == model.names.index("aa"))] < 0.01).all()
    with pytest.raises(ValueError, match="no labelled rows"):
        fit_rates(members, model, {"dd": 1.0})


def n_total(rows):
    return sum(len(WORD.findall(t)) for _, t in rows)


def test_copies_follow_the_rates(spark):
    rows, labels = corpus()
    docs, known = awkward(spark, rows), labelled(spark, labels)
    rates = {r["doc_id"]: r for r in mixed_rates(docs, known).collect()}
    assert all(math.floor(r["rate"]) <= r["copies"] <= math.floor(r["rate"]) + 1 for r in rates.values())
    assert abs(sum(r["copies"] - r["rate"] for r in rates.values())) < 40
    mixed = mix_documents(docs, known)
    assert mixed.columns == docs.columns
    counted: dict[int, int] = {}
    for r in mixed.collect():
        counted[r["doc_id"]] = counted.get(r["doc_id"], 0) + 1
    assert counted == {i: r["copies"] for i, r in rates.items() if r["copies"]}


def test_without_repeats_nothing_is_taken_twice(spark):
    rows, labels = corpus()
    mixed = mix_documents(awkward(spark, rows), labelled(spark, labels), repeat=False)
    ids = [r["doc_id"] for r in mixed.collect()]
    assert len(ids) == len(set(ids)) > 100


@pytest.mark.parametrize("labels", [[], [(4, "x"), (None, "y"), (5, None), (12, "z"), (2, "x"), (9, "z")]])
def test_awkward_rows(spark, labels):
    got = mixed_rates(awkward(spark), labelled(spark, labels)).collect()
    counted = ((i, len(WORD.findall(t or ""))) for i, t in AWKWARD)
    assert ordered((r["doc_id"], r["n_tokens"]) for r in got) == ordered(counted)
    assert all(0 <= r["posterior"] <= 1 and r["rate"] >= 0 for r in got)


def test_empty_table(spark):
    empty = awkward(spark).limit(0)
    assert mixed_rates(empty, labelled(spark, [(1, "x")])).count() == 0
    assert mix_documents(empty, labelled(spark, [])).count() == 0


def test_domains_come_from_all_labelled_rows(spark):
    draw = random.Random(5)
    rare = {17, 901, 1702}
    rows = [(i, " ".join(f"{'r' if i in rare else 'c'}{draw.randrange(40)}" for _ in range(20))) for i in range(2000)]
    labels = [(i, "rare" if i in rare else "common") for i, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_domains(docs, labelled(spark, labels), sample_rows=40)
    assert model.names == ("common", "rare")
    # Priors follow the full counts: all words of a domain and one for each hash value.
    words = {"common": 20 * 1997 + mixing.HASH_VALUES, "rare": 20 * 3 + mixing.HASH_VALUES}
    want = [math.log(words[d] / sum(words.values())) for d in model.names]
    assert np.allclose(model.priors, want, atol=1e-9)
    got, p, n = posteriors(memberships(docs, model), model)
    assert all((p[k].argmax() == 1) == (r["id"] in rare) for k, r in enumerate(got))


def test_parts_of_the_sample_are_bounded():
    assert mixing._parts({"a": 10, "b": 10_000, "c": 3_000}, 4_000) == {"a": 10, "c": 1_995, "b": 1_995}
    assert mixing._parts({"a": 5, "b": 7}, 4_000) == {"a": 5, "b": 7}
    assert sum(mixing._parts({str(k): 9_999 for k in range(64)}, 4_000).values()) <= 4_000


def test_too_many_domains_are_an_error(spark):
    rows = [(i, f"word{i}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with pytest.raises(ValueError, match="domains"):
        fit_domains(docs, labelled(spark, [(i, f"d{i}") for i, _ in rows]), sample_rows=40)
