from __future__ import annotations

import random
import zlib

import numpy as np

from rowan.llm.toxicity import HASH_BITS, SIZES, fit_toxicity, ngram_values, score_toxicity, training_rows
from tests.llm.plain import AWKWARD, awkward


def corpus(n=500, seed=9):
    draw = random.Random(seed)
    plain = [f"{draw.choice('bcdfglmnprst')}{draw.choice('aeiou')}{draw.choice('lmnrst')}ent{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        words, bad = draw.choices(plain, k=draw.randrange(15, 300)), i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["Grobnix", "snuzzfart", "wumpelige"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = awkward(spark, rows)
    model = fit_toxicity(docs, labelled(spark, labels))
    scored = score_toxicity(docs, model).collect()
    truth = {i: t for i, _, t in labels}
    assert len(scored) == len(rows)
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in scored if r["held_out"]]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(200)
    docs = awkward(spark, rows)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    models = [fit_toxicity(docs, labelled(spark, x)) for x in (labels, other)]
    assert (models[0].values == models[1].values).all() and (models[0].weights == models[1].weights).all()


def test_training_rows(spark):
    rows = [(1, "a"), (2, "b"), (3, None), (6, "c"), (6, "c"), (None, "d")]
    labels = [(1, 1, 1), (1, 1, 0), (2, 1, None), (3, 1, 0), (6, None, 0), (None, 1, 1), (77, 1, 1)]
    keep = {i for i in (1, 2, 3, 6) if zlib.crc32(str(i).encode()) % 5}
    got = sorted(map(tuple, training_rows(awkward(spark, rows), labelled(spark, labels)).collect()))
    want = [("a", 1.0)] * (1 in keep) + [("", 0.0)] * (3 in keep) + [("c", 0.0)] * 2 * (6 in keep)
    assert got == sorted(want)


def test_awkward_rows_and_missing_classes(spark):
    docs = awkward(spark)
    clean, bad = ([(i, 1, k) for i in range(1, 17)] for k in (0, 1))
    for labels, score in (([], 0.0), (clean, 0.0), (bad, 1.0)):
        scored = score_toxicity(docs, fit_toxicity(docs, labelled(spark, labels))).collect()
        assert len(scored) == len(AWKWARD)
        assert all(abs(r["score"] - score) < 1e-12 for r in scored)


def test_empty_table(spark):
    rows, labels = corpus(100)
    model = fit_toxicity(awkward(spark, rows), labelled(spark, labels))
    assert score_toxicity(awkward(spark).limit(0), model).count() == 0
    assert fit_toxicity(awkward(spark).limit(0), labelled(spark, labels)).values.size == 0


def test_ngrams_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé 汉\n") for _ in range(2000))
    whole = ngram_values(text)
    monkeypatch.setattr("rowan.llm.toxicity._BLOCK", 37)
    assert (ngram_values(text) == whole).all()
    assert len(ngram_values("")) == len(ngram_values(" \n ")) == 0
    assert len(ngram_values("ab")) == 1 and min(SIZES) == 4


def plain_scores(rows, labels, features, least_rows):
    """Counts, ratios and the penalised fit in numpy; every text's score."""
    known = {i: float(t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5}
    values = {i: ngram_values((t or "").lower()) for i, t in rows}
    good, bad = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    for i, t in known.items():
        (bad if t else good)[values[i]] += 1
    ratio = np.log((bad + 1) / (bad.sum() + len(bad))) - np.log((good + 1) / (good.sum() + len(good)))
    rank = np.where(good + bad >= least_rows, np.abs(ratio) * (good + bad), -1)
    chosen = np.argsort(-rank, kind="stable")[:features]
    chosen = chosen[rank[chosen] >= 0]
    place = {v: k for k, v in enumerate(chosen)}

    def vector(i):
        x = np.zeros(len(chosen) + 1)
        x[-1] = 1
        for v in values[i]:
            if v in place:
                x[place[v]] = ratio[v]
        return x

    x, y = np.array([vector(i) for i in known]), np.array(list(known.values()))
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(len(chosen), 1e-3), 0)
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ w))
        slopes = x.T @ (p - y) / len(y) + penalty * w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + np.diag(penalty + 1e-9), slopes)
    return {i: 1 / (1 + np.exp(-vector(i) @ w)) for i, _ in rows}


def test_scores_agree_with_a_plain_fit(spark):
    rows, labels = corpus(120)
    draw = random.Random(1)
    labels = [(i, q, t if draw.random() < 0.9 else 1 - t) for i, q, t in labels]
    docs = awkward(spark, rows)
    model = fit_toxicity(docs, labelled(spark, labels), features=60, least_rows=4)
    want = plain_scores(rows, labels, 60, 4)
    assert len(model.values) == 60
    for r in score_toxicity(docs, model).collect():
        assert abs(r["score"] - want[r["doc_id"]]) < 0.01


def test_both_classes_without_a_common_ngram(spark):
    rows = [(i, f"text{i * 7919}") for i in range(40)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(40)]
    known = [t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5]
    model = fit_toxicity(awkward(spark, rows), labelled(spark, labels), least_rows=41)
    for r in score_toxicity(awkward(spark, rows), model).collect():
        assert abs(r["score"] - np.mean(known)) < 1e-9
