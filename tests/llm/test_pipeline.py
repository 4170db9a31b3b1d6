"""The pipeline and the queries that SQL cannot express, against plain loops over whole tables."""

from __future__ import annotations

import base64
import struct
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from rowan.llm.queries import QUERIES, tokenizer
from tests.llm.plain import AWKWARD, WORD, awkward, fingerprint, groups, line_dedup, ordered, rules, sha

DATA = Path("/root/testdata/sf0.001")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks_path, pattern = tokenizer()
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def coded(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids))), sha(text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents that stay, junk, lines and near copies; extra columns; labels with nulls."""
    path = tmp_path_factory.mktemp("corpus")
    clean = [" ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(120 + i)) for i in range(40)]
    rows = [(100 + i, t) for i, t in enumerate(clean)]
    rows += [(200 + i, t + " tail") for i, t in enumerate(clean[:5])]
    shared = "A line that stands in many of the documents here, again and again"
    rows += [(300 + i, f"{t}\n{shared}") for i, t in enumerate(clean[5:14])]
    awkward(spark, AWKWARD + rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(100, 140)] + [(None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def texts(frame):
    return ordered((r["doc_id"], r["text"] or "") for r in frame.collect())


def test_stages_one_by_one(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, given = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"]
    stage = dict(corpus_pipeline.STAGES)
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]

    docs = stage["quality_rules"](spark, docs, folder)
    kept = {r for r in texts(docs)}
    for i, t in before:
        n, *_, repeats = rules(t)
        if n < 20 or 100 * repeats > 30 * n:
            assert (i, t or "") not in kept
        elif i is not None and i >= 100:
            assert (i, t) in kept
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]

    docs = stage["line_dedup"](spark, docs, folder)
    assert ordered((r["doc_id"], sha(r["text"] or "")) for r in docs.collect()) == ordered(
        (i, h) for i, _, _, h in line_dedup(before)
    )
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]

    docs = stage["simhash_near_dedup"](spark, docs, folder)
    prints = {fingerprint(t) for _, t in before}
    root = groups(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(root[fingerprint(r["text"])] for r in docs.collect()) == sorted(set(root.values()))
    assert set(texts(docs)) <= {(i, t or "") for i, t in before}
    before = texts(docs)

    docs = stage["source_mixing"](spark, docs, folder)
    after = texts(docs)
    assert len(set(after)) == len(after) and set(after) <= set(before) and len(after) > len(before) / 3
    assert docs.columns == given

    last = stage["byte_bpe"](spark, docs, folder).collect()
    assert ordered((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in last) == ordered(
        (i, *coded(library, t)) for i, t in after
    )
    assert ordered(corpus_pipeline.run(spark, folder).collect()) == ordered(last)


def plain_mixture(rows, power=0.7, values=4096, evidence=12):
    """For (id, text, domain), all labelled: rates and the draws that round them, from whole tables."""
    names = sorted({d for _, _, d in rows})
    words = [WORD.findall(t) for _, t, _ in rows]
    place = [[xxhash.xxh64_intdigest(w.encode(), seed=42) % values for w in x] for x in words]
    counts = np.ones((len(names), values))
    for x, (_, _, d) in zip(place, rows, strict=True):
        np.add.at(counts[names.index(d)], x, 1)
    likely = np.log(counts / counts.sum(1, keepdims=True))
    prior = np.log(counts.sum(1) / counts.sum())
    p = np.exp([prior + evidence * likely[:, x].mean(1) for x in place])
    p /= p.sum(1, keepdims=True)
    n = np.array([float(len(x)) for x in words])
    mass = n[:, None] * p
    weights = mass.sum(0) ** power
    want = n.sum() * weights / weights.sum()
    inverse = 1 / (mass * p).sum(0)
    step = 1 / np.abs(mass.T @ p * np.sqrt(inverse[:, None] * inverse)).sum(1).max()
    rate = np.ones(len(n))
    for _ in range(3000):
        rate = np.maximum(rate - step * p @ (inverse * (rate @ mass - want)), 0)
    draws = []
    for i, t, _ in rows:
        h = xxhash.xxh64_intdigest(struct.pack("<i", 0), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=h)
        h = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(t.encode(), seed=42)), seed=h)
        draws.append(h % (1 << 40) / (1 << 40))
    return n, rate, np.array(draws)


def test_mixing_stage_keeps_the_tokens_whatever_the_smallest_language(spark, tmp_path):
    sizes = {"en": 240, "de": 80, "la": 4}
    made = [(d, k) for d, size in sizes.items() for k in range(size)]
    rows = [(i, " ".join(f"{d}{(k * 13 + j * 7) % 61}" for j in range(40 + k % 30)), d) for i, (d, k) in enumerate(made)]
    docs = spark.createDataFrame(
        [(i, t, d, "s", len(t)) for i, t, d in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter(r["doc_id"] for r in corpus_pipeline.source_mixing(spark, docs, str(tmp_path)).collect())
    n, rate, draws = plain_mixture(rows)
    want = np.floor(rate) + (draws < rate % 1)
    copies = np.array([got[i] for i, _, _ in rows])
    sure = np.abs(draws - rate % 1) > 0.02  # rounds end when residuals hardly move
    assert sure.mean() > 0.9 and (copies == want)[sure].all()
    assert abs((copies * n).sum() / n.sum() - 1) < 0.1
    assert copies[[d == "la" for _, _, d in rows]].min() >= 2


def test_pipeline_of_nothing(spark, tmp_path):
    awkward(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


given_tables = pytest.mark.skipif(not DATA.exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(str(DATA / "documents.parquet")).collect()}


@given_tables
def test_bpe_query(spark, documents, library):
    got = QUERIES["op2_byte_bpe"](spark, str(DATA)).collect()
    assert ordered(got) == ordered((i, *coded(library, r["text"])) for i, r in documents.items())


@given_tables
def test_simhash_query(spark, documents):
    prints = {i: fingerprint(r["text"]) for i, r in documents.items()}
    least = groups(sorted(documents), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = QUERIES["op3_simhash_near_dedup"](spark, str(DATA)).collect()
    assert ordered(got) == ordered((i, f"{p:016x}", least[i]) for i, p in prints.items())


@given_tables
def test_token_count_query(spark, documents, library):
    sizes = [(r["source"], len(library.encode_ordinary(r["text"] or ""))) for r in documents.values()]
    got = QUERIES["op5_token_counts"](spark, str(DATA)).collect()
    assert {(r["source"], r["n_tokens"]): r["docs"] for r in got} == Counter(sizes)
    for r in got:
        assert r["truncated_tokens"] == sum(min(n, r["n_tokens"]) for s, n in sizes if s == r["source"])


@given_tables
def test_neighbour_query_finds_nine_in_ten(spark):
    rows = spark.read.parquet(str(DATA / "embeddings.parquet")).collect()
    ids = np.array([r["vec_id"] for r in rows])
    points = np.array([r["embedding"] for r in rows])
    got: dict[int, list] = {}
    for r in QUERIES["op7_nearest_neighbours"](spark, str(DATA)).collect():
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = points @ points[ids == q][0]
        best = [i for _, i in sorted(zip(-score, ids, strict=True)) if i != q][:20]
        hits += len(set(best) & {r["vec_id"] for r in found})
        assert [r["rank"] for r in sorted(found, key=lambda r: (-r["score"], r["vec_id"]))] == list(range(1, 21))
    assert hits >= 0.9 * 20 * len(got)


@given_tables
def test_mixing_and_toxicity_queries_cover_every_document(spark, documents):
    rates = QUERIES["op1_source_mixing"](spark, str(DATA)).collect()
    assert sorted(r["doc_id"] for r in rates) == sorted(documents)
    assert all(r["n_tokens"] == len(WORD.findall(documents[r["doc_id"]]["text"] or "")) for r in rates)
    right = [r["domain"] == documents[r["doc_id"]]["lang"] for r in rates if r["n_tokens"] >= 50]
    assert np.mean(right) > 0.9  # from 80 labelled documents
    scored = QUERIES["op9_toxicity"](spark, str(DATA)).collect()
    assert sorted(r["doc_id"] for r in scored) == sorted(documents)
