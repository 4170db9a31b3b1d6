from __future__ import annotations

import base64
import random

import pytest
from pyspark.sql import functions as F

from rowan.llm.bpe import Coder, decode_ids, digests, encode_texts
from tests.llm.plain import AWKWARD, awkward, ordered, sha

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
FILE, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests_of_awkward_rows(spark, library):
    got = encode_texts(awkward(spark), ["doc_id"], FILE, PATTERN, decode=True).select("row.doc_id", *digests())
    want = []
    for i, text in AWKWARD:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert ordered(got.collect()) == ordered(want)


def test_ids_decode_to_the_text(spark):
    docs = awkward(spark)
    coded = encode_texts(docs, ["doc_id", "text"], FILE, PATTERN).select("row.*", "ids")
    back = decode_ids(coded, FILE, PATTERN).select("row.text", "decoded").collect()
    assert len(back) == len(AWKWARD)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    got = [bytes(r[0]) for r in decode_ids(rows, FILE, PATTERN).select("decoded").collect()]
    assert got == [b"", b"", b'!"']


def test_hard_words(library):
    draw = random.Random(4)
    coder = Coder(FILE, PATTERN)
    texts = [
        "the" * 900,
        "".join(draw.choice("abcdefghij") for _ in range(1500)),
        "".join(draw.choice("etaoin shrdlu\n\t ") for _ in range(2000)),
        "".join(chr(draw.randrange(1, 0xD7FF)) for _ in range(2000)),
        "汉字测试" * 200,
        "''''s's 'll'LL 123456 ½²  \r\n\n  ",
    ]
    for _ in range(2):  # the second time from what is known
        ids, sizes = coder.encode(texts)
        at = 0
        for text, size in zip(texts, sizes, strict=True):
            assert ids[at : at + size].tolist() == library.encode_ordinary(text)
            at += size
        assert coder.decode(ids, sizes) == [t.encode() for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_long_words_without_a_break(library, seed):
    draw = random.Random(seed)
    coder = Coder(FILE, PATTERN)
    known = [k.decode() for k in coder.ranks if k.isalpha() and k.isascii()]
    texts = [
        "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40_000)),
        "".join(draw.choice("ACGT") for _ in range(20_000)),
        "".join(draw.choice("ab") for _ in range(9_000)),
        "".join(draw.choice(known) for _ in range(3_000)),
        "".join(draw.choice(known) + "a" * draw.randrange(120) + "the" * draw.randrange(50) for _ in range(200)),
        "".join(draw.choice("#*$%&|<>=-_") for _ in range(5_000)),
        "".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(5_000)),
        "-" * 30_000,
    ]
    ids, sizes = coder.encode(texts)
    at = 0
    for text, size in zip(texts, sizes, strict=True):
        assert ids[at : at + size].tolist() == library.encode_ordinary(text)
        at += size


def test_generations_of_known_words(library, monkeypatch):
    monkeypatch.setattr("rowan.llm.bpe.WORDS_KEPT", 5)
    coder = Coder(FILE, PATTERN)
    for k in range(6):
        text = f"some words zqx{k} again zqx{k - 1}"
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_empty_table(spark):
    assert encode_texts(awkward(spark).limit(0), ["doc_id"], FILE, PATTERN).count() == 0
    assert encode_texts(awkward(spark), ["doc_id"], FILE, PATTERN).where(F.col("ids").isNull()).count() == 0
