from __future__ import annotations

from pyspark.sql import functions as F

from rowan.llm.quality_rules import (
    BASE, POLICIES, RULES, ablations, keep_good, ledger, policy_mask, repeat_words, rule_verdicts,
)
from tests.llm.plain import AWKWARD, awkward, ordered, rules


def test_measurements_and_verdicts_of_awkward_rows(spark):
    got = rule_verdicts(awkward(spark)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert ordered((r["doc_id"], *(r[n] for n in names)) for r in got) == ordered((i, *rules(t)) for i, t in AWKWARD)
    for r in got:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_overlapping_and_distant_repeats(spark):
    texts = ["a b c d e f g h " * 2, "a " * 9, "a b c d e f g h x a b c d e f g h", "a b c d e f g h a b c d e f g"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(repeat_words(F.split(F.trim("t"), " "))).collect()]
    assert got == [rules(t)[4] for t in texts]


def test_clean_text_stays_and_junk_goes(spark):
    clean = " ".join(f"w{i}ord{i * 7}" for i in range(200))
    rows = [(1, clean), (2, clean.replace(" ", " | ")), (3, clean.upper().replace(" ", "!! ")), (4, "same line\n" * 50)]
    kept = {r["doc_id"] for r in keep_good(awkward(spark, rows)).collect()}
    assert kept == {1}


def test_kept_documents_have_their_own_columns(spark):
    docs = awkward(spark)
    assert keep_good(docs).columns == docs.columns


def test_policies_read_old_ledgers(spark):
    rows = ledger(awkward(spark), [F.col("doc_id")])
    masks = {r["failed"] for r in rows.collect()}
    assert all(0 <= m < 1 << len(RULES) for m in masks)
    assert policy_mask("v1") == policy_mask(BASE) == 0b11


def test_ablations_agree_with_the_ledger(spark):
    rows = ledger(awkward(spark), [F.col("doc_id")])
    failed = [r["failed"] for r in rows.collect()]
    mask = policy_mask("v2")
    for r in ablations(rows, "v2").collect():
        bit = policy_mask((r["rule"],))
        assert r["failing"] == sum(bool(f & bit) for f in failed)
        assert r["failing_alone"] == sum(f & mask == bit for f in failed)
        assert r["kept_without"] == sum(f & mask & ~bit == 0 for f in failed)
    assert ablations(rows, "v2").count() == len(POLICIES["v2"])


def test_empty_table(spark):
    assert rule_verdicts(awkward(spark).limit(0)).count() == 0
