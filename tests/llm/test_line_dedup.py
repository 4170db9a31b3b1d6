from __future__ import annotations

from pyspark.sql import functions as F

from rowan.llm.line_dedup import dedup_lines, drop_common_lines
from tests.llm.plain import AWKWARD, awkward, line_dedup, ordered


def found(docs, **limits):
    done = dedup_lines(docs, **limits)
    return ordered(done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect())


def test_awkward_rows(spark):
    assert found(awkward(spark)) == ordered(line_dedup(AWKWARD))


def test_threshold_counts_documents_not_lines(spark):
    line = "forty characters at the very least, in a line"
    rows = [(i, f"{line}\n{line}\n{line}") for i in range(4)]
    assert all(r[2] == 0 for r in found(awkward(spark, rows)))
    rows += [(3, f"{line} ")]  # the same document again
    assert all(r[2] == 0 for r in found(awkward(spark, rows)))
    rows += [(9, line.upper())]
    assert found(awkward(spark, rows)) == ordered(line_dedup(rows))


def test_documents_keep_their_columns_and_untouched_texts(spark):
    docs = awkward(spark)
    cut = drop_common_lines(docs)
    assert cut.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert (1, None) in texts and (2, "") in texts and (4, "one") in texts


def test_empty_table(spark):
    assert found(awkward(spark).limit(0)) == []
