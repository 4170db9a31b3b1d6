"""Quality rules: every rule is evaluated once per document into a bit mask beside its measurements;
versioned policies and ablations then work on the masks alone.

Defined cases: a null text has no words and fails `few_words`; empty texts likewise; a null id stays
null; repeated rows are judged each for itself; an empty table gives an empty ledger; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.llm.common import let, whole_text, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
)


@dataclass(frozen=True)
class Rule:
    """fails: SQL over the measurements, never null."""

    name: str
    fails: str


#: A rule's place is its bit; new rules go to the end, so that old ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repetition", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars"),
)

BASE = ("few_words", "repetition")
#: What a version rejects is fixed once published; a change gets a new version.
POLICIES = {
    "v1": BASE,
    "v2": tuple(rule.name for rule in RULES),
}


def policy_mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a version's rules, or of the rules named."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    place = {rule.name: i for i, rule in enumerate(RULES)}
    return reduce(lambda mask, name: mask | 1 << place[name], names, 0)


def _occurrences(text: Column, characters: str) -> Column:
    """How many characters of the regular expression class the text has."""
    return (F.size(F.split(text, f"[{characters}]")) - 1).cast("long")


def _distinct_loss(items: Column) -> Column:
    return (F.size(items) - F.size(F.array_distinct(items))).cast("long")


def _window_hashes(tokens: Column, width: int) -> Column:
    count = F.size(tokens) - (width - 1)
    hashes = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(tokens, i, width)))
    return F.when(count > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(tokens: Column, hashes: Column, width: int) -> Column:
    """Words in windows that occur again. Windows of equal hash are compared word by word."""

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice(tokens, a["i"] + 1, width) == F.slice(tokens, b["i"] + 1, width))

    def repeated(ordered: Column) -> Column:
        def place(one: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1), F.get(ordered, k + 1)
            again = ((k > 0) & same(one, before)) | ((k < F.size(ordered) - 1) & same(one, after))
            return F.when(again, one["i"])

        return F.array_sort(F.filter(F.transform(ordered, place), lambda i: i.isNotNull()))

    places = let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        places,
        start,
        lambda a, i: F.struct(
            (a["n"] + (i + width - F.greatest(i, a["end"]))).cast("long").alias("n"), (i + width).alias("end")
        ),
        lambda a: a["n"],
    )


def repeat_words(tokens: Column, width: int = WINDOW) -> Column:
    """Words inside windows of `width` words that are found twice or more in the array."""

    def counted(t: Column) -> Column:
        return let(
            _window_hashes(t, width),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
                _covered(t, h, width)
            ),
        )

    return let(tokens, counted)


def measure(docs: DataFrame, key: list[Column], text: str = "text") -> DataFrame:
    """The key columns and one long for each of MEASURES; one pass, no shuffle."""
    body = whole_text(F.col(text))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    parted = docs.select(*key, body.alias("__body"), words(body).alias("__words"), lines.alias("__lines"))
    kept = [F.col(c) for c in parted.columns[: len(key)]]
    return parted.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _occurrences(F.col("__body"), SYMBOLS).alias("n_symbols"),
        _distinct_loss(F.col("__lines")).alias("n_dup_lines"),
        repeat_words(F.col("__words")).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        _occurrences(F.col("__body"), "A-Z").alias("n_capitals"),
    )


def ledger(docs: DataFrame, key: list[Column], text: str = "text") -> DataFrame:
    """The key columns, the measurements and `failed`: bit i is set where RULES[i] fails."""
    measured = measure(docs, key, text)
    bits = (F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES))
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def passes(policy: str | tuple[str, ...], failed: Column) -> Column:
    return failed.bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: documents failing it, failing it alone, and kept without it.

    The ledger collapses to at most 2 ** len(RULES) masks before anything else is done.
    """
    mask = policy_mask(policy)
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("docs"))
    named = [F.struct(F.lit(name).alias("rule"), F.lit(policy_mask((name,))).alias("bit")) for name in POLICIES[policy]]
    spread = masks.select("bits", "docs", F.explode(F.array(*named)).alias("r")).select("bits", "docs", "r.*")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("docs"))), F.lit(0)).alias
    without = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    return spread.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0)("failing"),
        total(F.col("bits") == F.col("bit"))("failing_alone"),
        total(without == 0)("kept_without"),
    )


def rule_verdicts(docs: DataFrame, policy: str = "v2", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, measurements, failed, base_failed, kept."""
    rows = ledger(docs, [F.col(doc_id).alias("doc_id")], text)
    base = ~passes(BASE, F.col("failed"))
    return rows.withColumns({"base_failed": base, "kept": ~base & passes(policy, F.col("failed"))})


def keep_good(docs: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The documents that the base rules and the policy keep, with their own columns only."""
    rows = ledger(docs, [F.struct("*").alias("__row")], text)
    return rows.where(passes(BASE, F.col("failed")) & passes(policy, F.col("failed"))).select("__row.*")
