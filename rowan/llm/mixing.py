"""Mixing sources to target weights by soft membership, in DataFrame operations only.

A naive Bayes classifier over hashed words, fitted on a labelled table, predicts each document's domain
posteriors. Projected gradient then fits a rate for every document: nonnegative, with expected domain
token totals as near to the targets as least squares can bring them. A rate becomes that many copies,
its fraction settled by a hash of the document.

Tokens are words between blanks, not those of a tokenizer; a text written without blanks is one.

With tokens n, posteriors p and rates x, the squares (sum of x n p - target)^2 are weighted by the
inverse of each domain's sum of n p^2, and distances between rates by tokens; a step then changes a rate
by p times the weighted residual, so that equal posteriors get equal rates, however long the text.
Residuals, a number for each domain, are all that a round sends to the driver: rates follow from the
posteriors and the residuals so far, and are written down every ROUNDS_IN_PLAN rounds.

The domains, and how many labelled rows each has, come from all labelled rows. Words are learnt from at
most SAMPLE_ROWS of them: each domain has an equal part, as far as it has rows, the least by a hash of
their id; priors follow the full counts. Totals, posteriors and rates cover every document. The model is
one number for each hash value and domain.

Defined cases: a null or empty text has no tokens, the prior for posteriors and a rate like any other;
a null id is kept; labelled rows without id or domain are left out; several domains of one document all
count; a target for a domain that no label names is an error; without labelled rows there is one domain
of no name, and every rate is the target over the total; repeated rows get one rate and as many copies
each; an empty table gives an empty result; further columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowan.llm.common import BLANK_RUN, LEAST_ID, whole_text
from rowan.sources.scratch import written

SAMPLE_ROWS = 4_000
HASH_VALUES = 4_096
#: A document's evidence counts as that of so many words, however many it has; so posteriors stay soft.
EVIDENCE_WORDS = 12
MOST_DOMAINS = 64
ROUNDS = 200
ROUNDS_IN_PLAN = 10
CLOSE_ENOUGH = 1e-6


@dataclass(frozen=True)
class DomainModel:
    """names in order; priors and, for each domain, the log-probability of each hash value."""

    names: tuple[str, ...]
    priors: tuple[float, ...]
    tables: tuple[tuple[float, ...], ...]


def _word_value(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(HASH_VALUES)).cast("int")


def _constant(numbers: tuple[float, ...]) -> Column:
    """An array literal; folded once, when the plan is optimised."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")


def _parts(labels: dict[str, int], rows: int) -> dict[str, int]:
    """How many of each domain's rows are taken: equally many, and what small domains leave to the others."""
    parts, left = {}, rows
    for k, name in enumerate(sorted(labels, key=lambda name: (labels[name], name))):
        parts[name] = min(labels[name], max(left // (len(labels) - k), 1))
        left -= parts[name]
    return parts


def _least_of_each(known: DataFrame, labels: dict[str, int], parts: dict[str, int]) -> DataFrame:
    """As many rows of each domain as its part, the least by a hash of their id.

    Rows far above the part's share of hashes go before the ranking, so that none sorts a domain whole.
    """
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = {name: (parts[name] + 8 * math.sqrt(parts[name]) + 32) / labels[name] for name in labels}
    limits = F.create_map(*(F.lit(x) for name in labels for x in (name, share[name])))
    sizes = F.create_map(*(F.lit(x) for name in labels for x in (name, parts[name])))
    near = known.withColumn("draw", draw).where(F.col("draw") < limits[F.col("domain")])
    order = Window.partitionBy("domain").orderBy("draw", "id")
    ranked = near.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= sizes[F.col("domain")]).select("id", "domain")


def fit_domains(
    docs: DataFrame,
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DomainModel:
    """labelled: doc_id, domain."""
    known = labelled.select(F.col("doc_id").cast("long").alias("id"), F.col("domain").cast("string").alias("domain"))
    known = written(known.where("id IS NOT NULL AND domain IS NOT NULL").distinct())
    found = known.groupBy("domain").count().limit(MOST_DOMAINS + 1).collect()
    if len(found) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains; the model holds no more")
    labels = {r["domain"]: r["count"] for r in found}
    names = tuple(sorted(labels))
    if not names:
        return DomainModel(("",), (0.0,), ((0.0,) * HASH_VALUES,))
    parts = _parts(labels, sample_rows)
    sample = _least_of_each(known, labels, parts)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(F.col(text)).alias("text"))
    # At most sample_rows short rows.
    met = texts.join(F.broadcast(sample), "id").select("domain", F.explode(F.split("text", BLANK_RUN)).alias("word"))
    value = F.when(F.col("word") != "", _word_value(F.col("word")))
    counts = met.groupBy("domain", value.alias("value")).count().collect()
    tables = {name: [1.0] * HASH_VALUES for name in names}
    for r in counts:
        if r["value"] is not None:
            tables[r["domain"]][r["value"]] += r["count"]
    sums = {name: math.fsum(tables[name]) for name in names}
    # Words of the sample stand for those of all labelled rows.
    whole = {name: (sums[name] - HASH_VALUES) * labels[name] / parts[name] + HASH_VALUES for name in names}
    everything = math.fsum(whole.values())
    return DomainModel(
        names,
        tuple(math.log(whole[name] / everything) for name in names),
        tuple(tuple(math.log(x / sums[name]) for x in tables[name]) for name in names),
    )


def memberships(docs: DataFrame, model: DomainModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, body (hash of the text), rows, n_tokens and p0, p1, ...: the posteriors, in the order of names.

    Words are never shuffled: each task adds up its documents' evidence, and the sums meet by document.
    """
    body = whole_text(F.col(text))
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(body).alias("body"),
        F.split(body, BLANK_RUN).alias("words"),
    )
    # Apart from the step above, or the hash of the text would be taken anew for every word.
    # Outer, because a filter on the array's size would otherwise be inferred and split texts twice.
    spread = keyed.select("id", "body", F.posexplode_outer("words").alias("place", "word"))
    held = F.col("word") != ""
    valued = spread.select("id", "body", "place", F.when(held, _word_value(F.col("word"))).alias("value"))
    evidence = [F.sum(F.get(_constant(t), F.col("value"))).alias(f"e{k}") for k, t in enumerate(model.tables)]
    summed = valued.groupBy("id", "body").agg(
        F.sum(F.when(F.col("place") == 0, 1).otherwise(0)).alias("rows"), F.count("value").alias("n"), *evidence
    )
    scale = F.lit(float(EVIDENCE_WORDS)) / F.greatest(F.col("n"), F.lit(1))
    scored = summed.select(
        "id",
        "body",
        "rows",
        (F.col("n") / F.col("rows")).cast("long").alias("n_tokens"),
        *(
            (F.lit(prior) + F.coalesce(F.col(f"e{k}"), F.lit(0.0)) * scale).alias(f"s{k}")
            for k, prior in enumerate(model.priors)
        ),
    )
    scores = [F.col(f"s{k}") for k in range(len(model.names))]
    most = F.greatest(*scores) if len(scores) > 1 else scores[0]
    kept = ("id", "body", "rows", "n_tokens")
    shares = scored.select(*kept, *(F.exp(s - most).alias(f"x{k}") for k, s in enumerate(scores)))
    total = sum((F.col(f"x{k}") for k in range(1, len(scores))), F.col("x0"))
    return shares.select(*kept, *((F.col(f"x{k}") / total).alias(f"p{k}") for k in range(len(scores))))


def domain_totals(members: DataFrame, model: DomainModel) -> dict[str, float]:
    """Expected tokens of each domain."""
    sums = members.agg(*(F.sum(F.col("rows") * F.col("n_tokens") * F.col(f"p{k}")) for k in range(len(model.names))))
    return {name: x or 0.0 for name, x in zip(model.names, sums.first(), strict=True)}


def smoothed_targets(totals: dict[str, float], power: float, repeat: bool = True) -> dict[str, float]:
    """Targets in proportion to a power of the totals: of the same sum, or, without `repeat`, of the
    largest sum that no domain has to be repeated for."""
    weights = {name: x**power for name, x in totals.items() if x > 0}
    whole = math.fsum(weights.values())
    size = math.fsum(totals.values()) if repeat else min((totals[d] * whole / w for d, w in weights.items()), default=0)
    return {name: size * w / whole for name, w in weights.items()}


def fit_rates(
    members: DataFrame, model: DomainModel, targets: dict[str, float], most_rate: float | None = None
) -> DataFrame:
    """members with rate. most_rate, where given, bounds rates above as zero does below."""
    if unknown := set(targets) - set(model.names):
        raise ValueError(f"no labelled rows of the domains {sorted(unknown)}")
    k = range(len(model.names))
    wanted = [float(targets.get(name, 0.0)) for name in model.names]
    mass = [F.col("rows") * F.col("n_tokens") * F.col(f"p{d}") for d in k]
    pairs = [(d, e) for d in k for e in k if d <= e]
    products = members.agg(*(F.sum(mass[d] * F.col(f"p{e}")) for d, e in pairs)).first()
    gram = {pair: x or 0.0 for pair, x in zip(pairs, products, strict=True)}
    weight = [1 / gram[d, d] if gram[d, d] > 0 else 0.0 for d in k]
    # The weighted Gram matrix's largest row sum bounds its largest eigenvalue.
    step = 1 / max(
        math.fsum(gram[min(d, e), max(d, e)] * math.sqrt(weight[d] * weight[e]) for e in k) or 1.0 for d in k
    )
    now, known, before = members.withColumn("rate", F.lit(1.0)), 0, None
    for _ in range(ROUNDS):
        totals = now.agg(*(F.sum(F.col("rate") * m) for m in mass)).first()
        # Rounded, so that the order in which tasks end does not show.
        left = [float(f"{(x or 0.0) - t:.10e}") for x, t in zip(totals, wanted, strict=True)]
        size = max(math.fsum(wanted), 1.0)
        if before and all(abs(a - b) <= CLOSE_ENOUGH * size for a, b in zip(left, before, strict=True)):
            break
        before = left
        pull = sum((F.col(f"p{d}") * F.lit(step * weight[d] * left[d]) for d in k), F.lit(0.0))
        moved = F.greatest(F.col("rate") - pull, F.lit(0.0))
        now = now.withColumn("rate", moved if most_rate is None else F.least(moved, F.lit(float(most_rate))))
        known += 1
        if known % ROUNDS_IN_PLAN == 0:
            now = written(now)
    return now


def copies(rate: Column, *key: Column, seed: int = 0) -> Column:
    """The rate rounded up or down, up as often as its fraction says, always alike for a key."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mixture(
    docs: DataFrame,
    labelled: DataFrame,
    power: float = 0.7,
    repeat: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DomainModel]:
    """id, body, rows, n_tokens, posteriors, rate and copies, mixed to smoothed targets; and the model."""
    model = fit_domains(docs, labelled, doc_id, text)
    members = written(memberships(docs, model, doc_id, text))
    targets = smoothed_targets(domain_totals(members, model), power, repeat)
    rates = fit_rates(members, model, targets, None if repeat else 1.0)
    return rates.withColumn("copies", copies(F.col("rate"), F.col("id"), F.col("body"))), model


def mixed_rates(docs: DataFrame, labelled: DataFrame, **how) -> DataFrame:
    """doc_id, n_tokens, domain (the likeliest), posterior (its own), rate and copies of every row."""
    rates, model = mixture(docs, labelled, **how)
    likely = F.array_max(
        F.array(*(F.struct(F.col(f"p{k}").alias("p"), F.lit(name).alias("name")) for k, name in enumerate(model.names)))
    )
    each = rates.withColumns({"likely": likely, "row": F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))})
    return each.select(
        F.nullif("id", F.lit(LEAST_ID)).alias("doc_id"),
        "n_tokens",
        F.col("likely.name").alias("domain"),
        F.col("likely.p").alias("posterior"),
        "rate",
        "copies",
    )


def mix_documents(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents, with their own columns, each as often as its copies say."""
    rates, _ = mixture(docs, labelled, doc_id=doc_id, text=text, **how)
    taken = rates.where("copies > 0").select("id", "body", "copies")
    rows = docs.select(
        F.struct("*").alias("__row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(whole_text(F.col(text))).alias("body"),
    )
    met = rows.join(taken, ["id", "body"]).select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return met.select("__row.*")
