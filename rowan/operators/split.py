"""Exact stratified splits and folds without moving a row.

Every row gets a pseudo-random position in its class: the md5 of seed and key. Taking the first
``k`` rows of a class then means comparing that hash with one cut value per class, so once the
cuts are known the split is a plain column expression: no shuffle, no sort, and it can be
re-evaluated anywhere with the same outcome. The cuts are found by counting hash prefixes, a few
digits per pass; each pass aggregates to a bounded number of counters before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.functions.scores import first_match
from rowan.functions.text import column

HASH_DIGITS = 32
# Digits per pass: at most 16**3 counters per class or open cut come back. A prefix holding no
# more rows than that is resolved to the last digit at once.
_DIGITS = 3
_FEW_ROWS = 16**_DIGITS

Cuts = dict[str, list[str]]


def key_hash(key: str | Sequence[str], seed: int | str) -> Column:
    """Hexadecimal position of a row; the key has to be unique for exact sizes."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = [column(k).cast("string") for k in keys]
    # As JSON, so that neither nulls nor separators inside make two composite keys look alike.
    place = parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), place))


def _count_prefixes(hashed: DataFrame, digits: int) -> dict[str, list[tuple[str, int]]]:
    rows = (
        hashed.groupBy("c", F.substring("h", 1, digits).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counted: dict[str, list[tuple[str, int]]] = {}
    for r in sorted(rows, key=lambda r: (r["c"], r["p"])):
        counted.setdefault(r["c"], []).append((r["p"], r["n"]))
    return counted


def hash_cuts(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    seed: int | str,
    ranks: Callable[[dict[str, int]], dict[str, list[int]]],
) -> tuple[dict[str, int], Cuts]:
    """Class sizes, and per class the hashes below or at which exactly ``rank`` rows lie.

    ``ranks`` maps class sizes to the wanted ranks. Classes are few (they are labels), each pass
    brings back at most 16**3 counters per wanted cut.
    """
    hashed = df.select(column(label).cast("string").alias("c"), key_hash(key, seed).alias("h"))
    hashed = hashed.filter("c is not null")
    digits = _DIGITS
    counted = _count_prefixes(hashed, digits)
    sizes = {c: sum(n for _, n in buckets) for c, buckets in counted.items()}
    cuts: dict[tuple[str, int], str] = {}
    # (class, position of the cut) -> (prefix the cut lies under, rank inside that prefix)
    open_cuts = {
        (c, i): ("", rank)
        for c, wanted in ranks(sizes).items()
        for i, rank in enumerate(wanted)
    }
    while True:
        still_open: dict[tuple[str, int], tuple[str, int]] = {}
        largest = 0
        for cut, (prefix, rank) in open_cuts.items():
            if rank <= 0:
                cuts[cut] = prefix
                continue
            below = 0
            for p, n in counted.get(cut[0], []):
                if not p.startswith(prefix):
                    continue
                if below + n == rank:
                    cuts[cut] = p.ljust(HASH_DIGITS, "f")
                    break
                if below + n > rank:
                    still_open[cut] = (p, rank - below)
                    largest = max(largest, n)
                    break
                below += n
            else:
                cuts[cut] = "f" * HASH_DIGITS
        if not still_open:
            break
        if digits >= HASH_DIGITS:
            raise ValueError(f"Cannot split exactly: values of {key} repeat.")
        under = sorted({c + "|" + p for (c, _), (p, _) in still_open.items()})
        marker = F.concat_ws("|", "c", F.substring("h", 1, digits))
        digits = HASH_DIGITS if largest <= _FEW_ROWS else min(HASH_DIGITS, digits + _DIGITS)
        counted = _count_prefixes(hashed.filter(marker.isin(under)), digits)
        open_cuts = still_open
    by_class: Cuts = {}
    for (c, _), value in sorted(cuts.items()):
        by_class.setdefault(c, []).append(value)
    return sizes, by_class


def allocate(sizes: dict[str, int], total: int) -> dict[str, int]:
    """Share ``total`` draws over classes in proportion, largest remainders first."""
    n = sum(sizes.values())
    shares = {c: total * size / n for c, size in sizes.items()}
    drawn = {c: math.floor(share) for c, share in shares.items()}
    by_remainder = sorted(sizes, key=lambda c: (drawn[c] - shares[c], c))
    for c in by_remainder[: total - sum(drawn.values())]:
        drawn[c] += 1
    return drawn


def holdout_counts(sizes: dict[str, int], fraction: float) -> dict[str, int]:
    """Held-out rows per class: the training part is allocated first, the rest is held out."""
    n = sum(sizes.values())
    held_out = math.ceil(fraction * n)
    if min(sizes.values(), default=0) < 2:
        raise ValueError("Each class needs at least two rows for a stratified split.")
    if held_out < len(sizes) or n - held_out < len(sizes):
        raise ValueError("Too few rows: both parts need at least one row per class.")
    kept = allocate(sizes, n - held_out)
    return {c: size - kept[c] for c, size in sizes.items()}


@dataclass(frozen=True)
class Split:
    """A holdout split as an expression, with its class sizes known up front."""

    sizes: dict[str, int]
    held_out: dict[str, int]
    is_held_out: Column

    @property
    def kept(self) -> dict[str, int]:
        return {c: n - self.held_out[c] for c, n in self.sizes.items()}


def _under_cut(label: str, hashed: Column, cuts: Cuts, i: int) -> Column:
    cls = column(label).cast("string")
    branches = [(cls == c, hashed <= F.lit(values[i])) for c, values in cuts.items()]
    return F.coalesce(first_match(branches, None), F.lit(False))


def stratified_split(
    df: DataFrame, label: str, key: str | Sequence[str], fraction: float, seed: int | str
) -> Split:
    """Hold out ``ceil(fraction * n)`` rows, class shares kept to the row."""
    held_out: dict[str, int] = {}

    def ranks(sizes: dict[str, int]) -> dict[str, list[int]]:
        held_out.update(holdout_counts(sizes, fraction))
        return {c: [n] for c, n in held_out.items()}

    sizes, cuts = hash_cuts(df, label, key, seed, ranks)
    return Split(sizes, held_out, _under_cut(label, key_hash(key, seed), cuts, 0))


def inner_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    fraction: float,
    seed: int | str,
    sizes: dict[str, int],
) -> Split | None:
    """A validation split, or None when it is switched off or a class is too small."""
    if fraction <= 0 or len(sizes) < 2 or min(sizes.values()) < 2:
        return None
    return stratified_split(df, label, key, fraction, f"{seed}:inner")


def fold_sizes(sizes: dict[str, int], k: int) -> dict[str, list[int]]:
    """Rows per class and fold when class-ordered rows are dealt to the folds in turn."""
    dealt: dict[str, list[int]] = {}
    start = 0
    for c in sorted(sizes):
        end = start + sizes[c]
        dealt[c] = [(end - 1 - f) // k - (start - 1 - f) // k for f in range(k)]
        start = end
    return dealt


def clamp_folds(requested: int, sizes: dict[str, int]) -> int:
    """No more folds than rows of the smallest class; 0 means no cross-validation."""
    folds = min(requested, min(sizes.values(), default=0))
    return folds if folds >= 2 else 0


@dataclass(frozen=True)
class Folds:
    k: int
    sizes: dict[str, int]
    dealt: dict[str, list[int]]
    fold: Column

    def training_sizes(self, fold: int) -> dict[str, int]:
        return {c: n - self.dealt[c][fold] for c, n in self.sizes.items()}


def stratified_folds(
    df: DataFrame, label: str, key: str | Sequence[str], k: int, seed: int | str
) -> Folds:
    """``k`` folds whose sizes differ by at most one, overall and per class."""
    salt = f"{seed}:fold"
    dealt: dict[str, list[int]] = {}

    def ranks(sizes: dict[str, int]) -> dict[str, list[int]]:
        dealt.update(fold_sizes(sizes, k))
        return {c: [sum(parts[: i + 1]) for i in range(k - 1)] for c, parts in dealt.items()}

    sizes, cuts = hash_cuts(df, label, key, salt, ranks)
    hashed = key_hash(key, salt)
    under = [(_under_cut(label, hashed, cuts, i), F.lit(i)) for i in range(k - 1)]
    in_class = column(label).cast("string").isin(sorted(sizes))
    fold = F.when(in_class, first_match(under, F.lit(k - 1)))
    return Folds(k, sizes, dealt, fold)
