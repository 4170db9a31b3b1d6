"""Exact medians of many columns without sorting or holding the values.

A quantile sketch brackets the wanted ranks, one counting pass makes the bracket exact, and the
search goes on inside the bracket. Each round keeps under a thousandth of the rows (values equal
to a bracket end are settled by counting, so one hot value cannot keep a bracket large), which
puts 10^11 rows at two or three narrow scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So few values of a column are sorted at once; more are searched for.
EXACT_ROWS = 1_000
_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY


@dataclass
class _Search:
    """Neighbouring ranks of one column among the ``n`` values between ``low`` and ``high``."""

    column: int
    ranks: list[int]
    n: int
    low: float | None = None
    high: float | None = None

    def inside(self, value: Column) -> Column:
        condition = value.isNotNull()
        if self.low is not None:
            condition &= value > F.lit(self.low)
        if self.high is not None:
            condition &= value < F.lit(self.high)
        return F.when(condition, value)

    def ends(self) -> list[float]:
        """Shares of the bracket: beyond the sketch's error on both sides of the ranks."""
        first, last = (self.ranks[0] + 0.5) / self.n, (self.ranks[-1] + 0.5) / self.n
        return [max(0.0, first - _MARGIN), min(1.0, last + _MARGIN)]


def median_bracket(value: Column) -> Column:
    """Sketch of the values around the middle, for a caller that scans the table anyway."""
    return F.percentile_approx(value, [0.5 - _MARGIN, 0.5 + _MARGIN], _ACCURACY)


def collected_median(value: Column) -> Column:
    """Exact median from one sorted buffer: only for tables known to be small."""
    ordered = F.sort_array(F.collect_list(value))
    n = F.size(ordered)
    lower = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    upper = F.get(ordered, F.floor(n / 2).cast("int"))
    return (lower + upper) / 2


def _narrow(
    s: _Search, low: float, high: float, counts: dict[str, int]
) -> tuple[list[float], list[_Search]]:
    """Place each rank: settled on a bracket end, or still open below, between or above them."""
    found: list[float] = []
    parts = {
        "below": _Search(s.column, [], counts["below"], s.low, low),
        "between": _Search(s.column, [], counts["between"], low, high),
        "above": _Search(s.column, [], 0, high, s.high),
    }
    edges = [counts["below"], counts["low"], counts["between"], counts["high"]]
    parts["above"].n = s.n - sum(edges)
    for rank in s.ranks:
        left = rank
        for name, size in zip(("below", "low", "between", "high"), edges, strict=True):
            if left < size:
                if name in parts:
                    parts[name].ranks.append(left)
                else:
                    found.append(low if name == "low" else high)
                break
            left -= size
        else:
            parts["above"].ranks.append(left)
    return found, [p for p in parts.values() if p.ranks]


def medians(
    df: DataFrame,
    values: list[Column],
    counts: list[int],
    exact_rows: int = EXACT_ROWS,
    brackets: list[list[float] | None] | None = None,
) -> list[float | None]:
    """Exact median per value column (mean of the middle two), None where nothing is present.

    ``counts`` are the present values per column, ``brackets`` optional first ``median_bracket``
    results; both come from a pass the caller makes anyway.
    """
    middles: dict[int, list[float]] = {i: [] for i in range(len(values))}
    searches = [
        _Search(i, sorted({(n - 1) // 2, n // 2}), n) for i, n in enumerate(counts) if n
    ]
    known = {i: b for i, b in enumerate(brackets or []) if b}
    while searches:
        small = [s for s in searches if s.n <= exact_rows]
        large = [s for s in searches if s.n > exact_rows]
        aggregates = []
        for i, s in enumerate(small):
            ordered = F.sort_array(F.collect_list(s.inside(values[s.column])))
            picked = F.array(*[F.get(ordered, F.lit(r)) for r in s.ranks])
            aggregates.append(picked.alias(f"v{i}"))
        sketched = [i for i, s in enumerate(large) if s.column not in known]
        for i in sketched:
            inside = large[i].inside(values[large[i].column])
            sketch = F.percentile_approx(inside, large[i].ends(), _ACCURACY)
            aggregates.append(sketch.alias(f"b{i}"))
        row = df.agg(*aggregates).first() if aggregates else None
        for i, s in enumerate(small):
            middles[s.column] += row[f"v{i}"]
        if not large:
            break
        ends = [
            row[f"b{i}"] if i in sketched else known[s.column] for i, s in enumerate(large)
        ]
        known = {}
        counters = []
        for i, s in enumerate(large):
            low, high = (F.lit(e) for e in ends[i])
            v = s.inside(values[s.column])
            counters += [
                F.count_if(v < low).alias(f"below{i}"),
                F.count_if(v == low).alias(f"low{i}"),
                F.count_if((v > low) & (v < high)).alias(f"between{i}"),
                F.count_if((v == high) & (high > low)).alias(f"high{i}"),
            ]
        counted = df.agg(*counters).first()
        searches = []
        for i, s in enumerate(large):
            sizes = {k: counted[f"{k}{i}"] for k in ("below", "low", "between", "high")}
            found, rest = _narrow(s, *ends[i], sizes)
            middles[s.column] += found
            searches += rest
    return [sum(m) / len(m) if m else None for m in middles.values()]
