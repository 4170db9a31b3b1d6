"""Quality profile and gate.

A profile is a long table of facts ``(run_id, section, column, metric, value)``. All per-column
facts come out of one aggregate pass with map-side combine; only key uniqueness and the target's
value counts need their own (two-column) passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.functions.text import (
    column,
    is_invalid_number,
    is_unexpected,
    text_literal,
    to_number,
)
from rowan.spec import DatasetSpec

# Aggregates per pass: keeps generated code small on very wide tables. Each pass reads only
# its own columns, so splitting does not re-read data.
_AGGREGATES_PER_PASS = 120

_Fact = tuple[str, str | None, str, Column]


def _missing(name: str) -> Column:
    return F.count_if(column(name).isNull())


def _number_name(name: str) -> str:
    return f"__number_{name}"


def _with_numbers(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Parse each declared number once; several facts look at the result."""
    present = [c for c in spec.numeric if c in df.columns]
    return df.withColumns({_number_name(c): to_number(df, c) for c in present}) if present else df


def _column_facts(df: DataFrame, spec: DatasetSpec, sections: tuple[str, ...]) -> list[_Fact]:
    rows = F.count(F.lit(1))
    facts: list[_Fact] = []
    if "table" in sections:
        facts.append(("table", None, "row_count", rows))
        facts.append(("table", None, "column_count", F.first(F.lit(len(df.columns)))))
    if "missing" in sections:
        for c in df.columns:
            facts.append(("missing", c, "count", _missing(c)))
            facts.append(("missing", c, "rate", F.try_divide(_missing(c).cast("double"), rows)))
    if "numeric" in sections:
        for c in (c for c in spec.numeric if c in df.columns):
            number = column(_number_name(c))
            invalid = is_invalid_number(column(c), number)
            facts.append(("numeric", c, "invalid", F.count_if(invalid)))
            facts.append(("numeric", c, "missing_after_coercion", F.count_if(number.isNull())))
    if "category" in sections:
        for c, allowed in spec.allowed.items():
            if c in df.columns:
                unexpected = is_unexpected(column(c), allowed)
                facts.append(("category", c, "unexpected", F.count_if(unexpected)))
    return facts


def _grouping(by: str | None) -> Column:
    """The run column, or a constant when the whole table is one run."""
    return (column(by) if by else F.lit(None)).cast("string").alias("run_id")


def _long(df: DataFrame, facts: list[_Fact], by: str | None) -> DataFrame:
    grouping = [_grouping(by)] if by else []
    measured = df.groupBy(*grouping).agg(*[f[3].alias(f"m{i}") for i, f in enumerate(facts)])
    # As text: one parsed string instead of a column object per cell.
    cells = [
        f"named_struct('section', {text_literal(section)}, "
        f"'column', {text_literal(name) if name else 'CAST(NULL AS STRING)'}, "
        f"'metric', {text_literal(metric)}, 'value', CAST(m{i} AS DOUBLE))"
        for i, (section, name, metric, _) in enumerate(facts)
    ]
    rows = F.expr(f"array({', '.join(cells)})")
    run = F.col("run_id") if by else F.lit(None).cast("string").alias("run_id")
    return measured.select(run, F.explode(rows).alias("f")).select("run_id", "f.*")


def column_profile(
    df: DataFrame,
    spec: DatasetSpec,
    sections: tuple[str, ...] = ("table", "missing", "numeric", "category"),
    by: str | None = None,
) -> DataFrame:
    """Row and column counts, missing counts and rates, number and category checks."""
    data = df.drop(by) if by else df
    facts = _column_facts(data, spec, sections)
    parsed = _with_numbers(df, spec) if "numeric" in sections else df
    passes = [
        _long(parsed, facts[i : i + _AGGREGATES_PER_PASS], by)
        for i in range(0, len(facts), _AGGREGATES_PER_PASS)
    ]
    return reduce(DataFrame.unionByName, passes)


def duplicate_keys(df: DataFrame, key: str | list[str], by: str | None = None) -> DataFrame:
    """Rows after the first of each key; null keys equal each other.

    Counts are combined before the shuffle, so a key that fills a third of the table costs one
    row per task, not a hot partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(_grouping(by), *[column(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_run = per_key.groupBy("run_id") if by else per_key.groupBy()
    counted = per_run.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    run = F.col("run_id") if by else F.lit(None).cast("string").alias("run_id")
    return counted.select(run, "duplicates")


def _duplicate_fact(df: DataFrame, spec: DatasetSpec, by: str | None = None) -> DataFrame:
    return duplicate_keys(df, spec.key, by).select(
        "run_id",
        F.lit("table").alias("section"),
        F.lit(None).cast("string").alias("column"),
        F.lit("duplicate_keys").alias("metric"),
        F.col("duplicates").cast("double").alias("value"),
    )


def target_distribution(df: DataFrame, target: str, by: str | None = None) -> DataFrame:
    """Rows per target value; null is a value."""
    return df.groupBy(_grouping(by), column(target).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def unexpected_values(df: DataFrame, spec: DatasetSpec, by: str | None = None) -> DataFrame:
    """Every value outside its declared set with its row count: (run_id, column, value, n).

    The filter runs before the shuffle, and the list stays a table however long it is.
    """
    declared = {c: allowed for c, allowed in spec.allowed.items() if c in df.columns}
    candidates = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.when(is_unexpected(column(c), allowed), column(c).cast("string")).alias("value"),
            )
            for c, allowed in declared.items()
        ]
    )
    found = F.filter(candidates, lambda s: s["value"].isNotNull())
    return (
        df.select(_grouping(by), F.explode(found).alias("s"))
        .groupBy("run_id", "s.column", "s.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quality_report(
    df: DataFrame, spec: DatasetSpec, run_id: str | None = None, by: str | None = None
) -> DataFrame:
    """All facts of one run, or of every run when ``by`` names the run column."""
    data_columns = [c for c in df.columns if c != by]
    parts = [column_profile(df, spec, by=by)]
    if spec.key in data_columns:
        parts.append(_duplicate_fact(df, spec, by))
    if spec.target in data_columns:
        parts.append(
            target_distribution(df, spec.target, by).select(
                "run_id",
                F.lit("target").alias("section"),
                F.col("value").alias("column"),
                F.lit("count").alias("metric"),
                F.col("n").cast("double").alias("value"),
            )
        )
    report = reduce(DataFrame.unionByName, parts)
    return report if by else report.withColumn("run_id", F.lit(run_id).cast("string"))


def missing_columns(df: DataFrame, spec: DatasetSpec) -> list[str]:
    return [c for c in spec.required if c not in df.columns]


def _rules(spec: DatasetSpec) -> list[tuple[str, str | None, str, int, int, str, str]]:
    """Facts that must be zero: (section, column, metric) and the rule each one checks."""
    rules = [
        ("table", None, "duplicate_keys", 2, 0, "unique_key", spec.key),
        ("missing", spec.target, "count", 3, 0, "target_present", spec.target),
    ]
    rules += [
        ("numeric", c, "invalid", 4, i, "clean_number", c) for i, c in enumerate(spec.numeric)
    ]
    rules += [
        ("category", c, "unexpected", 5, i, "allowed_category", c)
        for i, c in enumerate(spec.allowed)
    ]
    return rules


def report_violations(report: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Broken rules of a profiled table: (step, position, check, column, n)."""
    # One row per declared rule.
    rules = report.sparkSession.createDataFrame(
        _rules(spec),
        "section string, `column` string, metric string, "
        "step int, position int, check string, subject string",
    )
    facts = report.filter("value > 0").alias("f")
    same = (
        (F.col("f.section") == F.col("r.section"))
        & (F.col("f.metric") == F.col("r.metric"))
        & F.col("f.column").eqNullSafe(F.col("r.column"))
    )
    return facts.join(rules.alias("r"), same).select(
        "r.step",
        "r.position",
        "r.check",
        F.col("r.subject").alias("column"),
        F.col("f.value").cast("bigint").alias("n"),
    )


def violations(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Broken rules as rows ``(step, position, check, column, n)``; empty when the table passes."""
    absent = missing_columns(df, spec)
    if absent:
        rows = [(1, i, "required_column", c, 1) for i, c in enumerate(absent)]
        schema = "step int, position int, check string, `column` string, n bigint"
        return df.sparkSession.createDataFrame(rows, schema)
    ruled = [c for c in df.columns if c in {spec.target, *spec.numeric, *spec.allowed}]
    profile = column_profile(df.select(*map(column, ruled)), spec)
    return report_violations(profile.unionByName(_duplicate_fact(df, spec)), spec)


def gate(df: DataFrame, spec: DatasetSpec, report: DataFrame | None = None) -> None:
    """Raise on the first broken rule, rules taken in their declared order.

    A quality report of the same table saves the gate its own passes.
    """
    checked = report is not None and not missing_columns(df, spec)
    broken = report_violations(report, spec) if checked else violations(df, spec)
    # At most one row per declared rule comes back.
    found = broken.orderBy("step", "position").collect()
    if not found:
        return
    first = found[0]["step"]
    names = [r["column"] for r in found if r["step"] == first]
    # The texts a caller matches on.
    messages = {
        1: f"Missing required columns: {names}",
        2: f"Duplicate {spec.key} values found.",
        3: "Target column contains null values.",
        4: f"Invalid numeric values found in columns: {names}",
        5: f"Unexpected categorical values found in columns: {names}",
    }
    raise ValueError(messages[first])
