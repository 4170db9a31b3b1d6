"""Text cleaning: missing-value tokens, blanks and guarded number parsing.

Everything is an expression, so it fuses into the scan's codegen stage. Numbers are described
by SQL text (``number_sql``) because a persisted pipeline stage stores SQL, and the same text
has to be used when statistics are fitted and when rows are scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader takes for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_BLANK = r"[\s\x1c-\x1f]"
_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_ANY_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Reference a column by its literal name, dots included."""
    return F.col(quoted(name))


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def normalise_na(df: DataFrame) -> DataFrame:
    """Turn the missing-value tokens of every text column into nulls."""
    tokens = ", ".join(map(text_literal, NA_TOKENS))

    def cleaned(name: str) -> str:
        ref = quoted(name)
        return f"CASE WHEN {ref} NOT IN ({tokens}) THEN {ref} END AS {ref}"

    return df.selectExpr(
        *[
            cleaned(f.name) if isinstance(f.dataType, T.StringType) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def strip(c: Column) -> Column:
    """Remove Unicode blanks on both ends (``trim`` knows only the space)."""
    return F.regexp_replace(c, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def is_blank(c: Column) -> Column:
    return c.cast("string").rlike(rf"(?U)^{_BLANK}*$")


def number_sql(name: str, dtype: T.DataType) -> str:
    """SQL for a column's value as a double, NULL where it is not a number.

    Plain decimals take the first branch; only odd values pay for trimming and the second
    pattern, which keeps out what Spark would accept beyond it (``1d``, ``1f``, ``nan``). Around
    a number only ASCII blanks are allowed.
    """
    ref = quoted(name)
    if isinstance(dtype, T.NumericType):
        return f"nanvl(try_cast({ref} AS DOUBLE), CAST(NULL AS DOUBLE))"
    text = f"CAST({ref} AS STRING)"
    trimmed = f"trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM {text})"
    return (
        f"CASE WHEN {text} RLIKE r'{_PLAIN_NUMBER}' THEN try_cast({text} AS DOUBLE) "
        f"WHEN {trimmed} RLIKE r'{_ANY_NUMBER}' THEN try_cast({trimmed} AS DOUBLE) END"
    )


def to_number(df: DataFrame, name: str) -> Column:
    return F.expr(number_sql(name, df.schema[name].dataType))


def is_invalid_number(raw: Column, number: Column) -> Column:
    """Present, not blank, and still not a number."""
    return number.isNull() & raw.isNotNull() & ~is_blank(raw)


def is_unexpected(c: Column, allowed: tuple[str, ...]) -> Column:
    """A present value outside the declared set; nulls are never unexpected."""
    text = c.cast("string")
    return text.isNotNull() & ~text.isin(*allowed)
