"""Column functions for text coercion and display.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null tokens pandas' read_csv turns into NaN by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# a plain decimal number: a cast alone also takes "12d", "7f", "NaN" and "Infinity"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(c) -> Column:
    """Text -> double; text that is not a plain finite number gives null
    (never raises, never NaN or an infinity)."""
    c = _col(c).cast("string")
    n = F.when(c.rlike(NUMBER), c.try_cast("double"))
    return F.when(F.abs(n) < float("inf"), n)


def finite(c) -> Column:
    """A double that is not NaN, as pandas reads one; NaN becomes null."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def null_tokens(c, tokens: Iterable[str] = ("",)) -> Column:
    """Read listed tokens as null. Default: only the empty field."""
    c = _col(c)
    tokens = list(tokens)
    if not tokens:
        return c
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def category_list(c) -> Column:
    """E3+E4: list text such as "['A', 'B']" -> array<string>.

    Brackets are stripped at both ends, single quotes removed, the rest split
    on ", ". The elements then go through array-literal rules: a
    double-quoted element loses its quotes, an unquoted one its surrounding
    blanks. "[]" and null give an empty array.
    """
    c = _col(c)
    body = F.regexp_replace(F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", ""), "'", "")
    parts = F.split(body, ", ")
    unquoted = F.transform(
        parts,
        lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) >= 2),
                         F.substring(x, 2, F.length(x) - 2).cast("string"))
        .otherwise(F.trim(x)),
    )
    cleaned = F.filter(unquoted, lambda x: x != "")
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(cleaned)


def int_or_zero(c) -> Column:
    """A number shown as an integer (truncated); null shows as 0."""
    return F.coalesce(_col(c).try_cast("int"), F.lit(0))


def round_half_up_2(c) -> Column:
    """P7 value rule: two decimals, halves away from zero for positive values."""
    return F.floor(_col(c) * 100 + 0.5) / 100


def two_decimals_text(c) -> Column:
    """P7 text rule: '%.2f' of the value, null stays null (not the text 'nu')."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%.2f", c))


def joined(c, sep: str = ", ") -> Column:
    """Category list shown as one text."""
    return F.array_join(_col(c), sep)


def key_text(c) -> Column:
    """Message key = str(user_id); a missing user gives the text 'None'."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))
