"""Scalar column functions (all JVM-side, codegen'd).

F1 decimal comma, F2 strip, F3 answer -> number, F4 comma text -> number,
F5 absolute difference, F6 prompt templating, F7 two-decimal display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.schemas import NA_TOKENS

# A plain decimal number as Python's float() reads it, minus the forms
# we reject on purpose: nan/inf, digit-group underscores, non-ASCII
# digits. Spark's try_cast alone would also accept '8d' / '8f'.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Leading/trailing whitespace as str.strip() sees it: Unicode White_Space
# (Java's (?U)\s) plus the four separators U+001C..U+001F, which Python
# also counts as whitespace.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

SLOT = "{review}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def parse_number(c: Column | str) -> Column:
    """text -> double, NULL when it is not a plain decimal number.

    The text is stripped first (the model answer is). No range check:
    0, 11 and -3 pass. Neither NaN nor an infinity can come out (``1e999``
    overflows to one, as ``inf`` would), so averages stay finite and
    NULL-aware.
    """
    s = strip(c)
    value = s.try_cast("double")
    return F.when(s.rlike(NUMBER_PATTERN) & (F.abs(value) < F.lit(float("inf"))), value)


def comma_decimal(c: Column | str) -> Column:
    """number text with decimal comma. Uses the value's own text."""
    return F.replace(_col(c).cast("string"), F.lit("."), F.lit(","))


def parse_comma_decimal(c: Column | str) -> Column:
    """decimal-comma (or dot) text -> double; unparsable -> NULL."""
    return parse_number(F.replace(_col(c), F.lit(","), F.lit(".")))


def abs_diff(a: Column | str, b: Column | str) -> Column:
    """|a - b|, NULL when either side is NULL."""
    return F.abs(_col(a) - _col(b))


def render(template: Column | str, review: Column | str) -> Column:
    """put the review into every ``{review}`` slot of the template.

    Literal replacement, so braces inside a review are safe.
    """
    return F.replace(_col(template), F.lit(SLOT), _col(review))


def missing_to_null(c: Column | str) -> Column:
    """The CSV missing-value tokens become NULL (exact match)."""
    c = _col(c)
    return F.when(~c.isin(*NA_TOKENS), c)


def fmt2(value: float | None) -> str:
    """two-decimal display of a driver-side number."""
    return "nan" if value is None else f"{value:.2f}"
