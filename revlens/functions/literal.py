"""Python-literal text -> typed Spark values.

Listing columns hold Python literals, not JSON (single quotes, ``None``,
``True``). Only ``ast.literal_eval`` reads those exactly, so the parse
runs in Arrow-batched pandas UDFs: Spark ships the one text column per
row to a Python worker, the rest of the row stays in the JVM.

The UDFs are marked non-deterministic so Catalyst never duplicates
them: a deterministic Python UDF that is both filtered on and projected
is evaluated twice (two ArrowEvalPython nodes).

JSON text is parsed natively with ``from_json`` instead; the two formats
are chosen by the caller and never tried one after the other.
"""

from __future__ import annotations

import ast
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.schemas import ADDRESS_TYPE, TAGGED_LISTING_TYPE

_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def clean_text(s: str) -> str:
    """Strings from a literal may hold lone surrogates ('\\ud800');
    Arrow needs valid UTF-8, so those become U+FFFD."""
    try:
        s.encode("utf-8")
        return s
    except UnicodeEncodeError:
        return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def as_text(obj) -> str | None:
    """How a value prints into a text column: str stays, None is NULL,
    anything else is written as ``str(obj)`` (what a CSV writer does)."""
    if obj is None:
        return None
    return clean_text(obj if isinstance(obj, str) else str(obj))


def coerce(obj, dtype: T.DataType):
    """Fit a Python literal value into ``dtype``; mismatches become None.

    Strings are only taken from str values, integers only from int (not
    bool), so a filter such as ``country IN ('Canada')`` can never match
    a value that was not the string ``'Canada'``.
    """
    if obj is None:
        return None
    if isinstance(dtype, T.StringType):
        return clean_text(obj) if isinstance(obj, str) else None
    if isinstance(dtype, T.BooleanType):
        return obj if isinstance(obj, bool) else None
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        ok = isinstance(obj, int) and not isinstance(obj, bool)
        return obj if ok and _LONG_MIN <= obj <= _LONG_MAX else None
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        ok = isinstance(obj, (int, float)) and not isinstance(obj, bool)
        return float(obj) if ok else None
    if isinstance(dtype, T.StructType):
        if not isinstance(obj, dict):
            return None
        return {f.name: coerce(obj.get(f.name), f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.ArrayType):
        if not isinstance(obj, (list, tuple)):
            return None
        return [coerce(x, dtype.elementType) for x in obj]
    if isinstance(dtype, T.MapType):
        if not isinstance(obj, dict):
            return None
        return [
            (coerce(k, dtype.keyType), coerce(v, dtype.valueType))
            for k, v in obj.items()
            if coerce(k, dtype.keyType) is not None
        ]
    return None


def _error(exc: BaseException) -> str:
    return f"{type(exc).__name__}: {exc}"


# ---------------------------------------------------------------------------
# One literal -> struct, strict or tolerant
# ---------------------------------------------------------------------------


def parse_struct_literal(text: str | None, dtype: T.StructType, strict: bool) -> dict:
    """Parse one literal into ``{"value": ..., "error": ...}``.

    strict: a missing value, a parse failure or a non-dict literal is an
    error (the caller turns it into a job failure). tolerant: those give
    a NULL value and no error.
    """
    if text is None:
        return {"value": None, "error": "ValueError: missing value" if strict else None}
    try:
        obj = ast.literal_eval(text)
    except Exception as exc:  # noqa: BLE001 - any parse failure is reported
        return {"value": None, "error": _error(exc) if strict else None}
    if not isinstance(obj, dict):
        err = f"AttributeError: '{type(obj).__name__}' object has no attribute 'get'"
        return {"value": None, "error": err if strict else None}
    return {"value": coerce(obj, dtype), "error": None}


def struct_literal_udf(dtype: T.StructType = ADDRESS_TYPE, strict: bool = True):
    """pandas UDF: literal text -> ``struct<value: dtype, error: string>``."""
    out_type = T.StructType(
        [T.StructField("value", dtype), T.StructField("error", T.StringType())]
    )

    @F.pandas_udf(out_type)
    def _parse(texts: pd.Series) -> pd.DataFrame:
        rows = [
            parse_struct_literal(None if t is None or t is pd.NA else t, dtype, strict)
            for t in texts
        ]
        return pd.DataFrame(rows, columns=["value", "error"])

    return _parse.asNondeterministic()


def parse_literal(c: Column | str, dtype: T.StructType = ADDRESS_TYPE, strict: bool = True) -> Column:
    """Column form of :func:`struct_literal_udf`."""
    return struct_literal_udf(dtype, strict)(F.col(c) if isinstance(c, str) else c)


# ---------------------------------------------------------------------------
# One listing's score and review list, as tagged literals
# ---------------------------------------------------------------------------


def read_literal(text: str | None):
    """(value, problem): problem is None, "malformed" (text that is no
    literal, or none at all: read as missing), or another error's message."""
    if text is None:
        return None, "malformed"
    try:
        return ast.literal_eval(text), None
    except (ValueError, SyntaxError):
        return None, "malformed"
    except Exception as exc:  # noqa: BLE001 - for example an unhashable dict key
        return None, _error(exc)


def tag_element(element) -> dict:
    """``item`` with its text where the element holds the key, ``none`` where
    it can be asked and does not, ``error`` where asking or taking fails."""
    try:
        if "comments" not in element:
            return {"tag": "none", "comments": None, "error": None}
        return {"tag": "item", "comments": as_text(element["comments"]), "error": None}
    except Exception as exc:  # noqa: BLE001 - reported with the row (N6)
        return {"tag": "error", "comments": None, "error": _error(exc)}


def read_score(text: str | None) -> dict:
    """The score's own text, NULL when missing or malformed; an error when
    the literal is no dict."""
    value, problem = read_literal(text)
    if problem == "malformed":
        return {"score_text": None, "score_error": None}
    if problem is None and isinstance(value, dict):
        return {"score_text": as_text(value.get("review_scores_value")), "score_error": None}
    return {"score_text": None, "score_error": problem or f"AttributeError: a {type(value).__name__} has no scores"}


def read_reviews(text: str | None) -> dict:
    """Every element of the review list, tagged; none when the list is
    missing or malformed; an error when the literal can not be walked."""
    value, problem = read_literal(text)
    if problem is not None:
        return {"elements": [], "list_error": None if problem == "malformed" else problem}
    try:
        return {"elements": [tag_element(e) for e in value], "list_error": None}
    except TypeError as exc:
        return {"elements": [], "list_error": _error(exc)}


def _listing_batch(reviews: pd.Series, scores: pd.Series) -> pd.DataFrame:
    given = [[None if t is None or t is pd.NA else t for t in side] for side in (reviews, scores)]
    rows = [{**read_score(s), **read_reviews(r)} for r, s in zip(*given, strict=True)]
    return pd.DataFrame(rows, columns=[f.name for f in TAGGED_LISTING_TYPE.fields])


def listing_udf():
    """pandas UDF: (reviews text, review_scores text) -> tagged listing."""
    return F.pandas_udf(_listing_batch, TAGGED_LISTING_TYPE).asNondeterministic()
