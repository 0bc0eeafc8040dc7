"""Typed copies of listing text: VARIANT columns, parsed once.

A listing's nested text (Python literal or JSON) is parsed once into
Spark's VARIANT type, which keeps every key with the type of its value.
Written as Parquet the copy is shredded: Spark stores frequent paths as
columns of their own, so a later filter on ``address.country`` reaches
the scan and reads neither the reviews nor the rest of the address.

The extraction (P3, N4-N6) runs on such a copy with the results that the
text itself gives (:func:`parse_variants`). Differences of the type: a JSON
number such as ``9.0`` is a decimal and prints as ``9``; a literal's float
stays a double and prints as Java prints it. A text above ``LARGE`` bytes
that Spark can not hold in one value is reported, never read as missing.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.literal import as_text, clean_text, read_literal
from revlens.operators.listings import FORMATS
from revlens.session import spread

# Spark holds a variant of at least this many bytes in one value.
LARGE = 16 * 1024 * 1024

_JSON_TYPE = T.StructType([T.StructField("json", T.StringType()), T.StructField("error", T.StringType())])
_MAP = "map<string,variant>"


def plain(value):
    """A literal's value as what JSON can say: tuples and sets as lists (sets
    by their printed order), other values and keys as they print."""
    if value is None or isinstance(value, bool | int):
        return value
    if isinstance(value, str):
        return clean_text(value)
    if isinstance(value, float):
        return value if math.isfinite(value) else str(value)
    if isinstance(value, dict):
        return {"None" if k is None else as_text(k): plain(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    if isinstance(value, set | frozenset):
        return [plain(v) for v in sorted(value, key=repr)]
    return as_text(value)


class _Doubles(json.JSONEncoder):
    """JSON in which floats have an exponent: Spark reads those as doubles,
    and others as decimals."""

    def iterencode(self, o, _one_shot=False):
        return json.encoder._make_iterencode(
            {}, self.default, json.encoder.encode_basestring, None, lambda x: r if "e" in (r := repr(x)) else f"{r}E0",
            self.key_separator, self.item_separator, self.sort_keys, self.skipkeys, False,
        )(o, 0)


_ENCODER = _Doubles(separators=(",", ":"), ensure_ascii=False)


def literal_as_json(text: str | None) -> dict:
    """``{"json": ..., "error": ...}`` of one literal; error is "missing",
    "malformed", or why the literal has no value."""
    if text is None:
        return {"json": None, "error": "missing"}
    value, problem = read_literal(text)
    if problem is not None:
        return {"json": None, "error": problem}
    try:
        return {"json": "".join(_ENCODER.iterencode(plain(value))), "error": None}
    except RecursionError as exc:
        return {"json": None, "error": f"RecursionError: {exc}"}


@F.pandas_udf(_JSON_TYPE)
def _literal_batch(texts: pd.Series) -> pd.DataFrame:
    rows = [literal_as_json(None if t is None or t is pd.NA else t) for t in texts]
    return pd.DataFrame(rows, columns=["json", "error"])


def with_variants(df: DataFrame, columns: Sequence[str], fmt: str = "python_literal") -> DataFrame:
    """``df`` with these text columns as VARIANT, and ``<column>_problem`` for
    each: NULL if it was read, else "missing", "malformed" or the reason."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    # Python dicts keep the last of equal keys; Spark refuses them by default.
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    if fmt == "python_literal":
        literal = _literal_batch.asNondeterministic()
        read = spread(df).select(*others, *(literal(F.col(f"`{c}`")).alias(f"__read_{c}") for c in columns))
        text, said = (lambda c: F.col(f"__read_{c}")["json"]), (lambda c: F.col(f"__read_{c}")["error"])
    else:
        read = df.select(*others, *(F.col(f"`{c}`").alias(f"__read_{c}") for c in columns))
        text = lambda c: F.col(f"__read_{c}")
        said = lambda c: F.when(F.col(f"__read_{c}").isNull(), F.lit("missing"))
    parsed = read.select(*others, *(x for c in columns for x in (
        F.try_parse_json(text(c)).alias(c), said(c).alias(f"__said_{c}"), (F.octet_length(text(c)) > LARGE).alias(f"__large_{c}"),
    )))

    def problem(c: str) -> Column:
        unread = F.when(F.col(f"__large_{c}"), F.lit(f"ValueError: more than {LARGE} bytes")).otherwise(F.lit("malformed"))
        return F.coalesce(F.col(f"__said_{c}"), F.when(F.col(f"`{c}`").isNull(), unread))

    return parsed.select(*others, *(x for c in columns for x in (F.col(f"`{c}`"), problem(c).alias(f"{c}_problem"))))


def at_path(column: str, *keys: str | int, kind: str = "string") -> Column:
    """The value under ``keys`` of a VARIANT column, NULL where there is
    none or it is of another kind."""
    steps = "".join(f"[{k}]" if isinstance(k, int) else f'["{k}"]' for k in keys)
    return F.try_variant_get(F.col(column), f"${steps}", kind)


def is_in(column: str, field: str, values: Sequence) -> Column:
    """P1 on a VARIANT column: ``column.field`` is one of ``values``, of their
    type (NULL where there is no such field, so that the test alone reaches
    the scan). Texts are compared as texts: the number 5 is not ``'5'``."""
    kinds = {str: "string", bool: "boolean", int: "bigint", float: "double"}
    if len({type(v) for v in values}) != 1 or type(values[0]) not in kinds:
        raise TypeError("the values must be texts, or numbers of one type")
    kind = kinds[type(values[0])]
    found = at_path(column, field, kind=kind).isin(list(values))
    if kind == "string" and any(re.fullmatch(r"true|false|[\s+-]*[\d.].*|NaN|-?Infinity", v) for v in values):
        found = found & (F.schema_of_variant(at_path(column, field, kind="variant")) == "STRING")
    return found


def parse_variants(
    df: DataFrame, id_col: str = "listing_id", reviews_col: str = "reviews", scores_col: str = "review_scores",
    fmt: str = "python_literal", keep: Sequence[str] = (),
) -> DataFrame:
    """``(id, *keep, parsed struct<items, score_text, error>)``, as
    ``parse_listings`` gives it, of a copy made by :func:`with_variants`.

    ``fmt`` says how an element that is no object is met: in JSON it stops
    the row; in Python a text, list or dict can be asked for the key.
    """
    base = [F.col(id_col), *[F.col(k) for k in keep]]
    of_kind = lambda x, kind: F.try_variant_get(x, "$", kind)
    read = df.select(
        *base, F.col(reviews_col).alias("__reviews"), F.col(f"{reviews_col}_problem").alias("__reviews_problem"), F.col(f"{scores_col}_problem").alias("__scores_problem"),
        of_kind(F.col(reviews_col), "array<variant>").alias("__list"), of_kind(F.col(scores_col), _MAP).alias("__scores"), F.col(scores_col).alias("__score_value"),
    )
    reason = lambda c: F.when(~F.col(c).isin("missing", "malformed"), F.col(c))
    not_a_list = F.when(F.col("__reviews").isNotNull() & F.col("__list").isNull(), F.schema_of_variant("__reviews"))
    if fmt == "json":
        list_error = F.when(not_a_list.isNotNull(), F.lit("TypeError: the reviews are not a list"))
    else:  # a text or a dict can be walked: by its letters, by its keys
        keys = F.map_keys(of_kind(F.col("__reviews"), _MAP))
        list_error = F.when(not_a_list.startswith("OBJECT"), F.when(F.exists(keys, lambda k: k.contains("comments")), F.lit("TypeError: a key can not give the comments"))).when(
            not_a_list.isNotNull() & (not_a_list != "STRING"), F.lit("TypeError: the reviews can not be walked")
        )
    score_kind = F.lit("TypeError: the scores are not an object") if fmt == "json" else F.lit("AttributeError: the value has no scores")
    walked = read.select(
        *base,
        F.coalesce(reason("__reviews_problem"), list_error).alias("__list_error"),
        F.coalesce(reason("__scores_problem"), F.when(F.col("__score_value").isNotNull() & F.col("__scores").isNull(), score_kind)).alias("__score_error"),
        of_kind(F.col("__scores")["review_scores_value"], "string").alias("__score_text"),
        F.col("__list"), F.transform("__list", lambda x: of_kind(x, _MAP)).alias("__objects"),
    )

    def stops(value: Column, fields: Column) -> Column:
        if fmt == "json":
            return fields.isNull()
        kind = F.schema_of_variant(value)
        asked = F.when(kind == "STRING", of_kind(value, "string").contains("comments")).when(
            kind.startswith("ARRAY"), F.exists(of_kind(value, "array<variant>"), lambda v: (F.schema_of_variant(v) == "STRING") & (of_kind(v, "string") == "comments"))
        )
        return fields.isNull() & F.coalesce(asked, F.lit(True))

    placed = walked.withColumn("__bad_at", F.array_position(F.zip_with("__list", "__objects", stops), True).cast("int"))
    stopped = F.col("__bad_at") > 0
    before = F.when(stopped, F.slice("__objects", F.lit(1), F.greatest(F.col("__bad_at") - 1, F.lit(0)))).otherwise(F.col("__objects"))
    items = F.transform(
        F.filter(before, lambda m: F.coalesce(F.map_contains_key(m, "comments"), F.lit(False))), lambda m: F.struct(of_kind(m["comments"], "string").alias("comments"))
    )
    none = F.array().cast("array<struct<comments:string>>")
    return placed.select(
        *base,
        F.struct(
            F.when(F.col("__score_error").isNotNull(), none).otherwise(F.coalesce(items, none)).alias("items"),
            F.col("__score_text").alias("score_text"),
            F.coalesce(F.col("__score_error"), F.col("__list_error"), F.when(stopped, F.lit("TypeError: an element is not an object"))).alias("error"),
        ).alias("parsed"),
    )
