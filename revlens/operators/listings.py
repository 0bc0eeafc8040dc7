"""Listing operators: country filter, review extraction, country comparison.

P1 membership filter on a nested field, N1 strict parse of the address,
N2/N3/N6 tolerant parse of scores and review lists, N4/N5 explode with
the listing score copied to each review, P3 key-exists, P4 projection,
A6 row count, D3 country comparison.

Every operator is a narrow transformation (no shuffle) except D3's
aggregate, which combines map-side before its small shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.literal import listing_udf, parse_literal
from revlens.schemas import ADDRESS_TYPE, REVIEW_COL, SCORE_COL
from revlens.session import spread

FORMATS = ("python_literal", "json")

_JSON_OBJECT = T.MapType(T.StringType(), T.StringType())
# Plain JSON: Spark would otherwise also accept single-quoted strings.
_JSON_OPTIONS = {"allowSingleQuotes": "false"}


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")


def _strict_json(c: Column, dtype: T.DataType, what: str) -> tuple[Column, Column]:
    """(value, error) for strict JSON parsing: FAILFAST on malformed text,
    an error for a missing value."""
    value = F.from_json(c, dtype, {**_JSON_OPTIONS, "mode": "FAILFAST"})
    error = F.when(c.isNull(), F.lit(f"ValueError: missing {what}"))
    return value, error


def filter_nested(
    df: DataFrame,
    column: str,
    field: str,
    values: Sequence,
    fmt: str = "python_literal",
    value_type: T.StructType | None = None,
    parsed_col: str | None = None,
) -> DataFrame:
    """P1 + P2: keep rows whose ``column.field`` is one of ``values``.

    A text column is parsed strictly (N1): a missing or malformed value,
    or a literal that is not a dict, fails the job, as one bad row ended
    the original run. A missing key drops the row. A column that is
    already a struct, map or VARIANT is used as is (P7), so on Parquet the
    predicate reaches the scan. The column itself is returned as it came,
    with every key; ``parsed_col`` adds its parsed ``value_type`` fields.
    """
    values = list(values)
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.StructType, T.MapType)):
        kept = df.where(F.col(column)[field].isin(values))
        return kept.withColumn(parsed_col, F.col(column)) if parsed_col else kept
    if isinstance(dtype, T.VariantType):
        from revlens.operators.variants import is_in

        kept = df.where(is_in(column, field, values))
        return kept.withColumn(parsed_col, F.col(column)) if parsed_col else kept
    if not isinstance(dtype, T.StringType):
        raise TypeError(f"{column} must be text, struct, map or variant, not {dtype.simpleString()}")
    _check_format(fmt)
    value_type = value_type or T.StructType([T.StructField(field, T.StringType())])
    tmp = "__nested_parsed"
    if fmt == "json":
        value, error = _strict_json(F.col(column), value_type, column)
        parsed = df.withColumn(tmp, F.struct(value.alias("value"), error.alias("error")))
    else:
        parsed = spread(df).withColumn(tmp, parse_literal(column, value_type, strict=True))
    err = F.col(f"{tmp}.error")
    keep = F.when(
        err.isNotNull(),
        F.raise_error(F.concat(F.lit(f"{column} can not be read: "), err)),
    ).otherwise(F.coalesce(F.col(f"{tmp}.value")[field].isin(values), F.lit(False)))
    kept = parsed.where(keep)
    return (kept.withColumn(parsed_col, F.col(f"{tmp}.value")) if parsed_col else kept).drop(tmp)


PROBLEM_COL = "__address_problem"


def address_problems(df: DataFrame, address_col: str = "address", fmt: str = "python_literal", parsed_col: str | None = None) -> DataFrame:
    """Adds why the address can not be read (NULL when it can): what the
    strict filter would stop at; ``parsed_col`` adds what the same parse read."""
    _check_format(fmt)
    parsed = lambda out, value: out.withColumn(parsed_col, value) if parsed_col else out
    if not isinstance(df.schema[address_col].dataType, T.StringType):
        return parsed(df.withColumn(PROBLEM_COL, F.lit(None).cast("string")), F.col(address_col))
    tmp = "__address_read"
    if fmt == "json":
        read = df.withColumn(tmp, F.from_json(F.col(address_col), _JSON_OBJECT, _JSON_OPTIONS))
        out = read.withColumn(PROBLEM_COL, F.when(F.col(tmp).isNull(), F.lit("ValueError: missing or malformed address")))
        return parsed(out, F.col(tmp)).drop(tmp)
    read = spread(df).withColumn(tmp, parse_literal(address_col, ADDRESS_TYPE, strict=True))
    return parsed(read.withColumn(PROBLEM_COL, F.col(tmp)["error"]), F.col(tmp)["value"]).drop(tmp)


def filter_country(
    df: DataFrame,
    countries: Sequence[str],
    address_col: str = "address",
    fmt: str = "python_literal",
    address_type: T.StructType = ADDRESS_TYPE,
    parsed_col: str | None = None,
) -> DataFrame:
    """P1 as the original pipeline uses it: ``address.country`` in a list."""
    return filter_nested(df, address_col, "country", countries, fmt, address_type, parsed_col)


def parse_listings(
    df: DataFrame,
    id_col: str = "listing_id",
    reviews_col: str = "reviews",
    scores_col: str = "review_scores",
    fmt: str = "python_literal",
    keep: Sequence[str] = (),
) -> DataFrame:
    """N2 + N3 + N6 + P3: ``(id, *keep, parsed struct<items, score_text, error>)``.

    Either format is read into tagged elements: python_literal by a pandas
    UDF with exact literal semantics, json by ``from_json``. What follows
    is the same for both, in Spark: a score that is no object fails the row
    (no items); the first element that can not be asked for the key stops
    it, and the items before stay; elements without the key give nothing.
    """
    _check_format(fmt)
    base = [F.col(id_col), *[F.col(k) for k in keep]]
    if fmt == "python_literal":
        tagged = spread(df).select(*base, listing_udf()(F.col(reviews_col), F.col(scores_col)).alias("__t"))
        read = tagged.select(*base, *(F.col(f"__t.{c}").alias(f"__{c}") for c in ("elements", "score_text", "score_error", "list_error")))
        walked = read.withColumn("__bad_at", F.array_position(F.transform("__elements", lambda x: x["tag"]), "error").cast("int"))
        bad = F.get("__elements", F.col("__bad_at") - 1)["error"]
        holds, text = (lambda x: x["tag"] == "item"), (lambda x: x["comments"])
    else:
        walked = _read_json(df.select(*base, F.col(reviews_col).alias("__reviews"), F.col(scores_col).alias("__scores")), base)
        bad = F.lit("TypeError: an element is not an object")
        # The key must exist; a JSON null value still counts.
        holds, text = (lambda x: F.map_contains_key(x, "comments")), (lambda x: x["comments"])
    stopped = F.col("__bad_at") > 0
    before = F.when(stopped, F.slice("__elements", F.lit(1), F.greatest(F.col("__bad_at") - 1, F.lit(0)))).otherwise(F.col("__elements"))
    items = F.transform(F.filter(before, holds), lambda x: F.struct(text(x).alias("comments")))
    return walked.select(
        *base,
        F.struct(
            F.when(F.col("__score_error").isNotNull(), F.slice(items, F.lit(1), F.lit(0))).otherwise(items).alias("items"),
            F.col("__score_text").alias("score_text"),
            F.coalesce(F.col("__score_error"), F.col("__list_error"), F.when(stopped, bad)).alias("error"),
        ).alias("parsed"),
    )


def _read_json(df: DataFrame, base: list[Column]) -> DataFrame:
    """``(*base, __elements, __bad_at, __score_text, __score_error, __list_error)``
    of JSON text: every element as a map, NULL where it is no object.

    Text that is no JSON counts as missing; valid JSON of the wrong kind is
    an error, looked for only where the opening mark is another. Each parse
    is a column of its own that later steps read: a struct made in one
    projection and taken apart in the next would be copied, parse and all,
    into every use.
    """

    def wrong_kind(c: str, opening: str, what: str) -> Column:
        other = ~F.ltrim(c).startswith(opening)
        return F.when(other, F.when(F.get_json_object(c, "$").isNotNull(), F.lit(f"TypeError: {what}")))

    as_list = F.coalesce(F.ltrim("__reviews").startswith("["), F.lit(False))
    read = df.select(
        *base,
        F.when(as_list, F.from_json("__reviews", T.ArrayType(T.StringType()), _JSON_OPTIONS)).alias("__texts"),
        F.from_json("__scores", _JSON_OBJECT, _JSON_OPTIONS)["review_scores_value"].alias("__score_text"),
        wrong_kind("__scores", "{", "the scores are not an object").alias("__score_error"),
        wrong_kind("__reviews", "[", "the reviews are not a list").alias("__list_error"),
    )
    objects = F.transform("__texts", lambda x: F.when(F.ltrim(x).startswith("{"), F.from_json(x, _JSON_OBJECT, _JSON_OPTIONS)))
    found = read.withColumn("__elements", F.coalesce(objects, F.array().cast(T.ArrayType(_JSON_OBJECT))))
    return found.withColumn("__bad_at", F.array_position(F.transform("__elements", lambda x: x.isNull()), True).cast("int"))


def explode_reviews(parsed: DataFrame, id_col: str = "listing_id", keep: Sequence[str] = ()) -> DataFrame:
    """N4 + N5 + P4: one row per review, in list order.

    Output ``(id, *keep, review_pos, Review, Review_Score)``; the score is
    the listing's, copied to each of its reviews, as the text the literal
    held. An empty list gives no row: those rows are dropped after an outer
    explode, since Spark would push the filter that it infers for an inner
    one below the projections, and parse every text once more for it.
    """
    exploded = parsed.select(
        F.col(id_col),
        *[F.col(k) for k in keep],
        F.posexplode_outer(F.col("parsed.items")).alias("review_pos", "item"),
        F.col("parsed.score_text").alias(SCORE_COL),
    ).where(F.col("review_pos").isNotNull())
    return exploded.select(
        id_col,
        *keep,
        F.col("review_pos").cast("int").alias("review_pos"),
        F.col("item.comments").alias(REVIEW_COL),
        SCORE_COL,
    )


def extraction_errors(parsed: DataFrame, id_col: str = "listing_id") -> DataFrame:
    """N6 side table: rows whose parse stopped, with the reviews kept.

    The rows are picked behind an outer explode of at most one element, for
    the reason given in :func:`explode_reviews`.
    """
    stopped = F.struct(F.col("parsed.error").alias("error"), F.size("parsed.items").alias("reviews_kept"))
    found = parsed.select(id_col, F.explode_outer(F.when(F.col("parsed.error").isNotNull(), F.array(stopped))).alias("__stopped"))
    return found.where(F.col("__stopped").isNotNull()).select(id_col, "__stopped.error", "__stopped.reviews_kept")


def count_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def compare_countries(
    df: DataFrame,
    countries: Sequence[str],
    country_col: str = "country",
    value_col: str = SCORE_COL,
) -> DataFrame:
    """D3: rows and mean value per country, for the listed countries.

    The aggregate is combined map-side per task before the shuffle, so a
    country holding most of the rows does not load one reducer.
    """
    return (
        df.where(F.col(country_col).isin(list(countries)))
        .groupBy(F.col(country_col).alias("country"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value_col).alias("mean_value"))
    )
