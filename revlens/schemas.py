"""Declared schemas and fixed values.

Listings arrive as text; the nested columns hold Python literals
(``{'country': 'Canada'}``, ``[{'comments': '...'}]``). Parsed forms are
declared here so no schema is ever inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The tokens pandas' CSV reader treats as missing by
# default (public pandas behaviour, ``na_values`` documentation).
# Matching is exact: no trimming, case as written.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Column names of the review table handed between stages.
REVIEW_COL = "Review"
SCORE_COL = "Review_Score"
PRED_COL = "predicho"
ERROR_COL = "answer_error"

ADDRESS_TYPE = T.StructType([T.StructField("country", T.StringType())])

# What the literal parser says of one listing: the score's text or why
# the score could not be used, and a tag for every element of the list:
# "item" (holds the key), "none" (does not), "error".
TAGGED_LISTING_TYPE = T.StructType(
    [
        T.StructField("score_text", T.StringType()),
        T.StructField("score_error", T.StringType()),
        T.StructField("list_error", T.StringType()),
        T.StructField(
            "elements",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("tag", T.StringType()),
                        T.StructField("comments", T.StringType()),
                        T.StructField("error", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
