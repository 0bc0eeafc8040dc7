"""Reviews of listings of any size: an Arrow table function that walks lists.

``parse_listings`` reads a listing's whole review list into memory, in the
JVM or in a Python worker. A listing whose list is hundreds of megabytes
needs another way: :func:`walk_listings` scans the text where it lies in the
Arrow buffer, element by element, and hands reviews on in batches of
about ``BATCH_BYTES`` as it meets them. Besides the text itself a worker holds one
element and one batch, so memory does not grow with the number of reviews.

Results are those of ``parse_listings`` (N2-N6, P3): a text that is no
literal (or no JSON) anywhere gives no review, so each text is walked twice,
once to see that it can be read and once to give the reviews; the first
element that can not be asked for the key stops the row after its prefix.
Only a text above ``SMALL`` bytes that is no list is not examined further:
it is reported as an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.literal import as_text, read_literal, read_reviews, read_score, tag_element
from revlens.operators.listings import FORMATS, _read_json
from revlens.schemas import REVIEW_COL, SCORE_COL
from revlens.session import ship_package

SMALL = 1 << 20
BATCH_BYTES = 1 << 20

# Strings (three quotes, one quote), comments, brackets and commas; a quote
# alone is one that nothing closes.
_TOKEN = re.compile(
    rb'"""(?:[^"\\]++|\\.|"(?!""))*+"""|' + rb"'''(?:[^'\\]++|\\.|'(?!''))*+'''|"
    + rb'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|' + rb"'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|" + rb"#[^\n]*+|[\[\](){},]|[\"']",
    re.DOTALL,
)
_COMMENT = re.compile(rb"#[^\n]*")
_STEP = {b"[": 1, b"(": 1, b"{": 1, b"]": -1, b")": -1, b"}": -1}


class Malformed(ValueError):
    """The text is no literal (no JSON)."""


def _blank(part: bytes) -> bool:
    return not _COMMENT.sub(b"", part).strip()


def elements(view: memoryview, trailing_comma: bool = True) -> Iterator[bytes]:
    """The texts between the commas of the list in ``view``, one at a time."""
    depth, start, ended, some = 0, 0, False, False
    for m in _TOKEN.finditer(view):
        token = m.group()
        if token in (b'"', b"'"):
            raise Malformed("a string does not end")
        if token[:1] == b"#":
            continue
        if depth == 0:
            if ended or token != b"[" or not _blank(bytes(view[: m.start()])):
                raise Malformed("not a list alone")
            depth, start = 1, m.end()
            continue
        step = _STEP.get(token, 0)
        if depth == 1 and (token == b"," or step < 0):
            part = bytes(view[start : m.start()])
            if _blank(part):
                if step == 0 or (some and not trailing_comma):
                    raise Malformed("an element is missing")
            else:
                some = True
                yield part
            start = m.end()
            if step < 0:
                if token != b"]":
                    raise Malformed("brackets do not match")
                ended = True
        depth += step
    if not ended or not _blank(bytes(view[start:])):
        raise Malformed("the list does not end")


def _literal_element(part: bytes) -> tuple[object, str | None]:
    # in brackets, as within the list, an element may go over several lines
    value, problem = read_literal(f"({part.decode('utf-8')}\n)")
    if problem == "malformed":
        raise Malformed(problem)
    return value, problem


def _no_constant(name: str):
    raise ValueError(name)


def _json_value(text: str):
    return json.loads(text, parse_constant=_no_constant)


def _json_element(part: bytes) -> tuple[object, str | None]:
    try:
        return _json_value(part.decode("utf-8")), None
    except ValueError as exc:
        raise Malformed(str(exc)) from exc


def tag_json(element) -> dict:
    """As ``tag_element`` for JSON: whatever is no object is an error."""
    if not isinstance(element, dict):
        return {"tag": "error", "comments": None, "error": "TypeError: an element is not an object"}
    if "comments" not in element:
        return {"tag": "none", "comments": None, "error": None}
    value = element["comments"]
    text = as_text(value) if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return {"tag": "item", "comments": text, "error": None}


def json_reviews(text: str | None) -> dict:
    """Every element of a JSON list, tagged, as ``read_reviews`` does for literals."""
    try:
        value = _json_value(text) if text is not None else []
    except ValueError:
        return {"elements": [], "list_error": None}
    if not isinstance(value, list):
        return {"elements": [], "list_error": "TypeError: the reviews are not a list"}
    return {"elements": [tag_json(e) for e in value], "list_error": None}


def walk(view: memoryview, fmt: str, small: int = SMALL) -> Iterator[tuple[str | None, str | None]]:
    """(comment, None) of each review in list order; (None, error) ends it."""
    tag = tag_element if fmt == "python_literal" else tag_json
    read: Callable = _literal_element if fmt == "python_literal" else _json_element
    if len(view) <= small:
        whole = (read_reviews if fmt == "python_literal" else json_reviews)(bytes(view).decode("utf-8"))
        if whole["list_error"]:
            yield None, whole["list_error"]
        tagged: Iterator[dict] = iter(whole["elements"])
    elif bytes(view[: 1 << 10]).lstrip()[:1] not in (b"[", b"#", b""):
        yield None, f"ValueError: more than {small} bytes that are no list"
        return
    else:
        comma = fmt == "python_literal"
        try:
            for part in elements(view, comma):
                _, problem = read(part)
                if problem is not None:  # then the list has no value either
                    yield None, problem
                    return
        except Malformed:
            return
        tagged = (tag(read(part)[0]) for part in elements(view, comma))
    for found in tagged:
        if found["tag"] == "error":
            yield None, found["error"]
            return
        if found["tag"] == "item":
            yield found["comments"], None


def _view(column: pa.Array, at: int) -> memoryview | None:
    """The bytes of one text, where they lie."""
    if not column[at].is_valid:
        return None
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    width = 8 if large else 4
    place = column.offset + at
    a, b = (int.from_bytes(offsets[width * (place + k) : width * (place + k + 1)].to_pybytes(), "little") for k in (0, 1))
    return memoryview(data)[a:b] if data is not None else memoryview(b"")


class WalkReviews:
    """Arrow table function: (row struct, reviews, score text, score error) to
    (row struct, review_pos, Review, Review_Score, error). A row with an
    error tells in ``review_pos`` how many reviews came before it."""

    fmt = "python_literal"
    small = SMALL

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = ["row", "review_pos", REVIEW_COL, SCORE_COL, "error"]
        kept = batch.column("row")
        found: list[list] = [[], [], [], [], []]
        size = 0

        def given() -> pa.RecordBatch:
            arrays = [kept.take(pa.array(found[0], pa.int64())), pa.array(found[1], pa.int32()), *(pa.array(x, pa.string()) for x in found[2:])]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for i in range(batch.num_rows):
            score, failed = (batch.column(c)[i].as_py() for c in ("score_text", "score_error"))
            view = _view(batch.column("reviews"), i)
            met = iter([(None, failed)]) if failed else walk(view, self.fmt, self.small) if view is not None else iter(())
            for place, (comment, error) in enumerate(met):
                for column, value in zip(found, (i, place, comment, score, error)):
                    column.append(value)
                size += 64 + len(comment or "")
                if size > BATCH_BYTES:
                    yield given()
                    found, size = [[], [], [], [], []], 0
        yield given()


_SCORE_TYPE = T.StructType([T.StructField("score_text", T.StringType()), T.StructField("score_error", T.StringType())])


@F.pandas_udf(_SCORE_TYPE)
def _score_batch(scores: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_score(None if s is None or s is pd.NA else s) for s in scores], columns=["score_text", "score_error"])


def walk_listings(
    df: DataFrame, id_col: str = "listing_id", reviews_col: str = "reviews", scores_col: str = "review_scores",
    fmt: str = "python_literal", keep: Sequence[str] = (), small: int = SMALL,
) -> DataFrame:
    """``(id, *keep, review_pos, Review, Review_Score, error)``: a row a review, and
    a row for each listing that stopped. Lists above ``small`` bytes are walked.

    Write it before both parts are read (:func:`walked_reviews`,
    :func:`walked_errors`): each reading walks the texts again.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    ship_package(df.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in (id_col, *keep)))
    base = [row.alias("row"), F.col(reviews_col).alias("reviews")]
    if fmt == "python_literal":
        scored = df.select(*base, _score_batch.asNondeterministic()(F.col(scores_col)).alias("__s"))
        source = scored.select("row", "reviews", "__s.score_text", "__s.score_error")
    else:
        read = _read_json(df.select(*base, F.lit(None).cast("string").alias("__reviews"), F.col(scores_col).alias("__scores")), [F.col("row"), F.col("reviews")])
        source = read.select("row", "reviews", F.col("__score_text").alias("score_text"), F.col("__score_error").alias("score_error"))
    kind = source.schema["row"].dataType
    out = T.StructType([
        T.StructField("row", kind), T.StructField("review_pos", T.IntegerType()), T.StructField(REVIEW_COL, T.StringType()),
        T.StructField(SCORE_COL, T.StringType()), T.StructField("error", T.StringType()),
    ])
    function = type("WalkReviews", (WalkReviews,), {"fmt": fmt, "small": small})
    walked = F.arrow_udtf(function, returnType=out)(source.asTable())
    return walked.select("row.*", "review_pos", REVIEW_COL, SCORE_COL, "error")


def walked_reviews(walked: DataFrame) -> DataFrame:
    """The reviews, as ``explode_reviews`` gives them."""
    return walked.where(F.col("error").isNull()).drop("error")


def walked_errors(walked: DataFrame, id_col: str = "listing_id") -> DataFrame:
    """The listings that stopped, as ``extraction_errors`` gives them."""
    return walked.where(F.col("error").isNotNull()).select(id_col, "error", F.col("review_pos").alias("reviews_kept"))
