from pyspark.sql import types as T

from revlens.functions.literal import coerce, parse_struct_literal, read_reviews, read_score
from revlens.schemas import ADDRESS_TYPE

# FIXTURES.md §2, "Parse and extract, Python-literal mode"
CASES = [
    ("[{'comments': 'a'}, {'comments': 'b'}]", "{'review_scores_value': 9}", ["a", "b"], "9", None),
    ("[{'comments': 'a'}]", "{'review_scores_value': 9.5}", ["a"], "9.5", None),
    ("[{'x': 1}, {'comments': None}]", "{}", [None], None, None),
    ("[{'comments': 'a'}, 5, {'comments': 'z'}]", "{'review_scores_value': 9}", ["a"], "9", "TypeError"),
    ("{'comments': 'a'}", "{'review_scores_value': 9}", [], "9", "TypeError"),
    ("[{'comments': 'a'}]", "[1]", [], None, "AttributeError"),
    ("[{'comments': 'a'}]", "bad(", ["a"], None, None),
    ("[{'comments': 'a'}]", None, ["a"], None, None),
    ("bad(", "{'review_scores_value': 9}", [], "9", None),
    (None, "{'review_scores_value': 9}", [], "9", None),
    ("[]", "{'review_scores_value': 9}", [], "9", None),
    ("[{'comments': \"it's\", 'k': True}]", "{'review_scores_value': 10}", ["it's"], "10", None),
]


def tags(text):
    return [(e["tag"], e["comments"]) for e in read_reviews(text)["elements"]]


def test_scores_are_read_as_their_own_text():
    assert read_score("{'review_scores_value': 9.5}") == {"score_text": "9.5", "score_error": None}
    for missing in (None, "bad(", "{}", "{'review_scores_value': None}"):
        assert read_score(missing) == {"score_text": None, "score_error": None}
    assert read_score("[1]")["score_error"].startswith("AttributeError")
    assert read_score("{[1]: 2}")["score_error"].startswith("TypeError")


def test_every_element_is_tagged():
    assert tags("[{'comments': 'a'}, {'x': 1}, 5, {'comments': None}]") == [("item", "a"), ("none", None), ("error", None), ("item", None)]
    # a string can be asked for the key but not give it
    assert tags("['my comments', 'other']") == [("error", None), ("none", None)]
    assert tags("{'comments': 'a'}") == [("error", None)]
    assert tags("[{'comments': 5}, {'comments': [1, 2]}]") == [("item", "5"), ("item", "[1, 2]")]
    # a lone surrogate is made valid for Arrow
    assert tags("[{'comments': '\\ud800x'}]") == [("item", "\ufffdx")]


def test_lists_that_can_not_be_walked():
    for missing in (None, "bad(", "[]"):
        assert read_reviews(missing) == {"elements": [], "list_error": None}
    assert read_reviews("5")["list_error"].startswith("TypeError")
    assert read_reviews("{[1]: 2}")["list_error"].startswith("TypeError")


def test_strict_struct_literal():
    ok = parse_struct_literal("{'country': 'Canada', 'city': 'x'}", ADDRESS_TYPE, strict=True)
    assert ok == {"value": {"country": "Canada"}, "error": None}
    missing_key = parse_struct_literal("{}", ADDRESS_TYPE, strict=True)
    assert missing_key == {"value": {"country": None}, "error": None}
    for bad in (None, "bad(", "[1]", "5"):
        got = parse_struct_literal(bad, ADDRESS_TYPE, strict=True)
        assert got["value"] is None and got["error"], bad
        assert parse_struct_literal(bad, ADDRESS_TYPE, strict=False)["error"] is None


def test_coerce_is_type_exact():
    schema = T.StructType(
        [
            T.StructField("s", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("d", T.DoubleType()),
            T.StructField("b", T.BooleanType()),
            T.StructField("a", T.ArrayType(T.LongType())),
        ]
    )
    got = coerce({"s": 5, "n": True, "d": 3, "b": 1, "a": (1, "x", 2**70)}, schema)
    assert got == {"s": None, "n": None, "d": 3.0, "b": None, "a": [1, None, None]}
    assert coerce([1], schema) is None
