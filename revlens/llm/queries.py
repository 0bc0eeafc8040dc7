"""Queries ``opN_<name>`` of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from revlens.llm import periodic_runs, quality_rules, setsketch_dedup, spelling_groups, toxicity_chain, url_trust
from revlens.llm.best_fit import pack
from revlens.llm.branch_bound_topk import top_k
from revlens.llm.jaccard_join import link
from revlens.llm.kd_shards import shard
from revlens.llm.piece_codec import encode_decode
from revlens.llm.stage import documents, materialize
from revlens.plans.tables import table
from revlens.llm.token_blocks import read_blocks, write_blocks
from revlens.llm.substring_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Chain order: junk form first, then toxic words, then both at once.
TOXIC_CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_junk": "toxic = 1 and quality = 0"}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing every 35-word window that starts elsewhere too."""
    return remove_repeats(documents(spark, sf_dir, "doc_id", "text"))


@_query
def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text and their decoding, as hashes."""
    return encode_decode(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as token blocks in the range coder's format, read back."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    path = write_blocks(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_blocks(spark, path)


@_query
def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts packed into sequences of at most 2,048 tokens."""
    return pack(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), end_id=0)


@_query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text and the verdict of the learned decision list."""
    found = materialize(quality_rules.statistics(documents(spark, sf_dir, "doc_id", "text")), "statistics")
    return quality_rules.judge(found, quality_rules.fit(found, table(spark, sf_dir, "labels")))


@_query
def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities of every text by the classifier chain, and the verdict."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    chain = toxicity_chain.fit(docs, table(spark, sf_dir, "labels"), TOXIC_CATEGORIES)
    found = toxicity_chain.with_probabilities(docs, chain)
    return found.select(
        "row.doc_id", *(F.col(f"found.{c}").alias(f"p_{c}") for c in chain.categories),
        (F.col("found.toxic") >= 0.5).alias("toxic"), (F.col("found.toxic") < 0.5).alias("kept"),
    )


@_query
def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes, by a k-d tree over their metadata."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars")
    return shard(docs, ["lang", "source", "n_chars", "doc_id"], shards=40)


@_query
def op7_branch_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of highest inner product for every 20th vector, against all vectors."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op7_branch_bound_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

URL_RULES = [
    url_trust.Rule(True, "com", "/"), url_trust.Rule(False, "example.com", "/en/"), url_trust.Rule(True, "www.example.com", "/en/"),
    url_trust.Rule(False, "net", "/es/"), url_trust.Rule(False, "net", "/fr/"),
]


@_query
def op8_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules; hosts without a rule by propagated trust and distrust."""
    return url_trust.judge(table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose 5-word shingle sets reach Jaccard 0.8, as components."""
    return link(documents(spark, sf_dir, "doc_id", "text"))


_WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

ORACLES["op5_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, {_WORDS_SQL.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (k))),
every AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op3_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS_SQL.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM w
),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
near AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x)
SELECT sets.doc_id, CAST(len(any_value(s)) AS BIGINT) AS n_shingles, min(reach.y) AS component_id
FROM sets JOIN reach ON sets.doc_id = reach.x GROUP BY sets.doc_id
"""

ORACLES["op12_setsketch_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS_SQL.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))) END AS s
  FROM w
),
one AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS e FROM sets),
near AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.e = b.e AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, n.y FROM reach r JOIN both_ways n ON r.y = n.x),
found AS (SELECT sets.doc_id, CAST(len(any_value(s)) AS BIGINT) AS n_shingles, min(reach.y) AS component_id FROM sets JOIN reach ON sets.doc_id = reach.x GROUP BY sets.doc_id)
SELECT *, doc_id = component_id AS kept FROM found
"""


@_query
def op12_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose 2-word shingle sets reach Jaccard 0.8, as groups of which the smallest id stays."""
    return setsketch_dedup.groups(documents(spark, sf_dir, "doc_id", "text"))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, of which every tenth is made to repeat."""
    return periodic_runs.periodic_runs(documents(spark, sf_dir, "doc_id", "text"), rewrite=periodic_runs.planted)


@_query
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, of which every 97th loses a letter, with the more frequent form of each and the root of its chain."""
    return spelling_groups.variants(documents(spark, sf_dir, "doc_id", "text"), mutate=spelling_groups.misspelt)


ORACLES["op11_spelling_groups"] = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) r(i))
),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS many
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
),
hashed AS (
  SELECT run, many, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc
),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, CAST(sum(many) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(many) >= 3
),
cut AS (SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT x, count(*) AS n_near, list(struct_pack(less := -n, other := y) ORDER BY -n, y)[1] AS b
  FROM near JOIN words ON y = word GROUP BY x
),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * n THEN b.other END AS form, CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n
  FROM words LEFT JOIN best ON word = x
),
chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON f.word = c.word AND c.next IS NULL
"""
