"""Classical text classifiers with Spark MLlib (D1) and the comparison
with generative scoring on the same held-out rows (D2).

Features: Unicode-aware tokens -> hashed term frequencies -> IDF. The
hashing trick keeps the feature space fixed (no vocabulary pass, no
driver-side dictionary), so it scales with the data. Training runs
MLlib's distributed optimisers (tree aggregation of gradients / node
statistics); nothing is collected but model coefficients and metrics.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import forest
from revlens.schemas import REVIEW_COL
from revlens.session import new_stage_path, spread

METHODS = ("svm", "random_forest", "logistic")

# Words (letters and digits of any script) and runs of marks: how a text is
# punctuated tells as much of its quality as its words.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


# Every method weighs rows so that each class counts the same in all:
# with a rare class, a model that always says the common one wins nothing.
WEIGHT_COL = "__weight"


def with_class_weights(df: DataFrame, label_col: str, n_classes: int) -> DataFrame:
    """``WEIGHT_COL``: rows / (classes x rows of the label). One aggregate of
    as many rows as there are classes; more than ``n_classes`` is an error."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).limit(n_classes + 1).collect()
    if len(counts) > n_classes:
        raise ValueError(f"{label_col} has more than {n_classes} classes")
    total = sum(r["n"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in counts:
        weight = F.when(F.col(label_col) == r[label_col], F.lit(total / (len(counts) * r["n"]))).otherwise(weight)
    return df.withColumn(WEIGHT_COL, weight)


def _classifier(method: str, label_col: str, n_classes: int, seed: int):
    if method == "svm":
        svm = LinearSVC(labelCol=label_col, featuresCol="features", maxIter=50, regParam=0.01, weightCol=WEIGHT_COL)
        return svm if n_classes <= 2 else OneVsRest(classifier=svm, labelCol=label_col)
    if method == "random_forest":
        return RandomForestClassifier(
            labelCol=label_col, featuresCol="features", numTrees=20, maxDepth=6, seed=seed,
            # hashed text is sparse: of the default square root of all features
            # a split would see almost none that occurs
            weightCol=WEIGHT_COL, featureSubsetStrategy="0.05",
        )
    if method == "logistic":
        return LogisticRegression(labelCol=label_col, featuresCol="features", maxIter=50, regParam=0.01, weightCol=WEIGHT_COL)
    raise ValueError(f"method must be one of {METHODS}, got {method!r}")


def featurizer(text_col: str, num_features: int = 1 << 16, min_doc_freq: int = 1) -> Pipeline:
    """Tokens -> hashed TF -> IDF, fitted once and shared by all methods."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text_col, outputCol="__tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True),
            HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features),
            IDF(inputCol="__tf", outputCol="features", minDocFreq=min_doc_freq),
        ]
    )


def text_classifier(
    method: str,
    text_col: str,
    label_col: str,
    n_classes: int = 2,
    num_features: int = 1 << 16,
    seed: int = 42,
) -> Pipeline:
    """Tokens -> hashed TF -> IDF -> classifier, as one Pipeline."""
    stages = featurizer(text_col, num_features).getStages()
    return Pipeline(stages=[*stages, _classifier(method, label_col, n_classes, seed)])


def _labelled(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    return df.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).withColumn(
        label_col, F.col(label_col).cast("double")
    )


def train_classifier(train: DataFrame, method: str, text_col: str, label_col: str, **options) -> PipelineModel:
    labelled = with_class_weights(_labelled(train, text_col, label_col), label_col, options.get("n_classes", 2))
    model = text_classifier(method, text_col, label_col, **options).fit(labelled)
    return scoring_copy(model, train.sparkSession)


def metrics_from_predictions(
    pred: DataFrame,
    method: str,
    label_col: str,
    pred_col: str = "prediction",
    label_to_score=None,
) -> DataFrame:
    """One row ``(method, n_test, majority, n_predicted, accuracy, f1, mae)``
    from one aggregate: the share of the larger class, and the number of
    classes that are ever predicted, tell a constant model.

    The predictions are reduced to a confusion table (one row per
    (label, prediction) pair, so at most classes^2 rows reach the
    driver); accuracy, weighted F1 and the deviation in score units
    (``label_to_score``) all follow from it.
    """
    to_score = label_to_score or (lambda v: v)
    cells = pred.groupBy(F.col(label_col).alias("y"), F.col(pred_col).alias("p")).count().collect()
    n = sum(c["count"] for c in cells)
    # a prediction that is no label is as far off as labels can be
    scores = [to_score(c["y"]) for c in cells]
    worst = max(scores, default=0) - min(scores, default=0)
    support: dict = {}
    predicted: dict = {}
    hits: dict = {}
    abs_err = 0.0
    for c in cells:
        y, p, k = c["y"], c["p"], c["count"]
        support[y] = support.get(y, 0) + k
        predicted[p] = predicted.get(p, 0) + k
        if y == p:
            hits[y] = hits.get(y, 0) + k
        abs_err += k * (abs(to_score(p) - to_score(y)) if p is not None else worst)
    f1 = 0.0
    for y, sup in support.items():
        tp = hits.get(y, 0)
        prec = tp / predicted[y] if predicted.get(y) else 0.0
        rec = tp / sup
        f1 += sup / n * (2 * prec * rec / (prec + rec) if prec + rec else 0.0)
    part = lambda x: x / n if n else None
    majority = max(support.values(), default=0)
    row = (method, n, part(majority), sum(p is not None for p in predicted), part(sum(hits.values())), f1 if n else None, part(abs_err))
    return pred.sparkSession.createDataFrame(
        [row], "method string, n_test long, majority double, n_predicted int, accuracy double, f1 double, mae double"
    )


def scoring_copy(model, spark: SparkSession):
    """The fitted model without its training summary, read back from the
    stage folder.

    A summary keeps a reference to the session, and ``transform`` ships
    the model inside the task closure: once the session has run an
    ``observe`` (A6), that reference can not be serialised. ``copy``
    keeps the summary for some models (logistic regression), a loaded
    model never has one. The written model also outlives the driver.
    """
    path = new_stage_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def compare_methods(
    dev: DataFrame,
    test: DataFrame,
    text_col: str,
    label_col: str,
    methods: Sequence[str] = ("svm", "random_forest"),
    label_to_score=None,
    *,
    n_classes: int = 2,
    num_features: int = 1 << 16,
    min_doc_freq: int = 1,
    seed: int = 42,
) -> DataFrame:
    """D1 + D2: train each method on ``dev``, score it on ``test``.

    Text is tokenised and hashed once, for dev and test rows together,
    and the term frequencies are persisted (recomputable from lineage if
    an executor is lost). IDF weights come from dev rows only; every
    method and the held-out scoring reuse the same vectors, so the
    iterative optimisers never re-tokenise the text.
    """
    part = "__part"
    both = (
        _labelled(dev, text_col, label_col).select(text_col, label_col, F.lit(0).alias(part))
        .unionByName(_labelled(test, text_col, label_col).select(text_col, label_col, F.lit(1).alias(part)))
    )
    tokens = RegexTokenizer(inputCol=text_col, outputCol="__tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features)
    # tokenising is the heavy step: spread a few large input splits over
    # every core first (a no-op when the input already has enough)
    hashed = tf.transform(tokens.transform(spread(both))).select(label_col, part, "__tf")
    hashed = hashed.persist(StorageLevel.MEMORY_AND_DISK)
    tables = []
    try:
        idf = IDF(inputCol="__tf", outputCol="features", minDocFreq=min_doc_freq).fit(hashed.where(F.col(part) == 0))
        weighted = idf.transform(hashed).select(label_col, part, "features")
        train_x = with_class_weights(weighted.where(F.col(part) == 0).drop(part), label_col, n_classes)
        test_x = weighted.where(F.col(part) == 1).drop(part)

        def fit_and_score(method: str) -> DataFrame:
            began = time.perf_counter()
            classifier = _classifier(method, label_col, n_classes, seed)
            if method == "random_forest":
                # MLlib's lays out every feature for every row
                model = forest.fit(train_x, classifier)
            else:
                model = scoring_copy(classifier.fit(train_x), train_x.sparkSession)
            # a one-row local table: final before the vectors are released
            found = metrics_from_predictions(model.transform(test_x), method, label_col, label_to_score=label_to_score)
            return found.withColumn("seconds", F.lit(time.perf_counter() - began))

        # The methods are independent jobs over the same cached vectors;
        # submitted from separate threads, Spark runs them side by side,
        # so the many small jobs of one optimiser do not leave slots idle.
        with ThreadPoolExecutor(max_workers=len(methods)) as pool:
            tables = list(pool.map(fit_and_score, methods))
    finally:
        hashed.unpersist()
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def generative_metrics(
    test_preds: DataFrame,
    pred_col: str,
    label_col: str,
    score_to_label,
    label_to_score=None,
    text_col: str = REVIEW_COL,
    method: str = "generative",
    seconds: float | None = None,
) -> DataFrame:
    """The generative predictions on the same rows as the classical ones
    (text and label present), measured by the same function: a predicted
    score maps to a label with ``score_to_label``; an answer that is no
    number counts as wrong in every measure."""
    rows = _labelled(test_preds, text_col, label_col).withColumn("prediction", score_to_label(F.col(pred_col)).cast("double"))
    return metrics_from_predictions(rows, method, label_col, label_to_score=label_to_score).withColumn("seconds", F.lit(seconds).cast("double"))
