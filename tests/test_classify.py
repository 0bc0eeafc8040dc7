"""MLlib classifiers and their metrics table."""

from pyspark.sql import functions as F

from revlens.operators.classify import compare_methods, metrics_from_predictions, train_classifier
from revlens.operators.listings import count_rows

_GOOD = ["great stay lovely host", "lovely clean great view", "great great host", "clean lovely quiet"]
_BAD = ["dirty noisy awful", "awful host dirty room", "noisy dirty bad", "bad awful smell"]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "Review string, quality int")


def _train_test(spark):
    train = _frame(spark, [(t, 1) for t in _GOOD] * 3 + [(t, 0) for t in _BAD] * 3)
    test = _frame(spark, [("lovely great host", 1), ("dirty awful noisy", 0), ("clean quiet view", 1), (None, 1)])
    return train, test


def test_classifiers_score_after_an_observation(spark):
    # once the session has observed metrics (A6), a model that still held
    # its training summary could not be shipped to tasks
    observed, obs = count_rows(spark.range(10), "warm")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10

    # (LinearSVC is covered by the registered query; on a separable toy
    # set its line search runs hundreds of tiny jobs)
    train, test = _train_test(spark)
    out = {r.method: r for r in compare_methods(train, test, "Review", "quality", ("logistic", "random_forest")).collect()}
    assert set(out) == {"random_forest", "logistic"}
    for r in out.values():
        assert r.n_test == 3  # the NULL review is not scored
        assert r.n_predicted == 2 and r.seconds > 0
    assert out["logistic"].accuracy == 1.0


def test_a_rare_class_is_predicted(spark):
    import random

    rng = random.Random(1)
    filler = [f"w{i}" for i in range(300)]
    rows = [(" ".join(rng.choices(filler, k=12) + (["awful", "dirty"] if i % 8 == 0 else [])), int(i % 8 != 0)) for i in range(480)]
    out = compare_methods(_frame(spark, rows[:400]), _frame(spark, rows[400:]), "Review", "quality", ("logistic", "random_forest"), num_features=4096).collect()
    for r in out:
        constant = r.majority * 2 * r.majority / (1 + r.majority)  # weighted F1 of always saying the larger class
        assert r.n_predicted == 2 and r.f1 > constant, r


def test_more_classes_than_told_are_refused(spark):
    import pytest

    from revlens.operators.classify import with_class_weights

    with pytest.raises(ValueError, match="more than 2"):
        with_class_weights(_frame(spark, [("a", 0), ("b", 1), ("c", 2)]), "quality", 2)


def test_trained_pipeline_transforms_after_an_observation(spark):
    observed, _ = count_rows(spark.range(3), "warm2")
    observed.write.format("noop").mode("overwrite").save()
    train, test = _train_test(spark)
    # logistic regression keeps its summary through copy(): the model is
    # read back from the stage folder instead
    model = train_classifier(train, "logistic", "Review", "quality")
    preds = model.transform(test.where(F.col("Review").isNotNull())).select("quality", "prediction").collect()
    assert [r.prediction for r in preds] == [float(r.quality) for r in preds]


def test_metrics_match_brute_force(spark):
    pairs = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 1.0), (0.0, 1.0), (1.0, 1.0)]
    pred = spark.createDataFrame(pairs, "quality double, prediction double")
    row = metrics_from_predictions(pred, "m", "quality", label_to_score=lambda v: v * 9 + 1).first()

    n = len(pairs)
    acc = sum(y == p for y, p in pairs) / n
    f1 = 0.0
    for c in (0.0, 1.0):
        tp = sum(y == c and p == c for y, p in pairs)
        prec = tp / sum(p == c for _, p in pairs)
        rec = tp / sum(y == c for y, _ in pairs)
        f1 += sum(y == c for y, _ in pairs) / n * 2 * prec * rec / (prec + rec)
    mae = sum(abs((p * 9 + 1) - (y * 9 + 1)) for y, p in pairs) / n
    assert row.n_test == n
    assert abs(row.accuracy - acc) < 1e-12
    assert abs(row.f1 - f1) < 1e-12
    assert abs(row.mae - mae) < 1e-12


def test_splits_see_the_librarys_number_of_bins(spark):
    from pyspark.ml.classification import RandomForestClassifier

    from revlens.operators import classify

    assert classify._classifier("random_forest", "y", 2, 1).getMaxBins() == RandomForestClassifier().getMaxBins()


def _vectors(rows):
    import pyarrow as pa

    from revlens.operators.forest import Rows

    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    return Rows.of(pa.array([{"type": 0, "size": 8, "indices": list(r), "values": list(r.values())} for r in rows], kind))


def test_forest_takes_the_best_split_of_all_values(spark):
    import numpy as np
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    from revlens.operators import forest

    rng = np.random.default_rng(3)
    rows = [{f: float(rng.integers(1, 4)) for f in range(8) if rng.random() < 0.4} for _ in range(120)]
    y = [float(r.get(2, 0.0) > 1 or (r.get(5, 0.0) == 3 and rng.random() < 0.5)) for r in rows]
    train = spark.createDataFrame([(a, 1.0 + a, Vectors.sparse(8, r)) for a, r in zip(y, rows)], ["label", "w", "features"])
    options = RandomForestClassifier(numTrees=3, maxDepth=2, weightCol="w", featureSubsetStrategy="1.0", seed=5)
    model = forest.fit(train, options)

    # by brute force over the written numbers, a root's split has the largest gain
    numbers = [r["number"] for r in train.select(F.monotonically_increasing_id().alias("number")).collect()]
    draws = forest._draws(np.array(numbers), 3, 5)
    x = np.array([[r.get(f, 0.0) for f in range(8)] for r in rows])
    label, weight = np.array(y), 1.0 + np.array(y)

    def gini(w, a):
        p = np.array([w[a == c].sum() for c in (0, 1)]) / max(w.sum(), 1e-300)
        return w.sum() * (1 - (p**2).sum())

    for tree in range(3):
        w = weight * draws[:, tree]
        f, t = int(model.forest.feature[tree, 1]), model.forest.threshold[tree, 1]

        def worth(f, t):
            left = x[:, f] <= t
            return gini(w, label) - gini(w[left], label[left]) - gini(w[~left], label[~left])

        assert f >= 0 and abs(worth(f, t) - max(worth(g, c) for g in range(8) for c in (0.5, 1.5, 2.5))) < 1e-6
    pred = model.transform(train.select("label", "features")).collect()
    assert sum(r.label == r.prediction for r in pred) > 100


def test_forest_of_very_many_features(spark):
    # at 2^20 features a row of MLlib's forest is 4 MB: here it is the row's words
    assert len(_vectors([{1: 2.0, 7: 0.0}, {}]).feature) == 1
    train, test = _train_test(spark)
    out = compare_methods(train, test, "Review", "quality", ("random_forest",), num_features=1 << 20).first()
    assert out.n_test == 3 and out.accuracy is not None


def test_forest_of_dense_vectors_and_of_one_class(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    from revlens.operators import forest

    options = RandomForestClassifier(numTrees=5, maxDepth=2, weightCol="w", featureSubsetStrategy="1.0", seed=1)
    rows = [(float(i >= 30), 1.0, Vectors.dense([float(i) - 50, 1.0])) for i in range(60)]  # 60 values: more than bins
    model = forest.fit(spark.createDataFrame(rows, ["label", "w", "features"]), options)
    found = model.transform(spark.createDataFrame(rows, ["label", "w", "features"])).collect()
    assert sum(r.label == r.prediction for r in found) >= 58
    one = forest.fit(spark.createDataFrame([(1.0, 1.0, Vectors.sparse(3, {0: 1.0}))] * 4, ["label", "w", "features"]), options)
    assert (one.forest.feature == -1).all()
