"""Random forests over sparse vectors.

MLlib's forest lays every row out as one bin for each feature: 256 KB a
row at 2^16 features, looked up one by one in every pass. Here a row keeps
the features that occur in it. A pass grows all trees by one level: tasks
sum the class weights of the values that occur, for the features that
each open node may split on, Spark adds the sums up by node, and the rows
of a node that lack a feature follow from the node's total.

Thresholds lie between neighbouring values of a feature, zero included: all
of them up to ``maxBins``, else those that part the rows evenly. A row's
part in a tree is a Poisson draw from its number. The features of a node are
drawn without replacement. Splits are chosen by Gini gain; leaves of one
parent that predict the same are merged; trees vote with the class shares
of their leaves. These are MLlib's rules, with other random draws.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.sources.stage import materialize

# Sums that a task holds before it combines them, and sends them on.
HELD = 1 << 21

# Of a Poisson variable of mean 1: the chances of at most 0, 1, ... draws.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


class Rows(NamedTuple):
    """The occurring values of a batch of vectors, by row and feature."""

    rows: int
    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, vectors: pa.StructArray) -> Rows:
        values, indices = vectors.field("values"), vectors.field("indices")
        n = np.diff(values.offsets.to_numpy()).astype(np.int64)
        row = np.repeat(np.arange(len(vectors)), n)
        feature = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)  # a dense vector's
        sparse = (vectors.field("type").to_numpy(zero_copy_only=False) == 0)[row]
        feature[sparse] = indices.flatten().to_numpy()
        value = values.flatten().to_numpy()
        some = value != 0
        return cls(len(vectors), row[some], feature[some], value[some])


class Cuts(NamedTuple):
    """Thresholds of all features one after another, and where each feature's begin."""

    begin: np.ndarray
    value: np.ndarray

    def bins(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of its feature's thresholds lie below each value."""
        first = self.begin[feature]
        low, high = first.copy(), self.begin[feature + 1]
        while (open_ := low < high).any():
            middle = (low + high) // 2
            below = open_ & (self.value[np.minimum(middle, len(self.value) - 1)] < value)
            low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
        return low - first


class Forest(NamedTuple):
    """Trees as arrays (tree, node): the children of node i are 2i and 2i + 1.
    ``feature`` is -1 in leaves, ``weight`` holds each node's class weights."""

    feature: np.ndarray
    threshold: np.ndarray
    weight: np.ndarray

    def leaves(self, rows: Rows, num_features: int) -> np.ndarray:
        """(row, tree): the node that each row comes to in each tree."""
        trees, size = self.feature.shape
        tree, at = np.arange(trees), np.ones((rows.rows, trees), dtype=np.int64)
        held = rows.row * num_features + rows.feature
        base = np.arange(rows.rows)[:, None] * num_features
        for _ in range(size.bit_length() - 2):
            feature = self.feature[tree, at]
            if not (feature >= 0).any():
                break
            wanted = base + np.maximum(feature, 0)
            value = np.zeros(wanted.shape)
            if len(held):
                place = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                value = np.where(held[place] == wanted, rows.value[place], 0.0)
            at = np.where(feature >= 0, 2 * at + (value > self.threshold[tree, at]), at)
        return at

    def predict(self, rows: Rows, num_features: int) -> np.ndarray:
        share = self.weight / np.maximum(self.weight.sum(axis=2, keepdims=True), 1e-300)
        at = self.leaves(rows, num_features)
        return share[np.arange(self.feature.shape[0]), at].sum(axis=1).argmax(axis=1).astype(float)

    def merged(self) -> Forest:
        """Without splits whose two leaves predict the same class."""
        feature, says = self.feature.copy(), self.weight.argmax(axis=2)
        for node in range(feature.shape[1] // 2 - 1, 0, -1):
            left, right = 2 * node, 2 * node + 1
            same = (feature[:, left] < 0) & (feature[:, right] < 0) & (says[:, left] == says[:, right])
            feature[same, node] = -1
        return self._replace(feature=feature)


def _draws(number: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(row, tree): how often the row is drawn for the tree."""
    with np.errstate(over="ignore"):
        x = number.astype(np.uint64)[:, None] * np.uint64(trees) + np.arange(trees, dtype=np.uint64)
        x = (x + np.uint64(seed & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(float) / (1 << 53), side="right")


def _summed(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(weights), minlength=len(found))


def _cuts(rows: DataFrame, n_rows: int, num_features: int, max_bins: int) -> Cuts:
    """Thresholds from the values of all rows. What reaches the driver has at
    most ``max_bins - 1`` lines a feature, as in MLlib."""

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Rows.of(batch.column("features"))
            yield pa.RecordBatch.from_arrays([pa.array(found.feature, pa.int32()), pa.array(found.value, pa.float64())], names=["feature", "value"])

    seen = rows.select("features").mapInArrow(occurring, "feature int, value double").groupBy("feature", "value").agg(F.count("*").alias("n"))
    zero = seen.groupBy("feature").agg((F.lit(n_rows) - F.sum("n")).alias("n")).filter("n > 0").select("feature", F.lit(0.0).alias("value"), "n")
    by = Window.partitionBy("feature")
    upto = by.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor((F.sum("n").over(upto) - 1) * max_bins / n_rows)
    values = seen.unionByName(zero).select("feature", "value", part.alias("part"), F.count("*").over(by).alias("many"))
    after = by.orderBy("value")
    found = (
        values.select("feature", "value", "part", "many", F.lead("value").over(after).alias("next"), F.lead("part").over(after).alias("next_part"))
        .filter((F.col("many") <= max_bins) | (F.col("part") < F.col("next_part"))).filter("next is not null")
        .select("feature", ((F.col("value") + F.col("next")) / 2).alias("value")).toPandas().sort_values(["feature", "value"])
    )
    begin = np.zeros(num_features + 1, dtype=np.int64)
    begin[1:] = np.cumsum(np.bincount(found["feature"].to_numpy(), minlength=num_features))
    return Cuts(begin, np.append(found["value"].to_numpy(dtype=float), np.inf))


def _grow(rows: DataFrame, forest: Forest, opened: list[tuple[int, int]], cuts: Cuts, num_features: int, subset: int, max_bins: int, seed: int) -> list:
    """The best split of every opened (tree, node): one pass over the rows."""
    trees, size, classes = forest.weight.shape
    slot = np.full((trees, size), -1, dtype=np.int64)
    allowed = np.zeros((len(opened), -(-num_features // 8)), dtype=np.uint8)
    for k, (tree, node) in enumerate(opened):
        slot[tree, node] = k
        mask = np.zeros(num_features, dtype=bool)
        mask[np.random.default_rng([seed, tree, node]).choice(num_features, subset, replace=False)] = True
        allowed[k] = np.packbits(mask, bitorder="little")
    width = (num_features + 1) * max_bins * classes  # the last feature stands for all rows of a node
    shared = rows.sparkSession.sparkContext.broadcast((forest, slot, allowed, cuts))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, slot, allowed, cuts = shared.value
        keys, weights, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, weight = _summed(keys, weights)
            keys.clear(), weights.clear()
            for at in range(0, len(key), 1 << 16):
                k = key[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k // width, pa.int32()), pa.array(k % width, pa.int64()), pa.array(weight[at : at + (1 << 16)], pa.float64())], names=["node", "place", "weight"]
                )

        for batch in batches:
            found = Rows.of(batch.column("features"))
            at = slot[np.arange(trees), forest.leaves(found, num_features)]
            drawn = _draws(batch.column("number").to_numpy(), trees, seed)
            weight = drawn * batch.column("weight").to_numpy()[:, None]
            y, bins = batch.column("label").to_numpy().astype(np.int64), cuts.bins(found.feature, found.value)
            for tree in range(trees):
                mine = (at[:, tree] >= 0) & (drawn[:, tree] > 0)
                node = at[mine, tree]
                e = np.flatnonzero(mine[found.row])
                row, feature = found.row[e], found.feature[e]
                own = at[row, tree]
                may = (allowed[own, feature >> 3] >> (feature & 7).astype(np.uint8)) & 1 == 1
                e, row, feature, own = e[may], row[may], feature[may], own[may]
                keys += [((node * (num_features + 1) + num_features) * max_bins) * classes + y[mine], ((own * (num_features + 1) + feature) * max_bins + bins[e]) * classes + y[row]]
                weights += [weight[mine, tree], weight[row, tree]]
                held += len(node) + len(e)
                if held > HELD:
                    key, total = _summed(keys, weights)
                    keys, weights, held = [key], [total], len(key)
                    if held > HELD // 2:
                        yield from flush()
                        held = 0
        if keys:
            yield from flush()

    def best(group: pa.Table) -> pa.Table:
        _, _, _, cuts = shared.value
        place, weight = group["place"].to_numpy(), group["weight"].to_numpy()
        label, one = place % classes, place // classes
        feature, bin_ = one // max_bins, one % max_bins
        all_rows = feature == num_features
        total = np.bincount(label[all_rows], weights=weight[all_rows], minlength=classes)
        feature, bin_, label, weight = feature[~all_rows], bin_[~all_rows], label[~all_rows], weight[~all_rows]
        split = (-1, 0, total)
        known, at = np.unique(feature, return_inverse=True)
        if len(known):
            by = np.zeros((len(known), max_bins, classes))
            by[at, bin_, label] = weight
            by[np.arange(len(known)), cuts.bins(known, np.zeros(len(known)))] += np.maximum(total - by.sum(axis=1), 0)
            left = np.cumsum(by, axis=1)[:, :-1]
            right = np.maximum(total - left, 0)
            w, wl, wr = total.sum(), left.sum(axis=2), right.sum(axis=2)
            # the node's Gini impurity less its children's, times the weight
            gain = ((left**2).sum(axis=2) / np.maximum(wl, 1e-300) + (right**2).sum(axis=2) / np.maximum(wr, 1e-300) - (total**2).sum() / w) / w
            there = np.arange(max_bins - 1) < (cuts.begin[known + 1] - cuts.begin[known])[:, None]
            gain[~there | (wl <= 1e-9 * w) | (wr <= 1e-9 * w)] = 0
            k, cut = np.unravel_index(gain.argmax(), gain.shape)
            if gain[k, cut] > 1e-12:
                split = (int(known[k]), int(cut), left[k, cut])
        return pa.table({
            "node": pa.array([group["node"][0].as_py()], pa.int32()), "feature": pa.array([split[0]], pa.int32()), "cut": pa.array([split[1]], pa.int32()),
            "total": pa.array([total.tolist()], pa.list_(pa.float64())), "left": pa.array([split[2].tolist()], pa.list_(pa.float64())),
        })

    summed = rows.mapInArrow(sums, "node int, place bigint, weight double").groupBy("node", "place").agg(F.sum("weight").alias("weight"))
    return summed.groupBy("node").applyInArrow(best, "node int, feature int, cut int, total array<double>, left array<double>").collect()


class ForestModel:
    """A fitted forest; ``transform`` adds ``prediction`` in place of the vectors."""

    def __init__(self, forest: Forest, num_features: int, features_col: str) -> None:
        self.forest, self.num_features, self.features_col = forest, num_features, features_col

    def transform(self, df: DataFrame) -> DataFrame:
        others = [f for f in df.schema.fields if f.name != self.features_col]
        forest, num_features, vectors = self.forest, self.num_features, self.features_col

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                said = forest.predict(Rows.of(batch.column(vectors)), num_features)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), pa.array(said, pa.float64())], names=[*(f.name for f in others), "prediction"])

        return df.mapInArrow(run, T.StructType([*others, T.StructField("prediction", T.DoubleType())]))


def fit(train: DataFrame, options: RandomForestClassifier) -> ForestModel:
    """A forest with the trees, depth, bins, share of features and columns of ``options``.

    The vectors are written once, so that a row has one number (and so the
    same draws) in every pass. A node's statistics are bounded by the
    features it may split on and the bins, whatever the rows.
    """
    label, vectors, weight = options.getLabelCol(), options.getFeaturesCol(), options.getWeightCol()
    trees, depth, max_bins, seed = options.getNumTrees(), options.getMaxDepth(), options.getMaxBins(), options.getSeed()
    chosen = train.select(F.col(label).cast("double").alias("label"), F.col(weight).cast("double").alias("weight"), F.col(vectors).alias("features"))
    rows = materialize(chosen.withColumn("number", F.monotonically_increasing_id()), "forest-rows")
    told = rows.agg(F.count("*").alias("n"), F.max("label").alias("top"), F.min("label").alias("least"), F.max((F.col("label") % 1).cast("double")).alias("rest")).first()
    if not told["n"]:
        raise ValueError("no rows to train on")
    if told["least"] < 0 or told["rest"]:
        raise ValueError(f"{label} must hold whole numbers from 0")
    num_features = rows.select("features").first()["features"].size
    subset = min(num_features, math.ceil(float(options.getFeatureSubsetStrategy()) * num_features))
    cuts = _cuts(rows, told["n"], num_features, max_bins)
    shape = (trees, 1 << (depth + 1))
    forest = Forest(np.full(shape, -1, dtype=np.int64), np.zeros(shape), np.zeros((*shape, int(told["top"]) + 1)))
    opened = [(tree, 1) for tree in range(trees)]
    for level in range(depth):
        if not opened:
            break
        deeper = []
        for found in _grow(rows, forest, opened, cuts, num_features, subset, max_bins, seed):
            tree, node = opened[found["node"]]
            total, left = np.array(found["total"]), np.array(found["left"])
            forest.weight[tree, node] = total
            if found["feature"] < 0:
                continue
            forest.feature[tree, node] = found["feature"]
            forest.threshold[tree, node] = cuts.value[cuts.begin[found["feature"]] + found["cut"]]
            for child, held in ((2 * node, left), (2 * node + 1, np.maximum(total - left, 0))):
                forest.weight[tree, child] = held
                if (held > 1e-9 * held.sum()).sum() > 1:
                    deeper.append((tree, child))
        opened = deeper
    return ForestModel(forest.merged(), num_features, vectors)
