"""Exact Shapley values of tree ensembles, and what is read off them.

A prediction of a tree whose splits are known for some features only is the mean over the training rows that fall on either
side of the others. For one leaf this is a product over the features of its path: 1 or 0 where the row meets the feature's
conditions or not, the share of training rows that meet them where the feature is unknown. Shapley weights depend on the number of
known features alone, so the sum over subsets is read from the coefficients of a polynomial with one factor a feature: cubic in the depth, for all rows of a
batch at once, not exponential in it. Trees are a table of nodes, as Spark stores its models; they are broadcast (nodes of the model,
at most rounds * 2^(depth + 1)).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..shipping import ship
from .evaluation import exact_quantile


@dataclass
class Leaf:
    """Its value times the tree's weight; by feature of its path: lower and upper bound, share of training rows."""

    value: float
    path: list[tuple[int, float, float, float]]


def leaves(nodes: dict[int, tuple], weight: float) -> list[Leaf]:
    """nodes: id -> (prediction, rows, left, right, feature, threshold); left is -1 at a leaf."""
    out, todo = [], [(0, {})]
    while todo:
        k, path = todo.pop()
        prediction, rows, left, right, feature, threshold = nodes[k]
        if left < 0:
            out.append(Leaf(weight * prediction, [(f, *x) for f, x in path.items()]))
            continue
        low, high, share = path.get(feature, (-math.inf, math.inf, 1.0))
        for child, bounds in ((left, (low, min(high, threshold))), (right, (max(low, threshold), high))):
            todo.append((child, path | {feature: (*bounds, share * nodes[child][1] / rows)}))
    return out


def stored_trees(model: GBTRegressionModel, folder: str) -> list[Leaf]:
    """The model's leaves, by way of its stored form under a folder that the driver and executors share."""
    spark = SparkSession.active()
    path = f"{folder.rstrip('/')}/trees_{uuid.uuid4().hex}"
    model.write().save(path)
    n = "nodeData"
    rows = spark.read.parquet(f"{path}/data").select("treeID", f"{n}.id", f"{n}.prediction", f"{n}.rawCount", f"{n}.leftChild", f"{n}.rightChild", f"{n}.split.featureIndex", F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).collect()
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        trees.setdefault(r.treeID, {})[r.id] = (r.prediction, r.rawCount, r.leftChild, r.rightChild, r.featureIndex, r.threshold)
    return [leaf for k, w in enumerate(model.treeWeights) for leaf in leaves(trees[k], w)]


def shapley(x: np.ndarray, every: list[Leaf]) -> tuple[np.ndarray, float]:
    """Attributions of rows by features, and the mean that they add up from."""
    out, mean = np.zeros(x.shape), 0.0
    for leaf in every:
        m = len(leaf.path)
        known = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in leaf.path]
        shares = [s for *_, s in leaf.path]
        mean += leaf.value * math.prod(shares)
        for j, (feature, *_) in enumerate(leaf.path):
            # Coefficient k: subsets of k known features among the others.
            poly = np.zeros((m, len(x)))
            poly[0] = 1.0
            for i in range(m):
                if i != j:
                    poly[1:] = poly[1:] * shares[i] + poly[:-1] * known[i]
                    poly[0] *= shares[i]
            weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
            out[:, feature] += leaf.value * (known[j] - shares[j]) * (weights @ poly)
    return out, mean


def attributions(model: GBTRegressionModel, dataset: DataFrame, features: list[str], folder: str) -> DataFrame:
    """The dataset's keys with `base` and `shap`, an array in the order of the features; missing features are 0, as in training.

    base + sum(shap) is the model's prediction.
    """
    ship(dataset.sparkSession)
    every = dataset.sparkSession.sparkContext.broadcast(stored_trees(model, folder))
    keys = [c for c in dataset.columns if c not in features]
    schema = StructType([*(dataset.schema[c] for c in keys), StructField("base", DoubleType()), StructField("shap", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[len(keys) :]], 1)
            shap, base = shapley(np.nan_to_num(x), every.value)
            offsets = np.arange(0, shap.size + 1, shap.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(np.full(len(x), base)), pa.ListArray.from_arrays(offsets, pa.array(shap.ravel()))], names=schema.names)

    return dataset.select(*keys, *(F.col(f).cast("double").alias(f) for f in features)).mapInArrow(run, schema)


def top_by_attribution(attributed: DataFrame, features: list[str], k: int = 64) -> DataFrame:
    """feature, mean_abs: the k features of the largest mean absolute attribution; ties by name."""
    s = attributed.agg(*(F.avg(F.abs(F.get("shap", F.lit(i)))).alias(str(i)) for i in range(len(features))))
    long = s.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"`{i}`").alias("mean_abs")) for i, f in enumerate(features)))).alias("r")).select("r.*")
    return long.orderBy(F.desc("mean_abs"), "feature").limit(k)


def attribution_statistics(attributed: DataFrame, dataset: DataFrame, features: list[str], keys: tuple[str, ...] = ("entity", "date"), shares: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """By feature: mean absolute attribution, exact quantiles, bias-corrected skewness, and the rank correlation of value and attribution.

    Both tables are read several times: give stored ones.
    """
    by = [*keys]
    on = attributed.select(*by, *(F.get("shap", F.lit(i)).alias(f"_s{i}") for i in range(len(features)))).join(dataset.select(*by, *(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, f in enumerate(features))), by)
    long = on.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"_s{i}").alias("shap"), F.col(f"_x{i}").alias("x")) for i, f in enumerate(features)))).alias("r")).select("r.*")
    n, g1 = F.col("n"), F.col("g1")
    flat = F.stddev_pop("shap") > 1e-12
    stats = long.groupBy("feature").agg(F.count("shap").alias("n"), F.avg(F.abs("shap")).alias("mean_abs"), F.when(flat, F.skewness("shap")).alias("g1"))
    stats = stats.select("feature", "n", "mean_abs", F.when(n > 2, g1 * F.sqrt((n * (n - 1)).cast("double")) / (n - 2)).alias("skew"))
    wide = attributed.select(*(F.get("shap", F.lit(i)).alias(f) for i, f in enumerate(features)))
    for q in shares:
        stats = stats.join(exact_quantile(wide, features, q).withColumnRenamed("value", f"q{round(100 * q):02d}"), "feature", "left")
    # Values of trees' attributions repeat: distinct ones are ranked, with their counts.
    pairs = long.groupBy("feature", "x", "shap").agg(F.count(F.lit(1)).alias("k"))
    return stats.join(weighted_rank_correlation(pairs), "feature", "left")


def weighted_rank_correlation(pairs: DataFrame) -> DataFrame:
    """feature, rank_corr: of pairs (feature, x, shap) that occur k times."""

    def mid(c: str) -> DataFrame:
        values = pairs.groupBy("feature", c).agg(F.sum("k").alias("t"))
        upto = F.sum("t").over(Window.partitionBy("feature").orderBy(c))
        return values.select("feature", c, (2 * upto - F.col("t") + 1).cast("double").alias(f"_r{c}"))

    on = pairs.join(mid("x"), ["feature", "x"]).join(mid("shap"), ["feature", "shap"])
    a, b, k = F.col("_rx"), F.col("_rshap"), F.col("k").cast("double")
    s = on.groupBy("feature").agg(F.sum(k).alias("n"), F.sum(k * a).alias("a"), F.sum(k * b).alias("b"), F.sum(k * a * a).alias("aa"), F.sum(k * b * b).alias("bb"), F.sum(k * a * b).alias("ab"))
    c = lambda xy, x, y: F.col(xy) - F.col(x) * F.col(y) / F.col("n")
    va, vb = c("aa", "a", "a"), c("bb", "b", "b")
    return s.select("feature", F.when((va > 0) & (vb > 0), c("ab", "a", "b") / F.sqrt(va * vb)).alias("rank_corr"))
