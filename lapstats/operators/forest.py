"""A fitted forest as a table of nodes: scores, importances and metrics in plain DataFrame terms.

``forest_nodes`` reads the table that MLlib's writer leaves: one row per node, with its split
(feature at most threshold goes left), its children, its mean and the rows it has seen. Its size
follows from the forest's parameters (trees x 2 ** (depth + 1)), never from the laps. Scoring
sends the table to every task once and walks the trees over batches of laps as arrays -- no
exchange, no row per lap and tree, no copy of the trees in a row, and no
model object, so other engines can score with the same table (the tests do, in SQL).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .model import DegradationModel


def forest_nodes(model: DegradationModel, spark) -> DataFrame:
    """(tree, node, feature, feature_index, threshold, left_child, right_child, prediction, gain,
    weight) of every node; leaves have null feature and threshold and index -1."""
    path = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    model.pipeline.stages[-1].write().save(path)
    n = F.col("nodeData")
    names = F.array(*[F.lit(f) for f in model.features])
    at = n["split"]["featureIndex"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(at >= 0, F.get(names, at)).alias("feature"),
        at.alias("feature_index"), F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
        n["leftChild"].alias("left_child"), n["rightChild"].alias("right_child"), n["prediction"].alias("prediction"),
        n["gain"].alias("gain"), F.get(n["impurityStats"], 0).alias("weight"))


def _walker(nodes: DataFrame, depth: int):
    """A function from arrays of feature values to the forest's predictions: all laps of a batch go
    down a tree together, one level at a time. Nested, so that it travels to the tasks by value."""
    cols = ["tree", "node", "feature_index", "threshold", "left_child", "right_child", "prediction"]
    t = nodes.select(*cols).orderBy("tree", "node").toArrow()
    tree, node, feature, threshold, left, right, value = (t[c].to_numpy() for c in cols)
    roots = np.flatnonzero(np.diff(tree, prepend=-1))           # a tree's nodes are numbered from 0
    feature, threshold = feature.astype(np.int64), np.where(feature >= 0, threshold, 0.0)
    own = np.arange(len(tree))
    base = np.repeat(roots, np.diff(roots, append=len(tree)))
    down = np.stack((np.where(feature >= 0, base + left, own), np.where(feature >= 0, base + right, own)))
    feature = np.maximum(feature, 0)                            # leaves lead to themselves

    def walk(x):
        rows, total = np.arange(x.shape[0]), np.zeros(x.shape[0])
        for root in roots:
            at = np.full(len(rows), root)
            for _ in range(depth):
                at = down[(x[rows, feature[at]] > threshold[at]).astype(np.int8), at]
            total += value[at]
        return total / len(roots)
    return walk


def score_with_nodes(laps: DataFrame, nodes: DataFrame, features: Sequence[str], depth: int = 10,
                     out: str = "prediction") -> DataFrame:
    """``laps`` with the mean over the trees of their leaves' means. Rows with a null feature are
    left out, as the model leaves them out. ``depth`` is the forest's largest depth."""
    walk = _walker(nodes, depth)

    @F.arrow_udf("double")
    def predict(*x: pa.Array) -> pa.Array:
        return pa.array(walk(np.stack([c.to_numpy(zero_copy_only=False) for c in x], axis=1)))
    x = [F.col(f).cast("double") for f in features]
    return laps.dropna(subset=list(features)).withColumn(out, predict(*x)).select(*laps.columns, out)


def importance_from_nodes(nodes: DataFrame) -> DataFrame:
    """(feature, importance): gain times rows of each feature's splits, each tree's sum made 1,
    then the sum over trees made 1."""
    split = nodes.where("feature_index >= 0")
    per = split.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("s"))
    tree = split.groupBy("tree").agg(F.sum(F.col("gain") * F.col("weight")).alias("t"))
    got = per.join(tree, "tree").groupBy("feature").agg(F.sum(F.col("s") / F.col("t")).alias("s"))
    total = got.agg(F.sum("s").alias("t"))
    return got.crossJoin(F.broadcast(total)).select("feature", (F.col("s") / F.col("t")).alias("importance"))
