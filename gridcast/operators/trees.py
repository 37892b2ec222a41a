"""Tree ensembles as tables of nodes (M1, M2, M5).

:func:`read_trees` reads a saved forest or boosted model as rows
``tree, node, level, feature, threshold, categories, left, right, value`` and
:meth:`TreeTable.predict` walks all trees level by level: a row starts at the root of every
tree, one join per level on ``(tree, node)`` moves it to a child or takes the leaf's value, and one
aggregate per row adds the trees up. Only the nodes of a level take part in its join. A level
of at most ``BROADCAST_NODES`` nodes is broadcast, so that the rows stay where they are; a larger
one is joined by a shuffle on ``(tree, node)``, which spreads like the nodes do.

Null features count as NaN, as the model's own assembler has it: they go right.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.models import ForecastModel
from gridcast.session import checkpoint_dir, materialize

#: Nodes of one level that are broadcast; about 100 bytes each.
BROADCAST_NODES = 200_000
ROW = "_row"


@dataclass
class TreeTable:
    """Nodes of an ensemble; ``levels`` holds the number of nodes of each level."""

    nodes: DataFrame
    levels: list[int]
    trees: int
    features: list[str]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` plus the ensemble's prediction. Equal rows stay apart."""
        rows = materialize(df.withColumn(ROW, F.monotonically_increasing_id()))
        state = rows.select(ROW, _values(self.features).alias("_x"),
                            F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))).alias("tree"))
        state = state.select("*", F.lit(0).alias("node"), F.lit(None).cast("double").alias("_value"))
        for level, count in enumerate(self.levels):
            at = self.nodes.where(F.col("level") == level).drop("level")
            if count <= BROADCAST_NODES:
                at = F.broadcast(at)
            x = F.element_at("_x", F.col("feature") + 1)
            goes_left = F.when(F.col("categories").isNull(), x <= F.col("threshold")).otherwise(F.array_contains("categories", x))
            # a row that has its leaf has no node any more and meets nothing further down
            state = state.join(at, ["tree", "node"], "left").select(
                ROW, "_x", "tree", F.when(F.col("feature").isNotNull(), F.when(goes_left, F.col("left")).otherwise(F.col("right"))).alias("node"),
                F.coalesce("_value", F.when(F.col("feature").isNull(), F.col("value"))).alias("_value"))
        found = state.groupBy(ROW).agg(F.sum("_value").alias(out))
        return rows.join(found, ROW).drop(ROW)


def _values(features: Sequence[str]):
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


def read_trees(spark: SparkSession, path: str) -> TreeTable:
    """The last published model under ``path``, saved by :meth:`ForecastModel.save`.

    ``value`` is a leaf's share of the prediction: its mean over the number of trees for
    a forest, times its tree's weight for boosted trees.
    """
    meta = ForecastModel.meta(path)
    if meta["model_type"] not in ("random_forest", "xgboost", "lightgbm", "boosted"):
        raise ValueError(f"a {meta['model_type']} model has no trees")
    stage = meta["at"] + "/model/stages/1_*"  # behind the assembler
    weights = spark.read.parquet(stage + "/treesMetadata").toDF("tree", "meta", "weight").select("tree", "weight")
    trees = weights.count()
    share = F.lit(1.0 / trees) if meta["model_type"] == "random_forest" else F.col("weight")
    n, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    split = n["split"]
    nodes = spark.read.parquet(stage + "/data").toDF("tree", "nodeData").join(weights, "tree").select(
        "tree", n["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & (split["numCategories"] < 0), F.element_at(split["leftCategoriesOrThreshold"], 1)).alias("threshold"),
        F.when(inner & (split["numCategories"] >= 0), split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.when(~inner, n["prediction"] * share).alias("value"))
    nodes, levels = _with_levels(materialize(nodes))
    return TreeTable(nodes, levels, trees, meta["features"])


def _with_levels(nodes: DataFrame) -> tuple[DataFrame, list[int]]:
    """``nodes`` with their level, one join per level (at most 31) from the roots down."""
    spark = nodes.sparkSession
    at, levels = f"{checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}", []
    level = nodes.where(F.col("node") == 0)
    while True:
        level.write.parquet(f"{at}/level={len(levels)}")
        written = spark.read.schema(nodes.schema).parquet(f"{at}/level={len(levels)}")
        count = written.count()
        if not count:
            break
        levels.append(count)
        below = written.where("feature is not null").select("tree", F.explode(F.array("left", "right")).alias("node"))
        level = nodes.join(below, ["tree", "node"], "left_semi")
    return spark.read.option("basePath", at).parquet(*[f"{at}/level={k}" for k in range(len(levels))]), levels
