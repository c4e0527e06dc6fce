"""Binary class tree and the classifier that walks it.

The tree is built on the k classes only (average linkage, cosine distance); k is checked. The
documents are touched only by Spark: one binary model per inner node.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from socialtext.functions.arrays import cosine_distance
from socialtext.operators.classify import NotFittedError
from socialtext.operators.sampling import balanced_downsample

MAX_CLASSES = 1000


@dataclass(frozen=True)
class Node:
    """``left`` and ``right`` are node ids, or None for a class."""

    id: int
    classes: tuple[str, ...]
    left: int | None = None
    right: int | None = None
    distance: float = 0.0


def class_distances(classes: DataFrame, label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """``a, b, distance`` of every two classes."""
    if classes.limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    every = classes.agg(F.sort_array(F.collect_list(F.struct(
        F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector")))).alias("c")).scalar()
    held = classes.select(F.col(label_col).cast("string").alias("a"), F.col(vector_col).alias("v"), every.alias("c"))
    pairs = held.select("a", F.explode(F.transform("c", lambda c: F.struct(
        c["label"].alias("b"), cosine_distance(F.col("v"), c["vector"]).alias("distance")))).alias("_p"))
    return pairs.select("a", "_p.b", "_p.distance").filter("a < b")


def build_tree(classes: DataFrame, label_col: str = "label", vector_col: str = "vector") -> list[Node]:
    """Average-linkage merges of the classes; the last node is the root. Ties merge the first pair in order."""
    rows = class_distances(classes, label_col, vector_col).collect()
    labels = sorted({r["a"] for r in rows} | {r["b"] for r in rows})
    if not labels:
        raise ValueError("need at least two classes")
    nodes = [Node(i, (label,)) for i, label in enumerate(labels)]
    place = {label: i for i, label in enumerate(labels)}
    between = {(place[r["a"]], place[r["b"]]): r["distance"] for r in rows}
    alive = set(range(len(labels)))

    def distance(i: int, j: int) -> float:
        return between[(i, j) if i < j else (j, i)]

    while len(alive) > 1:
        a, b = min(((i, j) for i in alive for j in alive if i < j), key=lambda p: (distance(*p), p))
        merged = Node(len(nodes), nodes[a].classes + nodes[b].classes, a, b, distance(a, b))
        alive -= {a, b}
        size_a, size_b = len(nodes[a].classes), len(nodes[b].classes)
        for c in alive:
            between[(c, merged.id)] = (size_a * distance(a, c) + size_b * distance(b, c)) / (size_a + size_b)
        alive.add(merged.id)
        nodes.append(merged)
    return nodes


def flat_clusters(spark, nodes: list[Node], t: float = 0.75) -> DataFrame:
    """``label, cluster``: the tree cut at distance ``t``; clusters are numbered from 0 by their first label."""
    groups: list[tuple[str, ...]] = []
    todo = [nodes[-1]]
    while todo:
        node = todo.pop()
        if node.left is None or node.distance <= t:
            groups.append(node.classes)
        else:
            todo += [nodes[node.left], nodes[node.right]]
    groups.sort(key=min)
    return spark.createDataFrame([(c, i) for i, g in enumerate(groups) for c in sorted(g)], "label string, cluster int")


class HierarchicalClassifier:
    """``P(class)`` is the product of the branch probabilities on its path from the root."""

    def __init__(self, nodes: list[Node], estimator, *, downsample: bool = False, seed: str = "24",
                 models_dir: str | None = None):
        self.nodes, self.estimator, self.downsample, self.seed = nodes, estimator, downsample, seed
        self.models_dir = models_dir
        self.models: dict[int, PipelineModel] = {}

    @property
    def inner(self) -> list[Node]:
        return [n for n in self.nodes if n.left is not None]

    def fit(self, df: DataFrame, id_col: str, label_col: str = "label") -> "HierarchicalClassifier":
        """Train every inner node on its own classes; label 1 is the left branch."""
        kept = df.withColumnRenamed(label_col, "_class").persist()
        try:
            for node in self.inner:
                left = list(self.nodes[node.left].classes)
                rows = kept.filter(F.col("_class").cast("string").isin(list(node.classes))).withColumn(
                    "label", F.col("_class").cast("string").isin(left).cast("double"))
                if self.downsample:
                    rows = balanced_downsample(rows, "label", [id_col], self.seed)
                model = self.estimator.fit(rows)
                if not isinstance(model, PipelineModel):
                    model = PipelineModel(stages=[model])
                if self.models_dir:
                    model.write().overwrite().save(os.path.join(self.models_dir, f"node_{node.id}"))
                self.models[node.id] = model
        finally:
            kept.unpersist()
        return self

    def load_models(self) -> "HierarchicalClassifier":
        for node in self.inner:
            self.models[node.id] = PipelineModel.load(os.path.join(self.models_dir, f"node_{node.id}"))
        return self

    def branch_probabilities(self, df: DataFrame) -> DataFrame:
        """One column ``_left_<node>`` per inner node, computed row by row without a shuffle."""
        if not self.models:
            raise NotFittedError("fit the model first")
        out, given = df, list(df.columns)
        for node in self.inner:
            done = [c for c in out.columns if c.startswith("_left_")]
            scored = self.models[node.id].transform(out)
            out = scored.select(*given, *done, vector_to_array("probability")[1].alias(f"_left_{node.id}"))
        return out

    def probabilities(self, df: DataFrame, id_col: str) -> DataFrame:
        """Long table ``id, label, p``."""
        paths: dict[int, list] = {self.nodes[-1].id: []}
        for node in reversed(self.inner):
            paths[node.left] = paths[node.id] + [F.col(f"_left_{node.id}")]
            paths[node.right] = paths[node.id] + [1 - F.col(f"_left_{node.id}")]
        entries = []
        for leaf in (n for n in self.nodes if n.left is None):
            p = F.lit(1.0)
            for branch in paths[leaf.id]:
                p = p * branch
            entries.append(F.struct(F.lit(leaf.classes[0]).alias("label"), p.alias("p")))
        scored = self.branch_probabilities(df).select(id_col, F.explode(F.array(*entries)).alias("_e"))
        return scored.select(id_col, "_e.label", "_e.p")

    def predict(self, df: DataFrame, id_col: str) -> DataFrame:
        best = F.max_by("label", F.struct("p", "label"))
        return self.probabilities(df, id_col).groupBy(id_col).agg(best.alias("prediction"))
