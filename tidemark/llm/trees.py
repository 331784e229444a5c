"""Reading fitted Spark ML trees: conjunctive rules and flat arrays for scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A condition (feature index, threshold, at most?): x <= threshold, or x > threshold.
Condition = tuple[int, float, bool]


def balanced_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, label, weight)`` as ``labelled_sample``, but of either label (0 or 1)
    half of ``rows`` if there are so many; places that one leaves go to the other.
    ``weight``: the labelled documents that a chosen one stands for."""
    by_id = _labels_by_id(labels, label)
    n = {r["label"]: r["count"] for r in by_id.groupBy("label").count().collect()}
    least = min(n.values(), default=0) if len(n) > 1 else 0
    few = min(least, rows // 2)
    share = {x: min(1.0, (few if k == least else rows - few) / k) for x, k in n.items()}
    rate = F.lit(1.0)
    for x, s in share.items():
        rate = F.when(F.col("label") == x, F.lit(s)).otherwise(rate)
    chosen = by_id.where(_place() < rate).withColumn("weight", 1.0 / rate)
    return _texts(docs, id_col, text_col).join(F.broadcast(chosen), "id")


def _labels_by_id(labels: DataFrame, label: str) -> DataFrame:
    by_id = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    return by_id.withColumnRenamed("doc_id", "id")


def _place() -> Column:
    return F.xxhash64("id", F.lit(11)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, label)`` of about ``rows`` labelled documents, chosen by hashed id.

    Only the chosen labels are broadcast: ``rows`` of them, about. Repeated labels of an
    id count once (the larger); null labels and null ids teach nothing.
    """
    by_id = _labels_by_id(labels, label)
    chosen = by_id.where(_place() < F.lit(min(1.0, rows / max(by_id.count(), 1))))
    return _texts(docs, id_col, text_col).join(F.broadcast(chosen), "id")


def _is_leaf(node) -> bool:
    return node.getClass().getSimpleName() == "LeafNode"


def rules_of(tree_model) -> list[tuple[Condition, ...]]:
    """One rule for every node below the root: the conditions on the way to it, the
    tightest of each feature and direction, in order of feature."""
    out: list[tuple[Condition, ...]] = []

    def visit(node, held: dict[tuple[int, bool], float]) -> None:
        if held:
            out.append(tuple((f, t, low) for (f, low), t in sorted(held.items())))
        if _is_leaf(node):
            return
        f, t = node.split().featureIndex(), node.split().threshold()
        visit(node.leftChild(), held | {(f, True): min(t, held.get((f, True), t))})
        visit(node.rightChild(), held | {(f, False): max(t, held.get((f, False), t))})

    visit(tree_model._java_obj.rootNode(), {})
    return out


def rule_column(rule: tuple[Condition, ...], features: list[Column]) -> Column:
    """1.0 where every condition of the rule holds, else 0.0."""
    holds = F.lit(True)
    for f, t, low in rule:
        holds = holds & ((features[f] <= F.lit(t)) if low else (features[f] > F.lit(t)))
    return F.when(holds, F.lit(1.0)).otherwise(F.lit(0.0))


class Ensemble:
    """A boosted ensemble as flat arrays, scored by numpy over many rows at once."""

    def __init__(self, model):
        self.weights = np.array(model.treeWeights)
        self.feature, self.threshold, self.left, self.right, self.value, self.roots = [], [], [], [], [], []
        for tree in model.trees:
            self.roots.append(self._add(tree._java_obj.rootNode()))
        for name in ("feature", "threshold", "left", "right", "value"):
            setattr(self, name, np.array(getattr(self, name)))
        self.depth = max((t.depth for t in model.trees), default=0)

    def _add(self, node) -> int:
        at = len(self.feature)
        leaf = _is_leaf(node)
        self.feature.append(0 if leaf else node.split().featureIndex())
        self.threshold.append(float("inf") if leaf else node.split().threshold())
        self.value.append(node.prediction())
        self.left.append(at)
        self.right.append(at)
        if not leaf:
            self.left[at] = self._add(node.leftChild())
            self.right[at] = self._add(node.rightChild())
        return at

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, uncalibrated, for each row of features."""
        rows = np.arange(len(x))
        margin = np.zeros(len(x))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            margin += weight * self.value[at]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))
