"""Quality classifier: tree paths as rules, lasso logistic weights, one Spark expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.statistics import COUNTS, SHARES, held_out, text_statistics, training_ids
from larkspur.session import materialise

FEATURES = (*COUNTS, *SHARES)
#: A condition: feature, "<=" or ">", threshold.
Condition = tuple[str, str, float]


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted conjunctions; ``score()`` is a Spark column over the statistics."""

    bias: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self):
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...]):
    test = F.lit(True)
    for name, sign, value in rule:
        test = test & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
    return test


def _paths(node, features, before: tuple[Condition, ...] = ()):
    """Conjunctions that lead to each node below the root of a fitted tree."""
    if before:
        yield _merge(before)
    if node.getClass().getSimpleName() == "InternalNode":
        name, value = features[node.split().featureIndex()], float(node.split().threshold())
        yield from _paths(node.leftChild(), features, (*before, (name, "<=", value)))
        yield from _paths(node.rightChild(), features, (*before, (name, ">", value)))


def _merge(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """Keep the tightest bound of each feature and side."""
    tight: dict[tuple[str, str], float] = {}
    for name, sign, value in path:
        old = tight.get((name, sign), value)
        tight[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return tuple(sorted((n, s, v) for (n, s), v in tight.items()))


def fit_rules(rows: DataFrame, features: tuple[str, ...] = FEATURES, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Fit on rows with ``features`` and a 0/1 ``label``.

    A forest of shallow trees proposes rules; a logistic fit with an L1
    penalty keeps few of them.  Without rows of both labels the result has no
    rule and scores every text with the smoothed share of label 1.
    """
    found = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n, ones = sum(found.values()), found.get(1.0, 0)
    if not ones or ones == n:
        from math import log

        return RuleEnsemble(log((ones + 1) / (n - ones + 1)), ())
    vectors = rows.select("label", array_to_vector(F.array(*(F.col(f).cast("double") for f in features))).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=max(1, min(20, n // 100)), seed=seed).fit(vectors)
    rules = sorted({p for tree in forest.trees for p in _paths(tree._java_obj.rootNode(), features)})
    if not rules:
        return RuleEnsemble(0.0, ())
    held = rows.select("label", array_to_vector(F.array(*(F.when(holds(r), 1.0).otherwise(0.0) for r in rules))).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(held)
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), tuple((float(w), r) for w, r in zip(weights, rules) if w))


def learn_quality(counted: DataFrame, labels: DataFrame, sample_rows: int = 20_000, label: str = "quality") -> RuleEnsemble:
    """Fit on the statistics of at most ``sample_rows`` labelled rows outside the held-out fold (see ``training_ids``)."""
    picked = F.broadcast(training_ids(labels, label, sample_rows))  # at most sample_rows rows
    return fit_rules(materialise(counted.join(picked, "doc_id").repartition(8), "sample"))


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, threshold: float = 0.5, label: str = "quality") -> DataFrame:
    """Score every document: doc_id, held_out, score (0 to 1), predicted, and the statistics used.

    Learns by ``learn_quality``; text statistics are the only inputs.  A null
    or empty text has zero statistics and is scored like any other.  Repeated
    rows are scored each; other columns of ``docs`` are ignored.
    """
    counted = materialise(text_statistics(docs), "statistics")
    scored = counted.withColumn("score", learn_quality(counted, labels, sample_rows, label).score())
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *FEATURES)


def good_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """The rows and columns of ``docs`` whose score reaches ``threshold``.

    The statistics are computed beside the rows, so texts are not shuffled.
    """
    picked = F.broadcast(training_ids(labels, "quality", sample_rows).select("doc_id").withColumnRenamed("doc_id", "sample_id"))
    model = learn_quality(text_statistics(docs.join(picked, docs.doc_id == F.col("sample_id"), "left_semi")), labels, sample_rows)
    beside = text_statistics(docs, carry=True)
    return beside.where(model.score() >= threshold).select([F.col(f"carried.{c}").alias(c) for c in docs.columns])
