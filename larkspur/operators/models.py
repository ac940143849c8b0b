"""Estimators in the shapes the application uses, and their comparison."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    FMClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, OneHotEncoder, StopWordsRemover, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import STOP_WORDS


class VectorColumns(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Each slot of a vector as a number column ``<input>_<slot>``."""

    width = Param(Params._dummy(), "width", "number of slots", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol: str | None = None, width: int | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def names(self) -> list[str]:
        return [f"{self.getInputCol()}_{i}" for i in range(self.getOrDefault(self.width))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        slots = vector_to_array(F.col(self.getInputCol()))
        return dataset.withColumns({name: slots[i] for i, name in enumerate(self.names())})


def trees_then_logistic(trees: int = 10, depth: int = 4, rounds: int = 20, seed: int = 3, weight: str | None = None) -> Pipeline:
    """Boosted trees; the leaf each tree reaches is one-hot coded and joins the features of a logistic model.

    ``weight`` names a column with the number of equal rows that a row stands for.
    """
    weighted = {"weightCol": weight} if weight else {}
    forest = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, leafCol="leaf", seed=seed,
                           predictionCol="tree_prediction", **weighted)
    forest.set(forest.rawPredictionCol, "tree_raw")
    forest.set(forest.probabilityCol, "tree_probability")
    leaves = VectorColumns(inputCol="leaf", width=trees)
    slots = [f"{name}_slots" for name in leaves.names()]
    return Pipeline(stages=[
        forest, leaves,
        OneHotEncoder(inputCols=leaves.names(), outputCols=slots, dropLast=False, handleInvalid="keep"),
        VectorAssembler(inputCols=["features", *slots], outputCol="combined"),
        LogisticRegression(featuresCol="combined", labelCol="label", maxIter=rounds, regParam=0.01, **weighted),
    ])


def leaf_rules(model) -> list[tuple[int, int, str]]:
    """(tree, leaf, conditions) of a fitted tree ensemble, read from its printed form."""
    rules, tree, path, leaf = [], -1, [], 0
    for line in model.toDebugString.splitlines():
        indent = len(line) - len(line.lstrip())
        text = line.strip()
        if text.startswith("Tree "):
            tree, path, leaf = tree + 1, [], 0
        elif text.startswith("If ") or text.startswith("Else "):
            path = [(i, c) for i, c in path if i < indent]
            path.append((indent, re.sub(r"^(If|Else) \((.*)\)$", r"\2", text)))
        elif text.startswith("Predict:"):
            rules.append((tree, leaf, " and ".join(c for i, c in path if i < indent)))
            leaf += 1
    return rules


def text_classifier(features: int = 4096, rounds: int = 10) -> Pipeline:
    """Words, stop words, hashed counts, inverse document frequency, logistic regression."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="words", pattern="[^\\p{L}]+"),
        StopWordsRemover(inputCol="words", outputCol="kept", stopWords=STOP_WORDS),
        HashingTF(inputCol="kept", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features", minDocFreq=2),
        LogisticRegression(maxIter=rounds, regParam=0.01),
    ])


def ctr_models(width: int) -> dict[str, Estimator]:
    """The click models compared on one split; input ``scaled`` of the feature pipeline."""
    common = {"featuresCol": "scaled", "labelCol": "label"}
    return {
        "logistic": LogisticRegression(maxIter=10, regParam=0.01, **common),
        "forest": RandomForestClassifier(numTrees=10, maxDepth=4, seed=2, **common),
        "boosted": GBTClassifier(maxIter=5, maxDepth=3, seed=2, **common),
        "bayes": NaiveBayes(**common),
        "factorisation": FMClassifier(factorSize=4, maxIter=20, stepSize=0.05, seed=2, **common),
        "network": MultilayerPerceptronClassifier(layers=[width, max(2, width // 2), 2], maxIter=20, blockSize=64, seed=2, **common),
    }


def compare(models: dict[str, Estimator], train: DataFrame, test: DataFrame) -> DataFrame:
    """Area under both curves for each model; one number per model and metric comes back."""
    roc = BinaryClassificationEvaluator(metricName="areaUnderROC")
    pr = BinaryClassificationEvaluator(metricName="areaUnderPR")
    rows = []
    for name, estimator in models.items():
        scored = estimator.fit(train).transform(test)
        rows.append((name, float(roc.evaluate(scored)), float(pr.evaluate(scored))))
    return train.sparkSession.createDataFrame(rows, "model string, roc double, pr double")


def _digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log gamma function of positive numbers: steps up to 6, then the asymptotic series."""
    x, out = np.array(x, float), np.zeros(np.shape(x))
    for _ in range(6):
        small = x < 6
        out -= np.where(small, 1 / x, 0)
        x += small
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def topic_bound(model, counted: DataFrame, column: str, alpha: float, eta: float) -> tuple[float, float]:
    """Variational lower bound on the log likelihood of word counts under an online LDA model, and the number of words.

    The bound of ``model.logLikelihood``, which takes the exponential of the
    whole topic matrix anew for every document; here a document reads the rows
    of its own words.  Its mixture comes from ``transform``, whose start is
    another random one, so the two agree to the fit's tolerance.
    """
    topics = model.topicsMatrix().toArray()  # words x topics; the vocabulary is bounded
    k = topics.shape[1]
    log_words = _digamma(topics) - _digamma(topics.sum(axis=0))
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    fixed = ((eta - topics) * log_words).sum() + (lgamma(topics) - math.lgamma(eta)).sum() + (math.lgamma(eta * len(topics)) - lgamma(topics.sum(axis=0))).sum()
    known = counted.sparkSession.sparkContext.broadcast(log_words)

    def one(counts, mixture):
        if not counts.numNonzeros():
            return 0.0, 0.0
        n = float(counts.values.sum())
        gamma = mixture.toArray() * (alpha * k + n)
        log_mixture = _digamma(gamma) - _digamma(gamma.sum())
        parts = log_mixture + known.value[counts.indices]
        top = parts.max(axis=1, keepdims=True)
        words = float(counts.values @ (top[:, 0] + np.log(np.exp(parts - top).sum(axis=1))))
        rest = float(((alpha - gamma) * log_mixture).sum()) + sum(math.lgamma(g) - math.lgamma(alpha) for g in gamma)
        return words + rest + math.lgamma(alpha * k) - math.lgamma(float(gamma.sum())), n

    bounds = model.transform(counted).select(F.udf(one, "bound double, n double")(column, model.getTopicDistributionCol()).alias("x"))
    total = bounds.agg(F.coalesce(F.sum("x.bound"), F.lit(0.0)).alias("bound"), F.coalesce(F.sum("x.n"), F.lit(0.0)).alias("n")).first()
    return float(fixed) + total["bound"], total["n"]


def reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
