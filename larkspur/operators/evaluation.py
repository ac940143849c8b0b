"""Curves of a score against a label, from counts by score and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import windows


def binary_curve(scored: DataFrame, score: str = "score", label: str = "label", steps: int | None = None) -> DataFrame:
    """One row per threshold: rows at or above it, and the measures of calling those positive.

    Counts are taken per score first, so the curve is as long as there are
    distinct scores; ``steps`` rounds scores to that many a unit, which bounds
    it.  Running totals go by ranges of the score, no task holds the curve.
    Returns threshold, positives and negatives of that score, true and false
    (counts at or above it), recall, fall_out, precision and f1.  Rows with a
    null score or label do not count; a label above one half is positive.
    """
    value = F.col(score).cast("double")
    value = F.floor(value * steps) / steps if steps else value
    kept = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = kept.groupBy(value.alias("threshold")).agg(F.count_if(F.col(label) > 0.5).alias("positives"), F.count_if(F.col(label) <= 0.5).alias("negatives"))
    counts = counts.withColumn("_down", -F.col("threshold"))
    both = windows.running_total(counts, [], "_down", "positives", "true")
    both = windows.running_total(both, [], "_down", "negatives", "false").drop("_down")
    totals = counts.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).select(F.struct("p", "n")).scalar()
    recall = F.try_divide(F.col("true"), totals["p"])
    precision = F.col("true") / (F.col("true") + F.col("false"))
    return both.withColumns({
        "recall": recall, "fall_out": F.try_divide(F.col("false"), totals["n"]), "precision": precision,
        "f1": F.try_divide(2 * F.col("true"), F.col("true") + F.col("false") + totals["p"])})


def areas(curve: DataFrame) -> DataFrame:
    """Areas under the recall-fall-out curve and the precision-recall curve, by trapezia.

    A row knows the totals before it, so no neighbour has to be looked up; the
    precision before the first row is that of the first row.
    """
    before_true, before_false = F.col("true") - F.col("positives"), F.col("false") - F.col("negatives")
    earlier = F.coalesce(F.try_divide(before_true, before_true + before_false), F.col("precision"))
    return curve.agg(
        F.try_divide(F.sum(F.col("negatives") * (before_true + F.col("positives") / 2)), F.sum("positives") * F.sum("negatives")).alias("roc"),
        F.try_divide(F.sum(F.col("positives") * (F.col("precision") + earlier) / 2), F.sum("positives")).alias("pr"))


def best_threshold(curve: DataFrame, beta: float = 1.0) -> DataFrame:
    """The threshold with the greatest F-measure, the highest of equals."""
    weight = beta * beta
    measure = F.try_divide((1 + weight) * F.col("precision") * F.col("recall"), weight * F.col("precision") + F.col("recall"))
    return curve.agg(F.max(F.struct(F.round(measure, 12).alias("f"), F.col("threshold"))).alias("best")).select("best.threshold", "best.f")


def class_measures(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: rows, recall, precision and f1, from one table of counts."""
    cells = predicted.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    ends = cells.select(F.explode(F.array(
        F.struct(F.col("l").alias("class"), F.col("n").alias("rows"), F.lit(0).cast("long").alias("called"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("right")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("rows"), F.col("n").alias("called"), F.lit(0).cast("long").alias("right")))).alias("x")).select("x.*")
    totals = ends.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("rows", "called", "right")])
    return totals.select("class", "rows", F.try_divide("right", "rows").alias("recall"), F.try_divide("right", "called").alias("precision"),
                         F.try_divide(2 * F.col("right"), F.col("rows") + F.col("called")).alias("f1"))
