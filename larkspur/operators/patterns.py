"""Rules from frequent sets, and what they say about baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rules(sets: DataFrame, baskets: int, least_confidence: float) -> DataFrame:
    """Rules with one consequent from the lattice of frequent sets of any size.

    ``sets`` has items (an array) and freq, and holds every subset of each of
    its sets, as frequent sets do.  A set of n items gives n rules; their
    antecedents are found again in the lattice by an equi join.  Returns
    antecedent (sorted array), consequent, freq, confidence, lift and support.
    """
    known = sets.select(F.array_sort("items").alias("items"), "freq")
    split = known.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("consequent"))
    split = split.withColumn("antecedent", F.array_sort(F.array_remove("items", F.col("consequent"))))
    before = known.select(F.col("items").alias("antecedent"), F.col("freq").alias("n_antecedent"))
    after = known.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("n_consequent"))
    confidence = F.col("freq") / F.col("n_antecedent")
    return (
        split.join(before, "antecedent").join(after, "consequent").where(confidence >= least_confidence)
        .select("antecedent", "consequent", "freq", confidence.alias("confidence"),
                (confidence / (F.col("n_consequent") / F.lit(baskets))).alias("lift"), (F.col("freq") / F.lit(baskets)).alias("support"))
    )


def predictions(baskets: DataFrame, found: DataFrame) -> DataFrame:
    """Baskets (items) with ``prediction``: consequents of all rules whose antecedents they hold, without what they hold.

    A basket meets a rule only through the rule's rarest antecedent item, then
    the whole antecedent is tested; equal baskets are judged once.
    """
    distinct = baskets.select(F.array_sort(F.array_distinct("items")).alias("items")).distinct()
    counts = distinct.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    held = found.select("antecedent", "consequent", F.explode("antecedent").alias("item")).join(counts, "item", "left")
    keyed = held.groupBy("antecedent", "consequent").agg(F.min_by("item", F.struct(F.coalesce("n", F.lit(0)), F.col("item"))).alias("item"))
    met = distinct.withColumn("item", F.explode("items")).join(keyed, "item")
    met = met.where((F.size(F.array_except("antecedent", "items")) == 0) & ~F.array_contains("items", F.col("consequent")))
    said = met.groupBy("items").agg(F.array_sort(F.collect_set("consequent")).alias("prediction"))
    keys = baskets.withColumn("_key", F.array_sort(F.array_distinct("items")))
    none = F.array().cast(baskets.schema["items"].dataType)
    return keys.join(said.withColumnRenamed("items", "_key"), "_key", "left").withColumn("prediction", F.coalesce("prediction", none)).drop("_key")
