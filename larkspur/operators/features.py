"""Feature pipelines and vector columns."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, QuantileDiscretizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import vectors as vx

# Buckets of the click rate, plain columns of a sample.
RATE_BUCKETS = 100
PLAIN = ["user_item_click", "user_item_imp", "is_new_user"]


def with_embedding_vectors(samples: DataFrame) -> DataFrame:
    """Array columns to vectors, with their cosine and their slot-wise product."""
    user, item = F.col("user_embedding"), F.col("item_embedding")
    return samples.withColumns({
        "embedding_inner": vx.cosine(user, item), "embedding_outer": array_to_vector(vx.product(user, item)),
        "user_vector": array_to_vector(user), "item_vector": array_to_vector(item)})


def ctr_pipeline(variant: str = "plain", buckets: int = RATE_BUCKETS) -> Pipeline:
    """Index, one-hot, rate buckets, assemble, scale to [0, 1].

    ``variant``: "plain" takes both embeddings, "inner" their cosine, "outer"
    their slot-wise product.
    """
    extra = {"plain": ["user_vector", "item_vector"], "inner": ["embedding_inner"], "outer": ["embedding_outer"]}[variant]
    return Pipeline(stages=[
        StringIndexer(inputCol="content_type", outputCol="content_index", handleInvalid="keep"),
        OneHotEncoder(inputCols=["content_index"], outputCols=["content_vector"], dropLast=False),
        QuantileDiscretizer(inputCol="item_ctr", outputCol="ctr_bucket", numBuckets=buckets),
        VectorAssembler(inputCols=["content_vector", "ctr_bucket", *PLAIN, *extra], outputCol="assembled"),
        MinMaxScaler(inputCol="assembled", outputCol="scaled"),
    ])


def chosen_by_p(tests: DataFrame, mode: str, value: float) -> DataFrame:
    """Features kept of ``tests`` (feature, p), one row each, by one of the five rules.

    ``top`` keeps ``value`` features, ``percentile`` that share of them,
    ``fpr`` all with p under it, ``fwe`` with p under it divided by their
    number, ``fdr`` steps up: all up to the last whose p is at most its place
    times ``value`` by their number.  Equal p keep the order of the features.
    The table has one row per slot of a vector, so it fits one task.
    """
    placed = tests.withColumns({"place": F.row_number().over(Window.orderBy("p", "feature")), "n": F.count("*").over(Window.partitionBy())})
    if mode == "fdr":
        reached = F.when(F.col("p") <= F.lit(value) / F.col("n") * F.col("place"), F.col("place"))
        return placed.withColumn("last", F.max(reached).over(Window.partitionBy())).where("place <= last").select("feature")
    rule = {"top": F.col("place") <= value, "percentile": F.col("place") <= F.floor(F.col("n") * value),
            "fpr": F.col("p") < value, "fwe": F.col("p") < F.lit(value) / F.col("n")}[mode]
    return placed.where(rule).select("feature")
