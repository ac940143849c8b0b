"""User functions: Arrow batches where Python is needed, SQL text where it is not."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import windows


def title_case() -> Callable[..., Column]:
    """Typed scalar Python function over Arrow batches."""

    def convert(text):
        return None if text is None else " ".join(w[:1].upper() + w[1:].lower() for w in text.split(" "))

    return F.udf(convert, "string", useArrow=True)


def register_sql(spark: SparkSession, name: str, function: Callable, returns: str) -> None:
    spark.udf.register(name, F.udf(function, returns, useArrow=True))


def register_jvm(spark: SparkSession, name: str, class_name: str, returns: str,
                 otherwise: str | None = None) -> bool:
    """Register a JVM class under a name; without the class, define the name by SQL text.

    ``otherwise`` looks like ``(s STRING) RETURNS STRING RETURN upper(s)``.
    Returns whether the class was found.
    """
    from pyspark.errors import PySparkException

    try:
        spark.udf.registerJavaFunction(name, class_name, returns)
        return True
    except PySparkException:
        if otherwise is None:
            raise
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{otherwise}")
        return False


def upper_series() -> Callable[..., Column]:
    """Vectorised scalar function: one pandas Series in, one out."""
    @F.pandas_udf("string")
    def convert(text: pd.Series) -> pd.Series:
        return text.str.upper()

    return convert


def grouped_scores(df: DataFrame, keys: Sequence[str], value: str, row_id: str, size: int = 100_000) -> DataFrame:
    """Standard score per group through a grouped pandas function.

    Group statistics are combined first and joined on; the pandas function then
    runs on slices of about ``size`` rows, so no group has to fit in one task.
    Rows with a null key are a group.
    """
    stats = df.groupBy(*keys).agg(
        F.avg(value).alias("group_mean"), F.stddev_samp(value).alias("group_sd"),
        F.ceil(F.count("*") / F.lit(size)).alias("slices"))
    sliced = (
        windows.rejoin(df.select(*keys, row_id, value), stats, keys)
        .withColumn("slice", F.pmod(F.xxhash64(row_id), F.col("slices")))
    )

    def score(pdf):
        return pdf.assign(z=(pdf[value] - pdf["group_mean"]) / pdf["group_sd"])[[row_id, "z"]]

    return sliced.groupBy(*keys, "slice").applyInPandas(score, f"{row_id} long, z double")


def with_noise(df: DataFrame, column: str, seed: int) -> DataFrame:
    """A non-deterministic function: the optimiser may not repeat or reorder it."""
    @F.pandas_udf("double")
    def jitter(values: pd.Series) -> pd.Series:
        import numpy as np

        return values + pd.Series(np.random.default_rng().random(len(values)))

    return df.withColumn(f"{column}_noisy", jitter.asNondeterministic()(F.col(column)))


def split_items_table(spark: SparkSession, name: str) -> None:
    """Register a table function: one JSON list in, one row per item out."""

    class SplitItems:
        def eval(self, text: str):
            import json

            parsed = json.loads(text)
            for item in parsed if isinstance(parsed, list) else [parsed]:
                yield (int(item),)

    spark.udtf.register(name, F.udtf(SplitItems, returnType="item int"))


def send_batches(df: DataFrame, connect: Callable, key: str) -> DataFrame:
    """Hand each batch to a client made once per partition; returns its receipts.

    ``connect()`` gives an object with ``send(batch_key, rows) -> int``.  The
    batch key depends only on the rows, so a client that ignores a key it has
    seen makes a repeated task harmless.
    """

    def run(batches):
        client = connect()
        for pdf in batches:
            if len(pdf):
                name = f"{pdf[key].min()}-{pdf[key].max()}-{len(pdf)}"
                yield pdf.head(1).assign(batch_key=name, sent=client.send(name, pdf))[["batch_key", "sent"]]

    return df.mapInPandas(run, "batch_key string, sent long")
