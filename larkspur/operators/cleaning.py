"""Missing values, casts and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(column: str, numeric: bool):
    is_null = F.col(column).isNull()
    return (is_null | F.isnan(column)) if numeric else is_null


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Null and NaN become the mean of the defined values."""
    defined = F.when(~F.isnan(column), F.col(column))
    mean = df.select(F.avg(defined)).scalar()
    return df.withColumn(column, F.coalesce(defined, mean))


def retype(df: DataFrame, target: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One projection from a list of (source, type, new name)."""
    return df.select(*[F.col(source).cast(kind).alias(name) for source, kind, name in target])


def impute(df: DataFrame, columns: Sequence[str], strategy: str) -> DataFrame:
    filled = [f"{c}_filled" for c in columns]
    return Imputer(inputCols=list(columns), outputCols=filled, strategy=strategy).fit(df).transform(df)


def impute_by_model(df: DataFrame, target: str, features: Sequence[str], seed: int = 7) -> DataFrame:
    """Rows without ``target`` get the class a forest predicts from ``features``."""
    known, unknown = df.filter(F.col(target).isNotNull()), df.filter(F.col(target).isNull())
    pipeline = Pipeline(stages=[
        StringIndexer(inputCol=target, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=list(features), outputCol="_features"),
        RandomForestClassifier(labelCol="_label", featuresCol="_features", numTrees=5, maxDepth=5, seed=seed),
    ])
    model = pipeline.fit(known)
    names = F.array(*[F.lit(int(v)) for v in model.stages[0].labels])
    guessed = (
        model.transform(unknown)
        .withColumn(target, F.element_at(names, F.col("prediction").cast("int") + 1))
        .select(*df.columns)
    )
    return known.unionByName(guessed)


def missing_as_category(df: DataFrame, column: str) -> DataFrame:
    """Missing is its own class: fill -1, index by frequency, one-hot."""
    text = df.na.fill({column: -1}).withColumn("category", F.col(column).cast("string"))
    stages = [
        StringIndexer(inputCol="category", outputCol="idx", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCol="idx", outputCol="vec", dropLast=False),
    ]
    return Pipeline(stages=stages).fit(text).transform(text)


def clip_outliers(df: DataFrame, column: str, widths: float = 2.0, floor_sd: bool = False) -> DataFrame:
    """Values outside mean +- ``widths`` sd become the mean."""
    mean = df.select(F.avg(column)).scalar()
    sd = df.select(F.floor(F.stddev_samp(column)) if floor_sd else F.stddev_samp(column)).scalar()
    inside = F.col(column).between(mean - widths * sd, mean + widths * sd)
    return df.withColumn(column, F.when(inside, F.col(column)).otherwise(mean))


def missing_table(df: DataFrame) -> DataFrame:
    """Missing count and share per column, from one aggregate."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    sums = df.agg(F.count("*").alias("rows"), *[
        F.sum(missing(c, c in numeric).cast("long")).alias(c) for c in df.columns])
    return (
        sums.unpivot("rows", list(df.columns), "column_name", "n_missing")
        .select("column_name", "n_missing", (F.col("n_missing") / F.col("rows")).alias("share"))
    )
