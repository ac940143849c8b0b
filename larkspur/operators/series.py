"""Vector series with undefined slots: statistics, covariance, components, decomposition."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import vectors as vx
from larkspur.session import materialise


def vector_stats(series: DataFrame, key: str = "measurement", values: str = "vals") -> DataFrame:
    """Per key: undefined slots, mean and sd of the rest, 1 % and 0.1 % cuts at both ends."""
    flat = series.select(key, F.explode(values).alias("x"))
    defined = F.when(~F.isnan("x"), F.col("x"))
    cuts = F.percentile_approx(defined, F.array(*[F.lit(p) for p in (0.001, 0.01, 0.99, 0.999)]), F.lit(10000))
    return flat.groupBy(key).agg(
        F.sum(F.isnan("x").cast("long")).alias("n_nan"), F.count(defined).alias("n"), F.avg(defined).alias("mean"),
        F.stddev_pop(defined).alias("sd"), cuts.alias("cuts"),
    ).select(key, "n_nan", "n", "mean", "sd", F.col("cuts")[0].alias("low1000"), F.col("cuts")[1].alias("low100"),
             F.col("cuts")[2].alias("high100"), F.col("cuts")[3].alias("high1000"))


def nan_covariance(series: DataFrame, key: str = "measurement", values: str = "vals") -> DataFrame:
    """Mean and covariance rows of every key, each pair of slots over the rows where both are defined.

    A leading 1 in each vector makes the outer products carry the sums as well.
    Every task adds up its own rows first and hands on one matrix per key.
    Result: key, slot ``i``, ``mean`` (number), ``cov`` (array over j), ``n`` (array).
    """

    def add_up(batches):
        sums: dict = {}
        for pdf in batches:
            for name, part in pdf.groupby(key)[values]:
                x = np.stack(part.to_numpy()).astype("f8")
                x = np.hstack([np.ones((len(x), 1)), x])
                known = ~np.isnan(x)
                filled, known = np.where(known, x, 0.0), known.astype("f8")
                outer, count = filled.T @ filled, known.T @ known
                old = sums.get(name)
                sums[name] = (outer, count) if old is None else (old[0] + outer, old[1] + count)
        for name, (outer, count) in sums.items():
            yield pd.DataFrame({key: name, "i": range(len(outer)), "s": list(outer), "n": list(count)})

    parts = series.select(key, values).mapInPandas(add_up, f"{key} int, i int, s array<double>, n array<double>")
    rows = materialise(parts.groupBy(key, "i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"),
        vector_to_array(Summarizer.sum(array_to_vector("n"))).alias("n")), "outer-products")
    first = rows.filter("i = 0").select(key, F.zip_with("s", "n", lambda a, b: a / b).alias("means"))
    joined = rows.filter("i > 0").join(first, key).withColumn("own", F.element_at("means", F.col("i") + 1))
    product = F.zip_with("s", "n", lambda a, b: a / b)
    centred = F.zip_with(product, "means", lambda p, m: p - F.col("own") * m)
    return joined.select(
        key, (F.col("i") - 1).alias("i"), F.col("own").alias("mean"),
        F.slice(centred, 2, F.size("s") - 1).alias("cov"), F.slice("n", 2, F.size("n") - 1).alias("n"))


def components(covariance: DataFrame, key: str = "measurement") -> DataFrame:
    """Eigenvalues, largest first, with their vectors.

    The matrix of one key has as many rows as a vector has slots (a few hundred
    at most), so it is decomposed where its rows meet.
    """

    def decompose(pdf):
        pdf = pdf.sort_values("i")
        values, vectors = np.linalg.eigh(np.stack(pdf["cov"].to_numpy()))
        order = np.argsort(values)[::-1]
        return pd.DataFrame({key: pdf[key].iloc[0], "rank": np.arange(1, len(order) + 1),
                             "eigval": values[order], "vec": list(vectors[:, order].T)})

    return covariance.select(key, "i", "cov").groupBy(key).applyInPandas(
        decompose, f"{key} int, rank int, eigval double, vec array<double>")


def variance_explained(eigen: DataFrame, key: str = "measurement") -> DataFrame:
    """Cumulative share of the variance by rank; a key has one row per slot."""
    upto = Window.partitionBy(key).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(key)
    return eigen.withColumn("explained", F.sum("eigval").over(upto) / F.sum("eigval").over(every))


def decompose(series: DataFrame, basis: DataFrame, k: int, key: str = "measurement", values: str = "vals") -> DataFrame:
    """Coefficients on ``k`` vectors and the share of variance left after the mean and each vector.

    ``basis`` has one row per key: ``means`` and ``axes`` (k arrays).  Undefined
    slots count nowhere.
    """
    rows = series.join(basis, key).withColumn("rest", vx.subtract(F.col(values), F.col("means")))

    def energy(c: str) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + F.when(F.isnan(x), 0.0).otherwise(x * x))

    rows = rows.withColumn("total_var", energy(values)).withColumn("left_0", energy("rest"))
    rows = rows.withColumn("centred", vx.nan_to_zero(F.col("rest")))
    for i in range(1, k + 1):
        axis = F.col("axes")[i - 1]
        rows = rows.withColumn(f"coeff_{i}", vx.total(F.zip_with("centred", axis, lambda a, b: a * b)))
        rows = rows.withColumn("rest", vx.subtract(F.col("rest"), vx.scale(axis, F.col(f"coeff_{i}"))))
        rows = rows.withColumn(f"res_{i}", energy("rest") / F.col("left_0"))
    kept = [f"{name}_{i}" for i in range(1, k + 1) for name in ("coeff", "res")]
    return rows.withColumn("res_mean", F.col("left_0") / F.col("total_var")).drop(
        "rest", "centred", "left_0", "means", "axes").select(*series.columns, "total_var", "res_mean", *kept)


def trigonometric_basis(width: int, size: int) -> list[list[float]]:
    """Constant, then sine and cosine of rising frequency; orthonormal on ``width`` points."""
    axes = [[1 / math.sqrt(width)] * width]
    for n in range(1, (size + 1) // 2 + 1):
        for wave in (math.sin, math.cos):
            axes.append([math.sqrt(2 / width) * wave(2 * math.pi * n * j / width) for j in range(width)])
    return axes[:size]


def project(series: DataFrame, axes: Sequence[Sequence[float]], values: str) -> DataFrame:
    """Coefficients on a given orthonormal basis and the error left after each vector."""
    table = F.array(*[vx.literal(a) for a in axes])
    numbers = vx.as_doubles(F.col(values))
    rows = series.withColumn("coeffs", F.transform(table, lambda axis: vx.total(F.zip_with(numbers, axis, lambda a, b: a * b))))
    square = vx.total(F.transform(numbers, lambda x: x * x))
    rows = rows.withColumn("energy", square)
    left = F.transform(F.sequence(F.lit(1), F.lit(len(axes))), lambda k: F.col("energy") - F.aggregate(
        F.slice("coeffs", 1, k), F.lit(0.0), lambda acc, c: acc + c * c))
    return rows.withColumn("errors", left)
