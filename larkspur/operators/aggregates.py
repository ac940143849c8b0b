"""Grouping beyond the built-in aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators import windows
from larkspur.session import materialise, spread

LIST_SIZE = 1000


def collect_chunks(df: DataFrame, keys: Sequence[str], item: str, row_id: str, name: str = "items",
                   size: int = LIST_SIZE, counted: int = 1_000_000) -> DataFrame:
    """Values per key as sorted lists of at most ``size``, numbered by ``chunk``.

    List 0 of a key has the values of its first ``size`` rows by ``row_id``
    (a number, no ties), list 1 those of the next, and so on; what a list
    holds does not depend on how many follow it.  Rows with a null key form a
    key of their own.  Keys of more than ``counted`` rows are counted off by
    ranges, the others in one task each; both give the same places.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(row_id))
    large = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > counted).select(*[F.col(k).alias(f"_large_{i}") for i, k in enumerate(keys)])
    if large.isEmpty():
        placed = df.withColumn("_place", place)
    else:
        large = materialise(large, "large-keys")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_large_{i}")) for i, k in enumerate(keys)])
        long = windows.position(df.join(large, same, "left_semi"), row_id, row_id, keys, "_place")
        placed = df.join(large, same, "left_anti").withColumn("_place", place).unionByName(long)
    return placed.withColumn("chunk", F.floor((F.col("_place") - 1) / size).cast("long")).groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(item)).alias(name))


def longest_word(words: DataFrame, column: str) -> DataFrame:
    """Longest word, the last in text order among equals."""
    best = F.max(F.struct(F.length(column).alias("n"), F.col(column).alias("word")))
    return words.agg(best.alias("best")).select(F.col("best.word").alias("word"), F.col("best.n").alias("n"))


def word_counts(texts: Column, df: DataFrame) -> DataFrame:
    return spread(df).select(F.explode(tx.raw_words(texts)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def kmers(df: DataFrame, column: str, k: int) -> DataFrame:
    """Counts of k consecutive words inside a line; letters and digits only."""
    line = F.explode(F.split(column, "\n")).alias("line")
    clean = F.lower(F.regexp_replace("line", "[^0-9a-zA-Z ]", " "))
    words = F.filter(F.split(clean, " "), lambda w: w != "")
    grams = F.transform(
        F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: F.concat_ws(" ", F.slice("words", i, k)))
    return (
        spread(df).select(line).select(words.alias("words")).filter(F.size("words") >= k)
        .select(F.explode(grams).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))
    )


def histogram(df: DataFrame, column: str, low: float, high: float, buckets: int) -> DataFrame:
    """Equal-width counts; the last bucket includes its upper edge."""
    raw = F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(buckets))
    bucket = F.when(F.col(column) == high, F.lit(buckets)).otherwise(raw)
    return (
        df.filter(F.col(column).between(low, high)).groupBy(bucket.cast("int").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every value of several columns in one pass."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("val")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.column_name", "p.val").agg(F.count("*").alias("n"))


def approximate_count(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Count of a Bernoulli sample scaled up, beside the exact count."""
    sampled = df.sample(fraction=fraction, seed=seed).agg((F.count("*") / fraction).alias("approximate"))
    return sampled.withColumn("exact", df.select(F.count("*")).scalar())


def reduce_all(df: DataFrame, column: str) -> DataFrame:
    """Sum, product of signs, smallest and largest in one tree of partial aggregates."""
    return df.agg(
        F.sum(column).alias("total"), F.count(column).alias("n"),
        F.min(column).alias("smallest"), F.max(column).alias("largest"))
