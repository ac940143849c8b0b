"""Joins with a rule of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import aggregates


def cogroup(left: DataFrame, right: DataFrame, key: str, left_item: str, right_item: str,
            left_id: str, right_id: str, size: int = aggregates.LIST_SIZE) -> DataFrame:
    """All rows of a key from both sides together: (key, side, chunk, items), items as text.

    A key on either side is there; one of many rows has several lists a side.
    The sides of a key are rows beside each other, not pairs of lists, so no
    list of one side depends on the size of the other.  A null key is a key.
    """
    sides = [("left", left, left_item, left_id), ("right", right, right_item, right_id)]
    lists = [aggregates.collect_chunks(df, [key], item, row, "items", size).select(key, F.lit(side).alias("side"), "chunk", F.col("items").cast("array<string>").alias("items"))
             for side, df, item, row in sides]
    return lists[0].unionByName(lists[1])


def keys_with_count(df: DataFrame, key: str, least: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(key)


def exclude_history(candidates: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(history.select(*keys).distinct(), list(keys), "left_anti")
