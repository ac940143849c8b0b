"""Keyed tables: incremental merge, versioned cells, collapse on overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators import windows
from larkspur.session import work_path


def incremental_merge(old: DataFrame, source: DataFrame, check: str, last_value, keys: Sequence[str],
                      order: Sequence[str]) -> DataFrame:
    """Rows of ``source`` changed after ``last_value`` replace older rows of the same key."""
    changed = source.filter(F.col(check) > last_value)
    both = old.unionByName(changed)
    values = [c for c in both.columns if c not in keys]
    return windows.latest(both, keys, order, values)


def collapse_and_swap(old: DataFrame, new: DataFrame, collapse, name: str) -> DataFrame:
    """Write the collapsed union to a new folder; readers move to it when it is complete."""
    path = work_path(old.sparkSession, name)
    merged = collapse(old.unionByName(new))
    merged.write.parquet(path)
    return old.sparkSession.read.schema(merged.schema).parquet(path)


def cells(df: DataFrame, row_key: Column, family: str, columns: Sequence[str], stamp: str) -> DataFrame:
    """Wide rows as (row_key, family, qualifier, value, ts), one cell per column."""
    packed = F.explode(F.array(*[
        F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in columns]))
    return (
        df.select(row_key.alias("row_key"), F.col(stamp).alias("ts"), packed.alias("cell"))
        .select("row_key", F.lit(family).alias("family"), "cell.qualifier", "cell.value", "ts")
    )


CELL = ["row_key", "family", "qualifier"]


def put(table: str, new_cells: DataFrame) -> None:
    """Append new versions; nothing is rewritten."""
    new_cells.write.mode("append").parquet(table)


def latest_cells(all_cells: DataFrame, before=None) -> DataFrame:
    """Newest version of each cell, optionally only from before a time."""
    rows = all_cells if before is None else all_cells.filter(F.col("ts") < before)
    return windows.latest(rows, CELL, ["ts", "value"], ["value", "ts"])


def versions(all_cells: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` newest versions of each cell, numbered from the newest."""
    return windows.top_k(all_cells, CELL, [F.desc("ts"), F.desc("value")], most, rank="version")


def delete(all_cells: DataFrame, doomed: DataFrame) -> DataFrame:
    return all_cells.join(doomed.select(*CELL).distinct(), CELL, "left_anti")
