"""Histogram sort: exact splitters by counting, then one exchange."""

from __future__ import annotations

from bisect import bisect_right
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larkspur.session import materialise

KEY_BYTES = 24


def _big_endian(column) -> F.Column:
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


def _histogram(probes: np.ndarray):
    """Arrow task: bytes, rows, lowest and highest key of each interval between probes."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), f"S{KEY_BYTES}")
            order = np.argsort(keys, kind="stable")
            keys, sizes = keys[order], batch.column("size").to_numpy()[order]
            cuts = np.concatenate([[0], np.searchsorted(keys, probes, "left"), [len(keys)]])
            total = np.concatenate([[0], np.cumsum(sizes)])
            held = np.flatnonzero(cuts[1:] > cuts[:-1])
            low, high = cuts[held], cuts[held + 1]
            ends = [[bytes(k).ljust(KEY_BYTES, b"\0") for k in keys[at]] for at in (low, high - 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int64()), pa.array(total[high] - total[low], pa.int64()), pa.array(high - low, pa.int64()), *(pa.array(e, pa.binary()) for e in ends)],
                ["bucket", "bytes", "rows", "low", "high"],
            )

    return run


def _bucket(probes: np.ndarray):
    """Arrow task: add the interval each row falls into."""

    def run(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), f"S{KEY_BYTES}")
            found = np.searchsorted(probes, keys, "right") if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, "histogram_range"])

    return run


def _as_keys(values: list[int]) -> np.ndarray:
    return np.array([v.to_bytes(KEY_BYTES, "big") for v in values], f"S{KEY_BYTES}")


def splitters(keyed: DataFrame, targets: int, per_shard: int, tolerance: float, probes_each: int = 8, rounds: int = 100) -> tuple[list[int], list[int]]:
    """Keys that cut the total size into ``targets`` equal parts, and the rows below each.

    Every round counts exactly, in one pass and with a sum per task before
    the shuffle, what lies between the probes.  A splitter is settled when the
    size below it is within ``tolerance`` of a shard of its target, or when
    the interval around its target holds a single row.  Every ``per_shard``-th
    splitter is a shard border; those between may be off by a quarter of a range.
    """
    cut = [0, 1 << (8 * KEY_BYTES)]
    probes: list[int] = [(1 << (8 * KEY_BYTES)) * i // targets for i in range(1, targets)]
    fixed: dict[int, tuple[int, int]] = {}
    for _ in range(rounds):
        probes = sorted(set(probes))
        counted = keyed.select("key", "size").mapInArrow(_histogram(_as_keys(probes)), "bucket long, bytes long, rows long, low binary, high binary")
        counted = counted.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
        found = sorted(counted.collect())
        if not found:
            return [cut[1] - 1] * (targets - 1), [0] * (targets - 1)
        starts, sizes, rows = [], [0], [0]
        for bucket in found:
            starts.append(int.from_bytes(bucket["low"], "big"))
            sizes.append(sizes[-1] + bucket["bytes"])
            rows.append(rows[-1] + bucket["rows"])
        total, more = sizes[-1], []
        slack = tolerance * total * per_shard / targets
        for j in (j for j in range(1, targets) if j not in fixed):
            goal = j * total / targets
            at = min(bisect_right(sizes, goal) - 1, len(found) - 1)
            near = at if goal - sizes[at] <= sizes[at + 1] - goal else at + 1
            low, high = (int.from_bytes(found[at][x], "big") for x in ("low", "high"))
            loose = slack if j % per_shard == 0 else max(slack, total / targets / 4)
            if abs(sizes[near] - goal) <= loose or low == high:
                fixed[j] = (starts[near] if near < len(found) else int.from_bytes(found[-1]["high"], "big") + 1, rows[near])
            else:
                more += [low + 1 + (high - low - 1) * i // probes_each for i in range(probes_each + 1)]
                more += [low, min(high + 1, cut[1] - 1)]
        if not more:
            break
        probes = more
    else:
        raise RuntimeError("splitters did not settle")
    return [fixed[j][0] for j in range(1, targets)], [fixed[j][1] for j in range(1, targets)]


def histogram_shards(rows: DataFrame, order: list[str], size: str, shards: int = 16, tolerance: float = 0.001, range_bytes: int = 128 << 20) -> DataFrame:
    """Sort by ``order`` (two long columns) into ``shards`` consecutive parts of nearly equal total ``size``.

    Adds ``shard`` (from 0) and ``slot`` (place within the shard, gapless from
    0).  Equal leading keys stay together except where a border falls inside
    them.  Each row also gets a number when the rows are first written, so
    rows that agree in everything are still told apart and a key that holds a
    third of all rows can be cut anywhere.  A shard consists of ranges of
    about ``range_bytes`` (eight at least), each sorted by its own task; the
    rows before a range are known from the last count, so no task sees a
    whole shard.  Null order values sort as 0.  Columns named like the added
    ones are replaced.  An empty table gives an empty result.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot", "histogram_key", "histogram_size", "histogram_range")]
    parts = [_big_endian(F.coalesce(F.col(c).cast("long"), F.lit(0))) for c in order]
    keyed = rows.select(*names, F.concat(*parts, _big_endian(F.monotonically_increasing_id())).alias("histogram_key"), F.col(size).cast("long").alias("histogram_size"))
    keyed = materialise(keyed, "keyed")
    slim = keyed.select(F.col("histogram_key").alias("key"), F.col("histogram_size").alias("size"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    per_shard = max(8, ceil(total / shards / range_bytes))
    borders, below = splitters(slim, shards * per_shard, per_shard, tolerance)
    base = [0, *below]
    # A border may repeat when rows are few; the ranges between equal borders are empty.
    ranged = keyed.withColumnRenamed("histogram_key", "key")
    schema = StructType([*ranged.schema.fields, StructField("histogram_range", LongType())])
    ranged = ranged.mapInArrow(_bucket(_as_keys([min(b, (1 << (8 * KEY_BYTES)) - 1) for b in borders])), schema)
    starts = rows.sparkSession.createDataFrame(
        [(r, r // per_shard, base[r] - base[r // per_shard * per_shard]) for r in range(shards * per_shard)], "histogram_range long, shard int, histogram_base long")
    placed = ranged.withColumn("histogram_row", F.row_number().over(Window.partitionBy("histogram_range").orderBy("key")))
    placed = placed.join(F.broadcast(starts), "histogram_range")
    return placed.select(*names, "shard", (F.col("histogram_base") + F.col("histogram_row") - 1).cast("long").alias("slot"))
