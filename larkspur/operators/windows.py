"""Positions, shifts and running totals that never need one task per group.

A plain window puts all rows of a key into one task.  Here ordered keys are cut
into value ranges first; each range is handled on its own and the small table
of range totals carries the offsets.  The number of ranges follows from the
number of rows (``ROWS_A_RANGE``), found in the pass that finds the borders.
Top-k keeps the plain form, because Spark limits each map task to k rows per
group before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import vectors as vx

RANGES, MOST_RANGES = 32, 1024
ROWS_A_RANGE = 1_000_000
BLOCK = 64  # borders looked through at once


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group; ``order`` must end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Newest row per key as an aggregate, so hot keys combine before the shuffle."""
    picked = F.max_by(F.struct(*values), F.struct(*order)).alias("picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "picked.*")


def _bounds(df: DataFrame, columns: Sequence[str], rows_a_range: int) -> Column:
    """Approximate quantiles of numeric columns in their own types, and the number of rows, from a single pass.

    A struct with an array of blocks of borders for each column.  All
    ``MOST_RANGES`` quantiles are drawn; every so many-th is a border, so that
    there is one for each ``rows_a_range`` rows, ``RANGES`` at least.
    """
    probs = vx.literal([i / MOST_RANGES for i in range(1, MOST_RANGES)])
    drawn = df.agg(F.count("*").alias("n"), *[F.percentile_approx(F.col(c), probs, F.lit(2 * MOST_RANGES)).alias(f"q{i}") for i, c in enumerate(columns)])
    wanted = F.least(F.greatest(F.ceil(F.col("n") / rows_a_range), F.lit(RANGES)), F.lit(MOST_RANGES))
    step = F.floor(F.lit(MOST_RANGES) / wanted).cast("int")

    def blocks(name: str) -> Column:
        some = F.array_distinct(F.transform(F.sequence(step, F.lit(MOST_RANGES - 1), step), lambda i: F.col(name)[i - 1]))
        return F.transform(F.sequence(F.lit(0), F.size(some) - 1, F.lit(BLOCK)), lambda i: F.slice(some, i + 1, F.lit(BLOCK)))

    kept = [F.when(F.col(f"q{i}").isNotNull(), blocks(f"q{i}")).alias(f"b{i}") for i in range(len(columns))]
    return drawn.select(F.struct(*kept)).scalar()


def _place(blocks: Column, x: Column) -> tuple[Column, Column]:
    """How many borders lie below ``x``, and whether ``x`` is one: first the block, then the place in it."""
    ahead = F.size(F.filter(blocks, lambda b: b[0] < x))  # blocks that begin below x
    here = F.get(blocks, F.greatest(ahead - 1, F.lit(0)))
    below = F.when(ahead > 0, (ahead - 1) * BLOCK + F.size(F.filter(here, lambda b: b < x))).otherwise(0)
    border = F.array_contains(here, x) | F.array_contains(F.coalesce(F.get(blocks, ahead), here), x)
    return F.coalesce(below, F.lit(0)), F.coalesce(border, F.lit(False))


def with_ranges(df: DataFrame, order: str, tie: str, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """Add ``r1``, ``r2``: ordering by (r1, r2) agrees with (order, tie).

    A value frequent enough to be a boundary gets a range of its own, and that
    range is cut again by the tie column; so one repeated value cannot make one
    large range.
    """
    bounded = df.withColumn("_q", _bounds(df, [order, tie], rows_a_range))
    below, own = _place(F.col("_q")["b0"], F.col(order))  # nulls sort first, in range 0
    tie_range, _ = _place(F.col("_q")["b1"], F.col(tie))
    return (
        bounded.withColumn("r1", 2 * below + own.cast("int"))
        .withColumn("r2", F.when(own, tie_range).otherwise(F.lit(0)))
        .drop("_q")
    )


def rejoin(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which a null equals a null, so rows with null keys keep their statistics."""
    other = stats.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in stats.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return df.join(other, same).drop(*[f"_key_{i}" for i in range(len(keys))])


def position(df: DataFrame, order: str, tie: str, keys: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """1-based position by (order, tie), over all rows or within ``keys``."""
    ranged = with_ranges(df, order, tie)
    slot = [*keys, "r1", "r2"]
    counts = ranged.groupBy(*slot).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("r1", "r2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy(*slot).orderBy(order, tie)))
    return (
        rejoin(local, offsets, slot)
        .withColumn(name, (F.col("_before") + F.col("_rn")).cast("long"))
        .drop("_before", "_rn", "r1", "r2")
    )


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Running sum of ``value`` by ``order``; (keys, order) must be unique."""
    ranged = df.withColumn("_q", _bounds(df, [order], ROWS_A_RANGE))
    ranged = ranged.withColumn("r1", _place(F.col("_q")["b0"], F.col(order))[0]).drop("_q")
    slot = [*keys, "r1"]
    sums = ranged.groupBy(*slot).agg(F.sum(value).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("r1").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = Window.partitionBy(*slot).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rejoin(ranged.withColumn("_run", F.sum(value).over(local)), offsets, slot)
        .withColumn(name, F.col("_before") + F.col("_run")).drop("_before", "_run", "r1")
    )


def cume_dist(df: DataFrame, keys: Sequence[str], value: str, name: str = "cume") -> DataFrame:
    """Share of rows at or below each distinct value of the group."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_c"))
    running = running_total(counted, keys, value, "_c", "_upto")
    totals = counted.groupBy(*keys).agg(F.sum("_c").alias("_all"))
    return (
        rejoin(running, totals, list(keys)) if keys else running.withColumn("_all", counted.select(F.sum("_c")).scalar())
    ).withColumn(name, F.col("_upto") / F.col("_all")).drop("_c", "_upto", "_all")


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_col: str, value: str,
               default) -> DataFrame:
    """Add ``<value>_prev`` and ``<value>_next`` in the order of each key.

    ``slice_col`` cuts the order of a key into pieces (for example the day of a
    time stamp).  Shifts are computed inside a piece; the edges come from the
    first and last value of the neighbouring piece.
    """
    piece = [*keys, slice_col]
    w = Window.partitionBy(*piece).orderBy(*order)
    prev, nxt = f"{value}_prev", f"{value}_next"
    local = (
        df.withColumn("_p", F.lag(F.struct(value)).over(w)).withColumn("_n", F.lead(F.struct(value)).over(w))
    )
    place = F.struct(*order)
    ends = df.groupBy(*piece).agg(
        F.max_by(F.struct(value), place).alias("_last"), F.min_by(F.struct(value), place).alias("_first"))
    across = Window.partitionBy(*keys).orderBy(slice_col)
    edges = ends.select(*piece, F.lag("_last").over(across).alias("_lp"), F.lead("_first").over(across).alias("_fn"))
    before, after = F.coalesce("_p", "_lp"), F.coalesce("_n", "_fn")
    return (
        rejoin(local, edges, piece)
        .withColumn(prev, F.when(before.isNull(), F.lit(default)).otherwise(before[value]))
        .withColumn(nxt, F.when(after.isNull(), F.lit(default)).otherwise(after[value]))
        .drop("_p", "_n", "_lp", "_fn")
    )


def dense_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Numbers 0.. without gaps, in the order of a numeric id."""
    distinct = df.select(column).distinct()
    numbered = position(distinct, column, column, name=name)
    return numbered.withColumn(name, F.col(name) - 1)


def normalise(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """(value - group mean) / group sd, with the statistics as a combined aggregate."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    return rejoin(df, stats, keys).withColumn(name, (F.col(value) - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def head_balance(rated: DataFrame, user: str, item: str, label: str, score: str) -> DataFrame:
    """Per user keep min(positives, negatives) rows of each class.

    Positives come in item order, negatives with the highest ``score`` first.
    """
    sizes = rated.groupBy(user).agg(
        F.sum(F.col(label)).alias("_pos"), F.sum(1 - F.col(label)).alias("_neg"))
    quota = sizes.select(user, F.least("_pos", "_neg").alias("_keep")).filter(F.col("_keep") > 0)
    ordered = rated.withColumn("_o", F.when(F.col(label) == 1, F.lit(0.0)).otherwise(-F.col(score)))
    placed = position(ordered, "_o", item, keys=[user, label], name="place")
    return placed.join(quota, user).filter(F.col("place") <= F.col("_keep")).drop("_o", "_keep")
