"""Samples and splits; the hash forms give the same rows on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_number(*parts: Column) -> Column:
    """A number in [0, 2^32) from the md5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, key: Column, fraction: float) -> DataFrame:
    return df.filter(hash_number(key) < int(fraction * 2**32))


def exact_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """Exactly ``n`` rows, by smallest hash."""
    return df.withColumn("_h", hash_number(key)).orderBy("_h", key).limit(n).drop("_h")


def poisson_sample(df: DataFrame, key: Column, fraction: float, seed: int = 0, name: str = "draw") -> DataFrame:
    """Rows drawn with replacement, ``fraction`` times on average: each row is repeated by a Poisson number from its hash.

    Independent of partitions and runs; ``name`` numbers a row's draws from 1.
    """
    chance, total, steps = math.exp(-fraction), 0.0, []
    for k in range(200):
        total += chance
        steps.append(min(int(total * 2**32), 2**32))
        if steps[-1] == 2**32 or total >= 1 - 2**-33:
            break
        chance *= fraction / (k + 1)
    place = hash_number(key, F.lit(seed))
    draws = F.size(F.filter(F.array(*[F.lit(s).cast("long") for s in steps]), lambda s: s <= place))
    return df.withColumn("_draws", draws).where("_draws > 0").withColumn(name, F.explode(F.sequence(F.lit(1), F.col("_draws")))).drop("_draws")


def hash_split(df: DataFrame, key: Column, share: float, name: str = "part") -> DataFrame:
    """Disjoint and complete: 'train' below the share, else 'test'."""
    return df.withColumn(name, F.when(hash_number(key) < int(share * 2**32), "train").otherwise("test"))


def negatives(seen: DataFrame, item_ids: DataFrame, tries: int = 3, seed: int = 0) -> DataFrame:
    """Unseen items per user, drawn by hash, at most as many as the user has positives.

    ``seen`` has user_id, item_id; ``item_ids`` has item_id with a number
    ``slot`` from 0 without gaps.  Each positive yields ``tries`` draws of one
    slot each, so the work grows with the number of positives and no user is
    paired with the whole pool.
    """
    pool = item_ids.select(F.count("*")).scalar()
    positives = seen.select("user_id", "item_id").distinct()
    draws = positives.select(
        "user_id", "item_id", F.explode(F.sequence(F.lit(1), F.lit(tries))).alias("try_no")
    ).select(
        "user_id",
        F.pmod(hash_number(F.col("user_id"), F.col("item_id"), F.col("try_no"), F.lit(seed)), pool).alias("slot"),
    ).distinct()
    drawn = draws.join(item_ids, "slot").join(positives, ["user_id", "item_id"], "left_anti")
    quota = positives.groupBy("user_id").agg(F.count("*").alias("quota"))
    return drawn.withColumn("luck", hash_number(F.col("user_id"), F.col("item_id"))).join(quota, "user_id")
