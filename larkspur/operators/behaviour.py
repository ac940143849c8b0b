"""Click logs: flatten, merge, weigh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_actions(log: DataFrame) -> DataFrame:
    """One row per user and item of each log row.

    An exposure row lists the items it showed; any other row names one item
    and sets the flag of its action (read counts as a click).  Every row counts
    as exposed.
    """
    shown = F.from_json("article_text", "array<int>")
    single = F.array(F.col("article_text").try_cast("int"))
    action = F.col("action")
    return log.select(
        "event_id", "user_id", "action_time",
        F.explode(F.when(action == "exposure", shown).otherwise(single)).alias("article_id"), "channel_id",
        (action == "share").alias("shared"), action.isin("click", "read").alias("clicked"),
        (action == "collect").alias("collected"), F.lit(True).alias("exposure"), "read_time",
    )


def merge_actions(rows: DataFrame) -> DataFrame:
    """One row per user and item: every flag that was ever set, the last time, the longest read."""
    seconds = F.coalesce(F.max(F.col("read_time").try_cast("long")), F.lit(0))
    return rows.groupBy("user_id", "article_id").agg(
        F.max("action_time").alias("action_time"), F.max("channel_id").alias("channel_id"),
        *[F.max(c).alias(c) for c in ("shared", "clicked", "collected", "exposure")],
        seconds.alias("read_time"),
    )


def days_between(as_of: str, stamp: Column) -> Column:
    """Whole days from a time stamp to ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", stamp, end) / 86400)


def action_weight(as_of: str) -> Column:
    """Share 3, click 5, collect 2, long read 2 or short read 1, fading with age."""
    decay = 1 / (F.log(days_between(as_of, F.col("action_time")) + 1) + 1)
    points = (
        F.col("shared").cast("int") * 3 + F.col("clicked").cast("int") * 5 + F.col("collected").cast("int") * 2
        + F.when(F.col("read_time") > 1000, 2).otherwise(1)
    )
    return decay * points


def label_weights(basic: DataFrame, topics: DataFrame, as_of: str, combine: str = "latest") -> DataFrame:
    """Weight of every (user, channel, topic).

    ``basic`` are merged actions, ``topics`` has article_id, channel_id and a
    topics array.  When several items of a channel share a topic the latest
    action decides (ties by item); ``combine="sum"`` adds them up instead.
    """
    labelled = (
        basic.drop("channel_id").join(topics, "article_id")
        .select("user_id", "article_id", "action_time", "channel_id", F.explode("topics").alias("topic"),
                action_weight(as_of).alias("weight"))
    )
    keys = ["user_id", "channel_id", "topic"]
    if combine == "sum":
        return labelled.groupBy(*keys).agg(F.sum("weight").alias("weight"))
    newest = F.max_by("weight", F.struct("action_time", "article_id")).alias("weight")
    return labelled.groupBy(*keys).agg(newest)


def age(born: Column, as_of: str) -> Column:
    """Full years; the text 'null' or no date counts as 0."""
    today = F.lit(as_of).cast("date")
    day = F.when(born != "null", born).cast("date")
    before_birthday = F.date_format(today, "MMdd") < F.date_format(day, "MMdd")
    return F.coalesce(F.year(today) - F.year(day) - before_birthday.cast("int"), F.lit(0))


def ab_bucket(user: Column, first_list: str, first: str, second: str) -> Column:
    """Strategy by the first hex digit of md5(user)."""
    digit = F.substring(F.md5(user.cast("string")), 1, 1)
    return F.when(F.lit(first_list).contains(digit), F.lit(first)).otherwise(F.lit(second))
