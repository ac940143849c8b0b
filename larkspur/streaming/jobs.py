"""Stream jobs over the click log.

Sources are folders of files (or Kafka, where its jar is present); every job
has a checkpoint folder.  Jobs that keep a table up to date write the rows of
a micro-batch to a batch of a :class:`BatchTable`, replacing it if the batch
is repeated.  Readers combine the batches by key, so a restart neither loses
nor counts anything twice; every ``merge_after`` batches what they amount to
takes their place, so a table does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import windows
from larkspur.operators.sampling import hash_number
from larkspur.session import work_path
from larkspur.sources.batches import FIRST, BatchTable

LOG_SCHEMA = (
    "actionTime string, readTime string, channelId int, "
    "param struct<action: string, userId: string, articleId: string, algorithmCombine: string>"
)


# sources ------------------------------------------------------------------

def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Text values of a topic; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return raw.load().select(F.col("value").cast("string").alias("value"))


def parse_log(lines: DataFrame) -> DataFrame:
    """JSON click-log lines to typed columns."""
    row = F.from_json("value", LOG_SCHEMA)
    return lines.select(row.alias("r")).select(
        F.col("r.actionTime").try_cast("timestamp_ntz").alias("action_time"), F.col("r.readTime").alias("read_time"),
        F.col("r.channelId").alias("channel_id"), F.col("r.param.action").alias("action"),
        F.col("r.param.userId").try_cast("long").alias("user_id"), F.col("r.param.articleId").alias("article_text"))


def parse_csv(lines: DataFrame, names: list[str]) -> DataFrame:
    """Comma text, fields by position."""
    fields = F.split("value", ",")
    return lines.select(*[F.get(fields, i).alias(name) for i, name in enumerate(names)])


# sinks --------------------------------------------------------------------

def run_to_end(stream: DataFrame, name: str, mode: str, each: Callable[[DataFrame, int], None] | None = None,
               path: str | None = None, checkpoint: str | None = None) -> None:
    """Process what is there, then stop; with ``path`` into Parquet files, else through ``each``."""
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option(
        "checkpointLocation", checkpoint or work_path(spark, f"{name}-checkpoint"))
    query = (writer.format("parquet").start(path) if path else writer.foreachBatch(each).start())
    query.awaitTermination()


def to_table(stream: DataFrame, name: str, mode: str = "append", prepare: Callable[[DataFrame], DataFrame] | None = None,
             checkpoint: str | None = None, path: str | None = None, combine: Callable[[DataFrame], DataFrame] | None = None,
             merge_after: int = 50) -> DataFrame:
    """Run a stream into a table of batches and read it back with ``batch_id``.

    The schema is that of an empty batch after ``prepare``, so a restart that
    finds nothing new reads the table like any other run.  With ``combine``,
    the batches before the one at hand are merged every ``merge_after`` batches.
    """
    spark = stream.sparkSession
    empty = spark.createDataFrame([], stream.schema)
    table = BatchTable.open(spark, path or work_path(spark, name), (prepare(empty) if prepare else empty).schema)

    def each(batch: DataFrame, batch_id: int) -> None:
        table.write(prepare(batch) if prepare else batch, batch_id)
        if combine and batch_id and batch_id % merge_after == 0:
            table.merge(combine, upto=batch_id - 1)

    run_to_end(stream, name, mode, each, checkpoint=checkpoint)
    return table.read()


# jobs ---------------------------------------------------------------------

def hot_items(log: DataFrame, **where) -> DataFrame:
    """Running count per (channel, item) of uses; the newest count of a key stands."""
    uses = log.filter(~F.col("action").isin("exposure", "read"))
    counts = uses.groupBy("channel_id", "item_id").agg(F.count("*").alias("uses"))

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("channel_id", "item_id").agg(F.max_by("uses", "batch_id").alias("uses"), F.max("batch_id").alias("batch_id"))

    return newest(to_table(counts, "hot-items", "update", combine=newest, **where)).drop("batch_id")


def hot_items_by_window(log: DataFrame, delay: str = "2 hours", width: str = "1 hour", step: str = "15 minutes",
                        **where) -> DataFrame:
    """The same count by event-time window; rows later than ``delay`` are dropped."""
    uses = log.filter(~F.col("action").isin("exposure", "read"))
    counts = (
        uses.withWatermark("action_time", delay)
        .groupBy(F.window("action_time", width, step), "channel_id", "item_id").agg(F.count("*").alias("uses"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "channel_id", "item_id", "uses")
    )
    return to_table(counts, "hot-windows", "append", **where).drop("batch_id")


def new_items(log: DataFrame, **where) -> DataFrame:
    """Last arrival per (channel, item)."""

    def newest(batch: DataFrame) -> DataFrame:
        return batch.groupBy("channel_id", "item_id").agg(F.max("action_time").alias("ts"))

    def last(rows: DataFrame) -> DataFrame:
        return rows.groupBy("channel_id", "item_id").agg(F.max("ts").alias("ts"), F.max("batch_id").alias("batch_id"))

    return last(to_table(log.select("channel_id", "item_id", "action_time"), "new-items", prepare=newest, combine=last, **where)).drop("batch_id")


RECALLED = "user_id long, channel_id int, item_id long"


def online_recall(log: DataFrame, similar: DataFrame, history: DataFrame, checkpoint: str | None = None, path: str | None = None,
                  buckets: int = 64, merge_after: int = 50) -> DataFrame:
    """Similar items of what was clicked, collected or shared, each recalled once for a user and channel.

    What is recalled is history at once: a batch leaves out what earlier
    batches recalled for the same user and channel, and what the user had
    before (``history``: user_id, item_id, for all channels).  Both lie in one
    table by bucket of users, so a batch reads the buckets of its own users
    only.  Returns the keys, item_id and the batch that recalled it.
    """
    spark = log.sparkSession
    before = history.select("user_id", F.lit(None).cast("int").alias("channel_id"), "item_id").distinct()
    table = BatchTable.open(spark, path or work_path(spark, "online-recall"), RECALLED, ["user_id"], buckets, first=before)
    acted = log.filter(F.col("action").isin("click", "collect", "share")).select("user_id", "channel_id", "item_id")
    found = acted.join(similar.select("item_id", "similar_id"), "item_id").select(
        "user_id", "channel_id", F.col("similar_id").alias("item_id"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.distinct().persist()
        past = table.read(before=batch_id, of=batch)
        everywhere = past.filter("channel_id is null").select("user_id", "item_id")
        same = past.filter("channel_id is not null").select("user_id", "channel_id", "item_id")
        table.write(batch.join(everywhere, ["user_id", "item_id"], "left_anti").join(same, ["user_id", "channel_id", "item_id"], "left_anti"), batch_id)
        batch.unpersist()
        if batch_id and batch_id % merge_after == 0:
            table.merge(lambda rows: rows, upto=batch_id - 1)

    run_to_end(found, "online-recall", "append", each, checkpoint=checkpoint)
    return table.read().where(F.col("batch_id") > FIRST).select("user_id", "channel_id", "item_id", "batch_id")


def profile_level(log: DataFrame, level: Column, **where) -> DataFrame:
    """Newest class level per user; anything but 1 to 4 is stored as missing."""
    valid = F.when(level.isin(1, 2, 3, 4), level)
    updates = log.select("user_id", "action_time", "event_id", valid.alias("level"))
    order = ["action_time", "event_id"]

    def newest(batch: DataFrame) -> DataFrame:
        return windows.latest(batch, ["user_id"], order, ["level", *order])

    def standing(rows: DataFrame) -> DataFrame:
        return windows.latest(rows, ["user_id"], order, ["level", *order, "batch_id"])

    return standing(to_table(updates, "profile-level", prepare=newest, combine=standing, **where)).select("user_id", "level")


EVENTS_A_BLOCK = 100_000  # events of a category that meet its items in one task
SLOTS_A_PIECE = 4_000_000  # slots of a category that such a task holds


def _items_of_slots(piece_size: int):
    """Arrow task: the distinct slots each user of a block drew from a piece of its category, as a list of items."""

    def run(asked: pa.Table, pool: pa.Table) -> pa.Table:
        users = asked.column("user_id").combine_chunks().dictionary_encode(null_encoding="encode")
        drawn = asked.column("slots").combine_chunks()
        at, items = pool.column("slot").to_numpy(), pool.column("item_id").combine_chunks()
        order = np.argsort(at, kind="stable")
        base = asked.column("piece")[0].as_py() * piece_size if len(asked) else 0
        width = int(at.max()) + 1 - base if len(at) else 1
        first = np.searchsorted(at[order], base + np.arange(width + 1))
        slots = drawn.flatten().fill_null(-1).to_numpy() - base
        who = np.repeat(users.indices.to_numpy().astype(np.int64), drawn.value_lengths().to_numpy())
        here = (slots >= 0) & (slots < width)
        who, slots = np.divmod(np.unique(who[here] * width + slots[here]), width)
        n = first[slots + 1] - first[slots]
        rows = np.repeat(first[slots] - np.cumsum(n) + n, n) + np.arange(n.sum())
        sizes = np.bincount(np.repeat(who, n), minlength=len(users.dictionary))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), items.take(pa.array(order[rows])))
        cate = asked.column("cate_id").combine_chunks().slice(0, 1).take(pa.array(np.zeros(len(lists), np.int64)))
        return pa.table([users.dictionary, cate, lists], ["user_id", "cate_id", "items"])

    return run


def category_recall(log: DataFrame, pool: DataFrame, draws: int = 50, **where) -> DataFrame:
    """For each event, ``draws`` items of its category, drawn by hash with repetition.

    ``pool`` has cate_id, item_id, ``slot`` (0.. without gaps) and ``n`` (items of the category).

    Draws are never shuffled one by one.  The events of a category are dealt
    into blocks by their id, so a user with very many is spread; each block
    draws where it lies and meets the items of the category, which are copied
    once per block.  The table has a list of items per user, category and
    block.
    """
    asked = log.select("event_id", "user_id", "cate_id")
    types = {f.name: f.dataType for f in [*asked.schema.fields, *pool.schema.fields]}
    shape = T.StructType([T.StructField("user_id", types["user_id"]), T.StructField("cate_id", types["cate_id"]), T.StructField("items", T.ArrayType(types["item_id"]))])
    sizes = pool.select("cate_id", "n").distinct()

    def named(batch: DataFrame) -> DataFrame:
        blocks = batch.groupBy("cate_id").agg(F.ceil(F.count("*") / EVENTS_A_BLOCK).cast("int").alias("blocks"))
        dealt = batch.join(sizes, "cate_id").join(blocks, "cate_id").select(
            "cate_id", F.pmod(F.xxhash64("event_id", "user_id"), "blocks").cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / SLOTS_A_PIECE).cast("int"))).alias("piece"), "event_id", "user_id", "n")
        drawn = F.array(*[F.pmod(hash_number(F.col("event_id"), F.lit(i)), F.col("n")) for i in range(1, draws + 1)])
        # Slots are drawn behind the exchange, which so moves the events only.
        parts = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # else few: the events are small, not so the work on them
        dealt = dealt.repartition(parts, "cate_id", "block", "piece").select("cate_id", "block", "piece", "user_id", drawn.alias("slots"))
        copies = pool.join(blocks, "cate_id").select(
            "cate_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.floor(F.col("slot") / SLOTS_A_PIECE).cast("int").alias("piece"), F.col("slot").cast("long").alias("slot"), "item_id")
        keys = ["cate_id", "block", "piece"]
        return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_items_of_slots(SLOTS_A_PIECE), shape)

    lists = to_table(asked, "category-recall", prepare=named, **where)
    # One exchange of lists serves equal rows and whatever is grouped by user and category.
    return lists.repartition("user_id", "cate_id").select("user_id", "cate_id", F.explode("items").alias("item_id")).distinct()


def deduplicated(log: DataFrame, key: str, delay: str = "1 day", **where) -> DataFrame:
    """Repeated rows dropped; the state only reaches back ``delay``."""
    once = log.withWatermark("action_time", delay).dropDuplicatesWithinWatermark([key])
    return to_table(once, "deduplicated", **where).drop("batch_id")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _last_actions_processor(n: int, idle_ms: int):
    """A state processor that keeps the newest ``n`` (micros, event_id) of a key and forgets the key after an idle time."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class LastActions(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.newest = handle.getListState("newest", "micros long, event_id long")

        def handleInputRows(self, key, rows, timerValues):
            held = {tuple(r) for r in self.newest.get()} if self.newest.exists() else set()
            for pdf in rows:
                held |= set(zip(pdf["micros"].tolist(), pdf["event_id"].tolist()))
                held = set(sorted(held)[-n:])
            kept = sorted(held)
            self.newest.put(kept)
            # One timer a key: that of the newest row; an earlier one would end the key too soon.
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            now = timerValues.getCurrentWatermarkInMs()
            self.handle.registerTimer(max(kept[-1][0] // 1000, now) + idle_ms)
            yield pd.DataFrame({"user_id": [key[0]], "salt": [key[1]], "micros": [[m for m, _ in kept]], "ids": [[i for _, i in kept]]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.newest.clear()
            return iter([])

        def close(self):
            pass

    return LastActions()


def last_actions(log: DataFrame, n: int, salts: int = 4, delay: str = "1 day", idle_ms: int = 86_400_000, **where) -> DataFrame:
    """Last ``n`` events per user, kept as list state and dropped by a timer after an idle time.

    A user's rows spread over ``salts`` states; the last ``n`` of their union
    are the last ``n`` of the user.  The lists of all batches are read
    together, so events from before an idle time still count.  A repeated
    event counts once.  Needs the RocksDB state store, which is set while the
    job runs.
    """
    spark = log.sparkSession
    keyed = log.withWatermark("action_time", delay).select(
        "user_id", F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt"), "event_id", "action_time",
        F.unix_micros("action_time").alias("micros"))
    states = keyed.groupBy("user_id", "salt").transformWithStateInPandas(
        _last_actions_processor(n, idle_ms), "user_id long, salt long, micros array<long>, ids array<long>", "update", "eventTime")

    def last(rows: DataFrame) -> DataFrame:
        each = rows.select("user_id", "batch_id", F.explode(F.arrays_zip("micros", "ids")).alias("x"))
        each = each.groupBy("user_id", "x.micros", F.col("x.ids").alias("event_id")).agg(F.max("batch_id").alias("batch_id"))
        return windows.top_k(each, ["user_id"], [F.desc("micros"), F.desc("event_id")], n, rank="back")

    def combine(rows: DataFrame) -> DataFrame:
        kept = last(rows).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("micros", "event_id"))).alias("x"), F.max("batch_id").alias("batch_id"))
        return kept.select("user_id", F.lit(0).cast("long").alias("salt"), F.col("x.micros").alias("micros"), F.col("x.event_id").alias("ids"), "batch_id")

    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, ROCKSDB)
    try:
        table = to_table(states, "last-actions", "update", combine=combine, **where)
    finally:
        spark.conf.set(store, before)
    return last(table).drop("batch_id")
