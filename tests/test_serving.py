"""Tables of batches, the feed's rounds, and online recall, against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.operators.serving import Feed
from larkspur.session import work_path
from larkspur.sources.batches import BatchTable
from larkspur.streaming import jobs

SCHEMA = "k long, v string"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def newest(df):
    return df.groupBy("k").agg(F.max_by("v", "batch_id").alias("v"), F.max("batch_id").alias("batch_id"))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_batches_before_during_and_after_a_merge(spark, keys):
    table = BatchTable.open(spark, work_path(spark, "batches"), SCHEMA, keys, buckets=4)
    assert table.read().count() == 0
    for n in range(6):
        table.write(spark.createDataFrame([(i, f"{n}-{i}") for i in range(n, 9)], SCHEMA), n)
    table.write(spark.createDataFrame([(5, "again")], SCHEMA), 5)  # a repeated batch takes the place of the first
    want = rows(newest(table.read()), "k", "v")
    assert (5, "again") in want and (8, "4-8") in want

    class Crash(BatchTable):
        def _name(self, upto, folder):
            raise RuntimeError("lost between writing and switching")

    with pytest.raises(RuntimeError):
        Crash(spark, table.path, table.schema, table.keys, table.buckets).merge(newest, upto=3)
    assert table.merged()[1] is None and rows(newest(table.read()), "k", "v") == want
    table.merge(newest, upto=3)
    assert table.merged()[0] == 3 and rows(newest(table.read()), "k", "v") == want
    table.write(spark.createDataFrame([(1, "late")], SCHEMA), 2)  # merged already: changes nothing
    assert rows(newest(table.read()), "k", "v") == want
    with pytest.raises(ValueError):
        table.read(before=2)
    table.trim()
    table.merge(newest)
    table.trim()
    assert rows(newest(table.read()), "k", "v") == want == rows(table.read(), "k", "v")
    again = BatchTable.open(spark, table.path, SCHEMA, keys, buckets=4)  # opening does not empty it
    assert rows(again.read(), "k", "v") == want


def test_only_the_buckets_of_the_keys_are_read(spark):
    table = BatchTable.open(spark, work_path(spark, "batches"), SCHEMA, ["k"], buckets=16)
    table.write(spark.createDataFrame([(i, "x") for i in range(400)], SCHEMA), 0)
    few = spark.createDataFrame([(7,), (9,)], "k int")  # another type of the same keys
    some = table.read(of=few)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan and some.count() < 120
    assert {7, 9} <= {r["k"] for r in some.collect()}
    assert table.read(of=few.limit(0)).count() == 0


class PlainFeed:
    def __init__(self, served, page):
        self.served, self.page = served, page
        self.history, self.queue = defaultdict(set), defaultdict(list)

    def serve(self, requests, scores):
        out = {}
        for key in requests:
            if self.queue[key]:
                front = self.queue[key][0]
                out[key], self.queue[key][0] = front[: self.served], front[self.served :]
                self.queue[key] = [p for p in self.queue[key] if p]
            else:
                gone = self.history[key] | self.history[key[0], 0]
                best = sorted((-s, i) for i, s in scores.get(key, {}).items() if i not in gone)
                best = [i for _, i in best]
                out[key], rest = best[: self.served], best[self.served :]
                self.queue[key] = [rest[i : i + self.page] for i in range(0, len(rest), self.page)]
        for key, items in out.items():
            self.history[key] |= set(items)
        return {k: v for k, v in out.items() if v}


def test_rounds_equal_a_plain_feed(spark):
    rng = random.Random(4)
    keys = [(u, c) for u in range(6) for c in (0, 1, 2)]
    feed, plain = Feed(spark, work_path(spark, "feed"), served=3, page=4, buckets=4), PlainFeed(3, 4)
    shown = defaultdict(list)
    for number in range(1, 6):
        scores = {k: {rng.randrange(40): rng.randrange(10) for _ in range(rng.choice([0, 2, 9, 25]))} for k in keys}
        asked = [k for k in keys if rng.random() < 0.7]
        table = spark.createDataFrame([(*k, i, float(s)) for k, own in scores.items() for i, s in own.items()], "user_id long, channel_id int, item_id long, score double")
        requests = spark.createDataFrame(asked + asked[:2], "user_id long, channel_id int")
        # Keys of one user in one round do not see each other's rows of that round: ask the plain feed the same way.
        before = {k: set(v) for k, v in plain.history.items()}
        want = {}
        for k in asked:
            apart = PlainFeed(3, 4)
            apart.history.update({x: set(v) for x, v in before.items()})
            apart.queue[k] = plain.queue[k]
            want |= apart.serve([k], scores)
            plain.queue[k] = apart.queue[k]
        for k, items in want.items():
            plain.history[k] |= set(items)
        for _ in range(2 if number % 2 else 1):  # a round run twice gives the same and takes its own place
            got = defaultdict(list)
            for r in sorted(feed.serve(number, requests, lambda idle: table).collect(), key=lambda r: r["place"]):
                got[r["user_id"], r["channel_id"]].append(r["item_id"])
            assert got == want
        for k, items in want.items():
            assert not set(items) & set(shown[k])
            shown[k] += items
    left = defaultdict(set)
    for r in feed.waiting(6, spark.createDataFrame(keys, "user_id long, channel_id int")).collect():
        left[r["user_id"], r["channel_id"]].add(r["item_id"])
    assert left == {k: {i for page in v for i in page} for k, v in plain.queue.items() if v}


def test_turning_back(spark):
    feed = Feed(spark, work_path(spark, "feed"), served=2, buckets=2)
    one = spark.createDataFrame([(1, 3)], "user_id long, channel_id int")
    items = spark.createDataFrame([(1, 3, i, float(-i)) for i in range(5)], "user_id long, channel_id int, item_id long, score double")
    for number in (1, 2, 3):
        feed.serve(number, one, lambda idle: items)
    seen, stamp = [], 4
    while stamp:
        shown = feed.earlier(one.withColumn("stamp", F.lit(stamp)), before=4).collect()
        seen.append({r["item_id"] for r in shown})
        stamp = shown[0]["next_stamp"]
    assert seen == [{4}, {2, 3}, {0, 1}]
    assert feed.earlier(one.withColumn("stamp", F.lit(1)), before=4).count() == 0


@pytest.mark.parametrize("merge_after", [2, 50])
def test_online_recall_recalls_once(spark, merge_after):
    rng = random.Random(9)
    source = work_path(spark, "acts")
    acts = [(rng.randrange(5), rng.choice([1, 2]), rng.randrange(8), rng.choice(["click", "share", "read"])) for _ in range(120)]
    schema = "user_id long, channel_id int, item_id long, action string"
    for i in range(6):
        spark.createDataFrame(acts[20 * i : 20 * i + 20], schema).coalesce(1).write.mode("append").parquet(source)
    similar = [(i, 100 + (i * j) % 17, float(j)) for i in range(8) for j in range(1, 6)]
    history = [(u, 100 + u) for u in range(5)]
    log = jobs.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    where = {"checkpoint": work_path(spark, "check"), "path": work_path(spark, "recalled")}
    table = spark.createDataFrame(similar, "item_id long, similar_id long, distance double")
    given = spark.createDataFrame(history, "user_id long, item_id long")
    for _ in range(2):  # the second run finds nothing new
        got = jobs.online_recall(log, table, given, buckets=4, merge_after=merge_after, **where)
        want = {(u, c, s) for u, c, i, a in acts if a != "read" for j, s, _ in similar if i == j} - {(u, c, i) for u, i in history for c in (1, 2)}
        assert rows(got, "user_id", "channel_id", "item_id") == sorted(want)
    assert got.select("batch_id").distinct().count() > 1


def test_stream_tables_are_merged(spark, tables):
    from larkspur import fixtures as fx

    path = work_path(spark, "log-parts")
    log = fx.actions_log(tables).select("event_id", "user_id", F.col("action_time").cast("timestamp").alias("action_time"), "action",
                                        F.col("item").cast("long").alias("item_id"), "channel_id")
    for i in range(4):
        log.where(F.col("event_id") % 4 == i).coalesce(1).write.mode("append").parquet(path)

    def stream():
        return jobs.file_stream(spark, path, log.schema, files_per_batch=1)

    jobs_of = {"hot": (jobs.hot_items, {}, ("channel_id", "item_id", "uses")), "new": (jobs.new_items, {}, ("channel_id", "item_id", "ts")),
               "level": (lambda s, **w: jobs.profile_level(s, F.col("item_id") % 6, **w), {}, ("user_id", "level")),
               "last": (lambda s, **w: jobs.last_actions(s, n=4, delay="60 days", **w), {}, ("user_id", "event_id", "back"))}
    for name, (job, extra, columns) in jobs_of.items():
        where = work_path(spark, name)
        merged = rows(job(stream(), merge_after=2, path=where, **extra), *columns)
        assert merged == rows(job(stream(), merge_after=1000, **extra), *columns), name
        assert spark.read.json(f"{where}.manifest").count() >= 1
