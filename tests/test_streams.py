"""Streams in several files: late rows, repeats, restart."""

import pytest
from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.session import work_path
from larkspur.streaming import jobs


@pytest.fixture(scope="module")
def stream_folder(spark, tables):
    """Five files by time; the fifth moves some rows back three hours and repeats twenty."""
    path = work_path(spark, "stream-fixture")
    log = fx.actions_log(tables).select(
        "event_id", "user_id", F.col("action_time").cast("timestamp").alias("action_time"), "action",
        F.col("item").cast("long").alias("item_id"), "channel_id", "article_text", "read_time")
    parts = log.withColumn("file_no", F.ntile(5).over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("action_time")))
    moved = parts.withColumn("action_time", F.when(
        (F.col("file_no") == 5) & (F.col("event_id") % 10 == 0), F.col("action_time") - F.expr("INTERVAL 3 HOURS")).otherwise(F.col("action_time")))
    again = moved.filter("file_no = 4").limit(20).withColumn("file_no", F.lit(5))
    for i in range(1, 6):
        moved.unionByName(again).filter(F.col("file_no") == i).drop("file_no").coalesce(1).write.mode("append").parquet(path)
    return path, log.schema


def open_stream(spark, stream_folder):
    path, schema = stream_folder
    return jobs.file_stream(spark, path, schema, files_per_batch=1)


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_hot_items_equal_batch(spark, stream_folder):
    got = jobs.hot_items(open_stream(spark, stream_folder))
    batch = spark.read.parquet(stream_folder[0]).filter(~F.col("action").isin("exposure", "read")).groupBy(
        "channel_id", "item_id").agg(F.count("*").alias("uses"))
    assert pairs(got, "channel_id", "item_id", "uses") == pairs(batch, "channel_id", "item_id", "uses")


def test_restart_counts_once(spark, stream_folder, tmp_path):
    checkpoint, table = str(tmp_path / "check"), str(tmp_path / "table")
    first = pairs(jobs.hot_items(open_stream(spark, stream_folder), checkpoint=checkpoint, path=table), "channel_id", "item_id", "uses")
    again = pairs(jobs.hot_items(open_stream(spark, stream_folder), checkpoint=checkpoint, path=table), "channel_id", "item_id", "uses")
    assert first == again


def test_windows_drop_late_rows(spark, stream_folder):
    log = open_stream(spark, stream_folder)
    strict = jobs.hot_items_by_window(log, delay="1 minute", width="1 hour", step="1 hour")
    wide = jobs.hot_items_by_window(open_stream(spark, stream_folder), delay="60 days", width="1 hour", step="1 hour")
    kept = strict.agg(F.sum("uses")).first()[0]
    uses = spark.read.parquet(stream_folder[0]).filter(~F.col("action").isin("exposure", "read")).count()
    assert 0 < kept < uses
    assert wide.count() == 0  # nothing is final while the watermark lies before every window


def test_dedup_ignores_repeats(spark, stream_folder):
    once = jobs.deduplicated(open_stream(spark, stream_folder), "event_id", delay="60 days")
    ids = [r["event_id"] for r in once.collect()]
    assert len(ids) == len(set(ids)) == spark.read.parquet(stream_folder[0]).select("event_id").distinct().count()


def test_last_actions_over_several_batches(spark, stream_folder):
    got = jobs.last_actions(open_stream(spark, stream_folder), n=3, delay="60 days")
    seen = {}
    for r in spark.read.parquet(stream_folder[0]).collect():
        seen.setdefault(r["user_id"], set()).add((r["action_time"], r["event_id"]))
    # The fixture repeats rows, so compare the newest row, which is never repeated.
    newest = {u: max(rows)[1] for u, rows in seen.items()}
    assert {r["user_id"]: r["event_id"] for r in got.filter("back = 1").collect()} == newest


def test_new_items_and_levels(spark, stream_folder):
    batch = spark.read.parquet(stream_folder[0])
    want = pairs(batch.groupBy("channel_id", "item_id").agg(F.max("action_time").alias("ts")), "channel_id", "item_id", "ts")
    assert pairs(jobs.new_items(open_stream(spark, stream_folder)), "channel_id", "item_id", "ts") == want
    levels = jobs.profile_level(open_stream(spark, stream_folder), F.col("item_id") % 6).collect()
    assert {r["level"] for r in levels} <= {1, 2, 3, 4, None} and len(levels) == batch.select("user_id").distinct().count()


def test_bad_json_gives_nulls(spark):
    lines = spark.createDataFrame([("{broken",), ('{"actionTime":"2024-01-01 00:00:00","param":{"userId":"7"}}',)], "value string")
    rows = jobs.parse_log(lines).collect()
    assert rows[0]["user_id"] is None and rows[1]["user_id"] == 7


@pytest.mark.parametrize("idle_days, remembered", [(1, False), (100, True)])
def test_idle_state_ends_by_timer(spark, idle_days, remembered):
    source, table = work_path(spark, "idle-source"), work_path(spark, "idle-table")
    for i, (user, day) in enumerate([(1, 1), (2, 11), (3, 12), (1, 13)]):
        spark.createDataFrame([(i, user, f"2024-03-{day:02d} 00:00:00")], "event_id long, user_id long, at string").select(
            "event_id", "user_id", F.to_timestamp("at").alias("action_time")).coalesce(1).write.mode("append").parquet(source)
    log = jobs.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    last = jobs.last_actions(log, n=5, salts=1, delay="1 hour", idle_ms=idle_days * 86_400_000, path=table)
    newest = spark.read.parquet(table).where("user_id = 1").orderBy(F.desc("batch_id")).first()
    assert newest["ids"] == ([0, 3] if remembered else [3])
    assert [(r["event_id"], r["back"]) for r in last.where("user_id = 1").orderBy("back").collect()] == [(3, 1), (0, 2)]


def test_category_recall_moves_events_not_draws(spark, stream_folder, monkeypatch):
    """The lists of a plain draw, with blocks and pieces of a few rows; tables hold lists, not a row for each draw."""
    from collections import defaultdict
    from hashlib import md5

    monkeypatch.setattr(jobs, "EVENTS_A_BLOCK", 7, raising=False)
    monkeypatch.setattr(jobs, "SLOTS_A_PIECE", 2, raising=False)
    sizes = {0: 1, 1: 3, 2: 5, None: 4}
    pool = [(c, s, 100 * (c or 0) + s * s, n) for c, n in sizes.items() for s in range(n)]
    pool = spark.createDataFrame([*pool, (1, 0, 777, 3)], "cate_id int, slot long, item_id long, n long")  # slot 0 of category 1 twice
    log = open_stream(spark, stream_folder).where("event_id < 60").select(
        "event_id", F.when(F.col("event_id") % 9 > 0, F.col("event_id") % 4).alias("user_id"), F.when(F.col("event_id") % 11 > 0, F.col("event_id") % 4).cast("int").alias("cate_id"))
    path = work_path(spark, "category-table")
    got = jobs.category_recall(log, pool, draws=3, path=path)
    items = defaultdict(list)
    for r in pool.collect():
        items[r["cate_id"], r["slot"]].append(r["item_id"])
    want = set()
    for e in [r["event_id"] for r in spark.read.parquet(stream_folder[0]).where("event_id < 60").collect()]:
        user, cate = e % 4 if e % 9 else None, e % 4 if e % 11 else None
        for d in range(1, 4) if cate in (0, 1, 2) else ():
            want |= {(user, cate, i) for i in items[cate, int(md5(f"{e}:{d}".encode()).hexdigest()[:8], 16) % sizes[cate]]}
    rows = [tuple(r) for r in got.select("user_id", "cate_id", "item_id").collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert spark.read.parquet(path).schema["items"].dataType.typeName() == "array"
