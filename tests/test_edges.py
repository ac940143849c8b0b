"""Long values near each other, ranks that do not settle, streams that restart or pause."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import graph, windows
from larkspur.streaming import jobs


def test_position_tells_longs_beyond_double_precision_apart(spark):
    rng = random.Random(4)
    ties = list(range(400))
    rng.shuffle(ties)
    rows = [((1 << 60) + i, tie) for i, tie in enumerate(ties)]
    rng.shuffle(rows)
    placed = windows.position(spark.createDataFrame(rows, "value long, tie long"), "value", "tie", name="place").collect()
    assert all(r.place == r.value - (1 << 60) + 1 for r in placed)


def test_running_total_of_longs_beyond_double_precision(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), (F.col("id") + (1 << 60)).alias("at"), F.lit(1).alias("v"))
    assert all(r.total == r.at - (1 << 60) + 1 for r in windows.running_total(df, ["k"], "at", "v", "total").collect())


def test_ranks_that_do_not_settle_raise(spark):
    edges = spark.createDataFrame([("a", "x"), ("x", "a"), ("a", "y"), ("y", "a"), ("b", "y"), ("y", "b")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "root string")
    with pytest.raises(RuntimeError, match="still moved"):
        graph.personal_rank_exact(edges, roots, alpha=0.99, step=2, most=2)


def actions(spark, path, rows):
    schema = "user_id long, channel_id int, item_id long, event_id long, action string, action_time timestamp"
    df = spark.createDataFrame([(u, 1, i, e, "click", None) for u, i, e, _ in rows], schema)
    times = spark.createDataFrame([(e, t) for _, _, e, t in rows], "event_id long, at string")
    df = df.join(times, "event_id").withColumn("action_time", F.col("at").cast("timestamp")).drop("at")
    df.coalesce(1).write.mode("append").parquet(path)
    return jobs.file_stream(spark, path, df.schema, files_per_batch=1)


def test_prepared_jobs_restart_without_new_rows(spark, tmp_path):
    where = {"checkpoint": str(tmp_path / "check"), "path": str(tmp_path / "table")}
    log = actions(spark, str(tmp_path / "log"), [(1, 5, 1, "2024-01-01 00:00:00"), (2, 6, 2, "2024-01-01 01:00:00")])
    first = sorted(jobs.new_items(log, **where).collect())
    assert len(first) == 2 and sorted(jobs.new_items(log, **where).collect()) == first


def test_events_from_before_a_pause_still_count(spark, tmp_path):
    where = {"checkpoint": str(tmp_path / "check"), "path": str(tmp_path / "table")}
    folder = str(tmp_path / "log")
    jobs.last_actions(actions(spark, folder, [(1, 5, e, f"2024-01-01 0{e}:00:00") for e in (3, 4, 5)]), 3, delay="1 minute", **where)
    jobs.last_actions(actions(spark, folder, [(2, 5, 200, "2024-01-20 00:00:00")]), 3, delay="1 minute", **where)
    last = jobs.last_actions(actions(spark, folder, [(1, 5, 300, "2024-01-21 00:00:00")]), 3, delay="1 minute", **where)
    assert sorted(r.event_id for r in last.filter("user_id = 1").collect()) == [4, 5, 300]
