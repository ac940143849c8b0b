"""Plans: what reaches the scan, and what must not occur."""

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.operators import text, windows
from larkspur.plans.catalogue import CATALOGUE
from larkspur.session import work_path
from larkspur.sources import files


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filter_and_columns_reach_the_scan(tables):
    shown = plan(tables.lineitem.filter("l_quantity > 45").select("l_orderkey"))
    assert "GreaterThan(l_quantity,45.0)" in shown
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in shown


def test_partition_pruning(spark, tables):
    path = work_path(spark, "pruned")
    log = tables.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    files.overwrite_partitions(log, path, "dt")
    shown = plan(files.read_partition(spark, path, log.schema, "dt", "2024-01-12"))
    assert "PartitionFilters: [isnotnull(dt" in shown and "2024-01-12" in shown


def test_top_k_is_limited_before_the_shuffle(tables):
    shown = plan(windows.top_k(tables.events, ["user_id"], [F.desc("value"), F.asc("event_id")], 3))
    assert shown.count("WindowGroupLimit") >= 2


def test_keyword_ranking_has_no_shuffle(tables):
    words = text.tokenize(tables.documents.select(
        F.col("doc_id").alias("article_id"), F.lit(1).alias("channel_id"), F.col("text").alias("sentence")))
    assert "Exchange" not in plan(text.textrank(words)).split("== Physical Plan ==")[1]


def test_broadcast_of_a_fixed_table(spark):
    assert "BroadcastHashJoin" in plan(CATALOGUE["fn_broadcast"](spark, FOLDER))


@pytest.mark.parametrize("name", ["app_content_recall", "app_item_knn", "app_user_category_profile", "smp_sample", "app_recall_merge",
                                  "app_doc_vector", "join_similarity_exact", "app_ctr_samples", "win_lag_lead", "ts_decompose"])
def test_no_cartesian_product(name, spark):
    shown = plan(CATALOGUE[name](spark, FOLDER))
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


def test_salted_position_needs_no_single_partition(tables):
    shown = plan(windows.position(tables.orders, "o_totalprice", "o_orderkey")).split("== Physical Plan ==")[1]
    last = shown.index("Window [row_number()")
    assert "hashpartitioning(r1" in shown[last:]


def test_dirty_fixture_has_its_nulls(tables):
    dirty = fx.dirty_orders(tables)
    assert dirty.filter("o_custkey IS NULL").count() > 0 and dirty.filter(F.isnan("o_totalprice")).count() > 0


def test_term_counts_stay_with_their_article(tables):
    """Whole word lists are shuffled by article; small weights are sent to the counts, so these never travel by word."""
    articles = tables.documents.select(F.col("doc_id").alias("article_id"), F.lit(1).alias("channel_id"), F.col("text").alias("sentence"))
    counts = text.term_counts(text.tokenize(articles))
    shown = plan(text.tfidf_topk(counts, text.idf_table(counts, articles))).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning(article_id" in shown and "Exchange hashpartitioning(keyword" not in shown
