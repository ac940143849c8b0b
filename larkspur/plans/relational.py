"""Projection, filters, cleaning, joins, aggregates, windows, order, sampling, sets."""

from __future__ import annotations

import contextlib
import io
import math

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from larkspur import fixtures as fx
from larkspur.functions import text as tx
from larkspur.operators import aggregates as ag
from larkspur.operators import cleaning, joins, sampling, windows
from larkspur.plans.registry import query
from larkspur.session import materialise

DAY = "yyyy-MM-dd"
HASH = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT)"


# projection ---------------------------------------------------------------

@query("""SELECT c_custkey AS id, c_name AS customer_name, c_acctbal * 2 + 1 AS twice,
  CAST(floor(c_acctbal) AS BIGINT) AS whole, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def prj_select(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("customer_name"),
        F.expr("c_acctbal * 2 + 1").alias("twice"), F.floor("c_acctbal").alias("whole"),
        F.col("c_nationkey").cast("string").alias("nation"))


@query("""SELECT p_partkey AS part_id, p_name, p_size * 10 AS p_size, p_retailprice, 'x' AS tag FROM part""")
def prj_withcolumn(t):
    return (t.part.withColumn("p_size", F.col("p_size") * 10).withColumn("tag", F.lit("x"))
            .withColumnRenamed("p_partkey", "part_id").drop("p_brand", "p_type"))


@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem")
def prj_colregex(t):
    shipped = t.lineitem.select("l_orderkey", "l_linenumber", t.lineitem.colRegex("`l_ship.*`"))
    return shipped.withColumn("l_shipdate", F.date_format("l_shipdate", DAY))


@query("""SELECT event_id, user_id AS param_user, event_type AS first_item, value AS mapped FROM events""")
def prj_nested(t):
    nested = t.events.select(
        "event_id", F.struct(F.col("user_id").alias("userId"), "value").alias("param"),
        F.array("event_type", F.lit("other")).alias("items"),
        F.create_map(F.lit("v"), F.col("value")).alias("attributes"))
    return nested.select(
        "event_id", F.col("param").getField("userId").alias("param_user"),
        F.col("items").getItem(0).alias("first_item"), F.element_at("attributes", "v").alias("mapped"))


@query(f"""SELECT doc_id, length(w) AS letters, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '{tx.WORD}')) AS w FROM documents) GROUP BY ALL""")
def prj_map_rows(t):
    words = F.transform(tx.raw_words(F.col("text")), F.length)
    return (t.documents.select("doc_id", F.explode(words).alias("letters"))
            .groupBy("doc_id", "letters").agg(F.count("*").alias("n")))


@query("SELECT count(*) AS n, count(DISTINCT l_orderkey) AS keys, true AS one_place_a_key, true AS in_range FROM lineitem")
def prj_partition_id(t):
    spread = t.lineitem.repartition(8, "l_orderkey").select("l_orderkey", F.spark_partition_id().alias("partition_no"))
    keys = spread.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("partition_no").alias("low"), F.max("partition_no").alias("high"))
    return keys.agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.bool_and(F.col("low") == F.col("high")).alias("one_place_a_key"),
                    F.bool_and(F.col("high").between(0, 7)).alias("in_range"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders")
def prj_index(t):
    placed = windows.position(t.orders.select("o_orderkey"), "o_orderkey", "o_orderkey")
    return placed.select("o_orderkey", (F.col("idx") - 1).alias("idx"))


@query("""SELECT a.idx, c_name, p_name FROM
  (SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer) a JOIN
  (SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part) b ON a.idx = b.idx""")
def prj_zip(t):
    left = windows.position(t.customer.select("c_custkey", "c_name"), "c_custkey", "c_custkey")
    right = windows.position(t.part.select("p_partkey", "p_name"), "p_partkey", "p_partkey")
    return left.join(right, "idx").select((F.col("idx") - 1).alias("idx"), "c_name", "p_name")


@query("SELECT n_regionkey AS k, n_nationkey AS v_key, n_name AS v_name FROM nation")
def prj_keyby(t):
    keyed = t.nation.select(F.col("n_regionkey").alias("k"), F.struct("*").alias("v"))
    return keyed.select("k", F.col("v.n_nationkey").alias("v_key"), F.col("v.n_name").alias("v_name"))


# filters ------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  WHERE l_quantity > 30 AND l_returnflag LIKE 'R%' AND l_discount < 0.05""")
def flt_where(t):
    return (t.lineitem.filter(F.col("l_quantity") > 30).where("l_returnflag like 'R%'")
            .filter("l_discount < 0.05D").select("l_orderkey", "l_linenumber", "l_quantity"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def flt_between(t):
    return t.orders.filter(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@query("""SELECT p_partkey, p_type FROM part
  WHERE p_type IN ('PROMO', 'SMALL') AND p_size NOT IN (1, 2, 3)""")
def flt_isin(t):
    return (t.part.filter(F.col("p_type").isin("PROMO", "SMALL") & ~F.col("p_size").isin(1, 2, 3))
            .select("p_partkey", "p_type"))


@query("""SELECT p_partkey, p_name LIKE 's%' AS f_like, regexp_matches(p_name, '^(red|blue) ') AS f_rlike,
  contains(p_name, 'bolt') AS f_contains, starts_with(p_name, 'hot') AS f_starts,
  ends_with(p_name, 'ring') AS f_ends FROM part
  WHERE p_name LIKE '%e%'""")
def flt_like(t):
    name = F.col("p_name")
    return t.part.where(name.like("%e%")).select(
        "p_partkey", name.like("s%").alias("f_like"), name.rlike("^(red|blue) ").alias("f_rlike"),
        name.contains("bolt").alias("f_contains"), name.startswith("hot").alias("f_starts"),
        name.endswith("ring").alias("f_ends"))


@query("""SELECT o_orderkey, o_custkey IS NULL AS no_customer, isnan(o_totalprice) AS no_price FROM f_dirty
  WHERE o_orderpriority IS NOT NULL""")
def flt_null(t):
    return (fx.dirty_orders(t).filter(F.col("o_orderpriority").isNotNull())
            .select("o_orderkey", F.col("o_custkey").isNull().alias("no_customer"),
                    F.isnan("o_totalprice").alias("no_price")))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'few' WHEN l_quantity < 30 THEN 'some'
  ELSE 'many' END AS size_word FROM lineitem""")
def flt_when(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             F.when(q < 10, "few").when(q < 30, "some").otherwise("many").alias("size_word"))


@query("""SELECT event_id, CASE WHEN ts <= TIMESTAMP '2024-01-30 00:00:00' THEN 'train' ELSE 'test' END AS part
  FROM events""")
def flt_time_split(t):
    limit = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    train = t.events.filter(F.col("ts") <= limit).select("event_id", F.lit("train").alias("part"))
    test = t.events.filter(F.col("ts") > limit).select("event_id", F.lit("test").alias("part"))
    return train.unionByName(test)


# cleaning -----------------------------------------------------------------

@query("""SELECT 'any' AS rule, o_orderkey FROM f_dirty
    WHERE o_custkey IS NOT NULL AND NOT isnan(o_totalprice) AND o_orderpriority IS NOT NULL
  UNION ALL SELECT 'subset', o_orderkey FROM f_dirty WHERE o_custkey IS NOT NULL
  UNION ALL SELECT 'thresh', o_orderkey FROM f_dirty
    WHERE CAST(o_custkey IS NOT NULL AS INTEGER) + CAST(NOT isnan(o_totalprice) AS INTEGER)
      + CAST(o_orderpriority IS NOT NULL AS INTEGER) >= 2""")
def cln_dropna(t):
    dirty = fx.dirty_orders(t)
    values = ["o_custkey", "o_totalprice", "o_orderpriority"]
    kept = {"any": dirty.na.drop(how="any"), "subset": dirty.na.drop(subset=["o_custkey"]),
            "thresh": dirty.na.drop(thresh=2, subset=values)}
    parts = [df.select(F.lit(rule).alias("rule"), "o_orderkey") for rule, df in kept.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey, coalesce(o_orderpriority, 'none') AS o_orderpriority,
  round(CASE WHEN isnan(o_totalprice) THEN (SELECT avg(o_totalprice) FROM f_dirty WHERE NOT isnan(o_totalprice))
    ELSE o_totalprice END, 4) AS o_totalprice FROM f_dirty""")
def cln_fillna(t):
    filled = fx.dirty_orders(t).na.fill({"o_custkey": -1, "o_orderpriority": "none"})
    return (cleaning.fill_with_mean(filled, "o_totalprice")
            .select("o_orderkey", "o_custkey", "o_orderpriority", F.round("o_totalprice", 4).alias("o_totalprice")))


@query("""SELECT adgroup_id, CASE brand_text WHEN 'NULL' THEN '-1' ELSE brand_text END AS brand_text,
  CASE cate_id WHEN 0 THEN 100 WHEN 1 THEN 101 ELSE cate_id END AS cate_id FROM f_ads""")
def cln_replace(t):
    return (fx.ads(t).na.replace("NULL", "-1", subset=["brand_text"])
            .na.replace({0: 100, 1: 101}, subset=["cate_id"]).select("adgroup_id", "brand_text", "cate_id"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_no,
  CAST(l_quantity AS INTEGER) AS pieces, l_extendedprice AS price FROM lineitem""")
def cln_cast_rename(t):
    return cleaning.retype(t.lineitem, [
        ("l_orderkey", "string", "order_id"), ("l_linenumber", "int", "line_no"),
        ("l_quantity", "int", "pieces"), ("l_extendedprice", "double", "price")])


@query("""SELECT o_orderkey, round(CASE WHEN isnan(o_totalprice)
  THEN (SELECT avg(o_totalprice) FROM f_dirty WHERE NOT isnan(o_totalprice)) ELSE o_totalprice END, 4) AS filled
  FROM f_dirty""")
def cln_impute(t):
    done = cleaning.impute(fx.dirty_orders(t), ["o_totalprice"], "mean")
    return done.select("o_orderkey", F.round("o_totalprice_filled", 4).alias("filled"))


@query("SELECT user_id, coalesce(pvalue_level, 0) AS known, true AS in_range FROM f_shop_users")
def cln_impute_model(t):
    filled = cleaning.impute_by_model(
        fx.shop_users(t), "pvalue_level", ["cms_group", "gender", "age_level", "shopping_level", "occupation"])
    before = fx.shop_users(t).select("user_id", F.col("pvalue_level").alias("given"))
    both = filled.select("user_id", "pvalue_level").join(before, "user_id")
    known = F.when(F.col("given").isNull(), 0).otherwise(F.col("pvalue_level").cast("int"))  # what was known stays as it was
    return both.select("user_id", known.alias("known"), F.coalesce(F.col("pvalue_level").isin(1, 2, 3), F.lit(False)).alias("in_range"))


@query("""SELECT category, CAST(row_number() OVER (ORDER BY n DESC, category) - 1 AS DOUBLE) AS idx, n FROM (
  SELECT CAST(coalesce(pvalue_level, -1) AS VARCHAR) AS category, count(*) AS n FROM f_shop_users GROUP BY 1)""")
def cln_missing_as_category(t):
    done = cleaning.missing_as_category(fx.shop_users(t), "pvalue_level")
    return done.groupBy("category", "idx").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, round(CASE WHEN c_acctbal BETWEEN m - 1.5e0 * s AND m + 1.5e0 * s THEN c_acctbal ELSE m END, 4)
  AS c_acctbal FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)""")
def cln_outlier_clip(t):
    clipped = cleaning.clip_outliers(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", widths=1.5)
    return clipped.withColumn("c_acctbal", F.round("c_acctbal", 4))


@query("""SELECT column_name, n_missing, round(n_missing / n, 6) AS share FROM (
  SELECT 'o_custkey' AS column_name, count(*) FILTER (o_custkey IS NULL) AS n_missing, count(*) AS n FROM f_dirty
  UNION ALL SELECT 'o_totalprice', count(*) FILTER (isnan(o_totalprice)), count(*) FROM f_dirty
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL), count(*) FROM f_dirty
  UNION ALL SELECT 'o_orderkey', 0, count(*) FROM f_dirty
  UNION ALL SELECT 'o_orderstatus', 0, count(*) FROM f_dirty)""")
def cln_missing_table(t):
    return cleaning.missing_table(fx.dirty_orders(t)).withColumn("share", F.round("share", 6))


@query("""SELECT 'l_returnflag' AS column_name, l_returnflag AS val, count(*) AS n FROM lineitem GROUP BY 2
  UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
  UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY 2""")
def cln_category_count(t):
    return ag.value_counts(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS code FROM orders""")
def cln_json_to_bool(t):
    codes = F.create_map(F.lit("F"), F.lit(0), F.lit("O"), F.lit(1), F.lit("P"), F.lit(2))
    return t.orders.select("o_orderkey", codes[F.col("o_orderstatus")].alias("code"))


# joins --------------------------------------------------------------------

@query("""SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer
  ON o_custkey = c_custkey AND o_totalprice > c_acctbal""")
def join_inner(t):
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > F.col("c_acctbal"))
    return t.orders.join(t.customer, on, "inner").select("o_orderkey", "c_name", "o_totalprice")


@query("""SELECT o_orderkey, o_custkey, c_name FROM f_dirty LEFT JOIN customer ON o_custkey = c_custkey""")
def join_left(t):
    return (fx.dirty_orders(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "o_custkey", "c_name"))


@query("""SELECT o.o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') o
  RIGHT JOIN customer ON o_custkey = c_custkey""")
def join_right(t):
    pending = t.orders.filter("o_orderstatus = 'P'")
    return (pending.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right")
            .select("o_orderkey", "c_custkey"))


@query("""SELECT coalesce(s_suppkey, p_partkey) AS k, s_name, p_name FROM supplier
  FULL JOIN part ON s_suppkey = p_partkey - 50""")
def join_full(t):
    return (t.supplier.join(t.part, F.col("s_suppkey") == F.col("p_partkey") - 50, "full")
            .select(F.coalesce("s_suppkey", "p_partkey").alias("k"), "s_name", "p_name"))


@query("""SELECT a.c_custkey AS a_key, b.c_custkey AS b_key, a.c_nationkey AS nation FROM customer a
  JOIN customer b ON b.c_custkey = a.c_custkey + 1 AND a.c_mktsegment = b.c_mktsegment""")
def join_self(t):
    a, b = t.customer.alias("a"), t.customer.alias("b")
    on = (F.col("b.c_custkey") == F.col("a.c_custkey") + 1) & (F.col("a.c_mktsegment") == F.col("b.c_mktsegment"))
    return a.join(b, on).select(F.col("a.c_custkey").alias("a_key"), F.col("b.c_custkey").alias("b_key"),
                                F.col("a.c_nationkey").alias("nation"))


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(t):
    # The two fixed dimension tables (5 and 25 rows); no growing table is crossed anywhere.
    return t.region.crossJoin(t.nation).select("r_name", "n_name")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def join_anti(t):
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(pending, "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT l_partkey, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_partkey IN
  (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 30) GROUP BY 1""")
def join_semi_filter(t):
    lines = t.lineitem.select("l_partkey", "l_quantity")
    popular = joins.keys_with_count(lines, "l_partkey", 30)
    return (lines.join(popular, "l_partkey", "left_semi").groupBy("l_partkey")
            .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")))


@query("""SELECT k, side, chunk, array_to_string(list_sort(list(item)), ',') AS items FROM (
    SELECT o_custkey AS k, 'left' AS side, CAST(o_orderkey AS VARCHAR) AS item, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 20 AS chunk FROM f_dirty
    UNION ALL SELECT c_custkey, 'right', c_name, 0 FROM customer) GROUP BY 1, 2, 3""")
def join_cogroup(t):
    left = fx.dirty_orders(t).select(F.col("o_custkey").alias("k"), "o_orderkey")
    right = t.customer.select(F.col("c_custkey").alias("k"), "c_name", "c_custkey")
    both = joins.cogroup(left, right, "k", "o_orderkey", "c_name", "o_orderkey", "c_custkey", size=20)
    return both.select("k", "side", "chunk", F.array_join(F.array_sort("items"), ",").alias("items"))


@query("""SELECT user_id, idx, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) JOIN
  (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM events))
  USING (user_id)""")
def join_lookup_index(t):
    ids = windows.dense_ids(t.events, "user_id", "idx")
    model_side = (t.events.join(ids, "user_id").groupBy("idx").agg(F.count("*").alias("n")))
    return model_side.join(ids, "idx").select("user_id", "idx", "n")


@query("""SELECT DISTINCT user_id, item FROM (SELECT user_id, (item + 1) % 100 AS item FROM f_actions_log WHERE action = 'click')
  EXCEPT SELECT user_id, item FROM f_actions_log""")
def join_history_exclude(t):
    log = fx.actions_log(t)
    candidates = (log.filter("action = 'click'")
                  .select("user_id", ((F.col("item") + 1) % 100).alias("item")).distinct())
    return joins.exclude_history(candidates, log, ["user_id", "item"])


# aggregates ---------------------------------------------------------------

@query("""SELECT count(*) AS n, round(avg(l_quantity), 6) AS mean_qty, min(l_extendedprice) AS low,
  max(l_extendedprice) AS high, round(sum(l_extendedprice), 1) AS total FROM lineitem""")
def agg_global(t):
    return t.lineitem.agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_qty"),
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
        F.round(F.sum("l_extendedprice"), 1).alias("total"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, min(l_discount) AS low,
  max(l_discount) AS high, round(avg(l_extendedprice), 4) AS mean_price FROM lineitem GROUP BY 1, 2""")
def agg_group(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.min("l_discount").alias("low"),
        F.max("l_discount").alias("high"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))


@query("""SELECT user_id, event_type, count(*) AS n, max(value) AS best, CAST(sum(event_id) AS BIGINT) AS id_sum
  FROM events GROUP BY 1, 2""")
def agg_reduce_by_key(t):
    return t.events.groupBy("user_id", "event_type").agg(
        F.count("*").alias("n"), F.max("value").alias("best"), F.sum("event_id").alias("id_sum"))


@query("""SELECT l_suppkey, round(sum(l_quantity) / count(l_quantity), 6) AS mean_qty, round(sum(l_quantity * l_discount), 4)
  AS weighted FROM lineitem GROUP BY 1""")
def agg_combine_by_key(t):
    parts = t.lineitem.groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("s"), F.count("l_quantity").alias("c"),
        F.sum(F.col("l_quantity") * F.col("l_discount")).alias("w"))
    return parts.select("l_suppkey", F.round(F.col("s") / F.col("c"), 6).alias("mean_qty"),
                        F.round("w", 4).alias("weighted"))


@query("""SELECT user_id, chunk, array_to_string(list_sort(list(event_id)), ',') AS ids, count(*) AS n FROM (
  SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 50 AS chunk
  FROM (SELECT CASE WHEN user_id % 9 <> 0 THEN user_id END AS user_id, event_id FROM events)) GROUP BY 1, 2""")
def agg_group_by_key(t):
    """Lists of fifty; the rows without a user are one large key."""
    events = t.events.select(F.when(F.col("user_id") % 9 != 0, F.col("user_id")).alias("user_id"), "event_id")
    lists = ag.collect_chunks(events, ["user_id"], "event_id", "event_id", "ids", 50)
    return lists.select("user_id", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
                        F.size("ids").cast("long").alias("n"))


@query("""SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, count(l_linenumber) AS n, min(l_linenumber) AS smallest,
  max(l_linenumber) AS largest FROM lineitem""")
def agg_reduce_all(t):
    return ag.reduce_all(t.lineitem, "l_linenumber")


@query(f"""SELECT word, length(word) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{tx.WORD}')) AS word
  FROM documents) ORDER BY length(word) DESC, encode(word) DESC LIMIT 1""")
def agg_longest_word(t):
    words = t.documents.select(F.explode(tx.raw_words(F.col("text"))).alias("word"))
    return ag.longest_word(words, "word")


@query("""SELECT count(*) AS n, count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_partkey, l_suppkey)) AS pairs,
  (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)) AS flags FROM lineitem""")
def agg_distinct(t):
    flags = t.lineitem.select("l_returnflag", "l_linestatus").distinct().select(F.count("*")).scalar()
    return t.lineitem.agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"),
                          F.count_distinct("l_partkey", "l_suppkey").alias("pairs")).withColumn("flags", flags)


@query("SELECT count(DISTINCT l_partkey) AS exact, true AS near FROM lineitem")
def agg_approx_distinct(t):
    counts = t.lineitem.agg(F.approx_count_distinct("l_partkey", 0.03).alias("about"), F.count_distinct("l_partkey").alias("exact"))
    return counts.select("exact", (F.abs(F.col("about") - F.col("exact")) <= 0.12 * F.col("exact")).alias("near"))  # four standard errors


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def agg_dedup(t):
    first = F.min_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("kept")
    return t.events.groupBy("user_id", "event_type").agg(first).select("user_id", "event_type", "kept.*")


@query("""SELECT user_id, cate_id, count(*) FILTER (btag = 'pv') AS pv, count(*) FILTER (btag = 'fav') AS fav,
  count(*) FILTER (btag = 'cart') AS cart, count(*) FILTER (btag = 'buy') AS buy FROM f_behaviour GROUP BY 1, 2""")
def agg_pivot(t):
    counts = fx.behaviour_log(t).groupBy("user_id", "cate_id").pivot("btag", ["pv", "fav", "cart", "buy"]).count()
    return counts.na.fill(0)


@query("SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_crosstab(t):
    # The long form of crosstab(), which builds its wide table on the driver.
    return t.lineitem.groupBy(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, true AS found FROM events GROUP BY 1 HAVING count(*) >= 0.1 * (SELECT count(*) FROM events)")
def agg_freq_items(t):
    """Every value of at least a tenth of the rows is among the items found, which may hold rarer ones too."""
    found = t.events.freqItems(["event_type"], 0.1).select(F.explode("event_type_freqItems").alias("event_type"), F.lit(True).alias("found"))
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n")).where(F.col("n") >= 0.1 * t.events.select(F.count("*")).scalar())
    return counts.join(found, "event_type", "left").select("event_type", "n", F.coalesce("found", F.lit(False)).alias("found"))


@query("""SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g_flag,
  grouping_id(l_returnflag, l_linestatus) AS g_id, sum(l_quantity) AS qty FROM lineitem
  GROUP BY CUBE (l_returnflag, l_linestatus)""")
def agg_cube(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(
        F.grouping("l_returnflag").cast("long").alias("g_flag"), F.grouping_id().alias("g_id"),
        F.sum("l_quantity").alias("qty"))


@query("""SELECT a.o_custkey, statuses, chunk, keys FROM
  (SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM f_dirty GROUP BY 1) a
  JOIN (SELECT o_custkey, chunk, array_to_string(list_sort(list(o_orderkey)), ',') AS keys FROM (
    SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 1000 AS chunk
    FROM f_dirty) GROUP BY 1, 2) b ON a.o_custkey IS NOT DISTINCT FROM b.o_custkey""")
def agg_collect(t):
    orders = fx.dirty_orders(t)
    sets = orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))
    lists = ag.collect_chunks(orders.select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", "o_orderkey")
    keys = F.array_join(F.col("items").cast("array<string>"), ",").alias("keys")
    return windows.rejoin(lists, sets, ["o_custkey"]).select("o_custkey", "statuses", "chunk", keys)


@query("""SELECT * FROM (
  SELECT 'count' AS stat, CAST(count(*) AS DOUBLE) AS qty, CAST(count(*) AS DOUBLE) AS disc FROM lineitem
  UNION ALL SELECT 'mean', round(avg(l_quantity), 5), round(avg(l_discount), 5) FROM lineitem
  UNION ALL SELECT 'stddev', round(stddev_samp(l_quantity), 5), round(stddev_samp(l_discount), 5) FROM lineitem
  UNION ALL SELECT 'min', min(l_quantity), min(l_discount) FROM lineitem
  UNION ALL SELECT 'max', max(l_quantity), max(l_discount) FROM lineitem
  UNION ALL SELECT 'var_pop', round(var_pop(l_quantity), 5), round(var_pop(l_discount), 5) FROM lineitem)""")
def agg_stats(t):
    lines = t.lineitem.select(F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc"))
    described = lines.describe("qty", "disc").select(
        F.col("summary").alias("stat"), *[F.round(F.col(c).cast("double"), 5).alias(c) for c in ("qty", "disc")])
    spread = lines.agg(*[F.round(F.var_pop(c), 5).alias(c) for c in ("qty", "disc")])
    return described.unionByName(spread.select(F.lit("var_pop").alias("stat"), "qty", "disc"))


@query("""SELECT round(covar_pop(l_extendedprice, l_quantity), 2) AS cov_pop,
  round(covar_samp(l_extendedprice, l_quantity), 2) AS cov_samp,
  round(corr(l_extendedprice, l_quantity), 8) AS pearson FROM lineitem""")
def agg_cov_corr(t):
    a, b = "l_extendedprice", "l_quantity"
    return t.lineitem.agg(F.round(F.covar_pop(a, b), 2).alias("cov_pop"), F.round(F.covar_samp(a, b), 2).alias("cov_samp"),
                          F.round(F.corr(a, b), 8).alias("pearson"))


@query("""SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50,
  quantile_cont(l_quantity, 0.75) AS q75 FROM lineitem GROUP BY 1""")
def agg_quantile(t):
    # Exact form: its state is one counter per distinct value (l_quantity has 50).
    cut = [F.percentile("l_quantity", F.lit(p)).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    return t.lineitem.groupBy("l_returnflag").agg(*cut)


@query("""SELECT CAST(CASE WHEN l_quantity = 50 THEN 7 ELSE floor((l_quantity - 1) / 7) + 1 END AS INTEGER) AS bucket,
  count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 GROUP BY 1""")
def agg_histogram(t):
    return ag.histogram(t.lineitem, "l_quantity", 1.0, 50.0, 7)


@query("SELECT count(*) AS exact, true AS near FROM lineitem")
def agg_approx_count(t):
    counts = ag.approximate_count(t.lineitem, 0.1, seed=5)
    return counts.select("exact", (F.abs(F.col("approximate") - F.col("exact")) <= 5 * F.sqrt(9 * F.col("exact"))).alias("near"))


@query(f"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{tx.WORD}')) AS word
  FROM documents) GROUP BY 1""")
def agg_word_count(t):
    return ag.word_counts(F.col("text"), t.documents).orderBy(F.desc("n"), "word")


@query("""WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
  words AS (SELECT list_filter(string_split(lower(regexp_replace(line, '[^0-9a-zA-Z ]', ' ', 'g')), ' '),
    lambda w: w <> '') AS w FROM lines)
  SELECT kmer, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w) - 1),
    lambda i: array_to_string(w[i:i+2], ' '))) AS kmer FROM words WHERE len(w) >= 3)
  GROUP BY 1 ORDER BY n DESC, kmer LIMIT 20""")
def agg_kmers(t):
    return ag.kmers(t.documents, "text", 3).orderBy(F.desc("n"), "kmer").limit(20)


# windows ------------------------------------------------------------------

@query("""SELECT user_id, event_id, value, rn AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 3""")
def win_topk_per_group(t):
    best = windows.top_k(t.events, ["user_id"], [F.desc("value"), F.col("event_id")], 3)
    return best.select("user_id", "event_id", "value", F.col("rank").cast("long").alias("rank"))


@query("""SELECT a.user_id, a.value AS latest, a.event_id AS latest_id, b.value AS before_mid FROM
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
   WHERE rn = 1) a LEFT JOIN
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
   WHERE ts < TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1) b ON a.user_id = b.user_id""")
def win_latest_version(t):
    order = ["ts", "event_id"]
    now = windows.latest(t.events, ["user_id"], order, ["value", "event_id"])
    early = t.events.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    before = windows.latest(early, ["user_id"], order, ["value"])
    return (now.withColumnsRenamed({"value": "latest", "event_id": "latest_id"})
            .join(before.withColumnRenamed("value", "before_mid"), "user_id", "left"))


@query("""SELECT DISTINCT event_type, value, round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 8) AS cume
  FROM events""")
def win_cume_dist(t):
    shares = windows.cume_dist(t.events, ["event_type"], "value")
    return shares.select("event_type", "value", F.round("cume", 8).alias("cume"))


@query("""SELECT event_id, lag(value, 1, 0.0) OVER w AS value_prev, lead(value, 1, 0.0) OVER w AS value_next
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag_lead(t):
    daily = t.events.withColumn("day", F.to_date("ts"))
    shifted = windows.neighbours(daily, ["user_id"], ["ts", "event_id"], "day", "value", 0.0)
    return shifted.select("event_id", "value_prev", "value_next")


@query("""SELECT user_id, movie_id, dense_rank() OVER (ORDER BY movie_id) - 1 AS item_no FROM f_ratings""")
def win_dense_ids(t):
    rated = fx.ratings(t).select("user_id", "movie_id")
    return rated.join(windows.dense_ids(rated, "movie_id", "item_no"), "movie_id")


@query("""SELECT user_id, round(sum(abs(value - p)), 4) AS gap FROM (SELECT user_id, value, lag(value, 1, value) OVER (
  PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1""")
def win_neighbor_gap(t):
    daily = t.events.withColumn("day", F.to_date("ts"))
    shifted = windows.neighbours(daily, ["user_id"], ["ts", "event_id"], "day", "value", None)
    gap = F.coalesce(F.abs(F.col("value") - F.col("value_prev")), F.lit(0.0))
    return shifted.groupBy("user_id").agg(F.round(F.sum(gap), 4).alias("gap"))


@query("""SELECT event_id, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS z FROM events
  WINDOW w AS (PARTITION BY user_id)""")
def win_group_normalize(t):
    return windows.normalise(t.events, ["user_id"], "value", "z").select("event_id", F.round("z", 6).alias("z"))


@query("""WITH r AS (SELECT user_id, movie_id, CAST(rating >= 4 AS INTEGER) AS label,
    avg(rating) OVER (PARTITION BY movie_id) AS m FROM f_ratings),
  c AS (SELECT user_id, least(sum(label), sum(1 - label)) AS keep FROM r GROUP BY 1),
  p AS (SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY CASE WHEN label = 1 THEN 0 ELSE -m END, movie_id)
    AS place FROM r)
  SELECT user_id, movie_id, label, place FROM p JOIN c USING (user_id) WHERE place <= keep""")
def win_head_balance(t):
    rated = fx.ratings(t)
    means = rated.groupBy("movie_id").agg(F.avg("rating").alias("m"))
    labelled = (rated.join(means, "movie_id")
                .select("user_id", "movie_id", (F.col("rating") >= 4).cast("int").alias("label"), "m"))
    labelled = materialise(labelled, "labelled-ratings")
    return (windows.head_balance(labelled, "user_id", "movie_id", "label", "m")
            .select("user_id", "movie_id", "label", "place"))


# order, limit, samples, partitions ---------------------------------------

@query("""SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderkey, o_totalprice FROM orders""")
def ord_sort(t):
    priced = t.orders.select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("neg"))
    placed = windows.position(priced, "neg", "o_orderkey", name="place").drop("neg")
    return placed.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("SELECT o_custkey, o_orderkey, true AS rises, true AS one_place FROM orders")
def ord_within(t):
    """Order inside a partition, shown by each row's place there: it rises with the keys, and a key has one partition."""
    placed = (t.orders.select("o_custkey", "o_orderkey").repartition(8, "o_custkey").sortWithinPartitions("o_custkey", "o_orderkey")
              .withColumn("place", F.monotonically_increasing_id()))
    placed = materialise(placed, "sorted-within")
    ends = placed.groupBy("o_custkey").agg(F.min(F.shiftright("place", 33)).alias("low"), F.max(F.shiftright("place", 33)).alias("high"))
    before = F.lag("place").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rises = placed.withColumn("rises", F.coalesce(before < F.col("place"), F.lit(True)))
    return rises.join(ends, "o_custkey").select("o_custkey", "o_orderkey", "rises", (F.col("low") == F.col("high")).alias("one_place"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10")
def ord_limit(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice").limit(10)


@query("""SELECT * FROM (SELECT 'top' AS side, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5)
  UNION ALL SELECT * FROM (SELECT 'bottom', l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 5)""")
def ord_topk(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    tie = ["l_orderkey", "l_linenumber"]
    top = lines.orderBy(F.desc("l_extendedprice"), *tie).limit(5).withColumn("side", F.lit("top"))
    bottom = lines.orderBy("l_extendedprice", *tie).limit(5).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


@query(f"""SELECT 'share' AS form, o_orderkey FROM orders
    WHERE {HASH.format('CAST(o_orderkey AS VARCHAR)')} < 429496729
  UNION ALL SELECT * FROM (SELECT 'exact', o_orderkey FROM orders
    ORDER BY {HASH.format('CAST(o_orderkey AS VARCHAR)')}, o_orderkey LIMIT 100)""")
def smp_sample(t):
    keys = t.orders.select("o_orderkey")
    share = sampling.hash_sample(keys, F.col("o_orderkey"), 0.1).withColumn("form", F.lit("share"))
    exact = sampling.exact_sample(keys, F.col("o_orderkey"), 100).withColumn("form", F.lit("exact"))
    return share.unionByName(exact)


def draws_sql(key: str, fraction: float, seed: int) -> str:
    chance, total, steps = math.exp(-fraction), 0.0, []
    for k in range(200):
        total += chance
        steps.append(min(int(total * 2**32), 2**32))
        if steps[-1] == 2**32 or total >= 1 - 2**-33:
            break
        chance *= fraction / (k + 1)
    return f"len(list_filter({steps}, lambda s: s <= CAST(('0x' || substr(md5({key} || ':{seed}'), 1, 8)) AS BIGINT)))"


@query(f"""SELECT o_orderkey, CAST(unnest(range(1, n + 1)) AS INTEGER) AS draw FROM (SELECT o_orderkey, {draws_sql('o_orderkey', 0.7, 3)} AS n FROM orders)""")
def smp_with_replacement(t):
    return sampling.poisson_sample(t.orders.select("o_orderkey"), F.col("o_orderkey"), 0.7, seed=3)


@query("""SELECT event_type, count(*) AS n, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN true ELSE false END AS kept, true AS share_right
  FROM events GROUP BY 1""")
def smp_stratified(t):
    """Each kind's rows, whether any are kept, and whether the share is that asked for, within five standard errors."""
    shares = {"view": 0.2, "click": 0.5, "purchase": 1.0}
    drawn = t.events.sampleBy("event_type", shares, seed=3).groupBy("event_type").agg(F.count("*").alias("k"))
    wanted = F.coalesce(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("event_type")], F.lit(0.0))
    whole = t.events.groupBy("event_type").agg(F.count("*").alias("n")).join(drawn, "event_type", "left").withColumns({"k": F.coalesce("k", F.lit(0)), "p": wanted})
    near = F.abs(F.col("k") - F.col("n") * F.col("p")) <= 5 * F.sqrt(F.col("n") * F.col("p") * (1 - F.col("p")))
    return whole.select("event_type", "n", (F.col("k") > 0).alias("kept"), near.alias("share_right"))


@query(f"""SELECT o_orderkey, CASE WHEN {HASH.format('CAST(o_orderkey AS VARCHAR)')} < 3435973836 THEN 'train' ELSE 'test' END
  AS part FROM orders""")
def smp_split(t):
    return sampling.hash_split(t.orders.select("o_orderkey"), F.col("o_orderkey"), 0.8)


@query(f"""WITH seen AS (SELECT DISTINCT user_id, movie_id AS item_id FROM f_ratings WHERE rating >= 4),
  pool AS (SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) - 1 AS slot FROM part),
  draws AS (SELECT DISTINCT user_id, {HASH.format("user_id || ':' || item_id || ':' || k || ':0'")}
      % (SELECT count(*) FROM pool) AS slot FROM seen, range(1, 4) AS g(k)),
  drawn AS (SELECT user_id, item_id FROM draws JOIN pool USING (slot) EXCEPT SELECT user_id, item_id FROM seen),
  ranked AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id
      ORDER BY {HASH.format("user_id || ':' || item_id")}, item_id) AS place FROM drawn)
  SELECT user_id, item_id FROM ranked JOIN (SELECT user_id, count(*) AS quota FROM seen GROUP BY 1) USING (user_id)
  WHERE place <= quota""")
def smp_negative(t):
    seen = fx.ratings(t).filter("rating >= 4").select("user_id", F.col("movie_id").alias("item_id"))
    pool = windows.dense_ids(t.part.select(F.col("p_partkey").alias("item_id")), "item_id", "slot")
    drawn = materialise(sampling.negatives(seen, pool), "drawn-negatives")
    placed = windows.position(drawn, "luck", "item_id", keys=["user_id"], name="place")
    return placed.filter(F.col("place") <= F.col("quota")).select("user_id", "item_id")


@query("SELECT o_orderkey % 10 AS digit, count(*) AS n, CAST(1 AS BIGINT) AS places FROM orders GROUP BY 1")
def par_repartition(t):
    last_digit = F.pmod("o_orderkey", F.lit(10))
    spread = t.orders.select("o_orderkey", last_digit.alias("digit")).repartition(10, "digit")
    return (spread.withColumn("partition_no", F.spark_partition_id())
            .groupBy("digit").agg(F.count("*").alias("n"), F.count_distinct("partition_no").alias("places")))


@query("""SELECT count(*) AS n, round(sum(l_extendedprice), 1) AS total, 'Disk Memory Serialized 1x Replicated' AS level FROM lineitem WHERE l_quantity > 25""")
def par_cache(t):
    lines = t.lineitem.filter("l_quantity > 25").select("l_orderkey", "l_extendedprice")
    lines.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        level = str(lines.storageLevel)
        totals = lines.agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 1).alias("total"))
        # Written while the cached rows are held; a lazy result would scan the files again.
        return materialise(totals.withColumn("level", F.lit(level)), "cached-totals")
    finally:
        lines.unpersist()


@query("SELECT count(*) AS n, true AS filter_pushed FROM lineitem WHERE l_quantity > 45")
def par_explain(t):
    filtered = t.lineitem.filter("l_quantity > 45").select("l_orderkey", "l_quantity")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        filtered.explain("formatted")
    pushed = "GreaterThan(l_quantity,45.0)" in shown.getvalue()
    return filtered.agg(F.count("*").alias("n")).withColumn("filter_pushed", F.lit(pushed))


# sets ---------------------------------------------------------------------

@query("""SELECT 'bag' AS form, k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
    GROUP BY 2
  UNION ALL SELECT 'set', k, 1 FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_union(t):
    a = t.customer.select(F.col("c_nationkey").alias("k"), F.lit("c").alias("side"))
    b = t.supplier.select(F.col("s_nationkey").alias("k"))
    bag = a.unionByName(b, allowMissingColumns=True).groupBy("k").agg(F.count("*").alias("n"))
    distinct = a.select("k").union(b).distinct().withColumn("n", F.lit(1).cast("long"))
    return bag.withColumn("form", F.lit("bag")).unionByName(distinct.withColumn("form", F.lit("set")))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query("""SELECT 'rows' AS form, k FROM (SELECT o_custkey AS k FROM f_dirty) WHERE k IS NULL OR k NOT IN
    (SELECT c_custkey FROM customer WHERE c_nationkey < 12)
  UNION ALL SELECT 'set', k FROM (SELECT o_custkey AS k FROM f_dirty EXCEPT
    SELECT c_custkey FROM customer WHERE c_nationkey < 12)""")
def set_except(t):
    left = fx.dirty_orders(t).select(F.col("o_custkey").alias("k"))
    right = t.customer.filter("c_nationkey < 12").select(F.col("c_custkey").alias("b"))
    kept = left.join(right.distinct(), F.col("k").eqNullSafe(F.col("b")), "left_anti")
    return kept.withColumn("form", F.lit("rows")).unionByName(left.subtract(right).withColumn("form", F.lit("set")))
