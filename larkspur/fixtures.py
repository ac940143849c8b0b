"""Stand-in views: the application tables, derived from the driver tables.

Each view exists twice, as a DataFrame function and as SQL text, by the same
rule.  ``as_of`` is fixed so that no job reads the clock.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.session import spread

AS_OF = "2024-02-01 00:00:00"
CHANNELS = 25


def event_item() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def actions_log(t) -> DataFrame:
    """Click log; an exposure row carries a JSON list of items."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "view", "exposure").when(kind == "click", "click")
        .when(kind == "purchase", "collect").when(kind == "signup", "share").otherwise("read")
    )
    k = F.col("item")
    shown = F.concat(F.lit("["), k, F.lit(", "), (k + 1) % 100, F.lit(", "), (k + 2) % 100, F.lit("]"))
    return (
        t.events.withColumn("item", event_item())
        .select(
            "event_id", "user_id", F.col("ts").alias("action_time"), action.alias("action"), "item",
            (k % CHANNELS + 1).alias("channel_id"),
            F.when(kind == "view", shown).otherwise(k.cast("string")).alias("article_text"),
            F.when(kind == "error", F.floor(F.col("value") * 10).cast("string"))
            .otherwise("").alias("read_time"),
        )
    )


def basic_rows(t) -> DataFrame:
    from larkspur.operators import behaviour

    return behaviour.flatten_actions(actions_log(t))


def user_article_basic(t) -> DataFrame:
    from larkspur.operators import behaviour

    return behaviour.merge_actions(basic_rows(t))


def articles(t) -> DataFrame:
    channel = F.regexp_extract("source", "([0-9]+)", 1).cast("int") + 1
    title = F.element_at(F.split("text", "\n"), 1)
    return spread(t.documents.select("doc_id", "source", "text")).select(
        F.col("doc_id").alias("article_id"), channel.alias("channel_id"),
        F.col("source").alias("channel_name"), title.alias("title"), F.col("text").alias("content"),
        F.concat_ws(",", "source", title, "text").alias("sentence"),
    )


def behaviour_log(t) -> DataFrame:
    kind = F.col("event_type")
    tag = (
        F.when(kind == "view", "pv").when(kind == "click", "fav")
        .when(kind == "signup", "cart").when(kind == "purchase", "buy")
    )
    return (
        t.events.filter(kind != "error")
        .select("event_id", "user_id", "ts", tag.alias("btag"),
                (event_item() % 20).alias("cate_id"), event_item().alias("brand_id"))
    )


def ratings(t) -> DataFrame:
    """One row per customer and part: the best rating and the last time."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"))
        .agg(F.max(F.ceil(F.col("l_quantity") / 10)).cast("int").alias("rating"),
             F.max(F.datediff("o_orderdate", F.lit("1970-01-01")) * F.lit(86400).cast("long")).alias("ts"))
    )


def movies(t) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("movie_id"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("title"),
        F.concat_ws("|", F.col("p_type"), F.replace("p_name", F.lit(" "), F.lit("|"))).alias("genres"),
    )


def ads(t) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        key.alias("adgroup_id"), F.pmod(key, F.lit(20)).cast("int").alias("cate_id"),
        F.pmod(key, F.lit(50)).cast("int").alias("campaign_id"),
        F.pmod(key, F.lit(30)).cast("int").alias("customer_id"),
        F.when(key % 13 == 0, "NULL").otherwise(F.regexp_extract("p_brand", "([0-9]+)", 1)).alias("brand_text"),
        F.col("p_retailprice").alias("price"),
    )


def ad_samples(t) -> DataFrame:
    lines = t.lineitem
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    clicked = (F.col("l_returnflag") == "R").cast("int")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        (F.datediff("o_orderdate", F.lit("1970-01-01")) * F.lit(86400).cast("long")).alias("ts"),
        F.col("l_partkey").alias("adgroup_id"), F.col("l_linestatus").alias("pid"),
        (1 - clicked).alias("nonclk"), clicked.alias("clk"),
    )


def shop_users(t) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("user_id"), (key % 4).cast("int").alias("cms_group"), (key % 2).cast("int").alias("gender"),
        (key % 7).cast("int").alias("age_level"),
        F.when(key % 5 == 0, F.lit(None)).otherwise((key % 3 + 1).cast("int")).alias("pvalue_level"),
        (key % 3 + 1).cast("int").alias("shopping_level"), (key % 2).cast("int").alias("occupation"),
        F.when(key % 4 == 0, F.lit(None)).otherwise((key % 4 + 1).cast("int")).alias("class_level"),
    )


def ctr_samples(t) -> DataFrame:
    """Pairs of vectors (id, id + 1) with a label and click features."""
    left = t.embeddings.select("vec_id", F.col("embedding").alias("user_embedding"), F.col("label").alias("grp"))
    right = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("item_embedding"))
    clicks = t.events.groupBy(event_item().cast("long").alias("k")).agg(
        F.sum((F.col("event_type") == "click").cast("int")).alias("clicks"), F.count("*").alias("shown"))
    docs = t.documents.select(F.col("doc_id").alias("vec_id"), "lang")
    labels = t.labels.select(F.col("doc_id").alias("vec_id"), "quality")
    return (
        left.join(right, "vec_id").join(docs, "vec_id").join(labels, "vec_id")
        .join(clicks, F.col("vec_id") % 100 == F.col("k"), "left")
        .select("vec_id", F.col("lang").alias("content_type"),
                F.coalesce("clicks", F.lit(0)).alias("user_item_click"),
                F.coalesce(F.col("shown"), F.lit(0)).cast("double").alias("user_item_imp"),
                F.coalesce(F.col("clicks") / F.col("shown"), F.lit(0.0)).alias("item_ctr"),
                (F.col("vec_id") % 3 == 0).cast("int").alias("is_new_user"),
                F.col("user_embedding").cast("array<double>").alias("user_embedding"),
                F.col("item_embedding").cast("array<double>").alias("item_embedding"),
                F.col("quality").alias("label"))
    )


def series(t) -> DataFrame:
    """Vector series with undefined slots, made by rule."""
    values = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x, j: F.when((F.col("vec_id") * 31 + j) % 17 == 0, F.lit(float("nan"))).otherwise(x),
    )
    return t.embeddings.select(
        "vec_id", (F.col("vec_id") % 10).cast("int").alias("station"),
        F.col("label").alias("measurement"), F.col("vec_id").alias("year"), values.alias("vals"),
    )


def dirty_orders(t) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.when(key % 11 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 17 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), "o_orderstatus",
    )


def graph(t) -> DataFrame:
    """User-item edges, both directions, for clicks and collects."""
    pairs = (
        actions_log(t).filter(F.col("action").isin("click", "collect"))
        .select(F.concat(F.lit("u"), "user_id").alias("u"), F.concat(F.lit("item_"), "item").alias("i"))
        .distinct()
    )
    return pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("src"), F.col("i").alias("dst")),
        F.struct(F.col("i").alias("src"), F.col("u").alias("dst")))).alias("e")).select("e.src", "e.dst")


def baskets(t) -> DataFrame:
    """Order with its distinct part types (at most six types exist)."""
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    parts = t.part.select("p_partkey", "p_type")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_type")).alias("items"))
    )


def item_vectors(t) -> DataFrame:
    return t.embeddings.select(
        F.col("vec_id").alias("item_id"), (F.col("label") + 1).alias("channel_id"),
        F.col("embedding").cast("array<double>").alias("vec"))


def item_similar(t, items: DataFrame) -> DataFrame:
    """The ten nearest items of the same channel, for every item of ``items`` (item_id)."""
    from larkspur.operators import similarity

    return similarity.nearest_to(items, item_vectors(t), k=10).select("item_id", "similar_id", "distance")


def user_factors(t) -> DataFrame:
    """A vector per user of the log, as a factor model would leave it."""
    n = t.embeddings.select(F.count("*")).scalar()
    users = t.events.select("user_id").distinct().withColumn("vec_id", F.pmod("user_id", n))
    return users.join(t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")), "vec_id").drop("vec_id")


VIEW_SQL: dict[str, str] = {
    "f_actions_log": """
        SELECT event_id, user_id, ts AS action_time,
          CASE event_type WHEN 'view' THEN 'exposure' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'collect'
               WHEN 'signup' THEN 'share' ELSE 'read' END AS action,
          k AS item, k % 25 + 1 AS channel_id,
          CASE WHEN event_type = 'view' THEN '[' || k || ', ' || (k + 1) % 100 || ', ' || (k + 2) % 100 || ']'
               ELSE CAST(k AS VARCHAR) END AS article_text,
          CASE WHEN event_type = 'error' THEN CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) ELSE '' END AS read_time
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "f_basic_rows": """
        SELECT event_id, user_id, action_time, CAST(unnest(
            CASE WHEN action = 'exposure' THEN CAST(from_json(article_text, '["INTEGER"]') AS INTEGER[])
                 ELSE [item] END) AS INTEGER) AS article_id, channel_id,
          action = 'share' AS shared, action IN ('click', 'read') AS clicked, action = 'collect' AS collected,
          true AS exposure, read_time
        FROM f_actions_log""",
    "f_basic": """
        SELECT user_id, article_id, max(action_time) AS action_time, max(channel_id) AS channel_id,
          bool_or(shared) AS shared, bool_or(clicked) AS clicked, bool_or(collected) AS collected,
          bool_or(exposure) AS exposure, coalesce(max(CAST(nullif(read_time, '') AS BIGINT)), 0) AS read_time
        FROM f_basic_rows GROUP BY user_id, article_id""",
    "f_articles": """
        SELECT doc_id AS article_id, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) + 1 AS channel_id,
          source AS channel_name, split_part(text, chr(10), 1) AS title, text AS content,
          concat_ws(',', source, split_part(text, chr(10), 1), text) AS sentence
        FROM documents""",
    "f_tokens": f"""
        SELECT article_id, channel_id, u.word AS word, u.pos AS pos FROM (
          SELECT article_id, channel_id, {tx.topic_words_sql('sentence')} AS words FROM f_articles) w,
          unnest(w.words) WITH ORDINALITY AS u(word, pos)""",
    "f_behaviour": """
        SELECT event_id, user_id, ts, CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
            WHEN 'signup' THEN 'cart' ELSE 'buy' END AS btag,
          CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS cate_id,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS brand_id
        FROM events WHERE event_type <> 'error'""",
    "f_ratings": """
        SELECT o_custkey AS user_id, l_partkey AS movie_id, CAST(max(ceil(l_quantity / 10)) AS INTEGER) AS rating,
          max(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "f_movies": """
        SELECT p_partkey AS movie_id, p_name || ' ' || p_partkey AS title,
          p_type || '|' || replace(p_name, ' ', '|') AS genres FROM part""",
    "f_ads": """
        SELECT p_partkey AS adgroup_id, CAST(p_partkey % 20 AS INTEGER) AS cate_id,
          CAST(p_partkey % 50 AS INTEGER) AS campaign_id, CAST(p_partkey % 30 AS INTEGER) AS customer_id,
          CASE WHEN p_partkey % 13 = 0 THEN 'NULL' ELSE regexp_extract(p_brand, '([0-9]+)', 1) END AS brand_text,
          p_retailprice AS price FROM part""",
    "f_ad_samples": """
        SELECT o_custkey AS user_id,
          date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 AS ts,
          l_partkey AS adgroup_id, l_linestatus AS pid,
          1 - CAST(l_returnflag = 'R' AS INTEGER) AS nonclk, CAST(l_returnflag = 'R' AS INTEGER) AS clk
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "f_shop_users": """
        SELECT c_custkey AS user_id, CAST(c_custkey % 4 AS INTEGER) AS cms_group,
          CAST(c_custkey % 2 AS INTEGER) AS gender, CAST(c_custkey % 7 AS INTEGER) AS age_level,
          CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 3 + 1 AS INTEGER) END AS pvalue_level,
          CAST(c_custkey % 3 + 1 AS INTEGER) AS shopping_level, CAST(c_custkey % 2 AS INTEGER) AS occupation,
          CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 4 + 1 AS INTEGER) END AS class_level FROM customer""",
    "f_ctr": """
        SELECT a.vec_id, d.lang AS content_type, CAST(coalesce(c.clicks, 0) AS BIGINT) AS user_item_click,
          CAST(coalesce(c.shown, 0) AS DOUBLE) AS user_item_imp, coalesce(c.clicks / c.shown, 0.0) AS item_ctr,
          CAST(a.vec_id % 3 = 0 AS INTEGER) AS is_new_user, CAST(a.embedding AS DOUBLE[]) AS user_embedding,
          CAST(b.embedding AS DOUBLE[]) AS item_embedding, l.quality AS label
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
        JOIN documents d ON d.doc_id = a.vec_id JOIN labels l ON l.doc_id = a.vec_id
        LEFT JOIN (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
            count(*) FILTER (event_type = 'click') AS clicks, count(*) AS shown FROM events GROUP BY 1) c
          ON a.vec_id % 100 = c.k""",
    "f_series_long": """
        SELECT vec_id, CAST(vec_id % 10 AS INTEGER) AS station, label AS measurement, vec_id AS year,
          CAST(u.pos - 1 AS INTEGER) AS slot,
          CASE WHEN (vec_id * 31 + u.pos - 1) % 17 = 0 THEN CAST('nan' AS DOUBLE) ELSE CAST(u.x AS DOUBLE) END AS val
        FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, pos)""",
    "f_dirty": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 17 = 0 THEN CAST('nan' AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority, o_orderstatus
        FROM orders""",
    "f_graph": """
        SELECT src, dst FROM (
          SELECT DISTINCT 'u' || user_id AS u, 'item_' || item AS i FROM f_actions_log
          WHERE action IN ('click', 'collect')) p, unnest([{'src': u, 'dst': i}, {'src': i, 'dst': u}]) AS e(e),
          LATERAL (SELECT e.e.src AS src, e.e.dst AS dst)""",
    "f_baskets": """
        SELECT l_orderkey, list_sort(list(DISTINCT p_type)) AS items
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "f_similar": """
        SELECT item_id, similar_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY item_id
            ORDER BY distance, similar_id) AS rn FROM (
          SELECT a.item_id, b.item_id AS similar_id, round(list_distance(a.vec, b.vec), 9) AS distance
          FROM f_item_vectors a JOIN f_item_vectors b ON a.channel_id = b.channel_id AND a.item_id <> b.item_id)) WHERE rn <= 10""",
    "f_user_factors": """
        SELECT user_id, CAST(embedding AS DOUBLE[]) AS vec FROM (SELECT DISTINCT user_id FROM events) u
        JOIN embeddings e ON e.vec_id = u.user_id % (SELECT count(*) FROM embeddings)""",
    "f_item_vectors": """
        SELECT vec_id AS item_id, label + 1 AS channel_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
}


def with_views(names: list[str], sql: str) -> str:
    """Put the text of every view the SQL mentions, direct or not, in front of it."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in VIEW_SQL and name not in needed:
            mentioned(VIEW_SQL[name])
            needed.append(name)

    def mentioned(body: str) -> None:
        for word in sorted(set(re.findall(r"\bf_[a-z_]+\b", body))):
            add(word)

    mentioned(sql)
    for name in names:
        add(name)
    parts = [f"{name} AS ({VIEW_SQL[name].strip()})" for name in needed]
    if not parts:
        return sql.strip()
    return f"WITH {', '.join(parts)} SELECT * FROM ({sql.strip()}) AS result"
