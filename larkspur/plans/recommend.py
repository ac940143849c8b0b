"""Recall, ranking, ratings and the user-item graph."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.operators import behaviour, graph, ranking, ratings, recall, sampling, text, windows
from larkspur.operators.retrieval import best_products
from larkspur.operators.serving import Feed
from larkspur.plans.content import LABELS, TFIDF, user_weights, word_tables
from larkspur.plans.registry import query
from larkspur.session import materialise, work_path

HASH = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT)"
FIRST_LIST = "0123456789abcd"


def items_log(t):
    return fx.actions_log(t).select(
        "user_id", F.col("item").cast("long").alias("item_id"), "channel_id", "action", F.col("action_time").alias("ts"))


def acted_on(log, *actions):
    return log.filter(F.col("action").isin(*actions)).select("user_id", "channel_id", "item_id").distinct()


# recall -------------------------------------------------------------------

def similar_sql(name: str, *actions: str) -> str:
    """Similar items of what a user did, without what the user has seen."""
    listed = ", ".join(f"'{a}'" for a in actions)
    return f"""{name} AS (SELECT c.user_id, c.channel_id, s.similar_id AS item_id, min(distance) AS distance FROM (
      SELECT DISTINCT user_id, channel_id, item FROM f_actions_log WHERE action IN ({listed})) c JOIN f_similar s ON s.item_id = c.item
    WHERE NOT EXISTS (SELECT 1 FROM f_actions_log h WHERE h.user_id = c.user_id AND h.item = s.similar_id) GROUP BY 1, 2, 3)"""


CLICKED, ACTED = ("click", "read"), ("click", "collect", "share")
CONTENT, ONLINE = similar_sql("content", *CLICKED), similar_sql("online", *ACTED)
FACTORS = """als AS (SELECT user_id, channel_id, item_id, rank FROM (SELECT u.user_id, v.channel_id, v.item_id,
      row_number() OVER (PARTITION BY u.user_id, v.channel_id ORDER BY list_dot_product(u.vec, v.vec) DESC, v.item_id) AS rank
    FROM f_user_factors u, f_item_vectors v WHERE NOT EXISTS (SELECT 1 FROM f_actions_log h WHERE h.user_id = u.user_id AND h.item = v.item_id))
  WHERE rank <= 10)"""
HOT = """hot AS (SELECT channel_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY uses DESC, item_id) AS rn
  FROM (SELECT channel_id, item AS item_id, count(*) AS uses FROM f_actions_log WHERE action NOT IN ('exposure', 'read') GROUP BY 1, 2))
  WHERE rn <= 10)"""
NEW = """fresh AS (SELECT channel_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY ts DESC, item_id) AS rn
  FROM (SELECT channel_id, item AS item_id, max(action_time) AS ts FROM f_actions_log GROUP BY 1, 2)) WHERE rn <= 100)"""
REQUESTS = f"""requests AS (SELECT DISTINCT user_id, channel_id, CASE WHEN contains('{FIRST_LIST}',
  substr(md5(CAST(user_id AS VARCHAR)), 1, 1)) THEN 'Algo-1' ELSE 'Algo-2' END AS strategy FROM f_actions_log)"""
MERGED = f"""{CONTENT}, {ONLINE}, {FACTORS}, {HOT}, {NEW}, {REQUESTS},
  history AS (SELECT user_id, channel_id, item AS item_id FROM f_actions_log WHERE action = 'exposure'
    UNION ALL SELECT user_id, 0, item FROM f_actions_log WHERE action = 'collect'),
  merged AS MATERIALIZED (SELECT DISTINCT u.user_id, u.channel_id, u.item_id, r.strategy FROM (
      SELECT user_id, channel_id, item_id FROM als UNION SELECT user_id, channel_id, item_id FROM content
      UNION SELECT user_id, channel_id, item_id FROM online
      UNION SELECT user_id, r.channel_id, item_id FROM requests r JOIN hot h ON r.channel_id = h.channel_id
      UNION SELECT user_id, r.channel_id, item_id FROM requests r JOIN fresh h ON r.channel_id = h.channel_id) u
    JOIN requests r ON u.user_id = r.user_id AND u.channel_id = r.channel_id
    WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = u.user_id AND h.item_id = u.item_id
      AND (h.channel_id = u.channel_id OR h.channel_id = 0)))"""
SERVED, PAGE, ROUNDS = 4, 6, 3


def feed_sql(rounds: int) -> str:
    """Rounds of the feed for all requests, one after the other: out1, out2 ... and what is still queued at the end (left)."""
    scored = HASH.format("user_id || ':' || item_id")
    parts = [MERGED, f"scored AS MATERIALIZED (SELECT user_id, channel_id, item_id, {scored} AS score FROM merged)",
             "out0 AS (SELECT user_id, channel_id, item_id, 0 AS place, '' AS origin FROM scored WHERE false)", "queue0 AS (SELECT *, 0 AS page FROM out0)"]
    for i in range(1, rounds + 1):
        gone = " UNION ALL ".join(f"SELECT user_id, channel_id, item_id FROM out{j}" for j in range(i))
        queued = " UNION ALL ".join(f"SELECT user_id, channel_id, item_id, place, page FROM queue{j}" for j in range(i))
        parts.append(f"""gone{i} AS MATERIALIZED ({gone}), open{i} AS MATERIALIZED (SELECT * FROM ({queued}) ANTI JOIN gone{i} USING (user_id, channel_id, item_id)),
  first{i} AS (SELECT user_id, channel_id, item_id, row_number() OVER (PARTITION BY user_id, channel_id ORDER BY place, item_id) AS place
    FROM open{i} JOIN (SELECT user_id, channel_id, min(page) AS page FROM open{i} GROUP BY 1, 2) USING (user_id, channel_id, page)),
  placed{i} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id, channel_id ORDER BY score DESC, item_id) AS place FROM scored
    ANTI JOIN open{i} USING (user_id, channel_id) ANTI JOIN gone{i} USING (user_id, channel_id, item_id)),
  out{i} AS MATERIALIZED (SELECT user_id, channel_id, item_id, place, 'waiting' AS origin FROM first{i} WHERE place <= {SERVED}
    UNION ALL SELECT user_id, channel_id, item_id, place, 'recall' FROM placed{i} WHERE place <= {SERVED}),
  queue{i} AS MATERIALIZED (SELECT user_id, channel_id, item_id, place, (place - {SERVED + 1}) // {PAGE} AS page FROM placed{i} WHERE place > {SERVED})""")
    gone = " UNION ALL ".join(f"SELECT user_id, channel_id, item_id FROM out{j}" for j in range(rounds + 1))
    queued = " UNION ALL ".join(f"SELECT user_id, channel_id, item_id, place FROM queue{j}" for j in range(rounds + 1))
    parts.append(f"gone AS ({gone}), waits AS (SELECT * FROM ({queued}) ANTI JOIN gone USING (user_id, channel_id, item_id))")
    return ", ".join(parts)


def content_list(t):
    log = items_log(t)
    clicked = acted_on(log, *CLICKED)
    return recall.content_recall(clicked, fx.item_similar(t, clicked), log)


def requests(log):
    return log.select("user_id", "channel_id").distinct().withColumn(
        "strategy", behaviour.ab_bucket(F.col("user_id"), FIRST_LIST, "Algo-1", "Algo-2"))


def factor_list(t, log):
    """Best items by given factors in the channels a user asks for, ranks within a channel, history out first."""
    asked = requests(log).select("user_id", "channel_id")
    return best_products(fx.user_factors(t).join(asked, "user_id"), fx.item_vectors(t), 10, log.select("user_id", "item_id"))


def merged(t):
    log = materialise(items_log(t), "items-log")
    similar = materialise(fx.item_similar(t, acted_on(log, *CLICKED, *ACTED)), "similar-items")
    shown = log.filter("action = 'exposure'").select("user_id", "channel_id", "item_id")
    kept = log.filter("action = 'collect'").select("user_id", F.lit(0).alias("channel_id"), "item_id")
    lists = {100: factor_list(t, log), 101: recall.content_recall(acted_on(log, *CLICKED), similar, log),
             102: recall.content_recall(acted_on(log, *ACTED), similar, log)}
    return recall.merge_recalls(requests(log), lists, {103: recall.new_items(log, 100), 104: recall.hot_items(log, 10)}, shown.unionByName(kept))


def rounds(t, n: int):
    """A feed after ``n`` rounds for everyone, and its requests."""
    found = materialise(merged(t).withColumn("score", sampling.hash_number(F.col("user_id"), F.col("item_id"))), "merged-recalls")
    everyone = materialise(requests(items_log(t)), "requests")
    feed = Feed(t.spark, work_path(t.spark, "feed"), served=SERVED, page=PAGE, buckets=8)
    for number in range(1, n + 1):
        feed.serve(number, everyone, lambda idle: found)
    return feed, everyone


@query(f"WITH {CONTENT} SELECT user_id, channel_id, item_id, distance FROM content")
def app_content_recall(t):
    return content_list(t)


@query(f"WITH {MERGED} SELECT user_id, channel_id, item_id, strategy FROM merged")
def app_recall_merge(t):
    return merged(t)


@query(f"WITH {feed_sql(ROUNDS)} " + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS round, user_id, channel_id, item_id, place, origin FROM out{i}" for i in range(1, ROUNDS + 1))
    + " UNION ALL SELECT CAST(0 AS BIGINT), user_id, channel_id, item_id, place, 'left' FROM waits")
def app_result_split(t):
    feed, everyone = rounds(t, ROUNDS)
    out = feed.history.read().select(F.col("batch_id").alias("round"), "user_id", "channel_id", "item_id", "place", "origin")
    left = feed.waiting(ROUNDS + 1, everyone).select(F.lit(0).cast("long").alias("round"), "user_id", "channel_id", "item_id", "place", F.lit("left").alias("origin"))
    return out.unionByName(left)


@query(f"""SELECT c_custkey, CASE WHEN contains('{FIRST_LIST}', substr(md5(CAST(c_custkey AS VARCHAR)), 1, 1))
  THEN 'Algo-1' ELSE 'Algo-2' END AS strategy FROM customer""")
def app_ab_bucket(t):
    return t.customer.select(
        "c_custkey", behaviour.ab_bucket(F.col("c_custkey"), FIRST_LIST, "Algo-1", "Algo-2").alias("strategy"))


def track_sql(action: str, items: str) -> str:
    return f"CAST(json_object('action', '{action}', 'userId', CAST(user_id AS VARCHAR), 'articleId', {items}, 'algorithmCombine', strategy) AS VARCHAR)"


@query(f"""WITH {feed_sql(1)}, lists AS (SELECT user_id, channel_id, strategy, list(item_id ORDER BY place) AS items
    FROM out1 JOIN requests USING (user_id, channel_id) GROUP BY 1, 2, 3),
  singles AS (SELECT *, unnest(items) AS item_id FROM lists)
  SELECT user_id, channel_id, {track_sql("exposure", "'[' || array_to_string(items, ', ') || ']'")} AS param, item_id AS article_id,
    """ + ", ".join(f'{track_sql(a, "CAST(item_id AS VARCHAR)")} AS "{a}"' for a in ("click", "collect", "share", "read")) + " FROM singles")
def app_track_params(t):
    feed, everyone = rounds(t, 1)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "item_id"))), lambda x: x["item_id"])
    lists = feed.history.read().join(everyone, ["user_id", "channel_id"]).groupBy("user_id", "channel_id", "strategy").agg(in_order.alias("items"))
    return recall.track_params(lists).select("user_id", "channel_id", "param", F.inline("recommends"))


@query()
def app_als_recall(t):
    basic = fx.user_article_basic(t)
    clicks = basic.select("user_id", F.col("article_id").cast("long").alias("item_id"), F.col("clicked").cast("int").alias("clicked"))
    channels = fx.articles(t).select(F.col("article_id").alias("item_id"), "channel_id")
    seen = items_log(t).filter(F.col("action").isin("click", "read"))
    return recall.als_recall(clicks, channels, seen, per_user=100)


# features and ranking -----------------------------------------------------

USER_WEIGHTS = f"""{LABELS}, uw AS (SELECT user_id, channel_id, list(weight ORDER BY weight DESC) AS w FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, channel_id ORDER BY weight DESC, encode(topic)) AS rn FROM weights) WHERE rn <= 10 GROUP BY 1, 2)"""
ITEM_WEIGHTS = f"""{TFIDF}, iw AS (SELECT article_id, list(tfidf ORDER BY tfidf DESC) AS w FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY tfidf DESC, encode(keyword)) AS rn FROM tfidf) WHERE rn <= 10 GROUP BY 1)"""


def item_features(t):
    _, _, counts, idf = word_tables(t)
    best = text.tfidf_topk(counts, idf).withColumnRenamed("tfidf", "weight")
    vectors = fx.item_vectors(t).withColumnRenamed("item_id", "article_id")
    return ranking.item_features(vectors, best.drop("channel_id"))


@query(f"""WITH {USER_WEIGHTS}, users AS (SELECT DISTINCT user_id FROM uw),
  cells AS (SELECT u.user_id, c.c AS channel_id, s.s AS slot FROM users u, range(1, 26) c(c), range(0, 10) s(s))
  SELECT c.user_id, CAST((c.channel_id - 1) * 10 + c.slot AS INTEGER) AS slot, round(coalesce(uw.w[c.slot + 1], 0), 8) AS v
  FROM cells c LEFT JOIN uw ON c.user_id = uw.user_id AND c.channel_id = uw.channel_id""")
def app_user_feature(t):
    vectors = ranking.user_features(user_weights(t))
    return vectors.select("user_id", F.posexplode("features").alias("slot", "v")).withColumn("v", F.round("v", 8))


@query(f"""WITH {ITEM_WEIGHTS}, f AS (SELECT item_id AS article_id, v.channel_id, list_concat(list_concat([CAST(v.channel_id AS DOUBLE)], v.vec),
    list_transform(range(1, 11), lambda i: coalesce(w[i], 0.0))) AS features FROM f_item_vectors v JOIN iw ON v.item_id = iw.article_id)
  SELECT article_id, CAST(u.pos - 1 AS INTEGER) AS slot, round(u.v, 6) AS v FROM f, unnest(f.features) WITH ORDINALITY AS u(v, pos)""")
def app_item_feature(t):
    return (item_features(t).select("article_id", F.posexplode("features").alias("slot", "v"))
            .withColumn("v", F.round("v", 6)))


def click_rows(t):
    users = ranking.user_channel_weights(user_weights(t))
    items = item_features(t).drop("channel_id").join(fx.articles(t).select("article_id", "channel_id"), "article_id")
    return users, items, ranking.training_rows(fx.user_article_basic(t), users, items)


@query(f"""WITH {USER_WEIGHTS}, {ITEM_WEIGHTS} SELECT b.user_id, b.article_id, CAST(b.clicked AS INTEGER) AS label,
    round(list_sum(uw.w), 6) AS user_sum, round(list_sum(v.vec) + v.channel_id + list_sum(iw.w), 5) AS item_sum
  FROM f_basic b JOIN f_item_vectors v ON v.item_id = b.article_id JOIN iw ON iw.article_id = b.article_id
  JOIN f_articles a ON a.article_id = b.article_id JOIN uw ON uw.user_id = b.user_id AND uw.channel_id = a.channel_id""")
def app_ctr_samples(t):
    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)

    rows = click_rows(t)[2]
    return rows.select("user_id", "article_id", "label", F.round(total("user_weights"), 6).alias("user_sum"),
                       F.round(total("features"), 5).alias("item_sum"))


@query()
def app_ctr_rank(t):
    users, items, _ = click_rows(t)
    users, items = materialise(users, "user-features"), materialise(items, "item-features")
    rows = materialise(ranking.training_rows(fx.user_article_basic(t), users, items), "click-rows")
    model = ranking.fit_clicks(rows)
    candidates = content_list(t).select("user_id", F.col("item_id").alias("article_id")).distinct()
    candidates = candidates.join(fx.articles(t).select("article_id", "channel_id"), "article_id", "left")
    return ranking.rank_candidates(model, candidates, users, items, width=75, k=100)


AD_ROWS = """SELECT coalesce(s.user_id, u.user_id) AS user_id, adgroup_id, clk, cate_id, cms_group, coalesce(pvalue_level, -1) AS pvalue_level
  FROM (SELECT coalesce(s.adgroup_id, a.adgroup_id) AS adgroup_id, s.user_id, s.clk, a.cate_id FROM f_ad_samples s
    FULL JOIN f_ads a ON s.adgroup_id = a.adgroup_id) s FULL JOIN f_shop_users u ON s.user_id = u.user_id"""


@query(AD_ROWS)
def app_ad_ctr_samples(t):
    rows = ranking.ad_rows(fx.ad_samples(t), fx.ads(t), fx.shop_users(t))
    return rows.select("user_id", "adgroup_id", "clk", "cate_id", "cms_group", "pvalue_level")


@query()
def app_ad_rank(t):
    samples = materialise(ranking.sample_rows(fx.ad_samples(t), fx.ads(t), fx.shop_users(t)), "ad-samples")
    latest = samples.select(F.max("ts")).scalar()
    rows = samples.na.drop(subset=["clk", "price", "cms_group"])
    train = rows.filter(F.col("ts") <= latest - 86400)
    model = ranking.ad_pipeline().fit(ranking.with_text_codes(train))
    return ranking.rank_ads(model, rows.drop("clk", "ts"), n=10)


# ratings ------------------------------------------------------------------

@query("""SELECT user_id, cate_id, round(0.2e0 * least(count(*) FILTER (btag = 'pv'), 20) + 0.4e0 * least(count(*) FILTER (btag = 'fav'), 20)
  + 0.6e0 * least(count(*) FILTER (btag = 'cart'), 20) + 1.0e0 * least(count(*) FILTER (btag = 'buy'), 20), 6) AS rating
  FROM f_behaviour GROUP BY 1, 2""")
def app_behaviour_score(t):
    return behaviour_ratings(t).withColumn("rating", F.round("rating", 6))


def behaviour_ratings(t):
    counts = fx.behaviour_log(t).groupBy("user_id", "cate_id").pivot("btag", ["pv", "fav", "cart", "buy"]).count()
    return ratings.behaviour_scores(counts).select("user_id", "cate_id", "rating")


@query("""SELECT user_id, """ + ", ".join(f"min(rating) FILTER (cate_id = {c}) AS c{c}" for c in range(20)) + """ FROM (
  SELECT user_id, cate_id, round(0.2e0 * least(count(*) FILTER (btag = 'pv'), 20) + 0.4e0 * least(count(*) FILTER (btag = 'fav'), 20)
  + 0.6e0 * least(count(*) FILTER (btag = 'cart'), 20) + 1.0e0 * least(count(*) FILTER (btag = 'buy'), 20), 6) AS rating
  FROM f_behaviour GROUP BY 1, 2) GROUP BY 1""")
def app_rating_matrix(t):
    wide = behaviour_ratings(t).groupBy("user_id").pivot("cate_id", list(range(20))).agg(F.min(F.round("rating", 6)))
    return wide.withColumnsRenamed({str(c): f"c{c}" for c in range(20)})


@query("SELECT count(*) AS n, true AS under_spread, true AS loaded_is_same FROM f_ratings")
def app_als_explicit(t):
    """Rated pairs, whether the fit errs less than the mean would, and whether the saved model says the same."""
    rated = materialise(fx.ratings(t), "ratings")
    model = ratings.fit_als(rated)
    path = work_path(t.spark, "factor-model")
    model.save(path)
    again = ratings.Factors.load(t.spark, path).transform(rated.select("user_id", "movie_id")).withColumnRenamed("prediction", "loaded")
    scored = model.transform(rated).join(again, ["user_id", "movie_id"])
    rmse = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)))
    return scored.agg(F.count("*").alias("n"), (rmse < F.stddev_pop("rating")).alias("under_spread"), F.bool_and(F.col("prediction") == F.col("loaded")).alias("loaded_is_same"))


@query()
def app_category_recall_fill(t):
    model = ratings.fit_als(behaviour_ratings(t), item="cate_id")
    predicted = model.best(20).select("user_id", F.col("item_id").alias("cate_id"), F.col("rank").alias("place"))
    return recall.category_fill(predicted, fx.ads(t).select("cate_id", F.col("adgroup_id").alias("item_id")))


MEANS = "means AS (SELECT movie_id, avg(rating) AS mean, count(*) AS n FROM f_ratings GROUP BY 1)"
CATEGORIES = """cats AS (SELECT DISTINCT movie_id, unnest(string_split(genres, '|')) AS category,
  round(1 / len(string_split(genres, '|')), 3) AS ratio FROM f_movies)"""
BEST = f"""{MEANS}, {CATEGORIES}, best AS (SELECT * FROM (SELECT category, c.movie_id, ratio, coalesce(mean, 0) AS mean, row_number() OVER (
  PARTITION BY category ORDER BY coalesce(mean, 0) DESC, c.movie_id) AS rank FROM cats c LEFT JOIN means m ON c.movie_id = m.movie_id) WHERE rank <= 10)"""
PROFILE = f"""{BEST}, liked AS (SELECT user_id, movie_id, rating * round(1 / (1 + ((SELECT max(ts) FROM f_ratings) - ts) / 86400 / 100), 3) AS r
    FROM f_ratings WHERE rating >= 4),
  top2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, encode(category)) AS rn FROM (
    SELECT user_id, category, round(sum(r * ratio), 6) AS score FROM liked l JOIN cats c ON l.movie_id = c.movie_id GROUP BY 1, 2)) WHERE rn <= 2),
  profile AS (SELECT user_id, category, round(score / sum(score) OVER (PARTITION BY user_id), 3) AS share FROM top2)"""


@query(f"WITH {MEANS} SELECT movie_id, CAST(round(CAST(mean AS DECIMAL(18, 9)), 3) AS DOUBLE) AS mean, n FROM means")
def app_mean_rating(t):
    return ratings.mean_ratings(fx.ratings(t)).withColumn("mean", F.round("mean", 3))


def best_items(t):
    categories = ratings.item_categories(fx.movies(t))
    return categories, ratings.best_per_category(categories, ratings.mean_ratings(fx.ratings(t)))


@query(f"WITH {BEST} SELECT category, movie_id, ratio, round(mean, 6) AS mean, rank FROM best")
def app_item_category_ratio(t):
    best = best_items(t)[1]
    return best.select("category", "movie_id", "ratio", F.round("mean", 6).alias("mean"), F.col("rank").cast("long").alias("rank"))


def taste(t):
    rated = fx.ratings(t)
    latest = rated.select(F.max("ts")).scalar()
    return ratings.user_category_profile(rated, best_items(t)[0], latest)


@query(f"WITH {PROFILE} SELECT user_id, category, share FROM profile")
def app_user_category_profile(t):
    return taste(t)


@query(f"""WITH {PROFILE} SELECT user_id, p.category AS category, movie_id, rank FROM profile p JOIN best b ON p.category = b.category
  WHERE rank <= CAST(floor(share * 10) AS INTEGER) + 1""")
def app_category_recommend(t):
    picks = ratings.recommend_by_category(taste(t), best_items(t)[1])
    return picks.withColumn("rank", F.col("rank").cast("long"))


@query("SELECT max(ts) AS latest FROM f_ratings")
def app_latest_ts(t):
    return fx.ratings(t).agg(F.max("ts").alias("latest"))


@query("""WITH r AS (SELECT * FROM f_ratings), u AS (SELECT user_id, count(*) AS n FROM r GROUP BY 1), m AS (SELECT movie_id, count(*) AS n FROM r GROUP BY 1),
  g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM f_movies)
  SELECT 'distinct ratings' AS question, count(DISTINCT rating) AS answer FROM r
  UNION ALL SELECT 'min per user', min(n) FROM u UNION ALL SELECT 'min per item', min(n) FROM m
  UNION ALL SELECT 'items rated once', count(*) FROM m WHERE n = 1
  UNION ALL SELECT 'users', count(*) FROM u UNION ALL SELECT 'items', count(*) FROM m
  UNION ALL SELECT 'items not rated', count(*) FROM f_movies WHERE movie_id NOT IN (SELECT movie_id FROM r)
  UNION ALL SELECT 'genres', count(DISTINCT genre) FROM g
  UNION ALL SELECT 'items of ' || genre, count(DISTINCT movie_id) FROM g GROUP BY genre
  UNION ALL SELECT 'ratings of ' || rating, count(*) FROM r GROUP BY rating""")
def app_rating_olap(t):
    fx.ratings(t).createOrReplaceTempView("larkspur_ratings")
    fx.movies(t).createOrReplaceTempView("larkspur_movies")
    return t.spark.sql("""WITH u AS (SELECT user_id, count(*) AS n FROM larkspur_ratings GROUP BY 1),
      m AS (SELECT movie_id, count(*) AS n FROM larkspur_ratings GROUP BY 1),
      g AS (SELECT movie_id, explode(split(genres, '[|]')) AS genre FROM larkspur_movies)
      SELECT 'distinct ratings' AS question, count(DISTINCT rating) AS answer FROM larkspur_ratings
      UNION ALL SELECT 'min per user', min(n) FROM u UNION ALL SELECT 'min per item', min(n) FROM m
      UNION ALL SELECT 'items rated once', count(*) FROM m WHERE n = 1
      UNION ALL SELECT 'users', count(*) FROM u UNION ALL SELECT 'items', count(*) FROM m
      UNION ALL SELECT 'items not rated', count(*) FROM larkspur_movies LEFT ANTI JOIN m USING (movie_id)
      UNION ALL SELECT 'genres', count(DISTINCT genre) FROM g
      UNION ALL SELECT concat('items of ', genre), count(DISTINCT movie_id) FROM g GROUP BY genre
      UNION ALL SELECT concat('ratings of ', rating), count(*) FROM larkspur_ratings GROUP BY rating""")


WANTED = "blue bolt 17"


@query(f"""SELECT movie_id, title, contains(lower(title), '{WANTED}') AS contains,
  round(100 * (1 - levenshtein(lower(title), '{WANTED}') / greatest(length(title), {len(WANTED)})), 6) AS ratio FROM f_movies
  WHERE contains(lower(title), '{WANTED}') OR 100 * (1 - levenshtein(lower(title), '{WANTED}') / greatest(length(title), {len(WANTED)})) >= 60""")
def app_title_match(t):
    return ratings.match_titles(fx.movies(t), WANTED).withColumn("ratio", F.round("ratio", 6))


@query("""WITH i AS (SELECT movie_id FROM f_ratings GROUP BY 1 HAVING count(*) >= 15), u AS (SELECT user_id FROM f_ratings GROUP BY 1 HAVING count(*) >= 15),
  r AS MATERIALIZED (SELECT user_id, movie_id, rating FROM f_ratings WHERE movie_id IN (FROM i) AND user_id IN (FROM u)),
  n AS (SELECT movie_id, sqrt(sum(rating * rating)) AS norm FROM r GROUP BY 1),
  q AS (SELECT min(movie_id) AS q FROM f_movies WHERE contains(lower(title), 'bolt') AND movie_id IN (SELECT movie_id FROM r)),
  d AS (SELECT a.movie_id AS query_id, b.movie_id, sum(a.rating * b.rating) AS dot FROM r a JOIN r b ON a.user_id = b.user_id AND a.movie_id <> b.movie_id
    WHERE a.movie_id = (SELECT q FROM q) GROUP BY 1, 2),
  s AS (SELECT query_id, d.movie_id, round(dot / (x.norm * y.norm), 9) AS cosine FROM d JOIN n x ON d.query_id = x.movie_id JOIN n y ON d.movie_id = y.movie_id)
  SELECT query_id, movie_id, cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, movie_id) AS rank FROM s)
  WHERE rank <= 10""")
def app_item_knn(t):
    active = ratings.active_part(fx.ratings(t), 15, 15)
    named = fx.movies(t).filter(F.lower("title").contains("bolt")).join(active, "movie_id", "left_semi")
    favourite = named.agg(F.min("movie_id").alias("movie_id"))
    near = ratings.item_neighbours(active, favourite, 10)
    return near.withColumn("rank", F.col("rank").cast("long"))


@query("""SELECT pairs, users, items, round(1 - pairs / (users * items), 8) AS empty, q50, q90 FROM
  (SELECT count(*) AS pairs, count(DISTINCT user_id) AS users, count(DISTINCT movie_id) AS items FROM f_ratings),
  (SELECT quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.9) AS q90 FROM (SELECT count(*) AS n FROM f_ratings GROUP BY movie_id))""")
def app_matrix_sparsity(t):
    rated = fx.ratings(t)
    counts = rated.groupBy("movie_id").agg(F.count("*").alias("n"))
    return ratings.sparsity(rated).withColumns({
        "empty": F.round("empty", 8), "q50": counts.select(F.percentile("n", F.lit(0.5))).scalar(),
        "q90": counts.select(F.percentile("n", F.lit(0.9))).scalar()})


@query("""SELECT factors, reg, true AS chosen_is_least FROM (VALUES (4), (8)) AS f(factors), (VALUES (0.05::DOUBLE), (0.2::DOUBLE)) AS r(reg)""")
def app_als_grid(t):
    tried = als_trials(t)
    least = F.min("rmse").over(Window.partitionBy())  # a row for each pair of settings
    return tried.withColumn("least", least).select("factors", "reg", (F.col("chosen") == (F.col("rmse") == F.col("least"))).alias("chosen_is_least"))


@query()
def app_als_errors(t):
    return als_trials(t)


@query()
def app_als_curve(t):
    """Error after 1, 2, 5 and 10 rounds, on what was fitted and on what was held back."""
    parts = materialise(sampling.hash_split(fx.ratings(t), F.concat_ws("-", "user_id", "movie_id"), 0.8), "ratings-split")
    return ratings.learning_curve(parts.filter("part = 'train'"), parts.filter("part = 'test'"), [1, 2, 5, 10])


def als_trials(t):
    parts = materialise(sampling.hash_split(fx.ratings(t), F.concat_ws("-", "user_id", "movie_id"), 0.8), "ratings-split")
    return ratings.als_grid(parts.filter("part = 'train'"), parts.filter("part = 'test'"), ranks=[4, 8], regs=[0.05, 0.2], rounds=3)


@query()
def app_new_user_reco(t):
    liked = fx.movies(t).filter(F.lower("title").contains("red ring")).select("movie_id")
    return ratings.recommend_for_new_user(fx.ratings(t), liked, n=10, least=20)


@query()
def app_lfm(t):
    rated = fx.ratings(t)
    means = rated.groupBy("movie_id").agg(F.avg("rating").alias("m"))
    labelled = rated.join(means, "movie_id").select(
        "user_id", "movie_id", (F.col("rating") >= 4).cast("int").alias("label"), "m")
    balanced = windows.head_balance(materialise(labelled, "labelled-ratings"), "user_id", "movie_id", "label", "m")
    signs = balanced.withColumn("sign", F.when(F.col("label") == 1, 1.0).otherwise(-1.0))
    model = ratings.fit_als(signs, rating="sign", rank=8)
    return model.best(10).select("user_id", F.col("item_id").alias("movie_id"), "score", (F.col("rank") - 1).alias("pos"))


# graph --------------------------------------------------------------------

def rank_sql(rounds: int) -> str:
    parts = ["deg AS (SELECT src, count(*) AS d FROM f_graph GROUP BY 1)", "e AS MATERIALIZED (SELECT g.src, g.dst, d FROM f_graph g JOIN deg USING (src))",
             "root AS (SELECT min(src) AS root FROM f_graph WHERE src LIKE 'u%')", "r0 AS (SELECT root AS node, 1.0e0 AS score FROM root)"]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS (SELECT node, sum(p) AS score FROM (SELECT e.dst AS node, 0.8e0 * r.score / e.d AS p FROM e JOIN r{i - 1} r
          ON e.src = r.node UNION ALL SELECT root, 1 - 0.8e0 FROM root) GROUP BY 1)""")
    return ", ".join(parts)


def first_user(edges):
    return edges.filter(F.col("src").startswith("u")).agg(F.min("src").alias("root"))


@query(f"""WITH {rank_sql(5)} SELECT root, node, score, rank FROM (SELECT root, node, round(score, 9) AS score, row_number() OVER (
  ORDER BY round(score, 9) DESC, node) AS rank FROM r5, root WHERE node LIKE 'item_%' AND node NOT IN (SELECT dst FROM f_graph WHERE src = root))
  WHERE rank <= 10""")
def app_personal_rank(t):
    edges = fx.graph(t)
    scores = graph.personal_rank(edges, first_user(edges), alpha=0.8, rounds=5)
    return graph.unseen_items(scores, edges, 10).withColumn("rank", F.col("rank").cast("long"))


@query()
def app_personal_rank_exact(t):
    edges = fx.graph(t)
    scores = graph.personal_rank_exact(edges, first_user(edges), alpha=0.8)
    return graph.unseen_items(scores, edges, 10)
