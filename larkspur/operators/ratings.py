"""Ratings: means, categories, taste profiles, neighbours, factor models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import vectors as vx
from larkspur.operators import windows
from larkspur.operators.retrieval import best_products
from larkspur.session import materialise, shared_folder

# Weight of each kind of behaviour.
BEHAVIOUR_WEIGHTS = {"pv": 0.2, "fav": 0.4, "cart": 0.6, "buy": 1.0}


def behaviour_scores(counts: DataFrame) -> DataFrame:
    """Sum of weight x min(count, 20) over the four kinds; no count is 0."""
    score = sum((F.least(F.coalesce(F.col(c), F.lit(0)), F.lit(20)) * F.lit(w) for c, w in BEHAVIOUR_WEIGHTS.items()),
                F.lit(0.0))
    return counts.withColumn("rating", score)


def mean_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movie_id").agg(F.avg("rating").alias("mean"), F.count("*").alias("n"))


def item_categories(movies: DataFrame) -> DataFrame:
    """One row per item and category, each with an equal share of the item."""
    names = F.split("genres", "[|]")
    return movies.select("movie_id", F.explode(names).alias("category"), F.round(1 / F.size(names), 3).alias("ratio")).distinct()


def best_per_category(categories: DataFrame, means: DataFrame, k: int = 10) -> DataFrame:
    scored = categories.join(means, "movie_id", "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    return windows.top_k(scored, ["category"], [F.desc("mean"), F.asc("movie_id")], k)


def time_score(ts: Column, latest: Column) -> Column:
    """1 / (1 + days / 100), three places."""
    return F.round(1 / (1 + (latest - ts) / 86400 / 100), 3)


def user_category_profile(ratings: DataFrame, categories: DataFrame, latest: Column, least: float = 4.0,
                          keep: int = 2) -> DataFrame:
    """Best categories of a user with shares that sum to 1."""
    liked = ratings.filter(F.col("rating") >= least).withColumn("fresh", time_score(F.col("ts"), latest))
    scored = (
        liked.join(categories, "movie_id")
        .groupBy("user_id", "category")
        .agg(F.round(F.sum(F.col("rating") * F.col("fresh") * F.col("ratio")), 6).alias("score"))
    )
    best = windows.top_k(scored, ["user_id"], [F.desc("score"), F.asc("category")], keep).drop("rank")
    totals = best.groupBy("user_id").agg(F.sum("score").alias("total"))
    return best.join(totals, "user_id").select("user_id", "category", F.round(F.col("score") / F.col("total"), 3).alias("share"))


def recommend_by_category(profile: DataFrame, best: DataFrame, k: int = 10) -> DataFrame:
    """int(k x share) + 1 items from each category of the profile."""
    quota = profile.withColumn("quota", F.floor(F.col("share") * k) + 1)
    return quota.join(best, "category").filter(F.col("rank") <= F.col("quota")).select("user_id", "category", "movie_id", "rank")


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """100 x (1 - edit distance / longer length)."""
    return 100 * (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def match_titles(movies: DataFrame, wanted: str, least: float = 60.0) -> DataFrame:
    """Titles that contain the text, or come close to it, best first."""
    title = F.lower("title")
    found = movies.select("movie_id", "title", title.contains(wanted).alias("contains"),
                          fuzzy_ratio(title, F.lit(wanted)).alias("ratio"))
    return found.filter(F.col("contains") | (F.col("ratio") >= least)).orderBy(
        F.desc("contains"), F.desc("ratio"), "movie_id")


def active_part(ratings: DataFrame, least_item: int, least_user: int) -> DataFrame:
    """Ratings of items and by users with enough of them."""
    items = ratings.groupBy("movie_id").agg(F.count("*").alias("n")).filter(F.col("n") >= least_item).select("movie_id")
    users = ratings.groupBy("user_id").agg(F.count("*").alias("n")).filter(F.col("n") >= least_user).select("user_id")
    return ratings.join(items, "movie_id", "left_semi").join(users, "user_id", "left_semi")


def item_neighbours(ratings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``k`` items nearest to each query item by cosine over users (exact).

    Every rating meets only the query items its user rated, so the work is the
    number of ratings times the number of queries, never all pairs of a user's
    items.
    """
    norms = ratings.groupBy("movie_id").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))
    asked = ratings.join(queries.select("movie_id").distinct(), "movie_id", "left_semi").select(
        "user_id", F.col("movie_id").alias("query_id"), F.col("rating").alias("query_rating"))
    dots = (
        ratings.join(asked, "user_id").filter(F.col("movie_id") != F.col("query_id"))
        .groupBy("query_id", "movie_id").agg(F.sum(F.col("rating") * F.col("query_rating")).alias("dot"))
    )
    query_norms = norms.select(F.col("movie_id").alias("query_id"), F.col("norm").alias("query_norm"))
    scored = dots.join(norms, "movie_id").join(query_norms, "query_id").withColumn(
        "cosine", F.round(F.col("dot") / (F.col("norm") * F.col("query_norm")), 9))
    return windows.top_k(scored, ["query_id"], [F.desc("cosine"), F.asc("movie_id")], k).select(
        "query_id", "movie_id", "cosine", "rank")


def sparsity(ratings: DataFrame) -> DataFrame:
    """Share of empty cells of the user-item matrix."""
    return ratings.agg(
        F.count("*").alias("pairs"), F.count_distinct("user_id").alias("users"), F.count_distinct("movie_id").alias("items")
    ).withColumn("empty", 1 - F.col("pairs") / (F.col("users") * F.col("items")))


@dataclass(frozen=True)
class Factors:
    """A factor model under the ids it was fitted with: tables (user, vec) and (item, vec)."""

    users: DataFrame
    items: DataFrame
    user: str
    item: str

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; rows of unknown users or items are dropped."""
        known = pairs.join(self.users.withColumnRenamed("vec", "_u"), self.user).join(self.items.withColumnRenamed("vec", "_i"), self.item)
        return known.withColumn("prediction", vx.dot(F.col("_u"), F.col("_i"))).drop("_u", "_i")

    def best(self, k: int, history: DataFrame | None = None, channels: DataFrame | None = None, **search) -> DataFrame:
        """``k`` best items per user (and channel of ``channels``: item, channel_id) outside the history, with rank."""
        items = self.items.select(F.col(self.item).alias("item_id"), "vec")
        items = items.join(channels.select(F.col(self.item).alias("item_id"), "channel_id"), "item_id") if channels is not None else items.withColumn("channel_id", F.lit(0))
        users = self.users.select(F.col(self.user).alias("user_id"), "vec")
        past = None if history is None else history.select(F.col(self.user).alias("user_id"), F.col(self.item).alias("item_id"))
        return best_products(users, items, k, past, **search)

    def save(self, path: str) -> None:
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Factors:
        users, items = spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items")
        return cls(users, items, users.columns[0], items.columns[0])


def _numbered(ratings: DataFrame, column: str, low: int | None, high: int | None) -> DataFrame:
    """(column, number) with numbers that fit 32 bits: the ids themselves where they do, else their places in order."""
    if low is None or (low >= -(1 << 31) and high < 1 << 31):
        return ratings.select(column).distinct().withColumn("number", F.col(column).cast("int"))
    return windows.dense_ids(ratings, column, "number").withColumn("number", F.col("number").cast("int"))


def fit_als(ratings: DataFrame, *, user: str = "user_id", item: str = "movie_id", rating: str = "rating", rank: int = 10,
            reg: float = 0.1, rounds: int = 5, implicit: bool = False, seed: int = 1) -> Factors:
    """Alternating least squares over long ids; rows with a null id or rating take no part.

    The fit works on 32-bit numbers.  Ids beyond them are numbered in order first, so none is cut.
    """
    shared_folder(ratings.sparkSession)
    typed = ratings.select(F.col(user).cast("long").alias(user), F.col(item).cast("long").alias(item), F.col(rating).cast("float").alias("_r"))
    typed = typed.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col("_r").isNotNull())
    ends = typed.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate((user, item)) for f in (F.min, F.max)]).first()
    small = all(x is None or -(1 << 31) <= x < 1 << 31 for x in ends)
    if small:
        numbered = typed.select(F.col(user).cast("int").alias("_user"), F.col(item).cast("int").alias("_item"), "_r")
    else:
        typed = materialise(typed, "long-id-ratings")
        names = [materialise(_numbered(typed, c, ends[2 * i], ends[2 * i + 1]), "id-numbers") for i, c in enumerate((user, item))]
        numbered = typed.join(names[0].withColumnRenamed("number", "_user"), user).join(names[1].withColumnRenamed("number", "_item"), item).select("_user", "_item", "_r")
    model = ALS(userCol="_user", itemCol="_item", ratingCol="_r", rank=rank, regParam=reg, maxIter=rounds,
                implicitPrefs=implicit, coldStartStrategy="drop", checkpointInterval=5, seed=seed).fit(numbered)
    sides = []
    for i, (factors, column) in enumerate(((model.userFactors, user), (model.itemFactors, item))):
        vec = F.col("features").alias("vec")  # floats, as they were fitted: half the bytes in every join
        sides.append(factors.select(F.col("id").cast("long").alias(column), vec) if small
                     else factors.join(names[i], F.col("id") == F.col("number")).select(column, vec))
    return Factors(*sides, user, item)


def rmse(model: Factors, ratings: DataFrame) -> float:
    return RegressionEvaluator(labelCol="rating", metricName="rmse").evaluate(model.transform(ratings.select(model.user, model.item, "rating")))


def als_grid(train: DataFrame, valid: DataFrame, ranks: Sequence[int], regs: Sequence[float], rounds: int) -> DataFrame:
    """RMSE of every (rank, reg); the best has ``chosen``."""
    scores = [(rank, reg, rmse(fit_als(train, rank=rank, reg=reg, rounds=rounds), valid)) for rank in ranks for reg in regs]
    best = min(s[2] for s in scores)
    return train.sparkSession.createDataFrame(
        [(rank, reg, value, value == best) for rank, reg, value in scores],
        "factors int, reg double, rmse double, chosen boolean")


def learning_curve(train: DataFrame, valid: DataFrame, rounds: Sequence[int], rank: int = 10, reg: float = 0.1) -> DataFrame:
    """Error on both parts after each number of rounds, as a check of whether the fit still gains."""
    rows = []
    for n in rounds:
        model = fit_als(train, rank=rank, reg=reg, rounds=n)
        rows.append((n, rmse(model, train), rmse(model, valid)))
    return train.sparkSession.createDataFrame(rows, "rounds int, train_rmse double, valid_rmse double")


def recommend_for_new_user(ratings: DataFrame, liked: DataFrame, n: int, least: int = 25, new_user: int = -1) -> DataFrame:
    """Refit with a user who likes the given items; best unseen items with enough ratings."""
    added = liked.select(F.lit(new_user).alias("user_id"), "movie_id", F.lit(5).alias("rating"))
    model = fit_als(ratings.select("user_id", "movie_id", "rating").unionByName(added))
    known = mean_ratings(ratings).filter(F.col("n") >= least).select("movie_id")
    unseen = known.join(liked.select("movie_id"), "movie_id", "left_anti").withColumn("user_id", F.lit(new_user))
    return model.transform(unseen).orderBy(F.desc("prediction"), "movie_id").limit(n).select("movie_id", "prediction")
