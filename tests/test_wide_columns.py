"""Wide columns are moved last, or as they are."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import ranking, ratings


def _plan(df, kind):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_features_are_joined_last(spark):
    basic = spark.createDataFrame([(7, 1, True), (7, 2, False), (8, 1, True), (9, 3, True)], "user_id long, article_id long, clicked boolean")
    items = spark.createDataFrame([(1, 1, [1.0]), (1, 1, [2.0]), (1, 2, [3.0]), (2, None, [4.0])], "article_id long, channel_id int, features array<double>")
    users = spark.createDataFrame([(7, 1, [0.5]), (8, 2, [0.25]), (7, None, [9.0])], "user_id long, channel_id int, weights array<double>")
    rows = ranking.training_rows(basic, users, items)
    got = sorted((r["user_id"], r["article_id"], r["label"], r["features"][0], r["user_weights"][0]) for r in rows.collect())
    assert got == [(7, 1, 1, 1.0, 0.5), (7, 1, 1, 2.0, 0.5), (8, 1, 1, 3.0, 0.25)]
    last = next(line for line in _plan(rows, "optimizedPlan").splitlines() if "Join" in line)
    assert "article_id" in last and "user_id" not in last


def test_factors_stay_floats(spark):
    rated = spark.range(60).select((F.col("id") % 6).alias("user_id"), (F.col("id") % 7).alias("movie_id"), (F.col("id") % 5 + 1).alias("rating"))
    model = ratings.fit_als(rated, rank=2, rounds=1)
    assert all(df.schema["vec"].dataType == T.ArrayType(T.FloatType(), df.schema["vec"].dataType.containsNull) for df in (model.users, model.items))
    assert ratings.rmse(model, rated.withColumn("other", F.lit("x"))) == ratings.rmse(model, rated)
