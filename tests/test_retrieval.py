"""Inner-product retrieval, factor models with long ids, and word neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import ratings, recall, retrieval, text
from larkspur.session import work_path

WIDTH = 10


@pytest.fixture(scope="module")
def factors(spark):
    """One channel of 4,000 items and one of 300, in clumps and of different lengths; 120 users with long ids."""
    rng = np.random.default_rng(3)
    clumps = rng.standard_normal((30, WIDTH))
    items = (clumps[rng.integers(0, 30, 4300)] * 0.7 + rng.standard_normal((4300, WIDTH))) * np.exp(rng.standard_normal((4300, 1)) * 0.4)
    users = clumps[rng.integers(0, 30, 120)] * 0.5 + rng.standard_normal((120, WIDTH))
    channel = [1 if i < 4000 else 2 for i in range(4300)]
    item_table = spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(zip(channel, items.tolist()))], "item_id long, channel_id int, vec array<double>").repartition(4)
    user_table = spark.createDataFrame([(10**12 + i, v) for i, v in enumerate(users.tolist())], "user_id long, vec array<double>").repartition(3)
    return user_table, item_table, users @ items.T


def truth(scores, user, low, high, k, gone=()):
    order = [i for i in np.argsort(-scores[user, low:high], kind="stable") + low if i not in gone]
    return order[:k]


def by_list(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["user_id"] - 10**12, r["channel_id"]), []).append((r["rank"], r["item_id"]))
    return {k: [i for _, i in sorted(v)] for k, v in out.items()}


def test_best_items_without_crossing(spark, factors):
    users, items, scores = factors
    gone = {u: set(truth(scores, u, 0, 4000, 5 if u % 2 else 40)) | {4000 + u} for u in range(0, 120, 3)}
    history = spark.createDataFrame([(10**12 + u, int(i)) for u, own in gone.items() for i in own], "user_id long, item_id long")
    best = retrieval.best_products(users, items, 20, history, patience=10)
    plan = best._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    got, hit = by_list(best), 0
    for u in range(120):
        assert got[u, 2] == truth(scores, u, 4000, 4300, 20, gone.get(u, ()))  # a small channel is exact
        assert len(got[u, 1]) == 20 and not set(got[u, 1]) & gone.get(u, set())
        hit += len(set(got[u, 1]) & set(truth(scores, u, 0, 4000, 20, gone.get(u, ()))))
    assert hit / (120 * 20) >= 0.9
    met = retrieval.candidates(users, items).where("channel_id = 1").count()
    assert met < 0.2 * 120 * 4000


def test_lists_leave_out_no_item(spark, factors):
    """Beyond 1,024 items too, with and without a history, whatever the cells are."""
    users, items, scores = factors
    gone = {u: set(truth(scores, u, 0, 4000, 30)[::2]) for u in range(0, 120, 2)}
    history = spark.createDataFrame([(10**12 + u, int(i)) for u, own in gone.items() for i in own], "user_id long, item_id long")
    for search in ({}, {"small": 10, "bands": 2}, {"most_cells": 3}, {"most_known": 0}):
        got = by_list(retrieval.best_products(users, items, 20, history, **search))
        assert got == {(u, c): truth(scores, u, *ends, 20, gone.get(u, ())) for u in range(120) for c, ends in ((1, (0, 4000)), (2, (4000, 4300)))}
    met = by_list(retrieval.candidates(users, items, share=0.25, least=50).withColumn("rank", -F.col("score")))
    assert all(met[u, c] == truth(scores, u, *ends, n) for u in range(120) for c, ends, n in ((1, (0, 4000), 1000), (2, (4000, 4300), 75)))


def test_recall_by_factors_does_not_depend_on_the_number_of_items(spark):
    """The lists of app_recall_merge, app_result_split and app_track_params, in a channel of 1,500 items."""
    from types import SimpleNamespace

    from larkspur.plans.recommend import factor_list

    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((1500, WIDTH)) * np.exp(rng.standard_normal((1500, 1)) * 0.3)).astype(np.float32)
    embeddings = spark.createDataFrame([(i, 0, v) for i, v in enumerate(vectors.tolist())], "vec_id long, label long, embedding array<float>").repartition(4)
    log = spark.createDataFrame([(u, 1, (7 * u + j) % 1500) for u in range(60) for j in range(9)], "user_id long, channel_id long, item_id long")
    got = {}
    for r in factor_list(SimpleNamespace(spark=spark, embeddings=embeddings, events=log.select("user_id")), log).collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = r["item_id"]
    scores = vectors[:60].astype(float) @ vectors.T.astype(float)
    assert {u: [own[i] for i in sorted(own)] for u, own in got.items()} == {
        u: truth(scores, u, 0, 1500, 10, {(7 * u + j) % 1500 for j in range(9)}) for u in range(60)}


def test_retrieval_edges(spark, factors):
    users, items, scores = factors
    own = users.withColumn("channel_id", F.lit(2))
    assert set(by_list(retrieval.best_products(own, items, 3))) == {(u, 2) for u in range(120)}
    none = items.limit(0)
    assert retrieval.best_products(users, none, 3).count() == 0 and retrieval.best_products(users.limit(0), items, 3).count() == 0
    odd = items.limit(3).unionByName(spark.createDataFrame([(None, 1, [0.0] * WIDTH), (7, None, [0.0] * WIDTH), (8, 1, None)], items.schema))
    assert retrieval.best_products(users, odd, 9).count() == 120 * 3
    same = spark.createDataFrame([(i, 1, [1.0, 0.0]) for i in range(50)], items.schema)  # ties by id
    one = spark.createDataFrame([(10**12, [0.5, 0.5])], users.schema)
    assert by_list(retrieval.best_products(one, same, 4, small=10)) == {(0, 1): [0, 1, 2, 3]}


def test_lists_are_cut_where_pairs_meet(spark, factors):
    users, items, scores = factors
    whole = {}
    for r in retrieval.candidates(users, items).collect():
        whole.setdefault((r["user_id"] - 10**12, r["channel_id"]), []).append((-r["score"], r["item_id"]))
    history = spark.createDataFrame([(10**12 + u, i) for u in range(0, 120, 2) for i in range(0, 4300, 3)], "user_id long, item_id long")
    for block in (200, 1 << 22):  # many blocks of users, or one
        best = retrieval.best_products(users, items, 20, history, block=block)
        joins = [line for line in best._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
        assert not any("cell" in line for line in joins)  # pairs are never rows
        got = by_list(best)
        for (u, c), found in whole.items():
            assert got[u, c] == [i for _, i in sorted(found) if u % 2 or i % 3][:20]


def test_lists_of_words_and_copies(spark):
    items = spark.createDataFrame([(f"w{i:03d}", 1, [1.0, float(i // 10)]) for i in range(90)] + [("w000", 1, [1.0, 50.0])],
                                  "item_id string, channel_id int, vec array<double>")
    users = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, -1.0]), (2, [float("nan"), 1.0])], "user_id long, vec array<double>")
    history = spark.createDataFrame([(1, "w000"), (1, "w089")], "user_id long, item_id string")
    got = {}
    for r in retrieval.best_products(users, items, 12, history).collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = r["item_id"], r["score"]
    # The user's two rows share one list; the words of one vector come in the order of their names.
    assert [got[1][i][0] for i in range(1, 13)] == [f"w{i:03d}" for i in range(80, 89)] + ["w070", "w071", "w072"]
    assert [got[2][i][0] for i in range(1, 13)] == ["w000"] * 2 + [f"w{i:03d}" for i in range(1, 11)]


def test_factor_model_keeps_long_ids(spark):
    rng = np.random.default_rng(5)
    taste = rng.integers(0, 2, 40)
    rows = [(10**13 + u, -(10**14) + i, 5.0 if taste[u] == i % 2 else 1.0) for u in range(40) for i in range(30) if (u * 7 + i) % 3]
    table = spark.createDataFrame(rows + [(None, 3, 1.0), (3, None, 1.0), (10**13, -(10**14), None)], "user_id long, movie_id long, rating double")
    model = ratings.fit_als(table, rank=4, rounds=8)
    assert model.users.count() == 40 and model.items.count() == 30
    assert ratings.rmse(model, table.where("rating is not null")) < 0.6
    path = work_path(spark, "factors")
    model.save(path)
    again = ratings.Factors.load(spark, path)
    a, b = (sorted((r["user_id"], r["item_id"], round(r["score"], 6)) for r in m.best(3).collect()) for m in (model, again))
    assert a == b and all(u >= 10**13 and i <= -(10**14) + 30 for u, i, _ in a)
    for u, i, _ in a:
        assert taste[u - 10**13] == (i + 10**14) % 2
    small = spark.createDataFrame([(u - 10**13, i + 10**14, r) for u, i, r in rows], "user_id long, movie_id long, rating double")
    assert abs(ratings.rmse(ratings.fit_als(small, rank=4, rounds=8), small) - ratings.rmse(model, table.where("rating is not null"))) < 0.1


def test_learning_curve_falls(spark, tables):
    from larkspur import fixtures as fx
    from larkspur.operators import sampling

    parts = sampling.hash_split(fx.ratings(tables), F.concat_ws("-", "user_id", "movie_id"), 0.8)
    rows = ratings.learning_curve(parts.filter("part = 'train'"), parts.filter("part = 'test'"), [1, 5], rank=4).orderBy("rounds").collect()
    assert rows[1]["train_rmse"] < rows[0]["train_rmse"]


def test_als_lists_are_full_where_the_channel_is(spark):
    rng = np.random.default_rng(8)
    clicks = [(u, i, int(rng.random() < 0.5)) for u in range(30) for i in range(60) if (u + i) % 4]
    table = spark.createDataFrame(clicks, "user_id long, item_id long, clicked int")
    channels = spark.createDataFrame([(i, 1 + i % 2) for i in range(60)], "item_id long, channel_id int")
    seen = table.where("clicked = 1")
    rows = recall.als_recall(table, channels, seen, per_user=10).collect()
    gone = {(u, i) for u, i, c in clicks if c}
    sizes = {}
    for r in rows:
        assert (r["user_id"], r["item_id"]) not in gone and r["channel_id"] == 1 + r["item_id"] % 2
        sizes[r["user_id"], r["channel_id"]] = max(r["rank"], sizes.get((r["user_id"], r["channel_id"]), 0))
    for u in range(30):
        for c in (1, 2):
            left = sum((u, i) not in gone for i in range(60) if 1 + i % 2 == c)
            assert sizes[u, c] == min(10, left)


def test_synonyms_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = {(c, f"w{c}-{i}"): rng.standard_normal(6) for c in (1, 2) for i in range(25)}
    words[1, "zero"] = np.zeros(6)
    table = spark.createDataFrame([(*k, v.tolist()) for k, v in words.items()], "channel_id int, keyword string, vec array<double>")
    got = {}
    for r in text.synonyms(table, k=4).collect():
        got.setdefault((r["channel_id"], r["keyword"]), []).append((r["rank"], r["synonym"]))
    assert (1, "zero") not in got
    for (c, w), v in words.items():
        if w != "zero":
            near = sorted((-float(v @ x / np.linalg.norm(v) / np.linalg.norm(x)), y) for (d, y), x in words.items() if d == c and y not in (w, "zero"))
            assert [s for _, s in sorted(got[c, w])] == [y for _, y in near[:4]]


def test_topic_bound_equals_sparks(spark):
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    from larkspur.operators import models

    rng = np.random.default_rng(1)
    docs = [([f"w{i}" for i in rng.integers(0, 20, 30) + 20 * (d % 2)],) for d in range(40)] + [([],)]
    table = spark.createDataFrame(docs, "w array<string>")
    counted = CountVectorizer(inputCol="w", outputCol="features").fit(table).transform(table)
    model = LDA(k=3, maxIter=5, seed=1, docConcentration=[0.25], topicConcentration=0.25).fit(counted)
    bound, n = models.topic_bound(model, counted, "features", 0.25, 0.25)
    assert n == 1200 and abs(bound / model.logLikelihood(counted) - 1) < 2e-3
    assert abs(-bound / n / model.logPerplexity(counted) - 1) < 2e-3


def test_word_vectors_fit_one_channel_at_a_time(spark, monkeypatch):
    rows = [(1, 1, ["red", "ring", "red"]), (2, 1, ["red", "ring", "ring"]), (3, 2, ["red", "wolf", "red"]), (4, 2, ["red"]), (5, 3, ["rare"])]
    table = spark.createDataFrame(rows, "article_id long, channel_id int, words array<string>")
    sizes, fit = [], text.Word2Vec.fit

    def counted(self, data):
        model = fit(self, data)
        sizes.append(model.getVectors().count())
        return model

    monkeypatch.setattr(text.Word2Vec, "fit", counted)
    got = text.word_vectors(table, size=5, min_count=3).collect()
    assert sorted((r["channel_id"], r["keyword"]) for r in got) == [(1, "red"), (1, "ring"), (2, "red")]
    assert all(len(r["vec"]) == 5 for r in got) and sorted(sizes) == [1, 2]  # never the words of all channels in one fit
    assert text.word_vectors(table.where("channel_id = 3"), size=5).count() == 0


def test_document_vectors_travel_once(spark):
    weights = spark.createDataFrame([(1, 1, "a", 2.0), (1, 1, "b", 2.0), (1, 1, "c", 1.0), (2, None, "a", 0.5)], "article_id long, channel_id int, keyword string, weight double")
    vectors = spark.createDataFrame([("a", [1.0, 0.5]), ("b", [1.0, 0.5]), ("c", [0.0, 4.0])], "keyword string, vec array<float>")
    docs = text.document_vectors(weights, vectors, ["keyword"])
    assert sorted((r["article_id"], r["vec"]) for r in docs.collect()) == [(1, [1.0, 2.5]), (2, [0.5, 0.25])]  # equal products count once
    plan = docs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning(article_id") == 1
