"""Properties of the queries that SQL cannot state exactly."""

import math

import oracle
import pytest
from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.operators import models, series, windows
from larkspur.plans import learning
from larkspur.plans.catalogue import CATALOGUE
from larkspur.session import work_path

# Known results of functions without a SQL twin.
CRC_OF_ABC, SOUNDEX_OF_ROBERT = 891568578, "R163"


# Queries whose rows say whether a property holds; SQL has the counts beside it.
CHECKED = ["par_cache", "par_explain", "par_repartition", "smp_stratified",
           "udf_nondeterministic", "udf_transformer", "udf_side_effect_partition", "fe_quantile_buckets", "fe_hashing_tf", "fe_poly", "fe_vector_indexer",
           "fe_rformula", "fe_pca", "fe_ctr_pipeline", "fe_chisq", "ml_logreg", "ml_tree_cls", "ml_rf_cls", "ml_gbt_cls", "ml_naive_bayes", "ml_svc", "ml_mlp",
           "ml_fm", "ml_gbt_lr", "ml_glm", "ml_tree_reg", "ml_rf_reg", "ml_gbt_reg", "ml_kmeans", "ml_gmm", "ml_pipeline_io",
           "ml_cross_validate", "ml_model_compare", "ml_fpgrowth", "ml_fpgrowth_rules", "ml_fpgrowth_predict", "smp_with_replacement", "sink_partitioned_table",
           "app_als_explicit", "app_als_grid", "app_word_vectors", "str_hot_windowed", "str_online_recall", "app_result_split", "app_track_params"]


@pytest.mark.parametrize("name", CHECKED)
def test_checked_by_sql(name, spark, duck):
    got = oracle.spark_rows(CATALOGUE[name](spark, "/root/testdata/sf0.001"))
    assert oracle.difference(got, oracle.duck_rows(duck, CATALOGUE[name].sql)) is None


def test_text_classifier_on_more_documents(spark):
    folder = "/root/testdata/sf0.01"  # the smallest folder has 24 unseen documents
    got = oracle.spark_rows(CATALOGUE["ml_text_classifier"](spark, folder))
    assert oracle.difference(got, oracle.duck_rows(oracle.duck(folder), CATALOGUE["ml_text_classifier"].sql)) is None


def test_known_function_values(spark):
    row = spark.range(1).select(F.crc32(F.lit("abc").cast("binary")).alias("crc"), F.soundex(F.lit("Robert")).alias("s"),
                                F.initcap(F.lit("ab cd")).alias("i"), F.conv(F.lit("ff"), 16, 10).alias("c"),
                                F.format_number(F.lit(1234.5), 2).alias("f")).first()
    assert tuple(row) == (CRC_OF_ABC, SOUNDEX_OF_ROBERT, "Ab Cd", "255", "1,234.50")


def test_hash_is_stable(run):
    assert run("fn_hash") == run("fn_hash")


def test_seeded_numbers_repeat(tables):
    drawn = [tables.orders.select("o_orderkey", F.rand(seed=11).alias("x"), F.randn(seed=11).alias("y")).collect() for _ in range(2)]
    assert drawn[0] == drawn[1] and len({r["x"] for r in drawn[0]}) == len(drawn[0])


def test_draws_with_replacement(spark):
    from larkspur.operators import sampling

    rows = spark.range(20_000)
    drawn = sampling.poisson_sample(rows, F.col("id"), 0.6, seed=2)
    times = {r["id"]: r["count"] for r in drawn.groupBy("id").count().collect()}
    n = sum(times.values())
    assert abs(n - 12_000) < 5 * math.sqrt(12_000)
    for k in (1, 2, 3):  # shares of rows drawn once, twice, three times
        p = math.exp(-0.6) * 0.6**k / math.factorial(k)
        assert abs(sum(c == k for c in times.values()) - 20_000 * p) < 5 * math.sqrt(20_000 * p)
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, sampling.poisson_sample(rows.repartition(7), F.col("id"), 0.6, seed=2).collect()))


def test_bad_jvm_class_fails(spark):
    from larkspur.functions import udfs

    with pytest.raises(Exception):
        udfs.register_jvm(spark, "no_such", "com.example.NoSuch", "string")


def test_recall_skips_seen_items(run, tables):
    seen = {(r["user_id"], r["item"]) for r in fx.actions_log(tables).filter("action in ('click', 'read')").collect()}
    rows = run("app_als_recall")
    assert rows and not any((r["user_id"], r["item_id"]) in seen for r in rows)


@pytest.mark.parametrize("name, keys, most", [("app_ctr_rank", ["user_id"], 100), ("app_ad_rank", ["user_id", "pid"], 10)])
def test_rankings_are_sorted(run, name, keys, most):
    groups = {}
    for r in run(name):
        groups.setdefault(tuple(r[k] for k in keys), []).append((r["rank"], r["score"]))
    for g in groups.values():
        scores = [s for _, s in sorted(g)]
        assert len(g) <= most and scores == sorted(scores, reverse=True) and all(0 <= s <= 1 for s in scores)


def test_als(run):
    assert all(0 <= r["pos"] < 10 for r in run("app_lfm"))
    grid = run("app_als_errors")
    assert min(grid, key=lambda r: r["rmse"])["chosen"] and sum(r["chosen"] for r in grid) >= 1


def test_new_user_gets_unliked_items(run, tables):
    liked = {r["movie_id"] for r in fx.movies(tables).filter(F.lower("title").contains("red ring")).collect()}
    rows = run("app_new_user_reco")
    assert 0 < len(rows) <= 10 and not liked & {r["movie_id"] for r in rows}


def test_category_fill_bounds(run):
    sizes = {}
    for r in run("app_category_recall_fill"):
        sizes[r["user_id"]] = sizes.get(r["user_id"], 0) + 1
        assert 1 <= r["place"] <= 20
    assert max(sizes.values()) <= 500


def test_fixed_point_of_personal_rank(spark, tables):
    from larkspur.operators import graph

    edges = fx.graph(tables).filter("src < 'u2' or dst < 'u2'").cache()
    roots = edges.filter("src like 'u%'").agg(F.min("src").alias("root"))
    exact = graph.personal_rank_exact(edges, roots, tolerance=1e-6).withColumn("score", F.col("score") * (1 - 0.8))
    sliced, nodes = graph.prepare(edges)
    moved = graph.one_round(sliced, nodes, roots, exact, 0.8).withColumnRenamed("score", "after")
    assert exact.join(moved, ["root", "node"]).agg(F.max(F.abs(F.col("score") - F.col("after")))).first()[0] < 1e-5


def test_components(spark, tables):
    import numpy as np

    covariance = series.nan_covariance(fx.series(tables).filter("measurement = 3")).cache()
    eigen = series.components(covariance).orderBy("rank").collect()
    u = np.array([r["vec"] for r in eigen])
    assert np.allclose(u @ u.T, np.eye(64), atol=1e-8)
    trace = sum(r["cov"][r["i"]] for r in covariance.collect())
    assert sum(r["eigval"] for r in eigen) == pytest.approx(trace)


def test_residuals_fall(tables):
    """Without undefined slots each orthonormal vector lowers what is left."""
    axes = series.trigonometric_basis(64, 3)
    whole = tables.embeddings.select("vec_id", F.lit(1).alias("measurement"), F.col("embedding").cast("array<double>").alias("vals"))
    basis = whole.select("measurement").distinct().select(
        "measurement", F.array_repeat(F.lit(0.0), 64).alias("means"), F.array(*[F.array(*[F.lit(x) for x in a]) for a in axes]).alias("axes"))
    errors = {r["vec_id"]: r for r in series.project(whole, axes, "vals").collect()}
    for r in series.decompose(whole, basis, 3).collect():
        assert 1 >= r["res_1"] >= r["res_2"] >= r["res_3"] and r["res_mean"] == pytest.approx(1)
        assert r["res_3"] * r["total_var"] == pytest.approx(errors[r["vec_id"]]["errors"][2], abs=1e-9)


def test_factorisation_score_is_the_formula(spark, tables):
    import numpy as np
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.functions import vector_to_array

    data = learning.line_samples(tables).limit(300).cache()
    model = FMClassifier(factorSize=3, maxIter=10, stepSize=0.01, seed=1).fit(data)
    w0, w, v = model.intercept, model.linear.toArray(), model.factors.toArray()
    for r in model.transform(data).select(vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("raw")).limit(20).collect():
        x = np.array(r["x"])
        want = w0 + x @ w + 0.5 * (((x @ v) ** 2) - (x**2) @ (v**2)).sum()
        assert r["raw"][1] == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_leaf_rules(spark, tables):
    from pyspark.ml.classification import GBTClassifier

    model = GBTClassifier(maxIter=3, maxDepth=2, seed=1).fit(learning.line_samples(tables))
    rules = models.leaf_rules(model)
    assert len({tree for tree, _, _ in rules}) == 3 and all("feature" in text for _, _, text in rules)


def test_clusters(run, tables):
    n = tables.embeddings.count()
    assert sum(r["n"] for r in run("ml_kmeans_centres")) == n and -1 <= run("ml_eval_cluster")[0]["silhouette"] <= 1
    assert sum(r["weight"] for r in run("ml_gmm_parts")) == pytest.approx(1)
    assert len(run("fe_pca_values")) == 3 * n


def test_topic_terms(run):
    rows = run("ml_lda")
    assert len(rows) == 40 and {r["topic"] for r in rows} == {0, 1, 2, 3}
    for topic in range(4):
        weights = [r["weight"] for r in sorted((r for r in rows if r["topic"] == topic), key=lambda r: r["rank"])]
        assert weights == sorted(weights, reverse=True)
    assert rows[0]["log_likelihood"] < 0 < rows[0]["log_perplexity"]


def test_curve_agrees_with_the_evaluator(spark, tables):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    from larkspur.operators import evaluation

    train, test = learning.halves(tables)
    model = LogisticRegression(maxIter=3, regParam=0.3).fit(train)
    scored = model.transform(test).cache()
    curve = evaluation.binary_curve(scored.select("label", vector_to_array("probability")[1].alias("score"))).cache()
    under = evaluation.areas(curve).first()
    for name, value in (("areaUnderROC", under["roc"]), ("areaUnderPR", under["pr"])):
        assert value == pytest.approx(BinaryClassificationEvaluator(metricName=name).evaluate(scored), abs=1e-3)
    best = evaluation.best_threshold(curve).first()
    summary = model.evaluate(test)
    assert best["f"] == pytest.approx(summary.fMeasureByThreshold.agg(F.max("F-Measure")).first()[0], abs=1e-6)
    rough = evaluation.binary_curve(scored.select("label", vector_to_array("probability")[1].alias("score")), steps=50)
    assert rough.count() <= 51 and evaluation.areas(rough).first()["roc"] == pytest.approx(under["roc"], abs=0.01)
    measures = {r["class"]: r for r in evaluation.class_measures(scored).collect()}
    each = MulticlassClassificationEvaluator(metricName="recallByLabel", metricLabel=1.0).evaluate(scored)
    assert measures[1.0]["recall"] == pytest.approx(each)
    odd = spark.createDataFrame([(0.5, 1.0), (None, 1.0), (0.5, None)], "score double, label double")
    one = evaluation.binary_curve(odd).first()
    assert (one["positives"], one["negatives"], one["recall"], one["fall_out"]) == (1, 0, 1.0, None)
    assert evaluation.areas(evaluation.binary_curve(odd)).first()["roc"] is None


def test_rules_equal_plain_lattice(spark):
    import random
    from itertools import combinations

    from pyspark.ml.fpm import FPGrowth

    from larkspur.operators import patterns

    rng = random.Random(3)
    baskets = [sorted({rng.choice("abcdefg") for _ in range(rng.randrange(1, 7))}) for _ in range(200)] + [["h"]]
    table = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "id long, items array<string>")
    sets = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.4).fit(table.select("items")).freqItemsets
    found = patterns.rules(sets, len(baskets), 0.4).collect()
    freq = {}
    for b in baskets:
        for k in range(1, len(b) + 1):
            for s in combinations(b, k):
                freq[s] = freq.get(s, 0) + 1
    freq = {s: n for s, n in freq.items() if n >= 0.1 * len(baskets)}
    want = {}
    for s, n in freq.items():
        for c in s:
            rest = tuple(x for x in s if x != c)
            if rest and n / freq[rest] >= 0.4:
                want[rest, c] = (n, n / freq[rest], n / freq[rest] / (freq[(c,)] / len(baskets)), n / len(baskets))
    got = {(tuple(r["antecedent"]), r["consequent"]): (r["freq"], r["confidence"], r["lift"], r["support"]) for r in found}
    assert got.keys() == want.keys() and max(len(a) for a, _ in got) >= 2
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    said = patterns.predictions(table, patterns.rules(sets, len(baskets), 0.4))
    for r in said.collect():
        assert r["prediction"] == sorted({c for a, c in want if set(a) <= set(r["items"]) and c not in r["items"]})


def test_features_chosen_by_p(spark):
    from larkspur.operators import features

    p = [0.001, 0.2, 0.03, 0.012, 0.9, 0.03]
    tests = spark.createDataFrame(list(enumerate(p)), "feature int, p double")
    got = {m: sorted(r["feature"] for r in features.chosen_by_p(tests, m, v).collect()) for m, v in
           {"top": 3, "percentile": 0.5, "fpr": 0.05, "fwe": 0.05, "fdr": 0.05}.items()}
    assert got == {"top": [0, 2, 3], "percentile": [0, 2, 3], "fpr": [0, 2, 3, 5], "fwe": [0], "fdr": [0, 2, 3, 5]}


def test_literal_cases(spark):
    """Null key, NaN, tie, duplicate key, zero-length vector, no words."""
    from larkspur.functions import vectors as vx
    from larkspur.operators import cleaning, text

    odd = spark.createDataFrame([(1, None, float("nan")), (1, "a", 2.0), (2, "a", 4.0), (3, "b", None)], "k int, s string, x double")
    missing = {r["column_name"]: r["n_missing"] for r in cleaning.missing_table(odd).collect()}
    assert missing == {"k": 0, "s": 1, "x": 2}
    assert [r["x"] for r in cleaning.fill_with_mean(odd, "x").orderBy("k", F.col("s").asc_nulls_first()).collect()] == [3.0, 2.0, 4.0, 3.0]
    latest = windows.latest(odd, ["s"], ["k"], ["x"])
    assert {r["s"]: r["x"] for r in latest.filter("s is not null").collect()} == {"a": 4.0, "b": None}
    zero = spark.range(1).select(vx.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("c"))
    assert zero.first()["c"] == 0.0
    empty = spark.createDataFrame([(1, 1, "a b <i>"), (2, 1, "word other word")], "article_id long, channel_id int, sentence string")
    words = text.tokenize(empty)
    assert {r["article_id"] for r in text.textrank(words).collect()} == {2}
    assert text.idf_table(text.term_counts(words), empty).count() == 2


def test_stream_categories(run):
    assert all(r["n"] >= 1 for r in run("str_category_recall"))


def test_every_other_query_has_rows(spark):
    names = ["app_item_similar", "join_lsh", "app_personal_rank_exact", "app_word_vector_values", "app_word_synonyms", "app_als_curve", "ml_logreg_summary",
             "ml_logreg_multi", "ml_model_areas"]
    for name in names:
        assert CATALOGUE[name](spark, "/root/testdata/sf0.001").limit(1).count() == 1
    assert work_path(spark, "x") != work_path(spark, "x")


def test_counted_lines_stand_for_all_lines(spark, tables):
    """Equal rows once with their number; the fit from them answers like that from all rows."""
    from larkspur.operators import models
    from larkspur.plans import learning

    for whole, counted in zip(learning.halves(tables), learning.counted_halves(tables)):
        each = {(r["features"], r["label"]): r["n"] for r in whole.groupBy("features", "label").agg(F.count("*").alias("n")).collect()}
        assert each == {(r["features"], r["label"]): r["n"] for r in counted.collect()}
    train, test = learning.counted_halves(tables)
    a, b = models.trees_then_logistic(trees=2, depth=3, rounds=5).fit(learning.halves(tables)[0]), models.trees_then_logistic(trees=2, depth=3, rounds=5, weight="n").fit(train)
    first, second = ({r["features"]: r["prediction"] for r in m.transform(test.drop("n") if m is a else test).collect()} for m in (a, b))
    assert sum(first[k] == second[k] for k in first) >= 0.98 * len(first)
