"""Vector series, feature stages, models and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, FMClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import (
    IDF, Binarizer, Bucketizer, CountVectorizer, CountVectorizerModel, ElementwiseProduct, HashingTF, IndexToString, MaxAbsScaler,
    MinMaxScaler, NGram, Normalizer, OneHotEncoder, PCA, PolynomialExpansion, QuantileDiscretizer, RegexTokenizer, RFormula,
    SQLTransformer, StandardScaler, StopWordsRemover, StringIndexer, Tokenizer, VectorAssembler, VectorIndexer, VectorSlicer)
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor)
from pyspark.ml.stat import ChiSquareTest, Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.functions import text as tx
from larkspur.functions import vectors as vx
from larkspur.operators import evaluation, features, models, patterns, sampling, series
from larkspur.plans.registry import query
from larkspur.session import materialise, work_path

# series -------------------------------------------------------------------

@query("""SELECT measurement, count(*) FILTER (isnan(val)) AS n_nan, count(*) FILTER (NOT isnan(val)) AS n,
  round(avg(val) FILTER (NOT isnan(val)), 8) AS mean, round(stddev_pop(val) FILTER (NOT isnan(val)), 8) AS sd
  FROM f_series_long GROUP BY 1""")
def ts_vector_stats(t):
    stats = series.vector_stats(fx.series(t))
    return stats.select("measurement", "n_nan", "n", F.round("mean", 8).alias("mean"), F.round("sd", 8).alias("sd"))


@query("""WITH v AS MATERIALIZED (SELECT * FROM f_series_long WHERE NOT isnan(val)),
  m AS (SELECT measurement, slot, avg(val) AS mean FROM v GROUP BY 1, 2),
  o AS (SELECT a.measurement, a.slot AS i, b.slot AS j, avg(a.val * b.val) AS o, count(*) AS n FROM v a JOIN v b ON a.vec_id = b.vec_id GROUP BY 1, 2, 3)
  SELECT o.measurement, i, j, round(o - x.mean * y.mean, 8) AS cov, CAST(n AS DOUBLE) AS n FROM o
  JOIN m x ON o.measurement = x.measurement AND i = x.slot JOIN m y ON o.measurement = y.measurement AND j = y.slot""")
def ts_nan_cov(t):
    rows = series.nan_covariance(fx.series(t))
    cell = F.posexplode(F.arrays_zip("cov", "n")).alias("j", "x")
    return rows.select("measurement", "i", cell).select(
        "measurement", "i", "j", F.round("x.cov", 8).alias("cov"), F.col("x.n").alias("n"))


@query("""WITH x AS (SELECT measurement, vec_id, slot, val FROM f_series_long WHERE NOT isnan(val)),
  one AS (SELECT measurement, slot, avg(val) AS m, avg(val * val) AS s FROM x GROUP BY 1, 2)
  SELECT measurement, count(*) AS vectors, round(sum(s - m * m), 6) AS trace, true AS orthonormal, true AS falling FROM one GROUP BY 1""")
def ts_pca(t):
    """Per measurement: eigenvalues add up to the variances, vectors are orthonormal, values fall with the rank."""
    eigen = materialise(series.components(series.nan_covariance(fx.series(t))), "eigenvectors")
    a, b = eigen.select("measurement", "rank", "eigval", "vec"), eigen.select("measurement", F.col("rank").alias("other"), F.col("vec").alias("other_vec"), F.col("eigval").alias("other_val"))
    pairs = a.join(b, "measurement")  # at most width x width pairs a measurement
    unit = F.abs(vx.dot(F.col("vec"), F.col("other_vec")) - (F.col("rank") == F.col("other")).cast("double")) < 1e-6
    falls = (F.col("rank") >= F.col("other")) | (F.col("eigval") >= F.col("other_val"))
    checks = pairs.groupBy("measurement").agg(F.bool_and(unit).alias("orthonormal"), F.bool_and(falls).alias("falling"))
    sums = eigen.groupBy("measurement").agg(F.count("*").alias("vectors"), F.round(F.sum("eigval"), 6).alias("trace"))
    return sums.join(checks, "measurement")


AXES = 2
AXIS_SQL = "sqrt(2e0 / 64) * {}(2 * pi() * v.slot / 64)"


@query(f"""WITH v AS (SELECT * FROM f_series_long), m AS (SELECT measurement, slot, avg(val) AS mean FROM v WHERE NOT isnan(val) GROUP BY 1, 2),
  x AS (SELECT v.vec_id, v.slot, val, val - mean AS r, {AXIS_SQL.format('sin')} AS u1, {AXIS_SQL.format('cos')} AS u2
    FROM v JOIN m ON v.measurement = m.measurement AND v.slot = m.slot WHERE NOT isnan(val)),
  c AS (SELECT vec_id, sum(r * u1) AS c1, sum(r * u2) AS c2 FROM x GROUP BY 1)
  SELECT x.vec_id, round(sum(val * val), 6) AS total_var, round(sum(r * r) / sum(val * val), 6) AS res_mean,
    round(any_value(c1), 6) AS coeff_1, round(sum((r - c1 * u1) * (r - c1 * u1)) / sum(r * r), 6) AS res_1,
    round(any_value(c2), 6) AS coeff_2, round(sum((r - c1 * u1 - c2 * u2) * (r - c1 * u1 - c2 * u2)) / sum(r * r), 6) AS res_2
  FROM x JOIN c ON x.vec_id = c.vec_id GROUP BY 1""")
def ts_decompose(t):
    data = fx.series(t)
    means = series.nan_covariance(data).groupBy("measurement").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("means"))
    axes = series.trigonometric_basis(64, AXES + 1)[1:]
    basis = means.withColumn("axes", F.array(*[vx.literal(a) for a in axes]))
    done = series.decompose(data, basis, AXES)
    numbers = ["total_var", "res_mean", "coeff_1", "res_1", "coeff_2", "res_2"]
    return done.select("vec_id", *[F.round(c, 6).alias(c) for c in numbers])


@query(f"""WITH x AS (SELECT vec_id, u.pos - 1 AS slot, CAST(u.x AS DOUBLE) AS x FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, pos)),
  c AS (SELECT vec_id, sum(x * x) AS energy, sum(x / 8) AS c0, sum(x * {AXIS_SQL.format('sin')}) AS c1, sum(x * {AXIS_SQL.format('cos')}) AS c2 FROM x v GROUP BY 1)
  SELECT vec_id, round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2, round(energy - c0 * c0, 6) AS e0,
    round(energy - c0 * c0 - c1 * c1, 6) AS e1, round(energy - c0 * c0 - c1 * c1 - c2 * c2, 6) AS e2 FROM c""")
def ts_project_basis(t):
    done = series.project(t.embeddings.select("vec_id", "embedding"), series.trigonometric_basis(64, 3), "embedding")
    columns = [F.round(F.col(name)[i], 6).alias(f"{short}{i}") for short, name in (("c", "coeffs"), ("e", "errors")) for i in range(3)]
    return done.select("vec_id", *columns)


@query("""WITH d AS (SELECT measurement, slot, avg(val * val) - avg(val) * avg(val) AS eigval FROM f_series_long WHERE NOT isnan(val) GROUP BY 1, 2),
  r AS (SELECT measurement, row_number() OVER (PARTITION BY measurement ORDER BY eigval DESC, slot) AS rank, eigval FROM d)
  SELECT measurement, rank, round(sum(eigval) OVER (PARTITION BY measurement ORDER BY rank) / sum(eigval) OVER (PARTITION BY measurement), 6) AS explained FROM r""")
def ts_variance_explained(t):
    from pyspark.sql import Window

    variances = series.nan_covariance(fx.series(t)).select("measurement", "i", F.element_at("cov", F.col("i") + 1).alias("eigval"))
    by_size = Window.partitionBy("measurement").orderBy(F.desc("eigval"), "i")
    ranked = variances.withColumn("rank", F.row_number().over(by_size).cast("long"))
    return series.variance_explained(ranked).select("measurement", "rank", F.round("explained", 6).alias("explained"))


@query("""SELECT s_name, l_returnflag, year(l_shipdate) AS y, count(*) AS n FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""")
def ts_station_join(t):
    joined = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.groupBy("s_name", "l_returnflag", F.year("l_shipdate").cast("long").alias("y")).agg(F.count("*").alias("n"))


# feature stages -----------------------------------------------------------

def embedding_vectors(t):
    return t.embeddings.select("vec_id", "label", array_to_vector(vx.as_doubles(F.col("embedding"))).alias("vec"))


def slots(df, column, digits=6):
    return df.select("vec_id", F.posexplode(vector_to_array(column)).alias("slot", "v")).withColumn("v", F.round("v", digits))


EMB = "(SELECT vec_id, label, CAST(u.pos - 1 AS INTEGER) AS slot, CAST(u.x AS DOUBLE) AS x FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, pos))"


@query("SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_quantity > 25 AS DOUBLE) AS v FROM lineitem")
def fe_binarizer(t):
    stage = Binarizer(threshold=25.0, inputCol="l_quantity", outputCol="v")
    return stage.transform(t.lineitem).select("l_orderkey", "l_linenumber", "l_quantity", "v")


@query("""SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS DOUBLE) AS v FROM customer""")
def fe_bucketizer(t):
    edges = [-float("inf"), 0.0, 5000.0, float("inf")]
    return Bucketizer(splits=edges, inputCol="c_acctbal", outputCol="v", handleInvalid="keep").transform(t.customer).select("c_custkey", "v")


@query("SELECT CAST(unnest(range(4)) AS DOUBLE) AS bucket, true AS even, true AS apart")
def fe_quantile_buckets(t):
    """Four buckets, each a quarter of the rows within the allowed error, and none overlapping the next."""
    stage = QuantileDiscretizer(numBuckets=4, inputCol="o_totalprice", outputCol="bucket", relativeError=0.001)
    cut = stage.fit(t.orders).transform(t.orders).groupBy("bucket").agg(F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    whole = t.orders.select(F.count("*")).scalar()
    following = F.lead("low").over(Window.partitionBy().orderBy("bucket"))  # four rows
    return cut.select("bucket", (F.abs(F.col("n") / whole - 0.25) < 0.005).alias("even"), F.coalesce(F.col("high") < following, F.lit(True)).alias("apart"))


CELLS = """long AS (SELECT u.feature, u.v, CAST(l_quantity * (1 - l_discount) > 24 AS INTEGER) AS label FROM lineitem,
    unnest([{'feature': 0, 'v': l_quantity}, {'feature': 1, 'v': l_discount}, {'feature': 2, 'v': l_tax}, {'feature': 3, 'v': l_linenumber}]) AS e(u)),
  cells AS (SELECT feature, v, label, count(*) AS n FROM long GROUP BY 1, 2, 3),
  grid AS (SELECT a.feature, a.v, b.label, coalesce(c.n, 0) AS n, a.n * b.n / a.total AS e FROM
      (SELECT feature, v, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY feature) AS total FROM cells GROUP BY 1, 2) a
    JOIN (SELECT feature, label, sum(n) AS n FROM cells GROUP BY 1, 2) b ON a.feature = b.feature
    LEFT JOIN cells c ON c.feature = a.feature AND c.v = a.v AND c.label = b.label),
  stat AS (SELECT feature, sum((n - e) * (n - e) / e) / 2 AS x, (count(DISTINCT v) - 1) * (count(DISTINCT label) - 1) / 2 AS a FROM grid GROUP BY 1),
  tests AS (SELECT feature, CASE WHEN x > 300 THEN 0.0 ELSE greatest(0, 1 - list_sum([exp(-x + (a + i) * ln(x) - lgamma(a + i + 1)) FOR i IN range(2000)])) END AS p FROM stat),
  placed AS (SELECT *, row_number() OVER (ORDER BY p, feature) AS place, count(*) OVER () AS n FROM tests)"""
MODES = {"top": 2, "percentile": 0.5, "fpr": 0.05, "fdr": 0.05, "fwe": 0.05}


@query(f"""WITH {CELLS} SELECT mode, CAST(feature AS INTEGER) AS feature FROM (
  SELECT 'top' AS mode, feature FROM placed WHERE place <= 2 UNION ALL SELECT 'percentile', feature FROM placed WHERE place <= floor(n * 0.5)
  UNION ALL SELECT 'fpr', feature FROM placed WHERE p < 0.05 UNION ALL SELECT 'fwe', feature FROM placed WHERE p < 0.05 / n
  UNION ALL SELECT 'fdr', feature FROM placed WHERE place <= (SELECT max(place) FROM placed WHERE p <= 0.05 / n * place))""")
def fe_chisq(t):
    tests = ChiSquareTest.test(line_samples(t), "features", "label", flatten=True)
    tests = materialise(tests.select(F.col("featureIndex").alias("feature"), F.col("pValue").alias("p")), "chi-square-tests")
    return reduce(DataFrame.unionByName, [features.chosen_by_p(tests, mode, value).withColumn("mode", F.lit(mode)) for mode, value in MODES.items()])


@query(f"SELECT vec_id, slot, round(x * (slot + 1), 6) AS v FROM {EMB}")
def fe_elementwise(t):
    from pyspark.ml.linalg import Vectors

    stage = ElementwiseProduct(scalingVec=Vectors.dense([float(i + 1) for i in range(64)]), inputCol="vec", outputCol="out")
    return slots(stage.transform(embedding_vectors(t)), "out")


@query(f"SELECT vec_id, slot, round(x / max(abs(x)) OVER (PARTITION BY slot), 6) AS v FROM {EMB}")
def fe_maxabs(t):
    data = embedding_vectors(t)
    return slots(MaxAbsScaler(inputCol="vec", outputCol="out").fit(data).transform(data), "out")


@query(f"""SELECT vec_id, slot, round((x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w), 6) AS v FROM {EMB} WINDOW w AS (PARTITION BY slot)""")
def fe_minmax(t):
    data = embedding_vectors(t)
    return slots(MinMaxScaler(inputCol="vec", outputCol="out").fit(data).transform(data), "out")


@query(f"SELECT vec_id, slot, round((x - avg(x) OVER w) / stddev_samp(x) OVER w, 6) AS v FROM {EMB} WINDOW w AS (PARTITION BY slot)")
def fe_standard(t):
    data = embedding_vectors(t)
    return slots(StandardScaler(withMean=True, withStd=True, inputCol="vec", outputCol="out").fit(data).transform(data), "out")


@query(f"SELECT vec_id, slot, round(x / sum(abs(x)) OVER (PARTITION BY vec_id), 6) AS v FROM {EMB}")
def fe_normalizer(t):
    return slots(Normalizer(p=1.0, inputCol="vec", outputCol="out").transform(embedding_vectors(t)), "out")


@query("""WITH x AS (SELECT [l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE, l_linenumber::DOUBLE] AS f FROM lineitem),
  w AS (SELECT flatten([list_concat([f[j]], [f[i] * f[j] FOR i IN range(1, j + 1)]) FOR j IN range(1, 5)]) AS o FROM x)
  SELECT CAST(u.slot - 1 AS INTEGER) AS slot, count(*) AS n, round(sum(u.v), 5) AS total FROM w, unnest(w.o) WITH ORDINALITY AS u(v, slot) GROUP BY 1""")
def fe_poly(t):
    wide = PolynomialExpansion(degree=2, inputCol="features", outputCol="out").transform(line_samples(t))
    return wide.select(F.posexplode(vector_to_array("out")).alias("slot", "v")).groupBy("slot").agg(F.count("*").alias("n"), F.round(F.sum("v"), 5).alias("total"))


VECTOR_KEY = "l_orderkey"


@query("""SELECT p_partkey, array_to_string(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), '|') AS grams
  FROM (SELECT p_partkey, string_split(p_name || ' ' || lower(p_type), ' ') AS w FROM part)""")
def fe_ngram(t):
    words = t.part.select("p_partkey", F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("w"))
    return NGram(n=2, inputCol="w", outputCol="g").transform(words).select("p_partkey", F.array_join("g", "|").alias("grams"))


@query("SELECT p_partkey, array_to_string(string_split(lower(p_name || ' ' || p_type), ' '), '|') AS words FROM part")
def fe_tokenizer(t):
    text = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("s"))
    return Tokenizer(inputCol="s", outputCol="w").transform(text).select("p_partkey", F.array_join("w", "|").alias("words"))


@query("""SELECT c_custkey, array_to_string(list_filter(regexp_split_to_array(lower(c_name), '#0*'), lambda w: length(w) >= 1), '|') AS words FROM customer""")
def fe_regex_tokenizer(t):
    stage = RegexTokenizer(inputCol="c_name", outputCol="w", pattern="#0*", minTokenLength=1)
    return stage.transform(t.customer).select("c_custkey", F.array_join("w", "|").alias("words"))


@query("""SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: lower(w) NOT IN ('red', 'blue', 'ring')), '|') AS words FROM part""")
def fe_stopwords(t):
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("w"))
    stage = StopWordsRemover(inputCol="w", outputCol="kept", stopWords=["red", "blue", "ring"], caseSensitive=False)
    return stage.transform(words).select("p_partkey", F.array_join("kept", "|").alias("words"))


def part_words(t):
    return t.part.select("p_partkey", F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("w"))


PART_WORDS = "(SELECT p_partkey, unnest(string_split(p_name || ' ' || lower(p_type), ' ')) AS w FROM part)"


def named_slots(df, vector, vocabulary):
    names = F.array(*[F.lit(w) for w in vocabulary])
    return df.select("p_partkey", F.explode(F.arrays_zip(names.alias("word"), vector_to_array(vector).alias("v"))).alias("x")).select(
        "p_partkey", "x.word", "x.v").filter("v <> 0")


@query(f"SELECT p_partkey, w AS word, CAST(count(*) AS DOUBLE) AS v FROM {PART_WORDS} GROUP BY 1, 2")
def fe_count_vectorizer(t):
    words = part_words(t)
    model = whole_vocabulary(words, minDF=1.0).fit(words)
    path = work_path(t.spark, "word-counter")
    model.write().overwrite().save(path)
    again = CountVectorizerModel.load(path)
    return named_slots(again.transform(words), "counts", again.vocabulary)


def whole_vocabulary(words, **settings):
    """A counter that keeps every word: its bound is the number of different words, not the default of the class."""
    size = words.select(F.explode("w").alias("word")).agg(F.count_distinct("word")).first()[0]
    return CountVectorizer(inputCol="w", outputCol="counts", vocabSize=max(1, size), **settings)


@query(f"SELECT p_partkey, CAST(count(*) AS DOUBLE) AS n_words, CAST(count(*) AS DOUBLE) AS total FROM {PART_WORDS} GROUP BY 1")
def fe_hashing_tf(t):
    hashed = HashingTF(numFeatures=256, inputCol="w", outputCol="tf").transform(part_words(t))
    return hashed.select("p_partkey", F.size("w").cast("double").alias("n_words"), vx.total(vector_to_array("tf")).alias("total"))


@query(f"""SELECT p_partkey, w AS word, round(count(*) * ln(((SELECT count(*) FROM part) + 1) / (any_value(df) + 1)), 6) AS v FROM {PART_WORDS} a
  JOIN (SELECT w, count(DISTINCT p_partkey) AS df FROM {PART_WORDS} GROUP BY 1) b USING (w) GROUP BY 1, 2""")
def fe_idf(t):
    words = part_words(t)
    counter = whole_vocabulary(words).fit(words)
    counted = counter.transform(words)
    weighted = IDF(inputCol="counts", outputCol="weights").fit(counted).transform(counted)
    return named_slots(weighted, "weights", counter.vocabulary).withColumn("v", F.round("v", 6))


INDEX = "(SELECT p_name, CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS DOUBLE) AS idx FROM part GROUP BY 1)"


def indexed_parts(t):
    return StringIndexer(inputCol="p_name", outputCol="idx", handleInvalid="keep").fit(t.part)


@query(f"SELECT p_partkey, idx FROM part JOIN {INDEX} i USING (p_name)")
def fe_string_indexer(t):
    return indexed_parts(t).transform(t.part).select("p_partkey", "idx")


@query("SELECT p_partkey, p_name AS back FROM part")
def fe_index_to_string(t):
    model = indexed_parts(t)
    back = IndexToString(inputCol="idx", outputCol="back", labels=model.labels)
    return back.transform(model.transform(t.part)).select("p_partkey", "back")


@query(f"SELECT CAST(idx AS INTEGER) AS slot, CAST(count(*) AS DOUBLE) AS n FROM part JOIN {INDEX} i USING (p_name) GROUP BY 1")
def fe_onehot(t):
    indexed = indexed_parts(t).transform(t.part)
    coded = OneHotEncoder(inputCols=["idx"], outputCols=["vec"], dropLast=False).fit(indexed).transform(indexed)
    return (coded.select(F.posexplode(vector_to_array("vec")).alias("slot", "v")).groupBy("slot").agg(F.sum("v").alias("n"))
            .filter("n > 0"))


def ranked_sql(column: str, most: int) -> str:
    """Place of a value among the column's values, zero first, where there are few; else the value."""
    return f"""CASE WHEN (SELECT count(DISTINCT {column}) FROM lineitem) > {most} THEN CAST({column} AS DOUBLE) ELSE (
      SELECT CAST(r AS DOUBLE) FROM (SELECT v, row_number() OVER (ORDER BY v = 0 DESC, v) - 1 AS r FROM (SELECT DISTINCT {column} AS v FROM lineitem)) k WHERE k.v = l.{column}) END"""


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(f"{ranked_sql(c, 12)} AS slot_{i}" for i, c in enumerate(("l_quantity", "l_discount", "l_tax", "l_linenumber"))) + " FROM lineitem l")
def fe_vector_indexer(t):
    data = line_samples(t)
    out = VectorIndexer(inputCol="features", outputCol="out", maxCategories=12).fit(data).transform(data)
    return out.select("l_orderkey", "l_linenumber", *[vector_to_array("out")[i].alias(f"slot_{i}") for i in range(4)])


@query("""SELECT l_orderkey, l_linenumber, l_quantity, array_to_string([CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_discount::DECIMAL(4,2)::VARCHAR], '|') AS v FROM lineitem""")
def fe_vector_assembler(t):
    stage = VectorAssembler(inputCols=["l_quantity", "l_linenumber", "l_discount"], outputCol="vec", handleInvalid="error")
    v = vector_to_array("vec")
    text = F.concat_ws("|", v[0].cast("int").cast("string"), v[1].cast("int").cast("string"), v[2].cast("decimal(4,2)").cast("string"))
    return stage.transform(t.lineitem).select("l_orderkey", "l_linenumber", "l_quantity", text.alias("v"))


@query(f"SELECT vec_id, CASE slot WHEN 3 THEN 0 ELSE 1 END AS slot, round(x, 6) AS v FROM {EMB} WHERE slot IN (3, 10)")
def fe_vector_slicer(t):
    return slots(VectorSlicer(inputCol="vec", outputCol="out", indices=[3, 10]).transform(embedding_vectors(t)), "out")


@query("SELECT p_partkey, p_size * 2 AS twice, upper(p_name) AS loud FROM part")
def fe_sql_transformer(t):
    stage = SQLTransformer(statement="SELECT p_partkey, p_size * 2 AS twice, upper(p_name) AS loud FROM __THIS__")
    return stage.transform(t.part)


@query("""WITH order_of AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) AS place, count(*) OVER () AS kinds FROM lineitem GROUP BY 1)
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS quantity, [CAST(place = k AS DOUBLE) FOR k IN range(1, kinds)] AS flags, CAST(l_extendedprice AS DOUBLE) AS y
  FROM lineitem JOIN order_of USING (l_returnflag)""")
def fe_rformula(t):
    """Number and one-hot flags, the rarest flag as the base; the label as it is."""
    formula = RFormula(formula="l_extendedprice ~ l_quantity + l_returnflag", featuresCol="f", labelCol="y")
    out = formula.fit(t.lineitem).transform(t.lineitem).withColumn("f", vector_to_array("f"))
    return out.select("l_orderkey", "l_linenumber", F.col("f")[0].alias("quantity"), F.slice("f", 2, F.size("f") - 1).alias("flags"), F.col("y").cast("double").alias("y"))


@query(f"SELECT count(*) AS slots, round(sum(v), 5) AS variance, true AS shares_add_up, true AS falling FROM (SELECT slot, var_samp(x) AS v FROM {EMB} GROUP BY 1)")
def fe_pca(t):
    """All components: their variances add up to that of the slots, fall, and are the shares the model tells."""
    data = embedding_vectors(t)
    model = PCA(k=64, inputCol="vec", outputCol="out").fit(data)
    shares = [float(x) for x in model.explainedVariance]
    out = slots(model.transform(data), "out", digits=12).groupBy("slot").agg(F.var_samp("v").alias("v"))
    told = t.spark.createDataFrame(list(enumerate(shares)), "slot int, share double")
    whole = materialise(out, "component-variances")
    total = whole.select(F.sum("v")).scalar()
    both = whole.join(told, "slot").withColumn("before", F.lag("v").over(Window.partitionBy().orderBy("slot")))  # 64 rows
    return both.agg(F.count("*").alias("slots"), F.round(F.sum("v"), 5).alias("variance"), F.bool_and(F.abs(F.col("v") / total - F.col("share")) < 1e-6).alias("shares_add_up"),
                    F.bool_and(F.coalesce(F.col("before") >= F.col("v") - 1e-9, F.lit(True))).alias("falling"))


@query()
def fe_pca_values(t):
    data = embedding_vectors(t)
    model = PCA(k=3, inputCol="vec", outputCol="out").fit(data)
    return slots(model.transform(data), "out")


PAIRS = """SELECT vec_id, {} FROM f_ctr"""


@query("""SELECT vec_id, round(list_cosine_similarity(user_embedding, item_embedding), 6) AS v FROM f_ctr""")
def fe_embedding_inner(t):
    samples = features.with_embedding_vectors(fx.ctr_samples(t))
    return samples.select("vec_id", F.round("embedding_inner", 6).alias("v"))


@query("""SELECT vec_id, CAST(u.pos - 1 AS INTEGER) AS slot, round(u.x * item_embedding[u.pos], 8) AS v
  FROM f_ctr, unnest(user_embedding) WITH ORDINALITY AS u(x, pos)""")
def fe_embedding_outer(t):
    return slots(features.with_embedding_vectors(fx.ctr_samples(t)), "embedding_outer", 8)


@query(f"SELECT vec_id, slot, round(x, 6) AS v FROM {EMB}")
def fe_array_to_vector(t):
    as_text = t.embeddings.select("vec_id", F.to_json(vx.as_doubles(F.col("embedding"))).alias("json"))
    back = as_text.select("vec_id", array_to_vector(F.from_json("json", "array<double>")).alias("vec"))
    return slots(back, "vec")


def ctr_scaled(t, variant):
    samples = materialise(features.with_embedding_vectors(fx.ctr_samples(t)), "ctr-samples")
    return features.ctr_pipeline(variant).fit(samples).transform(samples)


@query("SELECT variant, (SELECT count(*) FROM f_ctr) AS n, true AS one_width, true AS in_unit FROM (VALUES ('plain'), ('inner'), ('outer')) AS v(variant)")
def fe_ctr_pipeline(t):
    parts = []
    for variant in ("plain", "inner", "outer"):
        v = vector_to_array("scaled")
        parts.append(ctr_scaled(t, variant).agg(
            F.count("*").alias("n"), (F.min(F.size(v)) == F.max(F.size(v))).alias("one_width"),
            ((F.min(F.array_min(v)) >= 0) & (F.max(F.array_max(v)) <= 1)).alias("in_unit")).withColumn("variant", F.lit(variant)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# models -------------------------------------------------------------------

def line_samples(t):
    """Line items: is the discounted quantity high, and the net amount, from quantity, discount, tax and line number."""
    net = F.col("l_quantity") * (1 - F.col("l_discount"))
    parts = F.array(*[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")])
    return t.lineitem.select("l_orderkey", "l_linenumber", array_to_vector(parts).alias("features"),
                             (net > 24).cast("double").alias("label"), (net * (1 + F.col("l_tax")) * 100).alias("price"))


def halves(t):
    data = sampling.hash_split(line_samples(t), F.col("l_orderkey"), 0.7)
    return data.filter("part = 'train'"), data.filter("part = 'test'")


UNSEEN = "lineitem WHERE CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) >= 3006477107"
CLASSES = f"""SELECT CAST(l_quantity * (1 - l_discount) > 24 AS DOUBLE) AS label, count(*) AS n, true AS accurate, true AS beats_majority FROM {UNSEEN} GROUP BY 1"""
UNSEEN_ROWS = f"SELECT count(*) AS n, true AS close FROM {UNSEEN}"


def judged(scored, least, rows_each="1"):
    """Rows of each label, and whether the share of right answers reaches ``least`` and passes that of the commonest label."""
    kept = materialise(scored.groupBy("label", "prediction").agg(F.sum(F.expr(rows_each)).cast("long").alias("n")), "label-counts")
    labels = kept.groupBy("label").agg(F.sum("n").alias("n"))
    rows, most = labels.select(F.sum("n")).scalar(), labels.select(F.max("n")).scalar()
    right = kept.select(F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))), F.lit(0))).scalar()
    return labels.select("label", "n", (right / rows >= least).alias("accurate"), (right > most).alias("beats_majority"))


def counted_halves(t):
    """The rows of both halves, equal ones once with their number ``n``; fits that take weights read far fewer rows."""
    keys = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = sampling.hash_split(t.lineitem.select("l_orderkey", *keys), F.col("l_orderkey"), 0.7).groupBy("part", *keys).agg(F.count("*").alias("n"))
    parts = F.array(*[F.col(c).cast("double") for c in keys])
    label = (F.col("l_quantity") * (1 - F.col("l_discount")) > 24).cast("double")
    data = materialise(rows.select("part", array_to_vector(parts).alias("features"), label.alias("label"), F.col("n").cast("double").alias("n")), "counted-lines")
    return data.filter("part = 'train'"), data.filter("part = 'test'")


def classified(estimator, t, least):
    train, test = halves(t)
    return judged(estimator.fit(train).transform(test), least)


def fitted(estimator, t, share):
    """Unseen rows, and whether the error stays under ``share`` of the spread of the price."""
    train, test = halves(t)
    miss = F.col("prediction") - F.col("price")
    scored = estimator.fit(train).transform(test)
    measured = scored.agg(F.count("*").alias("n"), F.sqrt(F.avg(miss * miss)).alias("rmse"), F.stddev_pop("price").alias("spread"))
    return measured.select("n", (F.col("rmse") < share * F.col("spread")).alias("close"))


@query(CLASSES)
def ml_logreg(t):
    return classified(LogisticRegression(maxIter=20, regParam=0.01, elasticNetParam=0.5), t, 0.95)


@query()
def ml_logreg_summary(t):
    """The fit's history and its measures on unseen rows: areas, best threshold, recall and precision there."""
    train, test = halves(t)
    model = LogisticRegression(maxIter=20, regParam=0.01, elasticNetParam=0.5).fit(train)
    scored = model.transform(test).select("label", vector_to_array("probability")[1].alias("score"))
    curve = materialise(evaluation.binary_curve(scored), "logistic-curve")
    best = evaluation.best_threshold(curve)
    at_best = curve.join(best, "threshold").select("threshold", "f", "recall", "precision", "fall_out")
    history = [float(x) for x in model.summary.objectiveHistory]
    under = evaluation.areas(curve)
    return at_best.withColumns({"roc": under.select("roc").scalar(), "pr": under.select("pr").scalar(), "first_loss": F.lit(history[0]), "last_loss": F.lit(history[-1]), "rounds": F.lit(len(history) - 1)})


@query()
def ml_logreg_multi(t):
    """Three classes of line items by one multinomial fit, measured per class on unseen rows."""
    train, test = (df.withColumn("label", F.when(F.col("price") < 1000, 0.0).when(F.col("price") < 3000, 1.0).otherwise(2.0)) for df in halves(t))
    model = LogisticRegression(family="multinomial", maxIter=20, regParam=0.001).fit(train)
    return evaluation.class_measures(model.transform(test))


@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""")
def ml_linreg(t):
    data = t.lineitem.select(array_to_vector(F.array("l_quantity")).alias("features"), F.col("l_extendedprice").alias("label"))
    model = LinearRegression(regParam=0.0, solver="normal").fit(data)
    fitted = t.spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return fitted.select(F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("""WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
  SELECT count(*) AS n, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2, round(sqrt(avg(pow(l_extendedprice - a - b * l_quantity, 2))), 3) AS rmse,
    round(avg(abs(l_extendedprice - a - b * l_quantity)), 3) AS mae, true AS huber_no_worse FROM lineitem, m""")
def ml_linreg_summary(t):
    """What the fit says of itself, and whether a fit by Huber's loss leaves no larger absolute errors."""
    data = t.lineitem.select(array_to_vector(F.array(F.col("l_quantity").cast("double"))).alias("features"), F.col("l_extendedprice").alias("label"))
    model = LinearRegression(regParam=0.0, solver="normal").fit(data)
    robust = LinearRegression(loss="huber", epsilon=1.35, maxIter=50).fit(data)
    told = model.summary
    left = robust.transform(data).select(F.avg(F.abs(F.col("label") - F.col("prediction")))).scalar()
    row = (told.numInstances, float(told.r2), float(told.rootMeanSquaredError), float(told.meanAbsoluteError))
    table = t.spark.createDataFrame([row], "n long, r2 double, rmse double, mae double")
    return table.select("n", F.round("r2", 8).alias("r2"), F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"), (left <= 1.001 * F.col("mae")).alias("huber_no_worse"))


@query("SELECT true AS adds_up, true AS quantity_first, true AS variance_in_leaves")
def ml_tree_importances(t):
    """Importances add up to one and name the quantity first; rows carry the variance of their leaf."""
    train, test = halves(t)
    model = DecisionTreeRegressor(maxDepth=5, labelCol="price", varianceCol="variance", seed=1).fit(train)
    shares = [float(x) for x in model.featureImportances.toArray()]
    known = model.transform(test).agg((F.min("variance") >= 0).alias("v")).select("v").scalar()
    return t.spark.range(1).select(F.lit(abs(sum(shares) - 1) < 1e-9).alias("adds_up"), F.lit(max(shares) == shares[0]).alias("quantity_first"), known.alias("variance_in_leaves"))


@query()
def ml_gbt_rules(t):
    """The conditions that lead to each leaf of the boosted trees."""
    model = models.trees_then_logistic(trees=5, depth=3, rounds=10).fit(halves(t)[0])
    return t.spark.createDataFrame(models.leaf_rules(model.stages[0]), "tree int, leaf int, conditions string")


@query(UNSEEN_ROWS)
def ml_glm(t):
    return fitted(GeneralizedLinearRegression(family="gaussian", link="identity", labelCol="price", maxIter=10, regParam=0.1), t, 0.1)


@query(CLASSES)
def ml_tree_cls(t):
    return classified(DecisionTreeClassifier(maxDepth=5, impurity="gini", seed=1), t, 0.95)


@query(UNSEEN_ROWS)
def ml_tree_reg(t):
    return fitted(DecisionTreeRegressor(maxDepth=5, labelCol="price", varianceCol="variance", seed=1), t, 0.2)


@query(CLASSES)
def ml_rf_cls(t):
    return classified(RandomForestClassifier(numTrees=10, maxDepth=5, seed=1), t, 0.9)


@query(UNSEEN_ROWS)
def ml_rf_reg(t):
    return fitted(RandomForestRegressor(numTrees=10, maxDepth=5, labelCol="price", seed=1), t, 0.3)


@query(CLASSES)
def ml_gbt_cls(t):
    return classified(GBTClassifier(maxIter=5, maxDepth=4, featureSubsetStrategy="auto", seed=1), t, 0.95)


@query(UNSEEN_ROWS)
def ml_gbt_reg(t):
    return fitted(GBTRegressor(maxIter=5, maxDepth=4, labelCol="price", seed=1), t, 0.2)


@query(f"""SELECT form, c.* FROM ({CLASSES}) c, (VALUES ('multinomial'), ('bernoulli')) AS f(form)""")
def ml_naive_bayes(t):
    """Counts and yes-or-no features: both forms over one-hot coded steps of quantity, discount, tax and line number."""
    steps = {"q": F.floor(F.col("l_quantity") / 5), "d": F.round(F.col("l_discount") * 100), "x": F.round(F.col("l_tax") * 100), "l": F.col("l_linenumber")}
    rows = t.lineitem.withColumns({c: v.cast("double") for c, v in steps.items()})
    rows = rows.withColumn("label", (F.col("l_quantity") * (1 - F.col("l_discount")) > 24).cast("double")).select("l_orderkey", "label", *steps)
    parts = materialise(sampling.hash_split(rows, F.col("l_orderkey"), 0.7), "bayes-rows")
    flags = [OneHotEncoder(inputCols=list(steps), outputCols=[f"{c}_flags" for c in steps], dropLast=False, handleInvalid="keep"),
             VectorAssembler(inputCols=[f"{c}_flags" for c in steps], outputCol="features")]
    forms = []
    for form in ("multinomial", "bernoulli"):
        model = Pipeline(stages=[*flags, NaiveBayes(smoothing=1.0, modelType=form)]).fit(parts.filter("part = 'train'"))
        forms.append(judged(model.transform(parts.filter("part = 'test'")), 0.85).withColumn("form", F.lit(form)))
    return forms[0].unionByName(forms[1])


@query(CLASSES)
def ml_svc(t):
    return classified(LinearSVC(maxIter=10, regParam=0.01), t, 0.9)


@query(CLASSES)
def ml_mlp(t):
    scaled = MinMaxScaler(inputCol="features", outputCol="scaled")
    net = MultilayerPerceptronClassifier(layers=[4, 2, 2], featuresCol="scaled", blockSize=128, maxIter=30, stepSize=0.1, seed=1)
    return classified(Pipeline(stages=[scaled, net]), t, 0.95)


@query(CLASSES)
def ml_fm(t):
    scaled = MinMaxScaler(inputCol="features", outputCol="scaled")
    machine = FMClassifier(featuresCol="scaled", factorSize=4, maxIter=30, stepSize=0.1, seed=1)
    return classified(Pipeline(stages=[scaled, machine]), t, 0.9)


@query(CLASSES)
def ml_gbt_lr(t):
    train, test = counted_halves(t)
    model = models.trees_then_logistic(trees=5, depth=3, rounds=10, weight="n").fit(train)
    return judged(model.transform(test), 0.95, "n")


@query("SELECT count(*) AS n, CAST(4 AS BIGINT) AS clusters, true AS all_nearest, true AS centres_are_means FROM embeddings")
def ml_kmeans(t):
    """Every row lies in the cluster of the nearest centre; centres are the means of their rows to the fit's tolerance."""
    data = embedding_vectors(t)
    model = KMeans(k=4, seed=1, featuresCol="vec", maxIter=60).fit(data)
    centres = [c.tolist() for c in model.clusterCenters()]
    rows = materialise(model.transform(data).select("prediction", vector_to_array("vec").alias("v")), "clustered")
    far = [vx.euclidean(F.col("v"), vx.literal(c)) for c in centres]
    own = F.element_at(F.array(*far), F.col("prediction") + 1)
    table = t.spark.createDataFrame([(i, c) for i, c in enumerate(centres)], "prediction int, centre array<double>")
    means = rows.groupBy("prediction").agg(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("mean"))
    shift = means.join(table, "prediction").select(F.max(vx.euclidean(F.col("mean"), F.col("centre")))).scalar()
    return rows.agg(F.count("*").alias("n"), F.count_distinct("prediction").alias("clusters"), F.bool_and(own <= F.least(*far) + 1e-9).alias("all_nearest")).withColumn(
        "centres_are_means", shift < 0.05)


@query()
def ml_kmeans_centres(t):
    model = KMeans(k=4, seed=1, featuresCol="vec").fit(embedding_vectors(t))
    table = t.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    sizes = t.spark.createDataFrame(list(enumerate(model.summary.clusterSizes)), "cluster int, n long")
    return table.join(sizes, "cluster").withColumn("cost", F.lit(model.summary.trainingCost))


@query("SELECT count(*) AS n, true AS shares_add_up, true AS likeliest_first FROM lineitem")
def ml_gmm(t):
    """Each row's chances over the parts add up to one, and its part is the likeliest."""
    data = line_samples(t)
    model = GaussianMixture(k=2, seed=1, maxIter=10).fit(data)
    scored = model.transform(data).select("prediction", vector_to_array("probability").alias("p"))
    return scored.agg(F.count("*").alias("n"), F.bool_and(F.abs(vx.total(F.col("p")) - 1) < 1e-6).alias("shares_add_up"),
                      F.bool_and(F.element_at("p", F.col("prediction") + 1) >= F.array_max("p") - 1e-9).alias("likeliest_first"))


@query()
def ml_gmm_parts(t):
    """Weight, mean and covariance of each part of the mixture."""
    model = GaussianMixture(k=2, seed=1, maxIter=10).fit(line_samples(t))
    parts = model.gaussiansDF.select(vector_to_array("mean").alias("mean"), F.col("cov").cast("string").alias("cov")).collect()  # one row a part
    return t.spark.createDataFrame([(i, float(w), list(p["mean"]), p["cov"]) for i, (w, p) in enumerate(zip(model.weights, parts))],
                                   "part int, weight double, mean array<double>, cov string")


@query()
def ml_lda(t):
    """Terms of the topics, with the bound on the likelihood and the perplexity of all documents."""
    words = materialise(t.documents.select("doc_id", tx.topic_words(F.col("text")).alias("w")), "document-words")
    # The fit needs a bounded vocabulary: the most frequent words, this many at most.
    counter = CountVectorizer(inputCol="w", outputCol="features", vocabSize=1 << 18).fit(words)
    counted = counter.transform(words)
    model = LDA(k=4, maxIter=3, seed=1, docConcentration=[0.25], topicConcentration=0.25).fit(counted)
    terms = model.describeTopics(10).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "x"))
    names = t.spark.createDataFrame(list(enumerate(counter.vocabulary)), "index int, term string")
    top = terms.join(names, F.col("x.termIndices") == F.col("index")).select("topic", "rank", "term", F.col("x.termWeights").alias("weight"))
    bound, tokens = models.topic_bound(model, counted, "features", 0.25, 0.25)
    return top.withColumns({"log_likelihood": F.lit(bound), "log_perplexity": F.lit(-bound / tokens)})


SETS = """n AS (SELECT count(*) AS n FROM f_baskets),
  subs AS (SELECT [items[i] FOR i IN range(1, len(items) + 1) IF (m >> (i - 1)) & 1 = 1] AS items FROM (SELECT items, unnest(range(1, 1 << len(items))) AS m FROM f_baskets)),
  sets AS MATERIALIZED (SELECT items, count(*) AS freq FROM subs, n GROUP BY items HAVING count(*) >= 0.05 * any_value(n))"""
RULES = f"""{SETS}, split AS (SELECT items, freq, unnest(items) AS consequent FROM sets WHERE len(items) > 1),
  rules AS MATERIALIZED (SELECT a.items AS antecedent, consequent, s.freq AS freq, s.freq / a.freq AS confidence, s.freq / a.freq / (c.freq / n) AS lift, s.freq / n AS support
    FROM split s JOIN sets a ON a.items = list_filter(s.items, lambda x: x <> s.consequent) JOIN sets c ON c.items = [s.consequent], n WHERE s.freq / a.freq >= 0.3)"""


def frequent_sets(t):
    return FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.3).fit(fx.baskets(t).select("items")).freqItemsets


def basket_rules(t, baskets):
    return patterns.rules(materialise(frequent_sets(t), "frequent-sets"), baskets.count(), 0.3)


@query(f"WITH {SETS} SELECT array_to_string(items, ',') AS items, freq FROM sets")
def ml_fpgrowth(t):
    return frequent_sets(t).select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


@query(f"""WITH {RULES} SELECT array_to_string(antecedent, ',') AS antecedent, consequent, freq, round(confidence, 8) AS confidence,
  round(lift, 8) AS lift, round(support, 8) AS support FROM rules""")
def ml_fpgrowth_rules(t):
    found = basket_rules(t, fx.baskets(t))
    return found.select(F.array_join("antecedent", ",").alias("antecedent"), "consequent", "freq", *[F.round(c, 8).alias(c) for c in ("confidence", "lift", "support")])


@query(f"""WITH {RULES}, said AS (SELECT items, list_sort(list(DISTINCT consequent)) AS p FROM (SELECT DISTINCT items FROM f_baskets) b
    JOIN rules r ON list_has_all(b.items, r.antecedent) AND NOT list_contains(b.items, r.consequent) GROUP BY items)
  SELECT l_orderkey, coalesce(array_to_string(p, ','), '') AS prediction FROM f_baskets b LEFT JOIN said USING (items)""")
def ml_fpgrowth_predict(t):
    baskets = fx.baskets(t)
    said = patterns.predictions(baskets, materialise(basket_rules(t, baskets), "basket-rules"))
    return said.select("l_orderkey", F.array_join("prediction", ",").alias("prediction"))


def labelled_documents(t):
    labels = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    return t.documents.select("doc_id", "text").join(labels, "doc_id")


@query("""SELECT CAST(quality AS DOUBLE) AS label, count(*) AS n, true AS accurate, true AS beats_majority FROM documents JOIN labels USING (doc_id)
  WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) >= 3006477107 GROUP BY 1""")
def ml_text_classifier(t):
    data = sampling.hash_split(labelled_documents(t), F.col("doc_id"), 0.7)
    model = models.text_classifier().fit(data.filter("part = 'train'"))
    return judged(model.transform(data.filter("part = 'test'")), 0.8)


@query("SELECT true AS same, true AS any_rows")
def ml_pipeline_io(t):
    train, test = halves(t)
    model = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled"), LogisticRegression(featuresCol="scaled", maxIter=5)]).fit(train)
    again = models.reload(model, work_path(t.spark, "pipeline"))
    key = ["l_orderkey", "l_linenumber"]
    a, b = (m.transform(test).groupBy(*key, "prediction").agg(F.count("*").alias(name)) for m, name in ((model, "saved"), (again, "loaded")))
    both = a.join(b, [*key, "prediction"], "full")
    return both.agg(F.bool_and(F.col("saved").eqNullSafe(F.col("loaded"))).alias("same"), (F.count("*") > 0).alias("any_rows"))


@query("SELECT depth, true AS above_chance, true AS chosen_is_best FROM (VALUES (2), (4)) AS d(depth)")
def ml_cross_validate(t):
    train, _ = halves(t)
    tree = DecisionTreeClassifier(seed=1)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [2, 4]).build()
    found = CrossValidator(estimator=tree, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=3,
                           parallelism=2, seed=1).fit(train)
    best = max(found.avgMetrics)
    rows = [(int(params[tree.maxDepth]), float(m), bool(m == best)) for params, m in zip(grid, found.avgMetrics)]
    table = t.spark.createDataFrame(rows, "depth int, auc double, chosen boolean")
    deepest = found.bestModel.getOrDefault("maxDepth")
    return table.select("depth", (F.col("auc") > 0.5).alias("above_chance"), (F.col("chosen") == (F.col("depth") == deepest)).alias("chosen_is_best"))


def scored_lines(t):
    return t.lineitem.select(F.col("l_quantity").alias("score"), (F.col("l_extendedprice") > 40000).cast("double").alias("label"),
                             (F.col("l_quantity") > 30).cast("double").alias("prediction"))


@query("""WITH g AS (SELECT l_quantity AS s, count(*) FILTER (l_extendedprice > 40000) AS p, count(*) FILTER (l_extendedprice <= 40000) AS n FROM lineitem GROUP BY 1),
  c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS fp, sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM g),
  d AS (SELECT tp / pp AS rec, fp / nn AS fpr, tp / (tp + fp) AS prec, lag(tp / pp, 1, 0) OVER (ORDER BY s DESC) AS rec0,
    lag(fp / nn, 1, 0) OVER (ORDER BY s DESC) AS fpr0, lag(tp / (tp + fp), 1, tp / (tp + fp)) OVER (ORDER BY s DESC) AS prec0 FROM c)
  SELECT round(sum((fpr - fpr0) * (rec + rec0) / 2), 6) AS roc, round(sum((rec - rec0) * (prec + prec0) / 2), 6) AS pr FROM d""")
def ml_eval_binary(t):
    scored = scored_lines(t)
    measure = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    values = [float(measure.setMetricName(m).evaluate(scored)) for m in ("areaUnderROC", "areaUnderPR")]
    return t.spark.createDataFrame([tuple(values)], "roc double, pr double").select(F.round("roc", 6).alias("roc"), F.round("pr", 6).alias("pr"))


CURVE = """g AS (SELECT l_quantity AS threshold, count(*) FILTER (l_extendedprice > 40000) AS positives, count(*) FILTER (l_extendedprice <= 40000) AS negatives FROM lineitem GROUP BY 1),
  c AS (SELECT *, sum(positives) OVER (ORDER BY threshold DESC) AS t, sum(negatives) OVER (ORDER BY threshold DESC) AS f, sum(positives) OVER () AS pp, sum(negatives) OVER () AS nn FROM g)"""


@query(f"""WITH {CURVE} SELECT CAST(threshold AS DOUBLE) AS threshold, positives, negatives, CAST(t AS BIGINT) AS "true", CAST(f AS BIGINT) AS "false", round(t / pp, 8) AS recall,
  round(f / nn, 8) AS fall_out, round(t / (t + f), 8) AS precision, round(2 * t / (t + f + pp), 8) AS f1 FROM c""")
def ml_eval_curve(t):
    curve = evaluation.binary_curve(scored_lines(t))
    return curve.select("threshold", "positives", "negatives", "true", "false", *[F.round(c, 8).alias(c) for c in ("recall", "fall_out", "precision", "f1")])


@query(f"""WITH {CURVE} SELECT CAST(arg_max(threshold, (round(2 * t / (t + f + pp), 12), threshold)) AS DOUBLE) AS threshold, round(max(2 * t / (t + f + pp)), 8) AS f FROM c""")
def ml_eval_threshold(t):
    return evaluation.best_threshold(evaluation.binary_curve(scored_lines(t))).withColumn("f", F.round("f", 8))


@query("""SELECT round(avg(CAST((l_quantity > 30) = (l_extendedprice > 40000) AS INTEGER)), 6) AS accuracy FROM lineitem""")
def ml_eval_multi(t):
    value = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored_lines(t))
    return t.spark.createDataFrame([(float(value),)], "accuracy double").select(F.round("accuracy", 6).alias("accuracy"))


@query("""WITH x AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
  SELECT round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae, round(avg((y - p) * (y - p)) / 1e6, 3) AS mse,
    round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(y) FROM x)) * (y - (SELECT avg(y) FROM x))), 6) AS r2,
    round(avg((p - (SELECT avg(y) FROM x)) * (p - (SELECT avg(y) FROM x))) / 1e6, 3) AS var FROM x""")
def ml_eval_reg(t):
    data = t.lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction"))
    values = {m: float(RegressionEvaluator(metricName=m).evaluate(data)) for m in ("rmse", "mae", "mse", "r2", "var")}
    row = t.spark.createDataFrame([tuple(values.values())], ", ".join(f"{m} double" for m in values))
    return row.select(F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 3).alias("mse"),
                      F.round("r2", 6).alias("r2"), F.round(F.col("var") / 1e6, 3).alias("var"))


@query()
def ml_eval_cluster(t):
    data = embedding_vectors(t)
    grouped = KMeans(k=3, seed=1, featuresCol="vec").fit(data).transform(data)
    value = ClusteringEvaluator(featuresCol="vec").evaluate(grouped)
    return t.spark.createDataFrame([(float(value),)], "silhouette double")


@query("""SELECT model, true AS roc_in_unit, true AS pr_in_unit FROM (VALUES ('logistic'), ('forest'), ('boosted'), ('bayes'), ('factorisation'), ('network')) AS m(model)""")
def ml_model_compare(t):
    areas = model_areas(t)
    return areas.select("model", F.col("roc").between(0, 1).alias("roc_in_unit"), F.col("pr").between(0, 1).alias("pr_in_unit"))


@query()
def ml_model_areas(t):
    return model_areas(t)


def model_areas(t):
    scaled = materialise(ctr_scaled(t, "inner").select("vec_id", F.col("label").cast("double").alias("label"), "scaled"), "ctr-scaled")
    parts = sampling.hash_split(scaled, F.col("vec_id"), 0.7)
    width = len(scaled.select("scaled").first()[0])
    return models.compare(models.ctr_models(width), parts.filter("part = 'train'"), parts.filter("part = 'test'"))
