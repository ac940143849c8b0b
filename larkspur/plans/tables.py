"""Sources and sinks, and user functions."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur import fixtures as fx
from larkspur.functions import stages, udfs
from larkspur.functions import vectors as vx
from larkspur.operators import behaviour
from larkspur.plans.registry import query
from larkspur.session import materialise, spread, work_path
from larkspur.sources import files, keyed

STAMP = "yyyy-MM-dd HH:mm:ss"


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv(t):
    path = work_path(t.spark, "customer-csv")
    files.write(t.customer, path, "csv", header=True)
    return files.read_csv(t.spark, path, t.customer.schema)


@query("""SELECT 'good' AS kind, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE l_orderkey % 7 <> 0
  UNION ALL SELECT 'bad', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem WHERE l_orderkey % 7 = 0""")
def src_csv_corrupt(t):
    whole = F.concat_ws(",", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    cut = F.concat_ws(",", "l_orderkey", "l_partkey")
    source = spread(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"))
    lines = source.select(F.when(F.col("l_orderkey") % 7 == 0, cut).otherwise(whole).alias("line"))
    good, bad = files.parse_lines(
        lines, "line", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")
    kept = good.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys")).withColumn("kind", F.lit("good"))
    key = F.element_at(F.split("line", ","), 1).cast("long")
    lost = bad.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).withColumn("kind", F.lit("bad"))
    return kept.unionByName(lost)


WIDE = """WITH v AS (SELECT vec_id, label, [CASE WHEN (vec_id + i) % 50 <> 0 THEN CAST(floor(CAST(embedding[i % 64 + 1] AS DOUBLE) * 1000) AS BIGINT) END FOR i IN range(365)] AS vals
    FROM embeddings WHERE vec_id % 11 <> 0)"""


@query(f"""{WIDE} SELECT vec_id, label, CAST(365 AS BIGINT) AS n, CAST(len(list_filter(vals, lambda x: x IS NULL)) AS BIGINT) AS missing, CAST(list_sum(vals) AS DOUBLE) AS total FROM v
  UNION ALL SELECT NULL, NULL, count(*), NULL, NULL FROM embeddings WHERE vec_id % 11 = 0""")
def src_csv_wide(t):
    """Lines of two fields and 365 numbers, some missing; every eleventh line is cut short or spoilt."""
    day = F.sequence(F.lit(0), F.lit(364))
    number = F.transform(day, lambda i: F.when((F.col("vec_id") + i) % 50 != 0, F.floor(F.element_at("embedding", (i % 64 + 1).cast("int")).cast("double") * 1000).cast("string")).otherwise(""))
    spoilt = F.when(F.col("vec_id") % 22 == 0, F.slice(number, 1, 300)).otherwise(F.concat(F.slice(number, 1, 364), F.array(F.lit("x"))))
    kept = F.when(F.col("vec_id") % 11 == 0, spoilt).otherwise(number)
    lines = spread(t.embeddings).select(F.concat_ws(",", F.col("vec_id").cast("string"), F.col("label").cast("string"), kept).alias("line"))
    good, bad = files.parse_wide(lines, "line", {"vec_id": "long", "label": "int"}, 365)
    rows = good.select("vec_id", "label", F.size("vals").cast("long").alias("n"), F.size(F.filter("vals", lambda x: x.isNull())).cast("long").alias("missing"),
                       vx.total(F.filter("vals", lambda x: x.isNotNull())).alias("total"))
    lost = bad.agg(F.count("*").alias("n")).select(F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("int").alias("label"), "n",
                                                   F.lit(None).cast("long").alias("missing"), F.lit(None).cast("double").alias("total"))
    return rows.unionByName(lost)


def types_of(df):
    return F.array_join(F.array(*[F.lit(f"{name} {kind}") for name, kind in df.dtypes]), ",")


@query("""SELECT 'file' AS form, 'c_custkey int,c_name string,c_nationkey int,c_acctbal double,c_mktsegment string' AS types, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
  UNION ALL SELECT 'lines', 'key int,balance double', count(*), round(sum(c_acctbal), 2) FROM customer""")
def src_csv_inferred(t):
    """Types found from the data: of files with a header, and of lines that lie in a column."""
    path = work_path(t.spark, "customer-csv")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    files.write(t.customer.select(*columns), path, "csv", header=True)
    back = files.infer_csv(t.spark, path)
    lines = t.customer.select(F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string")).alias("line"))
    told = files.infer_lines(lines, "line", ["key", "balance"])
    one = back.agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")).select(F.lit("file").alias("form"), types_of(back).alias("types"), "n", "total")
    two = told.agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("total")).select(F.lit("lines").alias("form"), types_of(told).alias("types"), "n", "total")
    return one.unionByName(two)


@query("""SELECT 'event_id bigint,event_type string,props string,ts string,user_id bigint,value double' AS types, count(*) AS n, round(sum(value), 3) AS total FROM events""")
def src_json_inferred(t):
    path = work_path(t.spark, "events-json")
    files.write(t.events, path, "json")
    back = t.spark.read.json(path)
    return back.agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total")).select(types_of(back).alias("types"), "n", "total")


@query("SELECT item_id, md5(text || chr(10)) AS digest FROM benchmark")
def src_text_whole(t):
    """A folder of small files, each read as one row."""
    path = work_path(t.spark, "benchmark-files")
    t.benchmark.select("text", "item_id").repartition("item_id").write.partitionBy("item_id").option("lineSep", "\n").text(path)
    back = files.read_text(t.spark, path, whole_file=True)
    return back.select(F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("long").alias("item_id"), F.md5("value").alias("digest"))


@query("SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def src_json(t):
    path = work_path(t.spark, "events-json")
    files.write(t.events, path, "json")
    return files.read_json(t.spark, path, t.events.schema).withColumn("ts", F.date_format("ts", STAMP))


@query("""SELECT lang, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
  CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS n_chars FROM documents GROUP BY 1""")
def src_text(t):
    path = work_path(t.spark, "documents-text")
    t.documents.select("lang", "text").write.partitionBy("lang").option("lineSep", "\n").text(path)
    lines = files.read_text(t.spark, path)
    lang = F.regexp_extract("path", "lang=([^/]+)/", 1)
    return lines.groupBy(lang.alias("lang")).agg(
        F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'")
def src_parquet(t):
    return files.query_parquet(t.spark, t.path("lineitem"), "l_orderkey, l_linenumber, l_quantity",
                               "l_quantity >= 45 AND l_returnflag = 'R'")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def src_orc(t):
    path = work_path(t.spark, "orders-orc")
    files.write(t.orders, path, "orc", compression="snappy")
    back = t.spark.read.schema(t.orders.schema).orc(path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))


@query("""SELECT label, count(*) AS n, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 3) AS total
  FROM embeddings GROUP BY 1""")
def src_libsvm(t):
    path = work_path(t.spark, "embeddings-libsvm")
    vectors = t.embeddings.select(
        F.col("label").cast("double").alias("label"), array_to_vector(vx.as_doubles(F.col("embedding"))).alias("features"))
    files.write(vectors, path, "libsvm")
    back = files.read_libsvm(t.spark, path, 64)
    return back.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.round(F.sum(vx.total(vector_to_array("features"))), 3).alias("total"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def src_incremental(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    split = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    old = rows.filter(F.col("o_orderdate") <= split)
    merged = keyed.incremental_merge(old, rows, "o_orderdate", split, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return merged.select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-10 13:00:00'""")
def src_hour_slice(t):
    return files.hour_slice(t.events, "ts", "2024-01-10 13:25:00").select("event_id", "user_id")


@query("""SELECT event_id, action, item FROM f_actions_log WHERE strftime(action_time, '%Y-%m-%d') = '2024-01-12'""")
def src_date_partition(t):
    path = work_path(t.spark, "actions-by-day")
    log = fx.actions_log(t).select(
        F.struct("event_id", "action", "item").alias("param"), F.date_format("action_time", "yyyy-MM-dd").alias("dt"))
    files.overwrite_partitions(log, path, "dt")
    day = files.read_partition(t.spark, path, log.schema, "dt", "2024-01-12")
    fresh = files.new_partitions(day, ["2024-01-11"], "dt")
    return fresh.select("param.event_id", "param.action", "param.item")


@query("""SELECT n_name, v.label AS label FROM nation JOIN (VALUES (0, 'north'), (1, 'south'), (2, NULL)) AS v(k, label)
  ON n_regionkey = v.k""")
def src_create(t):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("label", T.StringType())])
    made = t.spark.createDataFrame([(0, "north"), (1, "south"), (2, None)], schema)
    return t.nation.join(made, F.col("n_regionkey") == F.col("k")).select("n_name", "label")


@query("""SELECT form, n_name, v.label AS label FROM nation JOIN (VALUES (0, 'north'), (1, 'south'), (2, NULL)) AS v(k, label) ON n_regionkey = v.k,
  (VALUES ('dicts'), ('rows'), ('pandas'), ('ddl')) AS f(form)""")
def src_create_forms(t):
    """The same small table from dictionaries, rows, a pandas frame, and tuples with a DDL schema."""
    import pandas as pd

    pairs = [(0, "north"), (1, "south"), (2, None)]
    make = t.spark.createDataFrame
    made = {"dicts": make([{"k": k, "label": v} for k, v in pairs]), "rows": make([Row(k=k, label=v) for k, v in pairs]),
            "pandas": make(pd.DataFrame(pairs, columns=["k", "label"]), "k long, label string"), "ddl": make(pairs, "k int, label string")}
    parts = [t.nation.join(df, F.col("n_regionkey") == F.col("k")).select(F.lit(form).alias("form"), "n_name", "label") for form, df in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""SELECT r.k AS k, o.o_orderkey IS NOT NULL AS used FROM range(0, (SELECT max(o_orderkey) + 11 FROM orders), 2) AS r(k)
  LEFT JOIN orders o ON o.o_orderkey = r.k""")
def src_range(t):
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    numbers = t.spark.range(0, last + 11, 2).withColumnRenamed("id", "k")
    return (numbers.join(t.orders.select("o_orderkey"), F.col("k") == F.col("o_orderkey"), "left")
            .select("k", F.col("o_orderkey").isNotNull().alias("used")))


@query("SELECT n_nationkey, n_name, CAST(count(c_custkey) AS BIGINT) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")
def src_catalog_table(t):
    """A table registered over files that lie somewhere, asked by name, then taken out of the catalogue."""
    path = work_path(t.spark, "customer-files")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    t.customer.select("c_custkey", "c_nationkey").write.parquet(path)
    t.spark.sql(f"CREATE TABLE {table} (c_custkey BIGINT, c_nationkey INT) USING parquet LOCATION '{path}'")
    found = t.spark.table(table).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    counts = t.nation.join(found, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("customers"))
    result = materialise(counts, "customers-by-nation")
    t.spark.sql(f"DROP TABLE {table}")
    return result


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src_catalog(t):
    t.nation.createOrReplaceTempView("larkspur_nation")
    t.region.createOrReplaceGlobalTempView("larkspur_region")
    joined = t.spark.sql("""SELECT n_nationkey, n_name, r_name FROM larkspur_nation
        JOIN global_temp.larkspur_region ON n_regionkey = r_regionkey""")
    t.spark.catalog.dropTempView("larkspur_nation")
    t.spark.catalog.dropGlobalTempView("larkspur_region")
    return joined


@query("""SELECT f.fmt AS fmt, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
  FROM orders, (VALUES ('csv'), ('json'), ('orc'), ('parquet'), ('text')) AS f(fmt) GROUP BY 1""")
def sink_files(t):
    keys = t.orders.select("o_orderkey")
    parts = []
    for fmt in ("csv", "json", "orc", "parquet", "text"):
        path = work_path(t.spark, f"orders-{fmt}")
        files.write(keys.select(F.col("o_orderkey").cast("string")) if fmt == "text" else keys, path, fmt)
        schema = "value string" if fmt == "text" else keys.schema
        back = t.spark.read.schema(schema).format(fmt).load(path)
        key = F.col("value").cast("long") if fmt == "text" else F.col("o_orderkey")
        parts.append(back.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).withColumn("fmt", F.lit(fmt)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("""SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n,
  round(sum(CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-05' THEN value * 2 ELSE value END), 3) AS total
  FROM events GROUP BY 1""")
def sink_partitioned(t):
    path = work_path(t.spark, "events-by-day")
    daily = t.events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    files.overwrite_partitions(daily, path, "dt")
    one_day = daily.filter("dt = '2024-01-05'").withColumn("value", F.col("value") * 2)
    files.overwrite_partitions(one_day, path, "dt")
    back = t.spark.read.schema(daily.schema).parquet(path)
    return back.groupBy("dt").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query("""SELECT dt, count(*) AS n, round(sum(value), 3) AS total FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS dt, value * CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-05' AND event_id % 3 = 0 THEN 2 ELSE 1 END AS value FROM events
    WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-05' OR event_id % 3 = 0
    UNION ALL SELECT strftime(ts, '%Y-%m-%d'), value FROM events WHERE event_id % 5 = 0 AND strftime(ts, '%Y-%m-%d') <> '2024-01-05') GROUP BY 1""")
def sink_partitioned_table(t):
    """Three rounds on a catalogued table: made with all rows, added to, and one day replaced."""
    path = work_path(t.spark, "events-table")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    daily = t.events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    files.create_partitioned(daily, table, path, "dt")
    files.append_partitioned(daily.filter("event_id % 5 = 0"), table, "dt")
    one_day = daily.filter("dt = '2024-01-05' and event_id % 3 = 0").withColumn("value", F.col("value") * 2)
    files.insert_partitions(one_day.select("dt", "value", "event_id"), table)
    back = t.spark.table(table).groupBy("dt").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))
    result = materialise(back, "events-table-totals")
    t.spark.sql(f"DROP TABLE {table}")  # the catalogue entry; the files stay
    return result


@query("""SELECT user_id, article_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, shared, clicked, collected,
  exposure, read_time FROM f_basic""")
def sink_merge_overwrite(t):
    rows = fx.basic_rows(t)
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    merged = keyed.collapse_and_swap(
        rows.filter(F.col("action_time") < half), rows.filter(F.col("action_time") >= half),
        behaviour.merge_actions, "user-article-basic")
    return merged.withColumn("action_time", F.date_format("action_time", STAMP)).drop("channel_id")


@query("""SELECT row_key, family, qualifier, value, version FROM (SELECT *, row_number() OVER (
    PARTITION BY row_key, family, qualifier ORDER BY ts DESC, value DESC) AS version FROM (
    SELECT 'user:' || user_id AS row_key, 'partial' AS family, 'action' AS qualifier, event_type AS value, ts FROM events
    UNION ALL SELECT 'user:' || user_id, 'partial', 'event', CAST(event_id AS VARCHAR), ts FROM events))
  WHERE version <= 5
  UNION ALL SELECT row_key, 'latest', qualifier, value, 0 FROM (SELECT *, row_number() OVER (
    PARTITION BY row_key, qualifier ORDER BY ts DESC, value DESC) AS version FROM (
    SELECT 'user:' || user_id AS row_key, 'action' AS qualifier, event_type AS value, ts FROM events
    UNION ALL SELECT 'user:' || user_id, 'event', CAST(event_id AS VARCHAR), ts FROM events))
  WHERE version = 1""")
def sink_wide_kv(t):
    table = work_path(t.spark, "user-profile-cells")
    events = t.events.select("user_id", "ts", F.col("event_type").alias("action"), F.col("event_id").alias("event"))
    key = F.concat(F.lit("user:"), F.col("user_id"))
    all_cells = keyed.cells(events, key, "partial", ["action", "event"], "ts")
    keyed.put(table, all_cells)
    stored = t.spark.read.schema(all_cells.schema).parquet(table)
    history = keyed.versions(stored, 5).select("row_key", "family", "qualifier", "value", F.col("version").cast("long"))
    newest = keyed.latest_cells(stored).select(
        "row_key", F.lit("latest").alias("family"), "qualifier", "value", F.lit(0).cast("long").alias("version"))
    return history.unionByName(newest)


@query("""SELECT vec_id, len(embedding) AS width, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total FROM embeddings""")
def sink_pack_array(t):
    path = work_path(t.spark, "packed")
    t.embeddings.select("vec_id", files.pack(F.col("embedding")).alias("blob")).write.parquet(path)
    back = t.spark.read.schema("vec_id long, blob binary").parquet(path)
    unpacked = back.select("vec_id", files.unpack(F.col("blob")).alias("vals"))
    return unpacked.select("vec_id", F.size("vals").cast("long").alias("width"),
                           F.round(vx.total(vx.as_doubles(F.col("vals"))), 5).alias("total"))


# user functions -----------------------------------------------------------

@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS v
  FROM part""")
def udf_python(t):
    return t.part.select("p_partkey", udfs.title_case()("p_name").alias("v"))


@query("SELECT p_partkey, length(p_name) + p_size AS v FROM part")
def udf_sql(t):
    udfs.register_sql(t.spark, "larkspur_size", lambda text, n: len(text) + n, "int")
    t.part.createOrReplaceTempView("larkspur_part_udf")
    return t.spark.sql("SELECT p_partkey, larkspur_size(p_name, p_size) AS v FROM larkspur_part_udf")


@query("SELECT p_partkey, upper(p_name) AS v FROM part")
def udf_java(t):
    udfs.register_jvm(t.spark, "larkspur_upper", "com.example.functions.Upper", "string",
                      otherwise="(s STRING) RETURNS STRING RETURN upper(s)")
    t.part.createOrReplaceTempView("larkspur_part_jvm")
    return t.spark.sql("SELECT p_partkey, larkspur_upper(p_name) AS v FROM larkspur_part_jvm")


@query("SELECT p_partkey, upper(p_name) AS v FROM part")
def udf_pandas_scalar(t):
    return t.part.select("p_partkey", udfs.upper_series()("p_name").alias("v"))


@query("""SELECT o_orderkey, round((o_orderkey - avg(o_orderkey) OVER w) / stddev_samp(o_orderkey) OVER w, 6) AS z FROM f_dirty
  WINDOW w AS (PARTITION BY o_orderpriority)""")
def udf_pandas_grouped(t):
    """The rows without a priority are a group like the others."""
    orders = fx.dirty_orders(t).withColumn("x", F.col("o_orderkey").cast("double"))
    scored = udfs.grouped_scores(orders, ["o_orderpriority"], "x", "o_orderkey")
    return scored.select("o_orderkey", F.round("z", 6).alias("z"))


@query("SELECT count(*) AS n, true AS in_unit, true AS differ FROM events")
def udf_nondeterministic(t):
    noisy = udfs.with_noise(t.events.select("event_id", "value"), "value", seed=1)
    noise = noisy.select((F.col("value_noisy") - F.col("value")).alias("x"))
    return noise.agg(F.count("*").alias("n"), F.bool_and(F.col("x").between(-1e-6, 1 + 1e-6)).alias("in_unit"),
                     (F.max("x") - F.min("x") > 0.5).alias("differ"))


@query("SELECT event_id, article_id AS item FROM f_basic_rows")
def udf_explode_table(t):
    udfs.split_items_table(t.spark, "larkspur_split_items")
    fx.actions_log(t).createOrReplaceTempView("larkspur_actions")
    return t.spark.sql("""SELECT event_id, s.item FROM larkspur_actions a,
        LATERAL larkspur_split_items(a.article_text) s""")


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings")
def udf_transformer(t):
    path = work_path(t.spark, "rename-pipeline")
    text = t.embeddings.select("vec_id", F.to_json("embedding").alias("json"))
    pipeline = Pipeline(stages=[
        stages.TextToVector(inputCol="json", outputCol="raw"),
        stages.ColumnRenamer(inputCol="raw", outputCol="features")])
    pipeline.fit(text).write().overwrite().save(path)
    back = PipelineModel.load(path).transform(text)
    return back.select("vec_id", F.round(vx.total(vector_to_array("features")), 4).alias("total"))


@query("SELECT count(*) AS rows_sent, true AS all_batches_named FROM orders")
def udf_side_effect_partition(t):
    class CountingClient:
        def send(self, batch_key, rows):
            return len(rows)

    sent = udfs.send_batches(t.orders.select("o_orderkey", "o_totalprice"), CountingClient, "o_orderkey")
    return sent.agg(F.sum("sent").alias("rows_sent"), (F.count_distinct("batch_key") == F.count("*")).alias("all_batches_named"))
