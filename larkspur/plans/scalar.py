"""One query per built-in function: scalar, date, collection, JSON and aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.functions import text as tx
from larkspur.operators import windows
from larkspur.plans.registry import query

SHORT_DATE = "yyyy-MM-dd"
STAMP = "yyyy-MM-dd HH:mm:ss"


def row_wise(name: str, table: str, key: str, value, sql: str | None):
    """Register ``fn_<name>``: the key of a table with a computed ``v``."""

    def build(t):
        column = value() if callable(value) else value
        return getattr(t, table).select(key, column.alias("v"))

    text = f"SELECT {key}, {sql} AS v FROM {table}" if sql else None
    query(text, key=f"fn_{name}")(build)


def day(column: str):
    return F.date_format(column, SHORT_DATE)


# String functions.  Values are column factories, so importing needs no session.
ROW_WISE = [
    ("ascii", "part", "p_partkey", lambda: F.ascii("p_name"), "ascii(p_name)"),
    ("base64", "customer", "c_custkey", lambda: F.base64("c_name"), "base64(encode(c_name))"),
    ("concat", "customer", "c_custkey", lambda: F.concat("c_name", F.lit("/"), "c_mktsegment"),
     "c_name || '/' || c_mktsegment"),
    ("concat_ws", "customer", "c_custkey", lambda: F.concat_ws("-", "c_name", "c_mktsegment"),
     "concat_ws('-', c_name, c_mktsegment)"),
    ("decode", "documents", "doc_id", lambda: F.md5(F.decode(F.encode("text", "UTF-8"), "UTF-8")), "md5(text)"),
    ("format_number", "orders", "o_orderkey", lambda: F.format_number("o_totalprice", 2),
     "format('{:,.2f}', o_totalprice)"),
    ("format_string", "part", "p_partkey", lambda: F.format_string("%s:%05d", "p_name", "p_size"),
     "printf('%s:%05d', p_name, p_size)"),
    ("hash", "customer", "c_custkey", lambda: F.hash("c_custkey", "c_name"), None),
    ("initcap", "part", "p_partkey", lambda: F.initcap("p_name"),
     "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"),
    ("instr", "part", "p_partkey", lambda: F.instr("p_name", "e"), "instr(p_name, 'e')"),
    ("length", "documents", "doc_id", lambda: F.length("text"), "length(text)"),
    ("levenshtein", "part", "p_partkey", lambda: F.levenshtein("p_name", "p_type"), "levenshtein(p_name, p_type)"),
    ("locate", "part", "p_partkey", lambda: F.locate("l", F.col("p_name"), 3),
     "CASE WHEN instr(substr(p_name, 3), 'l') = 0 THEN 0 ELSE instr(substr(p_name, 3), 'l') + 2 END"),
    ("lpad", "part", "p_partkey", lambda: F.lpad("p_name", 14, "*"), "lpad(p_name, 14, '*')"),
    ("md5", "customer", "c_custkey", lambda: F.md5("c_name"), "md5(c_name)"),
    ("regexp_extract", "customer", "c_custkey", lambda: F.regexp_extract("c_name", "#0*([1-9][0-9]*)$", 1),
     "regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1)"),
    ("regexp_replace", "customer", "c_custkey", lambda: F.regexp_replace("c_name", "0+", "-"),
     "regexp_replace(c_name, '0+', '-', 'g')"),
    ("repeat", "part", "p_partkey", lambda: F.repeat("p_name", 2), "repeat(p_name, 2)"),
    ("split", "part", "p_partkey", lambda: F.array_join(F.split("p_name", "[ e]"), "|"),
     "array_to_string(regexp_split_to_array(p_name, '[ e]'), '|')"),
    ("substring", "part", "p_partkey", lambda: F.substring("p_name", 2, 4), "substring(p_name, 2, 4)"),
    ("lower", "documents", "doc_id", lambda: F.md5(F.lower("text")), "md5(lower(text))"),
    ("upper", "customer", "c_custkey", lambda: F.upper("c_name"), "upper(c_name)"),
    ("strip_tags", "pages", "page_id", lambda: F.md5(tx.strip_tags(F.col("html"))),
     f"md5(regexp_replace(html, '{tx.TAG}', '', 'g'))"),
    # math
    ("abs", "customer", "c_custkey", lambda: F.abs(F.col("c_acctbal") - 5000), "abs(c_acctbal - 5000)"),
    ("acos", "customer", "c_custkey", lambda: F.round(F.acos(F.col("c_acctbal") / 20000), 6),
     "round(acos(c_acctbal / 20000), 6)"),
    ("asin", "customer", "c_custkey", lambda: F.round(F.asin(F.col("c_acctbal") / 20000), 6),
     "round(asin(c_acctbal / 20000), 6)"),
    ("atan", "customer", "c_custkey", lambda: F.round(F.atan(F.col("c_acctbal") / 1000), 6),
     "round(atan(c_acctbal / 1000), 6)"),
    ("bin", "orders", "o_orderkey", lambda: F.bin("o_orderkey"), "bin(o_orderkey)"),
    ("bround", "part", "p_partkey", lambda: F.bround(F.col("p_size") / 2, 0), "round_even(p_size / 2, 0)"),
    ("cbrt", "orders", "o_orderkey", lambda: F.round(F.cbrt("o_totalprice"), 6), "round(cbrt(o_totalprice), 6)"),
    ("ceil", "orders", "o_orderkey", lambda: F.ceil("o_totalprice"), "CAST(ceil(o_totalprice) AS BIGINT)"),
    ("conv", "orders", "o_orderkey", lambda: F.conv(F.col("o_orderkey").cast("string"), 10, 16),
     "format('{:X}', o_orderkey)"),
    ("cos", "orders", "o_orderkey", lambda: F.round(F.cos(F.col("o_totalprice") / 1000), 6),
     "round(cos(o_totalprice / 1000), 6)"),
    ("cosh", "customer", "c_custkey", lambda: F.round(F.cosh(F.col("c_acctbal") / 5000), 6),
     "round(cosh(c_acctbal / 5000), 6)"),
    ("factorial", "part", "p_partkey", lambda: F.factorial(F.col("p_size") % 15), "CAST(factorial(p_size % 15) AS BIGINT)"),
    ("greatest", "part", "p_partkey", lambda: F.greatest(F.col("p_size").cast("double"), F.col("p_retailprice") - 900),
     "greatest(CAST(p_size AS DOUBLE), p_retailprice - 900)"),
    ("hex", "orders", "o_orderkey", lambda: F.hex("o_orderkey"), "hex(o_orderkey)"),
    ("hypot", "customer", "c_custkey", lambda: F.round(F.hypot("c_acctbal", F.lit(3.0)), 6),
     "round(sqrt(c_acctbal * c_acctbal + 9e0), 6)"),
    ("least", "part", "p_partkey", lambda: F.least(F.col("p_size").cast("double"), F.col("p_retailprice") - 900),
     "least(CAST(p_size AS DOUBLE), p_retailprice - 900)"),
    ("log", "orders", "o_orderkey", lambda: F.round(F.log("o_totalprice") + F.log(2.0, F.col("o_totalprice")), 6),
     "round(ln(o_totalprice) + ln(o_totalprice) / ln(2e0), 6)"),
    ("round", "customer", "c_custkey", lambda: F.round(F.col("c_acctbal") / 7, 3), "round(c_acctbal / 7, 3)"),
    ("sqrt", "orders", "o_orderkey", lambda: F.round(F.sqrt("o_totalprice"), 6), "round(sqrt(o_totalprice), 6)"),
    ("abs_arith", "part", "p_partkey",
     lambda: F.round((F.col("p_size") * 2 + 1) / (F.pow("p_retailprice", F.lit(2.0)) - F.col("p_size")), 9),
     "round((p_size * 2 + 1) / (pow(p_retailprice, 2e0) - p_size), 9)"),
    ("exp", "customer", "c_custkey", lambda: F.round(F.exp(-F.col("c_acctbal") / 5000), 6),
     "round(exp(-c_acctbal / 5000), 6)"),
    ("signum", "customer", "c_custkey", lambda: F.signum(F.floor(F.col("c_acctbal") / 1000) - 4),
     "CAST(sign(floor(c_acctbal / 1000) - 4) AS DOUBLE)"),
    ("sin", "orders", "o_orderkey", lambda: F.round(F.sin(F.col("o_totalprice") / 1000), 6),
     "round(sin(o_totalprice / 1000), 6)"),
    ("dot_product", "embeddings", "vec_id", lambda: F.round(_dot(), 5),
     "round(list_dot_product(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))), 5)"),
    # dates
    ("add_months", "orders", "o_orderkey", lambda: day(F.add_months("o_orderdate", 1)),
     "strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d')"),
    ("date_add", "orders", "o_orderkey", lambda: day(F.date_add("o_orderdate", 10)),
     "strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d')"),
    ("date_sub", "orders", "o_orderkey", lambda: day(F.date_sub("o_orderdate", 10)),
     "strftime(o_orderdate - INTERVAL 10 DAY, '%Y-%m-%d')"),
    ("date_format", "events", "event_id", lambda: F.date_format("ts", "MM/dd/yyyy HH:mm"), "strftime(ts, '%m/%d/%Y %H:%M')"),
    ("date_trunc", "events", "event_id", lambda: F.date_format(F.date_trunc("hour", "ts"), STAMP),
     "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')"),
    ("datediff", "orders", "o_orderkey", lambda: F.datediff(F.lit("2002-01-01"), "o_orderdate").cast("long"),
     "date_diff('day', o_orderdate, TIMESTAMP '2002-01-01')"),
    ("dayofmonth", "orders", "o_orderkey", lambda: F.dayofmonth("o_orderdate").cast("long"), "day(o_orderdate)"),
    ("dayofweek", "orders", "o_orderkey", lambda: F.dayofweek("o_orderdate").cast("long"), "dayofweek(o_orderdate) + 1"),
    ("dayofyear", "orders", "o_orderkey", lambda: F.dayofyear("o_orderdate").cast("long"), "dayofyear(o_orderdate)"),
    ("from_unixtime", "orders", "o_orderkey", lambda: F.from_unixtime(F.col("o_orderkey") * 86401, STAMP),
     "strftime(make_timestamp(o_orderkey * 86401 * 1000000), '%Y-%m-%d %H:%M:%S')"),
    ("from_utc_timestamp", "events", "event_id",
     lambda: F.date_format(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Shanghai"), STAMP),
     "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')"),
    ("hour", "events", "event_id", lambda: F.hour("ts").cast("long"), "hour(ts)"),
    ("minute", "events", "event_id", lambda: F.minute("ts").cast("long"), "minute(ts)"),
    ("second", "events", "event_id", lambda: F.second("ts").cast("long"), "second(ts)"),
    ("last_day", "orders", "o_orderkey", lambda: day(F.last_day("o_orderdate")), "strftime(last_day(o_orderdate), '%Y-%m-%d')"),
    ("to_date", "events", "event_id", lambda: day(F.to_date(F.date_format("ts", STAMP), STAMP)), "strftime(ts, '%Y-%m-%d')"),
    ("to_timestamp", "events", "event_id",
     lambda: F.date_format(F.to_timestamp(F.date_format("ts", "dd.MM.yyyy HH:mm"), "dd.MM.yyyy HH:mm"), STAMP),
     "strftime(strptime(strftime(ts, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M'), '%Y-%m-%d %H:%M:%S')"),
    ("year", "orders", "o_orderkey", lambda: F.year("o_orderdate").cast("long"), "year(o_orderdate)"),
    ("month", "orders", "o_orderkey", lambda: F.month("o_orderdate").cast("long"), "month(o_orderdate)"),
    ("quarter", "orders", "o_orderkey", lambda: F.quarter("o_orderdate").cast("long"), "quarter(o_orderdate)"),
    ("months_between", "orders", "o_orderkey",
     lambda: F.round(F.months_between(F.lit("2003-01-01").cast("date"), "o_orderdate"), 6),
     "round((2003 - year(o_orderdate)) * 12 + (1 - month(o_orderdate)) + (1 - day(o_orderdate)) / 31, 6)"),
    ("next_day", "orders", "o_orderkey", lambda: day(F.next_day("o_orderdate", "Mon")),
     "strftime(o_orderdate + to_days(CAST(8 - isodow(o_orderdate) AS INTEGER)), '%Y-%m-%d')"),
    # arrays, maps, JSON
    ("array", "part", "p_partkey", lambda: F.array_join(F.array("p_name", "p_type"), ","),
     "array_to_string([p_name, p_type], ',')"),
    ("array_contains", "part", "p_partkey", lambda: F.array_contains(F.split("p_name", " "), "bolt"),
     "list_contains(string_split(p_name, ' '), 'bolt')"),
    ("create_map", "part", "p_partkey", lambda: F.create_map(F.lit("t"), "p_type", F.lit("b"), "p_brand")["b"],
     "map(['t', 'b'], [p_type, p_brand])['b']"),
    ("from_json", "events", "event_id", lambda: F.from_json("props", "k int")["k"],
     "CAST(json_extract_string(props, '$.k') AS INTEGER)"),
    ("get_json_object", "events", "event_id", lambda: F.get_json_object("props", "$.k"), "json_extract_string(props, '$.k')"),
    ("map_keys", "part", "p_partkey",
     lambda: F.array_join(F.array_sort(F.map_keys(F.create_map("p_type", "p_size", "p_brand", "p_size"))), ","),
     "array_to_string(list_sort(map_keys(map([p_type, p_brand], [p_size, p_size]))), ',')"),
    ("map_values", "part", "p_partkey",
     lambda: F.array_join(F.array_sort(F.map_values(F.create_map("p_type", "p_name", "p_brand", "p_brand"))), ","),
     "array_to_string(list_sort(map_values(map([p_type, p_brand], [p_name, p_brand]))), ',')"),
    ("sort_array", "part", "p_partkey", lambda: F.array_join(F.sort_array(F.array("p_name", "p_type", "p_brand"), asc=False), ","),
     "array_to_string(list_reverse_sort([p_name, p_type, p_brand]), ',')"),
    ("to_json", "events", "event_id", lambda: F.to_json(F.struct("event_id", "event_type")),
     "CAST(json_object('event_id', event_id, 'event_type', event_type) AS VARCHAR)"),
    ("map_from_lists", "part", "p_partkey",
     lambda: F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array("p_name", "p_type"))["b"],
     "map(['a', 'b'], [p_name, p_type])['b']"),
    ("map_entries_filter", "part", "p_partkey",
     lambda: F.array_join(F.map_values(F.map_filter(
         F.create_map(F.lit("1:x"), "p_name", F.lit("2:y"), "p_type"),
         lambda k, v: F.element_at(F.split(k, ":"), 1) == "2")), ","),
     "array_to_string([p_type], ',')"),
    ("array_set_ops", "part", "p_partkey",
     lambda: F.array_join(F.array_sort(F.array_except(
         F.array_distinct(F.array_union(F.split("p_name", " "), F.array("p_type"))), F.array(F.lit("red")))), ","),
     "array_to_string(list_sort(list_filter(list_distinct(list_concat(string_split(p_name, ' '), [p_type])), "
     "lambda w: w <> 'red')), ',')"),
    ("array_slice", "part", "p_partkey", lambda: F.array_join(F.slice(F.array("p_name", "p_type", "p_brand"), 1, 2), ","),
     "array_to_string([p_name, p_type, p_brand][1:2], ',')"),
    # columns
    ("coalesce", "part", "p_partkey", lambda: F.coalesce(F.when(F.col("p_size") > 20, F.col("p_name")), "p_type"),
     "coalesce(CASE WHEN p_size > 20 THEN p_name END, p_type)"),
    ("col", "part", "p_partkey", lambda: F.col("p_name"), "p_name"),
    ("expr", "part", "p_partkey", lambda: F.expr("length(p_name) + p_size"), "length(p_name) + p_size"),
    ("lit", "part", "p_partkey", lambda: F.lit("fixed"), "'fixed'"),
    ("isnull", "part", "p_partkey", lambda: F.isnull(F.nullif("p_type", F.lit("PROMO"))), "nullif(p_type, 'PROMO') IS NULL"),
    ("when", "part", "p_partkey", lambda: F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "mid").otherwise("big"),
     "CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'mid' ELSE 'big' END"),
]


# Checksum by its definition: eight shifts for each byte, over the distinct names.
CRC = """WITH RECURSIVE crc(name, step, c) AS (SELECT DISTINCT c_name, 0, 4294967295::BIGINT FROM customer UNION ALL
    SELECT name, step + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM (
      SELECT name, step, CASE WHEN step % 8 = 0 THEN xor(c, ascii(substr(name, step // 8 + 1, 1))::BIGINT) ELSE c END AS x FROM crc WHERE step < 8 * length(name)))
  SELECT c_custkey, xor(c, 4294967295) AS v FROM customer JOIN crc ON name = c_name AND step = 8 * length(c_name)"""


@query(CRC)
def fn_crc32(t):
    return t.customer.select("c_custkey", F.crc32("c_name").alias("v"))


# Sound code by its definition: code of each letter, h and w passed over, equal neighbours once, vowels out, three digits.
SOUND = """WITH names AS (SELECT DISTINCT p_name, upper(p_name) AS n FROM part),
  letters AS (SELECT p_name, i, n[i] AS ch, CASE WHEN n[i] IN ('B', 'F', 'P', 'V') THEN '1' WHEN n[i] IN ('C', 'G', 'J', 'K', 'Q', 'S', 'X', 'Z') THEN '2'
      WHEN n[i] IN ('D', 'T') THEN '3' WHEN n[i] = 'L' THEN '4' WHEN n[i] IN ('M', 'N') THEN '5' WHEN n[i] = 'R' THEN '6' WHEN n[i] IN ('H', 'W') THEN 'hw' ELSE '0' END AS code
    FROM (SELECT p_name, n, unnest(range(1, length(n) + 1)) AS i FROM names)),
  parted AS (SELECT *, lag(code) OVER (PARTITION BY p_name ORDER BY i) AS last FROM letters WHERE code <> 'hw' OR i = 1),
  kept AS (SELECT p_name, string_agg(code, '' ORDER BY i) AS digits FROM parted WHERE i > 1 AND code <> '0' AND code IS DISTINCT FROM last GROUP BY 1)
  SELECT p_partkey, upper(p_name[1]) || rpad(coalesce(digits, '')[1:3], 3, '0') AS v FROM part LEFT JOIN kept USING (p_name)"""


@query(SOUND)
def fn_soundex(t):
    return t.part.select("p_partkey", F.soundex("p_name").alias("v"))


def _dot():
    from larkspur.functions import vectors as vx

    return vx.dot(F.col("embedding"), F.reverse("embedding"))


for _row in ROW_WISE:
    row_wise(*_row)


@query("""SELECT o_orderkey, CASE WHEN isnan(o_totalprice) THEN -1.0 ELSE o_totalprice END AS v FROM f_dirty""")
def fn_nanvl(t):
    return fx.dirty_orders(t).select("o_orderkey", F.nanvl("o_totalprice", F.lit(-1.0)).alias("v"))


@query("SELECT o_orderkey, isnan(o_totalprice) AS v FROM f_dirty")
def fn_isnan(t):
    return fx.dirty_orders(t).select("o_orderkey", F.isnan("o_totalprice").alias("v"))


@query("SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) <= current_date GROUP BY 1")
def fn_current_date(t):
    return t.events.filter(F.to_date("ts") <= F.current_date()).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events WHERE ts <= CAST(now() AS TIMESTAMP) GROUP BY 1")
def fn_current_timestamp(t):
    now = F.current_timestamp().cast("timestamp_ntz")
    return t.events.filter(F.col("ts") <= now).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT strftime(d, '%Y-%m-%d') AS d FROM (SELECT unnest(generate_series(
  (SELECT date_trunc('day', min(ts)) FROM events), (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL 1 DAY)) AS d)""")
def fn_date_list(t):
    span = t.events.agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("d")).select(day("d").alias("d"))


def some_words():
    """Words of a part name; empty for every seventh part, null for every eleventh."""
    words = F.split("p_name", " ")
    empty = F.array().cast("array<string>")
    return F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).when(F.col("p_partkey") % 7 == 0, empty).otherwise(words)


SOME_WORDS = """(SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN CAST([] AS VARCHAR[])
  ELSE string_split(p_name, ' ') END AS w FROM part)"""


@query(f"SELECT p_partkey, unnest(w) AS word FROM {SOME_WORDS}")
def fn_explode(t):
    return t.part.select("p_partkey", F.explode(some_words()).alias("word"))


@query(f"SELECT p_partkey, u.word AS word FROM {SOME_WORDS} p LEFT JOIN LATERAL (SELECT unnest(p.w) AS word) u ON true")
def fn_explode_outer(t):
    return t.part.select("p_partkey", F.explode_outer(some_words()).alias("word"))


@query(f"SELECT p_partkey, u.pos - 1 AS pos, u.word AS word FROM {SOME_WORDS} p, unnest(p.w) WITH ORDINALITY AS u(word, pos)")
def fn_posexplode(t):
    return t.part.select("p_partkey", F.posexplode(some_words()).alias("pos", "word"))


@query(f"""SELECT p_partkey, u.pos - 1 AS pos, u.word AS word FROM {SOME_WORDS} p
  LEFT JOIN LATERAL (SELECT * FROM unnest(p.w) WITH ORDINALITY AS x(word, pos)) u ON true""")
def fn_posexplode_outer(t):
    return t.part.select("p_partkey", F.posexplode_outer(some_words()).alias("pos", "word"))


@query("""SELECT p_partkey, 'brand' AS k, p_brand AS v FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part""")
def fn_explode_map(t):
    t.part.createOrReplaceTempView("larkspur_part")
    return t.spark.sql("""SELECT p_partkey, k, v FROM larkspur_part
        LATERAL VIEW explode(map('brand', p_brand, 'type', p_type)) m AS k, v""")


# aggregates ---------------------------------------------------------------

@query("SELECT count(DISTINCT o_custkey) AS exact, true AS near FROM orders")
def fn_approxCountDistinct(t):
    counts = t.orders.agg(F.approx_count_distinct("o_custkey", 0.05).alias("about"), F.count_distinct("o_custkey").alias("exact"))
    return counts.select("exact", (F.abs(F.col("about") - F.col("exact")) <= 0.2 * F.col("exact")).alias("near"))  # four standard errors


@query("""SELECT l_orderkey, (n - 1) // 4 AS chunk, array_to_string(list_sort(list(l_partkey)), ',') AS v FROM (
    SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY place) AS n FROM (
      SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS place FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem))) GROUP BY 1, 2""")
def fn_collect_list(t):
    from larkspur.operators import aggregates as ag

    parts = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    lists = ag.collect_chunks(parts, ["l_orderkey"], "l_partkey", "l_partkey", size=4)
    return lists.select("l_orderkey", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("v"))


@query("""SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS v FROM events GROUP BY 1""")
def fn_collect_set(t):
    return t.events.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("v"))


def grouped(name: str, value, sql: str):
    """Register ``fn_<name>`` as an aggregate of lineitem by return flag."""

    def build(t):
        return t.lineitem.groupBy("l_returnflag").agg(value().alias("v"))

    query(f"SELECT l_returnflag, {sql} AS v FROM lineitem GROUP BY 1", key=f"fn_{name}")(build)


GROUPED = [
    ("corr", lambda: F.round(F.corr("l_extendedprice", "l_quantity"), 8), "round(corr(l_extendedprice, l_quantity), 8)"),
    ("count", lambda: F.count("l_orderkey"), "count(l_orderkey)"),
    ("countDistinct", lambda: F.count_distinct("l_partkey"), "count(DISTINCT l_partkey)"),
    ("covar_pop", lambda: F.round(F.covar_pop("l_extendedprice", "l_quantity"), 2),
     "round(covar_pop(l_extendedprice, l_quantity), 2)"),
    ("covar_samp", lambda: F.round(F.covar_samp("l_extendedprice", "l_quantity"), 2),
     "round(covar_samp(l_extendedprice, l_quantity), 2)"),
    ("stddev", lambda: F.round(F.stddev_samp("l_extendedprice"), 4), "round(stddev_samp(l_extendedprice), 4)"),
]
for _row in GROUPED:
    grouped(*_row)


@query("""SELECT l_returnflag, sum(l_quantity) AS s, round(avg(l_quantity), 6) AS a, min(l_tax) AS lo, max(l_tax) AS hi
  FROM lineitem GROUP BY 1""")
def fn_sum_avg_min_max(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("s"), F.round(F.avg("l_quantity"), 6).alias("a"),
        F.min("l_tax").alias("lo"), F.max("l_tax").alias("hi"))


@query("""SELECT DISTINCT l_returnflag, l_quantity, round(cume_dist() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 8)
  AS v FROM lineitem""")
def fn_cume_dist(t):
    shares = windows.cume_dist(t.lineitem.select("l_returnflag", "l_quantity"), ["l_returnflag"], "l_quantity", "v")
    return shares.select("l_returnflag", "l_quantity", F.round("v", 8).alias("v"))


@query("""SELECT o_orderstatus, grouping(o_orderstatus) AS g, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus)""")
def fn_grouping(t):
    return t.orders.cube("o_orderstatus").agg(F.grouping("o_orderstatus").cast("long").alias("g"), F.count("*").alias("n"))


@query("""SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS g, count(*) AS n FROM orders
  GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def fn_grouping_id(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))


# columns and order --------------------------------------------------------

@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def fn_asc(t):
    return t.orders.orderBy(F.asc("o_totalprice"), F.asc("o_orderkey")).select("o_orderkey", "o_totalprice").limit(25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25")
def fn_desc(t):
    return t.orders.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).select("o_orderkey", "o_totalprice").limit(25)


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def fn_broadcast(t):
    # nation is a fixed table of 25 rows.
    return (t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_name"))


@query("SELECT 'orders.parquet' AS file, count(*) AS n FROM orders")
def fn_input_file_name(t):
    # The table's own part of the path: it may be one file or a folder of files.
    file = F.regexp_extract(F.input_file_name(), "([^/]+[.]parquet)", 1)
    return t.orders.select(file.alias("file")).groupBy("file").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, true AS in_unit, true AS middle, true AS all_different FROM orders")
def fn_rand(t):
    drawn = t.orders.select(F.rand(seed=11).alias("x"))
    measured = drawn.agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"), F.count_distinct("x").alias("k"))
    return measured.select("n", ((F.col("low") >= 0) & (F.col("high") < 1)).alias("in_unit"),
                           (F.abs(F.col("mean") - 0.5) <= 5 * F.sqrt(1 / (12 * F.col("n")))).alias("middle"), (F.col("k") == F.col("n")).alias("all_different"))


@query("SELECT count(*) AS n, true AS mean_near_0, true AS sd_near_1 FROM orders")
def fn_randn(t):
    drawn = t.orders.select(F.randn(seed=11).alias("x"))
    measured = drawn.agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"))
    return measured.select("n", (F.abs("mean") <= 5 / F.sqrt("n")).alias("mean_near_0"), (F.abs(F.col("sd") - 1) <= 5 / F.sqrt(2 * F.col("n"))).alias("sd_near_1"))
