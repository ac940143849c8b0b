"""Articles: words, weights, keyword graphs, profiles, vectors and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import fixtures as fx
from larkspur.functions import text as tx
from larkspur.functions import vectors as vx
from larkspur.operators import behaviour, sampling, similarity, text
from larkspur.plans.registry import query
from larkspur.session import materialise

STAMP = "yyyy-MM-dd HH:mm:ss"
WORD_KEY = "CAST(('0x' || substr(md5(keyword), 1, 15)) AS BIGINT)"

# SQL twins of the word tables, as CTE text.
COUNTS = "counts AS MATERIALIZED (SELECT article_id, channel_id, word AS keyword, count(*) AS tf FROM f_tokens GROUP BY 1, 2, 3)"
IDF = f"""{COUNTS}, idf AS MATERIALIZED (SELECT keyword, ln(((SELECT count(*) FROM f_articles) + 1) / (count(*) + 1)) AS idf,
  sum(tf) AS total FROM counts GROUP BY 1)"""
TFIDF = f"""{IDF}, tfidf AS MATERIALIZED (SELECT article_id, channel_id, keyword, round(w, 4) AS tfidf FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY w DESC, encode(keyword)) AS rn FROM (
    SELECT article_id, channel_id, c.keyword, tf * idf AS w FROM counts c JOIN idf i ON c.keyword = i.keyword)) WHERE rn <= 20)"""


def rank_rounds(rounds: int = 10) -> str:
    """The keyword graph and its unrolled rounds."""
    parts = [
        "tok AS MATERIALIZED (SELECT article_id, word, row_number() OVER (PARTITION BY article_id ORDER BY pos) AS p FROM f_tokens)",
        """pairs AS (SELECT x.article_id, x.word AS a, y.word AS b, count(*) AS n FROM tok x JOIN tok y
          ON x.article_id = y.article_id AND y.p IN (x.p + 1, x.p + 2, x.p + 3, x.p + 4) GROUP BY 1, 2, 3)""",
        """edges AS MATERIALIZED (SELECT article_id, src, dst, sum(n) AS w FROM (
          SELECT article_id, a AS src, b AS dst, n FROM pairs UNION ALL SELECT article_id, b, a, n FROM pairs) GROUP BY 1, 2, 3)""",
        "outs AS MATERIALIZED (SELECT article_id, src, sum(w) AS o FROM edges GROUP BY 1, 2)",
        """shares AS MATERIALIZED (SELECT e.article_id, e.src, e.dst, e.w / o.o AS share FROM edges e JOIN outs o
          ON e.article_id = o.article_id AND e.src = o.src)""",
        """r0 AS MATERIALIZED (SELECT article_id, src AS word, 1.0e0 / count(*) OVER (PARTITION BY article_id) AS r FROM outs)""",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS MATERIALIZED (SELECT s.article_id, s.dst AS word, 0.15e0 + 0.85e0 * sum(s.share * r.r) AS r
          FROM shares s JOIN r{i - 1} r ON s.article_id = r.article_id AND s.src = r.word GROUP BY 1, 2)""")
    parts.append(f"""scaled AS (SELECT article_id, word, round((r - lo / 10) / (hi - lo / 10), 9) AS s FROM (
          SELECT *, min(r) OVER w AS lo, max(r) OVER w AS hi FROM r{rounds} WINDOW w AS (PARTITION BY article_id)))""")
    parts.append("""ranked AS MATERIALIZED (SELECT s.article_id, a.channel_id, word AS keyword, s AS textrank FROM (
          SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY s DESC, encode(word)) AS rn FROM scaled) s
          JOIN f_articles a ON s.article_id = a.article_id WHERE rn <= 20)""")
    return ", ".join(parts)


def word_tables(t, keep_words: bool = False):
    articles = fx.articles(t)
    words = text.tokenize(articles)
    if keep_words:
        words = materialise(words, "article-words")
    counts = text.term_counts(words)
    return articles, words, counts, text.idf_table(counts, articles)


@query("""SELECT user_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, article_id, channel_id, shared, clicked,
  collected, exposure, read_time FROM f_basic_rows""")
def app_action_flatten(t):
    rows = fx.basic_rows(t)
    return rows.withColumn("action_time", F.date_format("action_time", STAMP)).drop("event_id")


@query("""SELECT user_id, article_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, channel_id, shared, clicked,
  collected, exposure, read_time FROM f_basic""")
def app_action_merge(t):
    return fx.user_article_basic(t).withColumn("action_time", F.date_format("action_time", STAMP))


TITLE_TOPICS = f"""title_topics AS (SELECT article_id, channel_id, list_distinct({tx.topic_words_sql('title')}) AS topics FROM f_articles)"""
LABELS = f"""{TITLE_TOPICS}, weights AS (SELECT user_id, x.channel_id, topic, arg_max(weight, (action_time, article_id)) AS weight FROM (
    SELECT b.user_id, b.article_id, b.action_time, tt.channel_id, unnest(tt.topics) AS topic,
      (1 / (ln(floor(epoch(TIMESTAMP '{fx.AS_OF}' - action_time) / 86400) + 1) + 1)) * (3 * CAST(shared AS INTEGER)
        + 5 * CAST(clicked AS INTEGER) + 2 * CAST(collected AS INTEGER) + CASE WHEN read_time > 1000 THEN 2 ELSE 1 END) AS weight
    FROM f_basic b JOIN title_topics tt ON b.article_id = tt.article_id) x GROUP BY 1, 2, 3)"""


def title_topics(t):
    words = F.array_distinct(tx.topic_words(F.col("title")))
    return fx.articles(t).select("article_id", "channel_id", words.alias("topics"))


def user_weights(t):
    return behaviour.label_weights(fx.user_article_basic(t), title_topics(t), fx.AS_OF)


@query(f"WITH {LABELS} SELECT user_id, channel_id, topic, round(weight, 8) AS weight FROM weights")
def app_user_label_weight(t):
    return user_weights(t).withColumn("weight", F.round("weight", 8))


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE CAST(date_sub('year', DATE '1960-01-01' +
  CAST(c_custkey % 15000 AS INTEGER), CAST(TIMESTAMP '{fx.AS_OF}' AS DATE)) AS INTEGER) END AS age FROM customer""")
def app_user_age(t):
    born = F.date_add(F.lit("1960-01-01").cast("date"), F.pmod("c_custkey", F.lit(15000)).cast("int")).cast("string")
    text_date = F.when(F.col("c_custkey") % 9 == 0, "null").otherwise(born)
    return t.customer.select("c_custkey", behaviour.age(text_date, fx.AS_OF).alias("age"))


@query("SELECT article_id, channel_id, md5(sentence) AS digest FROM f_articles")
def app_sentence_merge(t):
    articles = fx.articles(t)
    channels = articles.select("channel_id", "channel_name").distinct()
    merged = text.merge_sentences(
        articles.select("article_id", "channel_id", "title"), channels, articles.select("article_id", "content"))
    return merged.select("article_id", "channel_id", F.md5("sentence").alias("digest"))


@query("""SELECT article_id, count(*) AS n, CAST(sum(length(word)) AS BIGINT) AS letters, md5(string_agg(word, ' ' ORDER BY pos)) AS digest
  FROM f_tokens GROUP BY 1""")
def app_tokenize(t):
    words = text.tokenize(fx.articles(t)).filter(F.size("words") > 0)
    letters = F.aggregate("words", F.lit(0), lambda acc, w: acc + F.length(w))
    return words.select("article_id", F.size("words").cast("long").alias("n"), letters.cast("long").alias("letters"),
                        F.md5(F.array_join("words", " ")).alias("digest"))


@query(f"WITH {COUNTS} SELECT article_id, keyword, tf FROM counts")
def app_count_vectors(t):
    return word_tables(t)[2].select("article_id", "keyword", "tf")


@query(f"""WITH {IDF} SELECT keyword, round(idf, 8) AS idf, row_number() OVER (ORDER BY total DESC, {WORD_KEY}) - 1 AS index FROM idf""")
def app_idf_table(t):
    return text.indexed(materialise(word_tables(t)[3], "idf-keywords")).withColumn("idf", F.round("idf", 8))


@query(f"WITH {TFIDF} SELECT article_id, channel_id, keyword, tfidf FROM tfidf")
def app_tfidf_topk(t):
    _, _, counts, idf = word_tables(t)
    return text.tfidf_topk(counts, idf)


@query(f"WITH {rank_rounds()} SELECT article_id, channel_id, keyword, textrank FROM ranked")
def app_textrank(t):
    return text.textrank(word_tables(t)[1])


@query(f"""WITH {IDF}, {rank_rounds()} SELECT article_id, channel_id, r.keyword AS keyword, round(textrank * idf, 6) AS weight
  FROM ranked r JOIN idf i ON r.keyword = i.keyword""")
def app_keyword_weights(t):
    _, words, _, idf = word_tables(t, keep_words=True)
    maps = text.keyword_weights(text.textrank(words), idf)
    return (maps.select("article_id", "channel_id", F.explode("keywords").alias("keyword", "weight"))
            .withColumn("weight", F.round("weight", 6)))


@query(f"""WITH {TFIDF}, {rank_rounds()} SELECT t.article_id, array_to_string(list_sort(list(DISTINCT t.keyword)), ',') AS topics
  FROM tfidf t JOIN ranked r ON t.article_id = r.article_id AND t.keyword = r.keyword GROUP BY 1""")
def app_topics(t):
    _, words, counts, idf = word_tables(t, keep_words=True)
    sets = text.topics(text.tfidf_topk(counts, idf), text.textrank(words))
    return sets.select("article_id", F.array_join("topics", ",").alias("topics"))


@query(f"""WITH {TFIDF}, {rank_rounds()} SELECT t.article_id, array_to_string(list_sort(list(DISTINCT t.keyword)), ',') AS topics
  FROM tfidf t WHERE t.keyword IN (SELECT keyword FROM ranked) GROUP BY 1""")
def join_theta_topic(t):
    _, words, counts, idf = word_tables(t, keep_words=True)
    sets = text.topics(text.tfidf_topk(counts, idf), text.textrank(words), global_match=True)
    return sets.select("article_id", F.array_join("topics", ",").alias("topics"))


@query(f"""WITH {TFIDF}, {rank_rounds()}, maps AS (SELECT r.article_id, min(r.channel_id) AS channel_id, count(*) AS n_keywords,
    sum(textrank * idf) AS total FROM ranked r JOIN idf i ON r.keyword = i.keyword GROUP BY 1),
  sets AS (SELECT t.article_id, array_to_string(list_sort(list(DISTINCT t.keyword)), ',') AS topics
    FROM tfidf t JOIN ranked r ON t.article_id = r.article_id AND t.keyword = r.keyword GROUP BY 1)
  SELECT article_id, channel_id, n_keywords, round(total, 5) AS total, topics FROM maps JOIN sets USING (article_id)""")
def app_article_profile(t):
    _, words, counts, idf = word_tables(t, keep_words=True)
    ranked = materialise(text.textrank(words), "textrank-keywords")
    profile = text.article_profile(
        text.keyword_weights(ranked, idf), text.topics(text.tfidf_topk(counts, idf), ranked))
    total = F.aggregate(F.map_values("keywords"), F.lit(0.0), lambda acc, x: acc + x)
    return profile.select("article_id", "channel_id", F.size("keywords").cast("long").alias("n_keywords"),
                          F.round(total, 5).alias("total"), F.array_join("topics", ",").alias("topics"))


@query("SELECT channel_id, word AS keyword, 100 AS width, true AS has_length FROM f_tokens GROUP BY 1, 2 HAVING count(*) >= 3")
def app_word_vectors(t):
    return word_vectors(t).select("channel_id", "keyword", F.size("vec").alias("width"), (vx.norm(F.col("vec")) > 0).alias("has_length"))


@query()
def app_word_vector_values(t):
    return word_vectors(t).select("channel_id", "keyword", F.transform("vec", lambda x: F.round(x, 6)).alias("vec"))


def word_vectors(t):
    return text.word_vectors(word_tables(t)[1], size=100, min_count=3)


@query()
def app_word_synonyms(t):
    near = text.synonyms(materialise(word_vectors(t), "word-vectors"), k=10)
    return near.select("channel_id", "keyword", "synonym", F.round("cosine", 6).alias("cosine"), "rank")


@query(f"""WITH {TFIDF}, x AS (SELECT DISTINCT article_id, channel_id, list_transform(CAST(e.embedding AS DOUBLE[]), lambda v: v * tfidf) AS x
    FROM tfidf JOIN embeddings e ON e.vec_id = CAST(('0x' || substr(md5(keyword), 1, 8)) AS BIGINT) % (SELECT count(*) FROM embeddings))
  SELECT article_id, channel_id, CAST(u.slot - 1 AS INTEGER) AS slot, round(avg(u.v), 6) AS v
  FROM x, unnest(x.x) WITH ORDINALITY AS u(v, slot) GROUP BY 1, 2, 3""")
def app_doc_vector(t):
    _, _, counts, idf = word_tables(t)
    n = t.embeddings.select(F.count("*")).scalar()
    best = (text.tfidf_topk(counts, idf).withColumnRenamed("tfidf", "weight")
            .withColumn("vec_id", F.pmod(sampling.hash_number(F.col("keyword")), n)))
    vectors = t.embeddings.select("vec_id", F.col("embedding").alias("vec"))
    docs = text.document_vectors(best, vectors, ["vec_id"])
    return docs.select("article_id", "channel_id", F.posexplode("vec").alias("slot", "v")).withColumn("v", F.round("v", 6))


@query()
def app_item_similar(t):
    items = fx.item_vectors(t)
    similar = similarity.nearest_listed(items, lambda reps: similarity.hashed_lists(reps, 10, 64, 2.0), k=10)
    return similar.withColumn("distance", F.round("distance", 6))


@query()
def join_lsh(t):
    return similarity.hashed_pairs(fx.item_vectors(t), 64, 1.2).withColumn("distance", F.round("distance", 6))


@query("""SELECT a.channel_id, a.item_id AS a_id, b.item_id AS b_id, round(list_distance(a.vec, b.vec), 6) AS distance
  FROM f_item_vectors a JOIN f_item_vectors b ON a.channel_id = b.channel_id AND a.item_id < b.item_id
  WHERE list_distance(a.vec, b.vec) < 1.25""")
def join_similarity_exact(t):
    return similarity.pairs_within(fx.item_vectors(t), 1.25).withColumn("distance", F.round("distance", 6))
