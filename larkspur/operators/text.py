"""Word weighting: term counts, inverse document frequency, keyword graphs, profiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions import vectors as vx
from larkspur.operators import windows
from larkspur.operators.retrieval import best_products
from larkspur.session import materialise, work_path

DOC = ["article_id", "channel_id"]


def merge_sentences(basic: DataFrame, channels: DataFrame, contents: DataFrame) -> DataFrame:
    """Channel name, title and content as one text per article."""
    joined = basic.join(channels, "channel_id").join(contents, "article_id", "left")
    return joined.select(
        *DOC, "channel_name", "title", "content",
        F.concat_ws(",", "channel_name", "title", F.coalesce("content", F.lit(""))).alias("sentence"))


def tokenize(articles: DataFrame, column: str = "sentence") -> DataFrame:
    return articles.select(*DOC, tx.topic_words(F.col(column)).alias("words"))


def term_counts(words: DataFrame) -> DataFrame:
    """Occurrences of each word in each article.

    The lists travel to their article whole: words of one article hardly meet
    elsewhere, so tables of them ahead of the shuffle would only spill.
    """
    return words.repartition("article_id").select(*DOC, F.explode("words").alias("keyword")).groupBy(*DOC, "keyword").agg(F.count("*").alias("tf"))


def word_key(word: str) -> Column:
    """A 60-bit number from the md5 of a word, to break ties between equal counts."""
    return F.conv(F.substring(F.md5(word), 1, 15), 16, 10).cast("long")


def idf_table(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """keyword, idf = ln((N + 1) / (df + 1)); N counts every document, also those without words."""
    n = documents.select(F.count("*")).scalar()
    return (
        counts.groupBy("keyword").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        .withColumn("idf", F.log((n + 1) / (F.col("df") + 1)))
    )


def indexed(idf: DataFrame) -> DataFrame:
    """Vocabulary index: most frequent word first."""
    ordered = idf.withColumn("_o", -F.col("total")).withColumn("_k", word_key("keyword"))
    placed = windows.position(ordered, "_o", "_k", name="index")
    return placed.select("keyword", "idf", (F.col("index") - 1).alias("index"))


def tfidf_topk(counts: DataFrame, idf: DataFrame, k: int = 20) -> DataFrame:
    """Best ``k`` words of each article by tf x idf, rounded to 4 places.

    The weights are written first, so Spark knows their size and sends small
    ones to the counts, which then stay with their article.
    """
    weighted = counts.join(materialise(idf.select("keyword", "idf"), "idf"), "keyword").withColumn("tfidf", F.col("tf") * F.col("idf"))
    best = windows.top_k(weighted, ["article_id"], [F.desc("tfidf"), F.asc("keyword")], k)
    return best.select(*DOC, "keyword", F.round("tfidf", 4).alias("tfidf"))


def textrank(words: DataFrame, k: int = 20, window: int = 5, damping: float = 0.85, rounds: int = 10) -> DataFrame:
    """Best ``k`` words of each article by rank in its co-occurrence graph.

    The graph of an article is no larger than its text times the window, and
    articles do not touch each other.  So each is ranked where its row lies:
    one pass in Arrow batches, no shuffle for the graph nor for its rounds, and
    at most ``k`` rows per article leave the task.
    """

    def rank_one(tokens):
        code, vocabulary = pd.factorize(np.asarray(tokens, dtype=object), sort=True)
        n, steps = len(vocabulary), range(1, min(window, len(code)))
        first = np.concatenate([code[:-g] for g in steps])
        second = np.concatenate([code[g:] for g in steps])
        cells, count = np.unique(np.concatenate([first * n + second, second * n + first]), return_counts=True)
        src, dst = np.divmod(cells, n)
        share = count / np.bincount(src, weights=count, minlength=n)[src]
        rank = np.full(n, 1.0 / n)
        for _ in range(rounds):
            rank = (1 - damping) + damping * np.bincount(dst, weights=share * rank[src], minlength=n)
        low, high = rank.min(), rank.max()
        score = np.round((rank - low / 10) / (high - low / 10), 9)
        best = np.lexsort((np.arange(n), -score))[:k]
        return vocabulary[best], score[best]

    def rank_batches(batches):
        for pdf in batches:
            scored = [rank_one(tokens) for tokens in pdf["words"]]
            sizes = [len(kept) for kept, _ in scored]
            if sizes:
                yield pd.DataFrame({
                    "article_id": np.repeat(pdf["article_id"].to_numpy(), sizes),
                    "channel_id": np.repeat(pdf["channel_id"].to_numpy(), sizes),
                    "keyword": np.concatenate([kept for kept, _ in scored]),
                    "textrank": np.concatenate([score for _, score in scored])})

    ranked = words.filter(F.size("words") > 1).mapInPandas(
        rank_batches, "article_id long, channel_id int, keyword string, textrank double")
    return ranked


def keyword_weights(ranked: DataFrame, idf: DataFrame) -> DataFrame:
    """Per article a map from keyword to textrank x idf (at most k keywords)."""
    weighted = ranked.join(idf.select("keyword", "idf"), "keyword")
    entry = F.struct("keyword", (F.col("textrank") * F.col("idf")).alias("weight"))
    return weighted.groupBy("article_id").agg(
        F.min("channel_id").alias("channel_id"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("keywords"))


def topics(tfidf: DataFrame, ranked: DataFrame, global_match: bool = False) -> DataFrame:
    """Words that both rankings chose.

    By default both must choose it for the same article; ``global_match`` lets
    the graph ranking of any article count.
    """
    on = ["keyword"] if global_match else ["article_id", "keyword"]
    shared = tfidf.join(ranked.select(*on).distinct(), on, "left_semi")
    return shared.groupBy("article_id").agg(F.array_sort(F.collect_set("keyword")).alias("topics"))


def article_profile(weights: DataFrame, topic_sets: DataFrame) -> DataFrame:
    return weights.join(topic_sets, "article_id").select(*DOC, "keywords", "topics")


def word_vectors(words: DataFrame, size: int = 100, min_count: int = 3, parts: int = 8, seed: int = 1) -> DataFrame:
    """Word vectors of every channel, from a fit of its own sentences only.

    Channels are fitted one after the other and each one's vectors are written
    before the next starts: Spark's Word2Vec holds a vocabulary in the driver,
    which so is that of the largest channel and never that of all.  A channel
    without a word of ``min_count`` occurrences has no vectors.
    """
    folder, spark = work_path(words.sparkSession, "channel-words"), words.sparkSession
    words.select("channel_id", "words").write.partitionBy("channel_id").parquet(folder)
    table = spark.read.schema(words.select("words", "channel_id").schema).parquet(folder)
    often = table.select("channel_id", F.explode("words").alias("w")).groupBy("channel_id", "w").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    vectors = spark.createDataFrame([], "channel_id int, keyword string, vec array<double>")
    for channel, in often.select("channel_id").distinct().orderBy("channel_id").collect():  # one row a channel
        own = F.lit(channel).cast("int")
        model = Word2Vec(vectorSize=size, minCount=min_count, inputCol="words", outputCol="v", seed=seed,
                         numPartitions=parts).fit(table.where(F.col("channel_id").eqNullSafe(own)).select("words"))
        found = model.getVectors().select(own.alias("channel_id"), F.col("word").alias("keyword"), vector_to_array("vector").alias("vec"))
        vectors = vectors.unionByName(materialise(found, "word-vectors"))
    return vectors


def synonyms(vectors: DataFrame, k: int = 10, **search) -> DataFrame:
    """``k`` words of the same channel nearest by cosine to each word (exact), see :func:`retrieval.best_products`.

    Words without a length have no neighbours and are none.
    """
    size = vx.norm(F.col("vec"))
    units = vectors.where(size > 0).select("channel_id", "keyword", vx.scale(F.col("vec"), 1 / size).alias("vec"))
    near = best_products(units.withColumnRenamed("keyword", "user_id"), units.withColumnRenamed("keyword", "item_id"), k + 1, **search)
    other = near.where("user_id <> item_id").select("channel_id", F.col("user_id").alias("keyword"), F.col("item_id").alias("synonym"), F.col("score").alias("cosine"))
    return windows.top_k(other, ["channel_id", "keyword"], [F.desc("cosine"), F.asc("synonym")], k)


def document_vectors(weights: DataFrame, vectors: DataFrame, on: Sequence[str]) -> DataFrame:
    """Mean of the distinct weight x word vector products of an article.

    ``weights`` has article_id, channel_id, keyword, weight; ``vectors`` has the
    columns of ``on`` and an array ``vec``.  Vectors travel to their article
    once and in the type they have; both aggregations use that exchange.
    """
    met = weights.join(vectors, list(on)).select(*DOC, "weight", "vec").repartition(*DOC)
    scaled = met.select(*DOC, vx.scale(vx.as_doubles(F.col("vec")), F.col("weight")).alias("x")).distinct()
    mean = vector_to_array(Summarizer.mean(array_to_vector("x")))
    return scaled.groupBy(*DOC).agg(mean.alias("vec"))
