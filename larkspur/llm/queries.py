"""One thin query per operator of this folder, with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.chat import repaired_chats
from larkspur.llm.decontaminate import contaminated
from larkspur.llm.decision_list import quality_rules
from larkspur.llm.jaccard import jaccard_components
from larkspur.llm.licences import KNOWN, canonical_sql, licence_matches
from larkspur.llm.line_dedup import fuzzy_lines
from larkspur.llm.negatives import hard_negatives
from larkspur.llm.packing import pack, token_pieces
from larkspur.llm.periods import periodic_runs
from larkspur.llm.quality import quality_scores
from larkspur.llm.sharding import histogram_shards
from larkspur.llm.simhash import simhash_components
from larkspur.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_sentence_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"), F.array_max("sentence_scores").alias("worst_sentence"))


def op2_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    cut = fuzzy_lines(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_removed", F.coalesce("any_left", F.length(F.trim("text")) > 0, F.lit(False)).alias("any_left"),
                      F.length("text").alias("n_chars_left"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op3_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64("text").alias("text_key"))
    placed = histogram_shards(slim, ["text_key", "doc_id"], "size")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_edit_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_vertical_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [list_aggregate(w[i:i+3], 'string_agg', chr(10)) FOR i IN range(1, len(w) - 2)]
                                      WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', chr(10))] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, count(g) AS n FROM documents LEFT JOIN grams USING (doc_id) GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
sets AS (SELECT doc_id, list(g ORDER BY g) AS s FROM grams GROUP BY 1),
degrees AS (SELECT x, count(DISTINCT o.s) AS d FROM links JOIN sets i ON i.doc_id = x JOIN sets o ON o.doc_id = y WHERE o.s <> i.s GROUP BY 1)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id, coalesce(any_value(d.d), 0) AS n_links
FROM sizes s JOIN reach r ON r.x = s.doc_id LEFT JOIN degrees d ON d.x = s.doc_id GROUP BY s.doc_id, s.n
"""


def op7_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op8_licence_digests(spark: SparkSession, folder: str) -> DataFrame:
    return licence_matches(_table(spark, folder, "documents"), spark.createDataFrame(list(KNOWN), "licence string, text string"))


OP8_SQL = f"""
WITH known AS (SELECT DISTINCT licence, md5({canonical_sql("t")}) AS digest FROM (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in KNOWN)}) AS k(licence, t)),
pieces AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, NULL::INTEGER AS line, text AS t FROM documents WHERE text IS NOT NULL
          UNION ALL SELECT doc_id, (unnest(range(len(l))))::INTEGER AS line, unnest(l) AS t FROM pieces)
SELECT doc_id, line, licence, digest FROM (SELECT doc_id, line, md5({canonical_sql("t")}) AS digest FROM units) JOIN known USING (digest)
"""


def op9_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired_chats(_table(spark, folder, "conversations"))


def op10_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return pack(token_pieces(_table(spark, folder, "documents"), *tokenizer_paths()))


def op11_packed_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank, other_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op12_anchor_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(_table(spark, folder, "documents"))


def op13_factor_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(_table(spark, folder, "documents"), repeat=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return best.withColumn("exponent_milli", F.floor(1000 * F.col("length") / F.col("period")).cast("long"))


OP13_SQL = r"""
WITH RECURSIVE raw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
crc(doc_id, step, c) AS (
  SELECT doc_id, 0, 4294967295::BIGINT FROM documents
  UNION ALL
  SELECT doc_id, step + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT doc_id, step, CASE WHEN step % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, step // 8 + 1, 1))::BIGINT) ELSE c END AS x
        FROM crc WHERE step < 8 * length(doc_id::VARCHAR))),
hash AS (SELECT doc_id, xor(c, 4294967295) AS h FROM crc WHERE step = 8 * length(doc_id::VARCHAR)),
plan AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM raw JOIN hash USING (doc_id)),
cut AS (SELECT *, CASE WHEN planted THEN g % n END AS a, CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM plan),
words AS (SELECT doc_id, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word, n FROM (SELECT *, unnest(range(n)) AS i FROM cut)),
alike AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM alike) GROUP BY doc_id, q, k),
long AS (SELECT * FROM island WHERE length >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS told,
                max_by({'s': start, 'l': length, 'q': q}, (length::HUGEINT * 1000000000 - start) * 1000000000 - q) AS best FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period, (1000 * best.l // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


QUERIES = {f.__name__: f for f in (
    op1_sentence_toxicity, op2_fuzzy_lines, op3_histogram_shards, op4_rule_ensemble, op5_edit_contamination, op6_vertical_jaccard, op7_decision_list, op8_licence_digests,
    op9_role_repair, op10_bin_completion, op11_packed_negatives, op12_anchor_simhash, op13_factor_runs)}
ORACLE = {"op6_vertical_jaccard": OP6_SQL, "op8_licence_digests": OP8_SQL, "op11_packed_negatives": OP11_SQL, "op13_factor_runs": OP13_SQL}
