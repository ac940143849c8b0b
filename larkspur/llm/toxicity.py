"""Toxicity by multiple-instance learning: sentences combined by noisy-or, trained from document labels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.flat import Flat, list_column, slices
from larkspur.llm.statistics import held_out, training_ids
from larkspur.session import materialise

#: Bytes of a word's start that are features beside the whole word.
STARTS = (4, 5, 6, 7)
_ENDING = np.zeros(256, bool)
_ENDING[list(b".!?")] = True
_EDGE = np.zeros(256, bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _features(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sentence of each word, owner of each sentence, word of each feature, feature hashes).

    A sentence ends after a word that ends with a full stop, exclamation or
    question mark, at a line feed, and at the end of its text.
    """
    data, start, end = flat.data, flat.start.copy(), flat.end.copy()
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    feeds = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])
    new = np.ones(len(start), bool)
    new[1:] = _ENDING[data[end[:-1] - 1]] | (feeds[start[1:]] > feeds[end[:-1]]) | (flat.doc[1:] != flat.doc[:-1])
    sentence = np.cumsum(new) - 1
    # Punctuation at the edges is not part of a feature; four marks at each side at most.
    for _ in range(4):
        start += (start < end) & _EDGE[data[np.minimum(start, len(data) - 1)]]
        end -= (start < end) & _EDGE[data[end - 1]]
    hashes, words = [flat.span_hashes(start, end, lower=True)], [np.arange(len(start))]
    for n in STARTS:
        longer = np.flatnonzero(end - start > n)
        hashes.append(flat.span_hashes(start[longer], start[longer] + n, lower=True))
        words.append(longer)
    return sentence, flat.doc[new], np.concatenate(words), np.concatenate(hashes)


def _distinct_features(batches):
    for batch in batches:
        parts = []
        for low, high, flat in slices(batch.column("text")):
            _, _, word, hashes = _features(flat)
            doc = flat.doc[word]
            order = np.argsort(doc, kind="stable")
            doc, hashes = doc[order], hashes[order]
            cuts = np.searchsorted(doc, np.arange(high - low + 1))
            parts += [np.unique(hashes[cuts[i] : cuts[i + 1]]).view(np.int64) for i in range(high - low)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), list_column(parts)], ["label", "features"])


def _find(hashes: np.ndarray, known: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a hash is known, its index among the known)."""
    some = np.flatnonzero(maybe[hashes & np.uint64(len(maybe) - 1)])
    if not len(known):
        return some[:0], some[:0]
    at = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
    hit = known[at] == hashes[some]
    return some[hit], at[hit]


def _maybe(known: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 20, bool)
    table[known & np.uint64(len(table) - 1)] = True
    return table


def _instances(known: np.ndarray):
    """Arrow task: per document its number of sentences, and (sentence, feature index) of known features."""

    def run(batches):
        maybe = _maybe(known)
        for batch in batches:
            totals, sentences, found = [], [], []
            for low, high, flat in slices(batch.column("text")):
                sentence, owner, word, hashes = _features(flat)
                where, at = _find(hashes, known, maybe)
                own = sentence[word[where]] if len(where) else where
                order = np.argsort(own, kind="stable")
                own, at = own[order], at[order]
                cuts = np.searchsorted(owner[own] if len(own) else own, np.arange(high - low + 1))
                firsts = np.searchsorted(owner, np.arange(high - low + 1))
                totals += list(np.diff(firsts))
                for i in range(high - low):
                    sentences.append(own[cuts[i] : cuts[i + 1]] - firsts[i])
                    found.append(at[cuts[i] : cuts[i + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(totals, pa.int32()), list_column(sentences, np.int32), list_column(found, np.int32)],
                                             ["label", "sentences", "sentence", "feature"])

    return run


@dataclass(frozen=True)
class SentenceModel:
    known: np.ndarray
    weights: np.ndarray
    bias: float


def fit_noisy_or(labels: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, totals: np.ndarray, width: int,
                 steps: int = 300, rate: float = 0.15, penalty: float = 2e-5, start: float = -6.0) -> tuple[np.ndarray, float]:
    """Minimise the log loss of 1 - prod(1 - sigmoid(z)) over each document's sentences, with an L1 penalty.

    ``sentence`` numbers the sentences that hold a known feature over all
    documents, ``doc`` gives the owner of each; the rest of a document's
    ``totals`` have only the bias.
    """
    weights, bias = np.zeros(width), start
    moment, square = np.zeros(width + 1), np.zeros(width + 1)
    plain = totals - np.bincount(doc, minlength=len(totals))
    for step in range(1, steps + 1):
        z = bias + np.bincount(sentence, weights[feature], minlength=len(doc))
        soft = np.logaddexp(0, z)
        clean = np.bincount(doc, soft, minlength=len(totals)) + plain * np.logaddexp(0, bias)  # -log P(no toxic sentence)
        push = np.where(labels > 0, -1 / np.expm1(np.clip(clean, 1e-9, 700)), 1.0) / len(labels)
        inner = push[doc] / (1 + np.exp(-z))
        slope = np.append(np.bincount(feature, inner[sentence], minlength=width), inner.sum() + (push * plain).sum() / (1 + np.exp(-bias)))
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights = weights - move[:-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * penalty * 100, 0)
        bias = min(bias - move[-1], -2.0)
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int, most_features: int, sigmas: float, label: str = "toxic") -> SentenceModel:
    """Fit on at most ``sample_rows`` labelled documents; of their features keep those whose share of label 1 lies ``sigmas`` above chance."""
    picked = F.broadcast(training_ids(labels, label, sample_rows))  # at most sample_rows rows
    sample = materialise(docs.join(picked, "doc_id").select("label", "text").repartition(16), "sample")
    ones, rows = sample.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    none = np.zeros(0, np.uint64)
    if not ones or ones == rows:
        odds = np.log((ones + 1) / (rows - ones + 1))
        return SentenceModel(none, np.zeros(0), float(odds))
    seen = sample.mapInArrow(_distinct_features, "label double, features array<long>").select("label", F.explode("features").alias("feature"))
    seen = seen.groupBy("feature").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    share = ones / rows
    power = (F.col("p") / F.col("n") - share) * F.sqrt("n") / (share * (1 - share)) ** 0.5
    seen = seen.withColumn("power", power).where(F.col("power") >= sigmas).orderBy(F.desc("power"), "feature").limit(most_features)
    known = np.sort(np.array([r[0] for r in seen.select("feature").collect()], np.int64).view(np.uint64))
    table = sample.mapInArrow(_instances(known), "label double, sentences int, sentence array<int>, feature array<int>").toArrow()
    sizes = table.column("sentence").combine_chunks()
    lengths = np.diff(sizes.offsets.to_numpy())
    owner = np.repeat(np.arange(table.num_rows), lengths)
    pairs = np.stack([owner, sizes.flatten().to_numpy()], 1)
    distinct, sentence = np.unique(pairs, axis=0, return_inverse=True)
    feature = table.column("feature").combine_chunks().flatten().to_numpy()
    weights, bias = fit_noisy_or(table.column("label").to_numpy(), distinct[:, 0], sentence.reshape(-1), feature, table.column("sentences").to_numpy().astype(float), len(known))
    used = weights != 0
    return SentenceModel(known[used], weights[used], bias)


def _score(held, threshold: float):
    """Arrow task: document score and the sentences at or above the threshold."""

    def run(batches):
        model = held.value
        maybe = _maybe(model.known)
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offending", pa.list_(pa.string())), ("sentence_scores", pa.list_(pa.float64()))])
        for batch in batches:
            scores, spans, odds = [], [], []
            for low, high, flat in slices(batch.column("text")):
                sentence, owner, word, hashes = _features(flat)
                where, at = _find(hashes, model.known, maybe)
                z = model.bias + np.bincount(sentence[word[where]], model.weights[at], minlength=len(owner)) if len(owner) else np.zeros(0)
                chance = 1 / (1 + np.exp(-z))
                clean = np.bincount(owner, np.logaddexp(0, z), minlength=high - low)
                texts: list[list] = [[] for _ in range(high - low)]
                chances: list[list] = [[] for _ in range(high - low)]
                for s in np.flatnonzero(chance >= threshold):
                    own = np.searchsorted(sentence, [s, s + 1])
                    texts[owner[s]].append(flat.data[flat.start[own[0]] : flat.end[own[1] - 1]].tobytes().decode())
                    chances[owner[s]].append(float(chance[s]))
                scores += list(-np.expm1(-clean))
                spans += texts
                odds += chances
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, schema.field(2).type), pa.array(odds, schema.field(3).type)], schema=schema)

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, most_features: int = 20_000, sigmas: float = 5.0, threshold: float = 0.7) -> DataFrame:
    """Score every whole text and name its offending sentences.

    Returns doc_id, held_out, score (0 to 1), predicted, ``offending`` (the
    sentences whose own chance reaches ``threshold``) and ``sentence_scores``.
    A sentence's chance is a logistic function of its words and word starts;
    a document's is one minus the product of (1 - chance).  Only the
    document's label is known in training.  Null and empty texts have no
    sentence and score 0.  Repeated rows are scored each; other columns are
    ignored.  Without labels of both kinds the bias alone scores.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(train(texts, labels, sample_rows, most_features, sigmas))
    scored = texts.mapInArrow(_score(model, threshold), "doc_id long, score double, offending array<string>, sentence_scores array<double>")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending", "sentence_scores")
