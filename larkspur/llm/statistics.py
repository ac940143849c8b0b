"""Statistics of whole texts, and the labelled rows that models here learn from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.flat import SPACE, Flat, mix, slices

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct", "n_bangs",
          "n_unique_words", "longest_word", "n_ended_lines")
SHARES = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "unique_share", "upper_share", "digit_share", "punct_share",
          "bang_share", "ended_share", "words_per_line")


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


SYMBOLS = _class(b"#*$%&|<>")
UPPER = _class(bytes(range(65, 91)))
DIGITS = _class(b"0123456789")
PUNCT = _class(b"!\"'(),-./:;?")
ENDS = _class(b".!?:;")


def _repeats(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash: how often it occurs within its text."""
    keys = mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[back]


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Different hashes of each text."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return np.bincount(d[new], minlength=n)


def count_slice(flat: Flat) -> list[np.ndarray]:
    """COUNTS of every text of a slice."""
    n, data, offsets = len(flat), flat.data, flat.offsets

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    solid = ~SPACE[data]
    words = flat.word_hashes()
    n_words = np.bincount(flat.doc, minlength=n)
    # Lines: cut at line feeds and at the ends of texts.
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    end = np.sort(np.concatenate([offsets[1:], feeds]))
    owner = np.sort(np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, "right") - 1]))
    sums = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    kept = sums[end] > sums[start]
    start, end, owner = start[kept], end[kept], owner[kept]
    n_lines = np.bincount(owner, minlength=n)
    distinct_lines = _distinct(owner, flat.span_hashes(start, end), n)
    ended = np.bincount(owner[ENDS[data[end - 1]]], minlength=n)
    # Words inside windows of three that occur at least twice.
    windows, at = flat.windows(words, 3)
    marked = np.zeros(len(words) + 2, bool)
    twice = at[_repeats(flat.doc[at], windows) >= 2]
    for j in range(3):
        marked[twice + j] = True
    repeated = np.bincount(flat.doc[marked[: len(words)]], minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, flat.doc, flat.end - flat.start)
    return [n_words, total(solid & ((data & 0xC0) != 0x80)), total(SYMBOLS[data]), n_lines - distinct_lines, repeated, n_lines, total(UPPER[data]),
            total(DIGITS[data]), total(PUNCT[data]), total(data == 33), _distinct(flat.doc, words, n), longest, ended]


def _count(batches):
    for batch in batches:
        parts = [count_slice(flat) for _, _, flat in slices(batch.column("text"))]
        columns = [pa.array(np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else [], pa.int64()) for i in range(len(COUNTS))]
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], [*rest, *COUNTS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: doc_id, COUNTS as long and SHARES as double.

    Words are runs of characters other than space and the five ASCII line and
    tab characters; ``n_upper``, ``n_digits`` and ``n_punct`` count ASCII
    characters.  A null text counts as empty: all counts and shares are 0.
    Repeated rows stay.  With ``carry`` the whole input row comes along as the
    struct ``carried``; other columns are ignored otherwise.
    """
    row = [F.struct(*docs.columns).alias("carried")] if carry else []
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *row)
    kind = f", carried {slim.schema['carried'].dataType.simpleString()}" if carry else ""
    counted = slim.mapInArrow(_count, f"doc_id long{kind}, " + ", ".join(f"{c} long" for c in COUNTS))

    def share(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.select(
        "*", share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_unique_words", "n_words").alias("unique_share"), share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"), share("n_punct", "word_chars").alias("punct_share"),
        share("n_bangs", "word_chars").alias("bang_share"), share("n_ended_lines", "n_lines").alias("ended_share"),
        share("n_words", "n_lines").alias("words_per_line"))


def held_out(id_column: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 modulo 3; such rows never train anything."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_ids(labels: DataFrame, label: str, sample_rows: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``sample_rows`` labelled rows outside the held-out fold.

    The sample is the rows with the smallest hash of their id, so it does not
    depend on the order of the input.  Null labels and ids are left out; of
    several labels of one id the largest counts.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).where(~held_out())
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
