"""Runs of repeated word sequences in texts, by a dictionary of basic factors."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Factors:
    """Names of all factors of 1, 2, 4 ... symbols of several sequences laid end to end.

    Level k names the factor of 2**k symbols at each position; equal factors
    of one sequence have equal names.  A factor that occurs once in its
    sequence has the name -1, and so have all longer factors that start there.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray):
        self.n = len(symbols)
        self.levels: list[np.ndarray] = []
        self.next: list[np.ndarray] = []
        at = np.arange(self.n)
        key = owner.astype(np.int64) * (int(symbols.max(initial=0)) + 1) + symbols
        length = 1
        while len(at):
            at, name, after = self._named(at, key)
            full, follow = np.full(self.n, -1, np.int32), np.full(self.n, -1, np.int64)
            full[at], follow[at] = name, after
            self.levels.append(full)
            self.next.append(follow)
            at = at[at + length < self.n]
            at = at[full[at + length] >= 0]
            at = at[owner[at] == owner[at + length]]
            key = full[at].astype(np.int64) * self.n + full[at + length]
            length *= 2

    @staticmethod
    def _named(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, name, next position of that name or -1) of the keys that occur twice or more."""
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        as_next = np.zeros(len(key), bool)
        as_next[:-1] = key[1:] == key[:-1]
        repeated = as_next.copy()
        repeated[1:] |= as_next[:-1]
        after = np.full(len(at), -1, np.int64)
        after[:-1] = np.where(as_next[:-1], at[1:], -1)
        name = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]])) if len(key) else key
        at, name, after = at[repeated], name[repeated], after[repeated]
        back = np.argsort(at, kind="stable")
        return at[back], name[back], after[back]

    def match_right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols from x and from y on are equal (y > x, one sequence)."""
        total = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, open_ = self.levels[k], np.arange(len(x))
            while len(open_):
                a, b = x[open_] + total[open_], y[open_] + total[open_]
                inside = b < self.n
                a, b, open_ = a[inside], b[inside], open_[inside]
                open_ = open_[(name[a] >= 0) & (name[a] == name[b])]
                total[open_] += 1 << k
                if k < len(self.levels) - 1:
                    break
        return total

    def match_left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols before x and before y are equal (y > x, one sequence)."""
        total = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, open_ = self.levels[k], np.arange(len(x))
            while len(open_):
                a, b = x[open_] - total[open_] - (1 << k), y[open_] - total[open_] - (1 << k)
                inside = a >= 0
                a, b, open_ = a[inside], b[inside], open_[inside]
                open_ = open_[(name[a] >= 0) & (name[a] == name[b])]
                total[open_] += 1 << k
                if k < len(self.levels) - 1:
                    break
        return total


def find_runs(symbols: np.ndarray, owner: np.ndarray, exponent: int = 4, shortest: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs, by start and then period; positions count over all sequences.

    At each power-of-two length, a factor's next occurrence at a distance d of
    up to twice that length, followed by another at the same distance, is an
    arithmetic progression that proposes period d.  A run of ``exponent``
    periods or more, three at least, holds such a progression at its first
    position.  One position of each stretch of equal proposals is extended to
    both sides; equal runs are found from several lengths and kept once.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods may hold no progression of three factors")
    factors = Factors(symbols, owner)
    found = []
    for k, follow in enumerate(factors.next):
        at = np.flatnonzero(follow >= 0)
        step = follow[at] - at
        near = step <= 2 << k
        at, step = at[near], step[near]
        third = follow[at + step]
        again = third == at + 2 * step
        at, step = at[again], step[again]
        head = np.ones(len(at), bool)
        head[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1])
        at, step = at[head], step[head]
        left = factors.match_left(at, at + step)
        length = left + factors.match_right(at, at + step) + step
        long = (length >= exponent * step) & (length >= shortest)
        found.append(np.stack([at[long] - left[long], length[long], step[long]]))
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    start, period, length = np.unique(runs[[0, 2, 1]], axis=1)
    return start, length, period


def repeated_words(words: list[bytes], stretch: int) -> list[bytes]:
    """A text for tests of this operator: from one word on, a stretch of words over and over.

    ``stretch`` decides as the tenth parts of a checksum do: with g its tenth,
    a = g % n and p = 1 + (n - a) // (3 + g % 8), word i >= a becomes word a + (i - a) % p.
    """
    n, g = len(words), stretch // 10
    if stretch % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p]
    return words[:a] + (again * (-(-(n - a) // p)))[: n - a]


def _pieces(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of the rows of a batch, some ``limit`` words at a time or one longer text."""
    texts, repeats = batch.column("text").cast(pa.large_binary()), batch.column("repeat")
    first, held, many = 0, [], 0
    for row in range(batch.num_rows):
        words = (texts[row].as_py() or b"").split()
        if repeats[row].is_valid:
            words = repeated_words(words, repeats[row].as_py())
        if held and many + len(words) > limit:
            yield first, held
            first, held, many = row, [], 0
        held.append(words)
        many += len(words)
    if held:
        yield first, held


def _judged(exponent: int, shortest: int, limit: int):
    names = ["doc_id", "starts", "lengths", "periods", "collapsed"]

    def run(batches):
        for batch in batches:
            for first, texts in _pieces(batch, limit):
                sizes = np.array([len(t) for t in texts], np.int64)
                base = np.cumsum(sizes) - sizes
                ids = []
                for words in texts:
                    number: defaultdict[bytes, int] = defaultdict()
                    number.default_factory = number.__len__
                    ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                owner = np.repeat(np.arange(len(texts)), sizes)
                start, length, period = find_runs(np.concatenate(ids), owner, exponent, shortest)
                cuts = np.searchsorted(start, np.append(base, sizes.sum()))
                lost = np.zeros(int(sizes.sum()) + 1, np.int64)
                np.add.at(lost, start + period, 1)
                np.add.at(lost, start + length, -1)
                kept = np.cumsum(lost[:-1]) == 0
                collapsed = []
                for i, words in enumerate(texts):
                    if cuts[i] < cuts[i + 1]:
                        words = [words[j] for j in np.flatnonzero(kept[base[i] : base[i] + sizes[i]]).tolist()]
                    collapsed.append(b" ".join(words))
                ends = pa.array(cuts, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int64))) for v in (start - base[owner[start]], length, period)]
                text = pa.array(collapsed, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), *lists, text], names)

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat: Column | None = None, exponent: int = 4, shortest: int = 6, slice_words: int = 200_000) -> DataFrame:
    """Runs of every text and the text without their repetitions.

    A run is a stretch of words with smallest period q (words q apart are
    equal) and a length of at least ``shortest`` and ``exponent * q`` that
    cannot be made longer on either side.  Returns doc_id, ``runs`` (array of
    start, length and period, by start and then period; word numbers from 0)
    and ``collapsed``: the words that lie in no run beyond its first period,
    with single spaces between them.

    Words are runs of bytes other than space and 0x09 to 0x0D.  Nothing is
    shuffled: runs lie within one text.  A task holds about ``slice_words``
    words or its longest text, with some 12 bytes a word and level, levels
    ending where no factor of that length repeats.  Time is in proportion to
    words and levels, whatever repeats.

    ``repeat`` (a long per row) plants repetitions first, for tests of
    recall: see :func:`repeated_words`; null leaves a text as it is.  Null,
    empty and blank texts have no runs and an empty collapsed text.  Null ids
    and repeated rows stay rows of their own; extra columns are ignored; an
    empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (F.lit(None) if repeat is None else repeat).cast("long").alias("repeat"))
    found = slim.mapInArrow(_judged(exponent, shortest, slice_words), "doc_id long, starts array<long>, lengths array<long>, periods array<long>, collapsed string")
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", runs.alias("runs"), "collapsed")
