"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.flat import Flat, mix, slices

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of items that are also sought piece by piece: a walk is hardly longer, and its few windows miss edited ones.
SHORT = 126


@dataclass(frozen=True)
class Plan:
    """Walks and samples: ``steps`` of each walk's random bits, and the sampled steps of every table."""

    steps: int
    moves: np.ndarray  # walk x step x byte -> 0 or 1
    samples: tuple[tuple[int, tuple[int, ...]], ...]  # (walk, steps) of each table

    @staticmethod
    def make(recall: float, agreement: float, symbols: int, walks: int, steps: int, seed: int) -> Plan:
        """Tables so that a window whose sampled symbols agree with probability ``agreement`` each is found with ``recall``."""
        tables = ceil(log(1 - recall) / log(1 - agreement**symbols))
        tables += -tables % walks
        bits = mix((np.arange(walks * steps * 256, dtype=np.uint64) + np.uint64(seed)) * _STEP) & np.uint64(1)
        samples = []
        for t in range(tables):
            # Every second round of tables looks at the first half of the walk only: short items and ends of items need it.
            reach = steps // 2 if t // walks % 2 else steps
            order = np.argsort(mix((np.arange(reach, dtype=np.uint64) + np.uint64(seed + 7919 * (t + 1))) * _STEP))
            samples.append((t % walks, tuple(sorted(int(s) for s in order[:symbols]))))
        return Plan(steps, bits.astype(np.int8).reshape(walks, steps, 256), tuple(samples))

    def embed(self, fenced: np.ndarray, at: np.ndarray, walk: int) -> np.ndarray:
        """Step x window matrix of symbols; a walk that reaches the fence behind its text stays there and reads 0."""
        at, out = at.astype(np.int32), np.empty((self.steps, len(at)), np.uint8)
        moves = self.moves[walk].astype(np.int32)
        moves[:, 0] = 0
        for step in range(self.steps):
            np.take(fenced, at, out=out[step])
            at += np.take(moves[step], out[step])
        return out

    def keys(self, table: int, embedded: np.ndarray) -> np.ndarray:
        key = np.full(embedded.shape[1], table, np.uint64)
        for step in self.samples[table][1]:
            key = (key << np.uint64(8)) | embedded[step]
        return mix(key)

    def whole(self, table: int, embedded: np.ndarray) -> np.ndarray:
        """Windows whose walk is still inside its text at the table's last sample; others have no key."""
        return np.flatnonzero(embedded[self.samples[table][1][-1]])


def fence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts with a zero byte behind each; what stood at x in text d stands at x + d."""
    out = np.zeros(len(data) + len(offsets) - 1, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = data
    return out


def normalise(column: pa.Array) -> pa.Array:
    """Lower case, one space for each run of white space, none at the ends."""
    lowered = pc.utf8_lower(column.fill_null("")).cast(pa.binary())
    return pa.array([b" ".join(v.as_py().split()) for v in lowered], pa.binary())


def winnow(flat: Flat, hashes: np.ndarray, width: int) -> np.ndarray:
    """Words that are the smallest of some run of ``width`` words of their text (of all its words, if fewer)."""
    n = len(hashes)
    least = hashes.copy()
    doc = flat.doc
    for j in range(1, min(width, n)):
        same = np.flatnonzero(doc[j:] == doc[: n - j])
        least[same] = np.minimum(least[same], hashes[same + j])
    # Runs that begin too late to be whole count only if the text has no whole run.
    counts = np.diff(flat.bounds)
    place = np.arange(n) - flat.bounds[doc]
    whole = (place + width <= counts[doc]) | ((counts[doc] < width) & (place == 0))
    chosen = np.zeros(n, bool)
    for j in range(min(width, n)):
        start = np.flatnonzero(whole[: n - j])
        start = start[doc[start] == doc[start + j]]
        chosen[start + j] |= least[start] == hashes[start + j]
    return np.flatnonzero(chosen)


def _by_row(embedded: np.ndarray) -> np.ndarray:
    """A row of eight symbols to a word for each window."""
    padded = np.zeros((embedded.shape[1], -(-embedded.shape[0] // 8) * 8), np.uint8)
    padded[:, : embedded.shape[0]] = embedded.T
    return padded.view(np.uint64)


def _filled(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is not zero."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return (((words & low) + low) | words) & ~low


class Index:
    """Every word start of every item, embedded and sampled."""

    def __init__(self, plan: Plan, items: list[tuple[int, bytes]]):
        self.plan, self.items = plan, items
        texts = pa.array([t for _, t in items], pa.binary())
        offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in items])]).astype(np.int64)
        flat = Flat(np.frombuffer(b"".join(t for _, t in items), np.uint8), offsets) if len(texts) and offsets[-1] else None
        if flat is None:
            self.item = self.offset = np.zeros(0, np.int64)
            self.embedded = [np.zeros((plan.steps, 0), np.uint8)] * len(plan.moves)
        else:
            self.item, self.offset = flat.doc, flat.start - offsets[flat.doc]
            fenced = fence(flat.data, offsets)
            self.embedded = [plan.embed(fenced, flat.start + flat.doc, w) for w in range(len(plan.moves))]
        self.rows = [_by_row(e) for e in self.embedded]
        self.inside = [_filled(r) for r in self.rows]
        self.tables = []
        for t, (walk, _) in enumerate(plan.samples):
            inside = plan.whole(t, self.embedded[walk])
            keys = plan.keys(t, self.embedded[walk])[inside]
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[keys & np.uint64(len(maybe) - 1)] = True
            self.tables.append((keys[order], inside[order], maybe))

    def matches(self, fenced: np.ndarray, at: np.ndarray, most_apart: float) -> tuple[np.ndarray, np.ndarray]:
        """(window, item word) pairs that share a table key and whose embeddings differ in at most this share of steps."""
        found = [np.zeros(0, np.int64)]
        for walk in range(len(self.plan.moves)):
            embedded = self.plan.embed(fenced, at, walk)
            rows, own_rows, own_inside = _by_row(embedded), self.rows[walk], self.inside[walk]
            steps = np.bitwise_count(own_inside).sum(axis=1, dtype=np.int64)
            for t, (own, _) in enumerate(self.plan.samples):
                if own != walk:
                    continue
                keys = self.plan.keys(t, embedded)
                known, order, maybe = self.tables[t]
                some = self.plan.whole(t, embedded)
                some = some[maybe[keys[some] & np.uint64(len(maybe) - 1)]]
                low, high = (np.searchsorted(known, keys[some], side) for side in ("left", "right"))
                window = np.repeat(some, high - low)
                if not len(window):
                    continue
                first = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
                word = order[first + np.arange(len(window))]
                for cut in range(0, len(window), 1 << 14):
                    a, b = window[cut : cut + (1 << 14)], word[cut : cut + (1 << 14)]
                    apart = np.bitwise_count(_filled(rows[a] ^ own_rows[b]) & own_inside[b]).sum(axis=1, dtype=np.int64)
                    near = apart <= most_apart * steps[b]
                    found.append(a[near] * len(self.item) + b[near])
        pairs = np.unique(np.concatenate(found))
        return np.divmod(pairs, max(1, len(self.item)))


class ShortIndex:
    """Items of up to ``SHORT`` bytes, sought without loss.

    Of the halves of an item (of the item itself, up to 63 bytes) one has
    at most its share of the edits; cut into one piece more than these
    edits, it keeps a piece unchanged.  Pieces are looked up at every byte
    by up to eight bytes, and the half is compared there by bit vectors.
    """

    def __init__(self, items: list[tuple[int, bytes]], share: float):
        parts, pieces = [], []
        for number, (_, text) in enumerate(items):
            if len(text) > SHORT:
                continue
            most, halves = int(np.floor(len(text) * share)), ceil(len(text) / 63)
            for h in range(halves):
                low, high = len(text) * h // halves, len(text) * (h + 1) // halves
                edits = min(most // halves, high - low - 1)
                for i in range(edits + 1):
                    a, b = ((high - low) * j // (edits + 1) for j in (i, i + 1))
                    piece = text[low + a : low + min(b, a + 8)]
                    pieces.append((len(piece), int.from_bytes(piece, "little"), len(parts), a))
                parts.append((number, low, high - low, edits, text[low:high]))
        self.item, self.low, self.length, self.edits = (np.array([p[c] for p in parts], np.int64) for c in range(4))
        self.places = np.zeros((len(parts), 256), np.uint64)
        for row, part in enumerate(parts):
            for i, c in enumerate(part[4]):
                self.places[row, c] |= np.uint64(1 << i)
        self.pieces = []
        for length in sorted({p[0] for p in pieces}):
            own = sorted(p[1:] for p in pieces if p[0] == length)
            values = np.array([p[0] for p in own], np.uint64)
            maybe = np.zeros(1 << 20, bool)
            maybe[self._slot(values)] = True
            self.pieces.append((length, values, np.array([p[1] for p in own], np.int64), np.array([p[2] for p in own], np.int64), maybe))

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return (values * _STEP) >> np.uint64(44)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, place where the item would begin) of halves within their edits."""
        found = [np.zeros((0, 3), np.int64)]
        if self.pieces and len(data):
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            eight = np.zeros(len(data), np.uint64)
            for j in range(8):
                eight |= padded[j : j + len(data)].astype(np.uint64) << np.uint64(8 * j)
        for length, values, part, offset, maybe in self.pieces:
            own = eight & np.uint64((1 << 8 * length) - 1)
            at = np.flatnonzero(maybe[self._slot(own)])
            low, high = (np.searchsorted(values, own[at], side) for side in ("left", "right"))
            for cut in range(0, len(at), 50_000):
                count = (high - low)[cut : cut + 50_000]
                place = np.repeat(at[cut : cut + 50_000], count)
                if not len(place):
                    continue
                one = np.repeat(low[cut : cut + 50_000] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(place))
                row, begin = part[one], place - offset[one]
                doc = np.searchsorted(offsets, place, "right") - 1
                near = self._near(data, offsets[doc], offsets[doc + 1], begin, row)
                found.append(np.unique(np.stack([doc, self.item[row], begin - self.low[row]], 1)[near], axis=0))
        return tuple(np.concatenate(found).T)

    def _near(self, data: np.ndarray, first: np.ndarray, stop: np.ndarray, begin: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Whether the half lies around ``begin`` within its edits: the steps of ``least_distance`` for many places at once.

        A few more may pass, never fewer: the exact distance of the whole item decides later.
        """
        size, edits = self.length[row], self.edits[row]
        if not len(row):
            return np.zeros(0, bool)
        # All lengths go through the steps together; bits above a half's own are cut off by its mask.
        one = np.uint64(1)
        top = (size - 1).astype(np.uint64)
        full = ((one << top) - one) | (one << top)
        plus, minus = full.copy(), np.zeros(len(row), np.uint64)
        score, best = size.copy(), size.copy()
        reach = int(edits.max())
        for step in range(-reach, int(size.max()) + reach):
            at = begin + step
            inside = (at >= first) & (at < stop) & (step < size + reach)
            eq = np.where(inside, self.places[row, data[np.clip(at, 0, len(data) - 1)]], np.uint64(0))
            vertical = eq | minus
            eq = eq | (((eq & plus) + plus) ^ plus)
            up, down = minus | (full & ~(eq | plus)), plus & eq
            score += ((up >> top) & one).astype(np.int64) - ((down >> top) & one).astype(np.int64)
            up, down = (up << one) & full, (down << one) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            np.minimum(best, score, out=best)
        near = best <= edits
        return near


def _candidates(held, share: float, width: int, most_apart: float):
    """Arrow task: (document, item, stretch of normalised text) to verify."""

    def run(batches):
        index, short = held.value
        lengths = np.array([len(t) for _, t in index.items], np.int64)
        for batch in batches:
            rows, items, texts = [], [], []
            for low, _, flat in slices(normalise(batch.column("text"))):
                if not len(flat.start) or not index.items:
                    continue
                at = flat.start[winnow(flat, flat.word_hashes(), width)]
                doc = np.searchsorted(flat.offsets, at, "right") - 1
                window, word = index.matches(fence(flat.data, flat.offsets), at + doc, most_apart)
                item = index.item[word]
                owner, begin = doc[window], at[window] - index.offset[word]
                owner, item, begin = (np.concatenate(both) for both in zip((owner, item, begin), short.matches(flat.data, flat.offsets)))
                slack = np.floor(lengths[item] * share).astype(np.int64)
                # Windows of one item that begin close together are one stretch.
                order = np.lexsort((begin, item, owner))
                last: tuple | None = None
                for k in order:
                    own = (int(owner[k]), int(item[k]))
                    if last and last[0] == own and begin[k] - last[1] <= slack[k]:
                        continue
                    last = (own, begin[k])
                    a = max(flat.offsets[own[0]], begin[k] - slack[k])
                    b = min(flat.offsets[own[0] + 1], begin[k] + lengths[item[k]] + 2 * slack[k])
                    rows.append(low + own[0])
                    items.append(index.items[own[1]][0])
                    texts.append(flat.data[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "item_id", "stretch"])

    return run


def least_distance(pattern: bytes, text: bytes) -> int:
    """Smallest edit distance of ``pattern`` to any part of ``text`` (bit-parallel, one word of any length)."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        vertical = eq | minus
        eq |= ((eq & plus) + plus) ^ plus
        up = minus | (full & ~(eq | plus))
        down = plus & eq
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        best = min(best, score)
    return best


def _verify(batches):
    for batch in batches:
        distance = [least_distance(a.as_py(), b.as_py()) for a, b in zip(batch.column("item"), batch.column("stretch"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_id"), pa.array(distance, pa.int32()), pa.array([len(i.as_py()) for i in batch.column("item")], pa.int32())],
                                         ["doc_id", "item_id", "distance", "item_length"])


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.1, recall: float = 0.95, agreement: float = 0.7, symbols: int = 6, walks: int = 2,
                 steps: int = 128, width: int = 8, most_apart: float = 0.5, block_items: int = 20_000, seed: int = 17) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, up to an edit distance of ``share`` of the item.

    Returns doc_id, item_id, distance (bytes of normalised text, the least
    found) and item_length, one row per pair.

    * Texts are normalised to lower case and single spaces.
    * Windows of a document begin at winnowed words: each run of ``width``
      words gives at least one, and equal passages give the same ones whatever
      stands around them.  On the items' side a window begins at every word.
    * The walk embedding turns a window into a string of symbols on which
      few edits change few places; ``symbols`` sampled places make a table's
      key.  The number of tables follows from ``recall`` for one window
      whose places agree with probability ``agreement``; a passage has several windows.
    * Items of up to ``SHORT`` bytes are also sought by unchanged pieces
      (``ShortIndex``), which loses none.
    * Agreeing windows are placed against the item, and the exact least edit
      distance of the whole item to the stretch decides.

    Items are indexed in blocks of ``block_items``, so that what is broadcast
    stays bounded; each block is one pass over the documents.  Null and empty
    texts or items hold nothing; items with a null id are left out; of items
    with equal id each counts.  A walk ends at a zero byte as at the end of
    its text.  Repeated documents give their pairs once.
    """
    spark = docs.sparkSession
    plan = Plan.make(recall, agreement, symbols, walks, steps, seed)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    total = items.count()
    blocks = max(1, ceil(total / block_items))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    result = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "text").toArrow()
        listed = [(i, t) for i, t in zip(rows.column("item_id").to_pylist(), normalise(rows.column("text").combine_chunks()).to_pylist()) if t]
        held = spark.sparkContext.broadcast((Index(plan, listed), ShortIndex(listed, share)))
        known = spark.createDataFrame(listed, "item_id long, item binary")
        near = texts.mapInArrow(_candidates(held, share, width, most_apart), "doc_id long, item_id long, stretch binary").distinct()
        near = near.join(F.broadcast(known), "item_id").select("doc_id", "item_id", "item", "stretch")
        checked = near.mapInArrow(_verify, "doc_id long, item_id long, distance int, item_length int").where(F.col("distance") <= F.floor(F.col("item_length") * F.lit(share)))
        result = checked if result is None else result.unionByName(checked)
    return result.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"), F.min("item_length").alias("item_length"))
