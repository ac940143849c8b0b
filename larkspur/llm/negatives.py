"""Hard negatives by exact integer inner products, several candidates to one wide integer."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import materialise, work_path

LARGEST = 1 << 31  # components must stay below it after scaling
PACKED = "label long, n int, dims int, width int, bias long, bound long, ids binary, words binary"
NO_SCORE, NO_ID = -(1 << 63), (1 << 63) - 1


def whole_vectors(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, components) of the rows of a batch that take part; short vectors end in zeros."""
    vectors = batch.column("vector")
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    whole = broken[ends] == broken[ends - sizes]
    for name in ("id", "label", "vector"):
        whole &= pc.is_valid(batch.column(name)).to_numpy(zero_copy_only=False)
    value = np.floor(flat * scale)
    if (np.abs(value[np.repeat(whole, sizes)]) >= LARGEST).any():
        raise ValueError(f"components must stay below {LARGEST} after scaling")
    rows = np.flatnonzero(whole)
    dims = int(sizes[rows].max(initial=0))
    out = np.zeros((len(rows), dims), np.int64)
    filled = np.arange(dims) < sizes[rows, None]
    at = (ends - sizes)[rows, None] + np.arange(dims)
    out[filled] = value[at[filled]].astype(np.int64)
    ids, labels = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False)[rows] for c in ("id", "label"))
    return ids, labels, out


def pack_block(ids: np.ndarray, block: np.ndarray, anchor_square: int) -> tuple[int, int, int, int, bytes, bytes]:
    """(dims, field width, bias, bound, ids, words) of candidates of one label, by id.

    The bound is that of Cauchy and Schwarz on any anchor's product with a
    row of the block; a field holds twice it, so sums never reach the next
    field.  The bias makes every component of the block a natural number.
    """
    order = np.argsort(ids, kind="stable")
    ids, block = ids[order], block[order]
    bias = max(0, -int(block.min(initial=0)))
    square = max((sum(int(x) * int(x) for x in row) for row in block), default=0) if np.abs(block).max(initial=0) >= 1 << 24 else int((block * block).sum(axis=1).max(initial=0))
    bound = max(isqrt(square * anchor_square) + 1, int(block.max(initial=0)) + bias)
    if bound >= 1 << 62:
        raise ValueError("scores do not fit 64 bits")
    width = (2 * bound).bit_length()
    fields = 64 // width
    n, dims = block.shape
    padded = np.zeros((-(-n // fields) * fields, dims), np.uint64)
    padded[:n] = (block + bias).astype(np.uint64)
    words = np.zeros((dims, len(padded) // fields), np.uint64)
    for f in range(fields):
        words |= padded[f::fields].T << np.uint64(f * width)
    return dims, width, bias, bound, ids.astype(np.int64).tobytes(), words.tobytes()


def block_scores(anchors: np.ndarray, words: np.ndarray, n: int, width: int, bias: int, bound: int) -> np.ndarray:
    """Exact inner products of all anchors with the ``n`` packed candidates.

    One product per anchor component and word serves all fields of the word.
    Everything is taken modulo 2**64, so an anchor's signs need no care: the
    last addition lifts every field's sum to a number from 0 to twice the
    bound, which is what the field then holds.
    """
    fields, dims = 64 // width, min(len(words), anchors.shape[1])
    lift = sum(1 << (f * width) for f in range(fields))
    signed = anchors[:, :dims]
    total = np.zeros((len(anchors), words.shape[1]), np.uint64)
    product = np.empty_like(total)
    columns = np.ascontiguousarray(signed.T).view(np.uint64)
    for k in range(dims):
        np.multiply(columns[k][:, None], words[k], out=product)
        total += product
    total += ((bound - bias * signed.sum(axis=1)).view(np.uint64) * np.uint64(lift))[:, None]
    out = np.empty((len(anchors), words.shape[1] * fields), np.int64)
    mask = np.uint64((1 << width) - 1)
    for f in range(fields):
        out[:, f::fields] = ((total >> np.uint64(f * width)) & mask).view(np.int64) - bound
    return out[:, :n]


class Best:
    """The first few (score, id) of each of many lists: higher scores, then smaller ids; equal entries once."""

    def __init__(self, lists: int, keep: int):
        self.score = np.full((lists, keep), NO_SCORE, np.int64)
        self.id = np.full((lists, keep), NO_ID, np.int64)

    def open(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where a score of the given lists would enter."""
        worst, last = self.score[lists, -1:], self.id[lists, -1:]
        return (score > worst) | ((score == worst) & (ids[None, :] < last))

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        touched, keep = np.unique(at), self.score.shape[1]
        at = np.concatenate([at, np.repeat(touched, keep)])
        score = np.concatenate([score, self.score[touched].reshape(-1)])
        ids = np.concatenate([ids, self.id[touched].reshape(-1)])
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        at, score, ids = at[fresh], score[fresh], ids[fresh]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < keep
        self.score[touched], self.id[touched] = NO_SCORE, NO_ID
        self.score[at[top], rank[top]], self.id[at[top], rank[top]] = score[top], ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, k = np.nonzero(self.id != NO_ID)
        return at, self.score[at, k], self.id[at, k]


def _clean(scale: int):
    def run(batches):
        for batch in batches:
            ids, labels, block = whole_vectors(batch, scale)
            sizes = np.arange(len(ids) + 1) * block.shape[1]
            vectors = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(block.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), vectors], ["anchor_id", "label", "vector"])

    return run


def _pack(scale: int, anchor_square: int, rows: int):
    """Arrow task: blocks of up to ``rows`` vectors of one label, held back until full or until many wait."""

    def record(label: int, ids: np.ndarray, block: np.ndarray):
        dims, width, bias, bound, held, words = pack_block(ids, block, anchor_square)
        return pa.RecordBatch.from_pylist([{"label": label, "n": len(ids), "dims": dims, "width": width, "bias": bias, "bound": bound, "ids": held, "words": words}],
                                          pa.schema([("label", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("width", pa.int32()), ("bias", pa.int64()), ("bound", pa.int64()), ("ids", pa.binary()), ("words", pa.binary())]))

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        dims = max(b.shape[1] for _, b in parts)
        return np.concatenate([i for i, _ in parts]), np.concatenate([np.pad(b, ((0, 0), (0, dims - b.shape[1]))) for _, b in parts])

    def run(batches):
        waiting: dict[int, list] = {}
        held = 0
        for batch in batches:
            ids, labels, block = whole_vectors(batch, scale)
            for label in np.unique(labels).tolist():
                own = labels == label
                waiting.setdefault(label, []).append((ids[own], block[own]))
                held += int(own.sum())
            for label in list(waiting):
                many = sum(len(i) for i, _ in waiting[label])
                if many < rows and held < 16 * rows:
                    continue
                i, b = merged(waiting.pop(label))
                held -= many
                for low in range(0, many, rows):
                    yield record(label, i[low : low + rows], b[low : low + rows])
        for label, parts in waiting.items():
            i, b = merged(parts)
            for low in range(0, len(i), rows):
                yield record(label, i[low : low + rows], b[low : low + rows])

    return run


def _blocks(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[int, int, int, int]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
            words = np.frombuffer(one["words"], np.uint64).reshape(one["dims"], -(-one["n"] // (64 // one["width"])))
            yield one["label"], np.frombuffer(one["ids"], np.int64), words, (one["n"], one["width"], one["bias"], one["bound"])


def _positives(shared, keep: int, chunk: int = 256):
    """Arrow task: the best rows of the anchor's own label, of this task's blocks."""

    def run(batches):
        names, labels, vectors = shared.value
        best = Best(len(names), keep)
        for label, ids, words, layout in _blocks(batches):
            same = np.flatnonzero(labels == label)
            for low in range(0, len(same), chunk):
                lists = same[low : low + chunk]
                score = block_scores(vectors[lists], words, *layout)
                a, c = np.nonzero(best.open(lists, score, ids) & (ids[None, :] != names[lists, None]))
                best.add(lists[a], score[a, c], ids[c])
        at, score, ids = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(ids), pa.array(score)], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(shared, keep: int, low_percent: int, high_percent: int, chunk: int = 256):
    """Arrow task: the best rows of other labels in each positive's range of scores, of this task's blocks."""

    def run(batches):
        (names, labels, vectors), (owner, positive, reach) = shared.value
        best = Best(len(owner), keep)
        first = np.searchsorted(owner, np.arange(len(names) + 1))  # pairs come in the order of their anchors
        most = int((first[1:] - first[:-1]).max(initial=0))
        bottom, top = -(-low_percent * reach // 100), high_percent * reach // 100
        for label, ids, words, layout in _blocks(batches):
            other = np.flatnonzero((labels != label) & (first[1:] > first[:-1]))
            for low in range(0, len(other), chunk):
                anchors = other[low : low + chunk]
                score = block_scores(vectors[anchors], words, *layout)
                for p in range(most):
                    rows = np.flatnonzero(first[anchors] + p < first[anchors + 1])
                    pairs = first[anchors[rows]] + p
                    own = score[rows]
                    a, c = np.nonzero((own >= bottom[pairs, None]) & (own <= top[pairs, None]) & best.open(pairs, own, ids))
                    best.add(pairs[a], own[a, c], ids[c])
        at, score, ids = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(names[owner[at]]), pa.array(positive[at]), pa.array(reach[at]), pa.array(ids), pa.array(score)],
                                         ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _first(rows: DataFrame, keys: list[str], score: str, name: str, keep: int) -> DataFrame:
    """The first rows of each key by score and id, equal ones once, with ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(name))
    return rows.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= keep).dropDuplicates([*keys, "rank"])


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                   positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, anchor_block: int = 16384, block_rows: int = 2048) -> DataFrame:
    """For each anchor and each of its nearest rows of the same label, the nearest rows of other labels below it.

    ``anchor`` is a condition on ``vectors``.  Components become
    ``floor(scale * x)``; a score is the inner product of these integers and
    exact.  A positive's negatives score from ``low_percent`` to
    ``high_percent`` per cent of its score.  Higher scores come first, then
    smaller ids.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score and negative_score, all numbers long but rank.

    * Candidates are packed once into blocks of one label, each with a field
      width from its own longest vector and the longest anchor, and written
      to the shared folder.  They are never shuffled.
    * Anchors are dealt by hash into blocks of at most ``anchor_block``, the
      only thing broadcast (with their positives).  For each block of anchors
      the packed table is read twice; tasks send on only their best rows.
    * No row is left out: every anchor meets every packed candidate.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part.  Shorter vectors end in zeros.  Rows that agree
    in id and score count once in a list; of several anchor rows under one id
    the one with the smallest label and components counts.  A row is no
    positive of an anchor with its id.  Components of 2**31 or more after
    scaling raise ``ValueError``, as do scores beyond 2**62.  Extra columns
    are ignored; an empty table or no anchor gives an empty result.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), anchor.alias("anchor"))
    chosen = slim.where("anchor").drop("anchor").mapInArrow(_clean(scale), "anchor_id long, label long, vector array<long>")
    chosen = chosen.groupBy("anchor_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    chosen = materialise(chosen.select("anchor_id", "row.label", "row.vector"), "anchors")
    square = F.aggregate("vector", F.lit(0).cast("decimal(38,0)"), lambda total, x: (total + x.cast("decimal(18,0)") * x.cast("decimal(18,0)")).cast("decimal(38,0)"))
    count, longest = chosen.agg(F.count("*"), F.max(square)).first()
    packed = materialise(slim.select("id", "label", "vector").mapInArrow(_pack(scale, int(longest or 0), block_rows), PACKED), "packed-vectors") if count else None

    # Blocks by hash: more of them until the largest fits, so the bound on what is broadcast holds for any ids.
    blocks = -(-count // anchor_block)
    dealt = lambda: F.pmod(F.xxhash64("anchor_id"), F.lit(blocks))
    while count > anchor_block and chosen.groupBy(dealt().alias("block")).count().agg(F.max("count")).first()[0] > anchor_block:
        blocks *= 2
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    folder = work_path(spark, "hard-negatives")
    for block in range(blocks):
        held = chosen.where(dealt() == block).toArrow().sort_by("anchor_id").combine_chunks()
        if not held.num_rows:
            continue
        names, labels = held.column("anchor_id").to_numpy(), held.column("label").to_numpy()
        lists = held.column("vector").combine_chunks()
        rows = np.zeros((len(names), int(pc.max(pc.list_value_length(lists)).as_py())), np.int64)
        sizes = pc.list_value_length(lists).to_numpy()
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        table = (names, labels, rows)
        first = spark.sparkContext.broadcast(table)
        near = _first(packed.mapInArrow(_positives(first, positives), "anchor_id long, positive_id long, positive_score long"), ["anchor_id"], "positive_score", "positive_id", positives)
        near = near.toArrow().sort_by([("anchor_id", "ascending"), ("rank", "ascending")])
        first.unpersist()
        pairs = (np.searchsorted(names, near.column("anchor_id").to_numpy()), near.column("positive_id").to_numpy(), near.column("positive_score").to_numpy())
        second = spark.sparkContext.broadcast((table, pairs))
        far = packed.mapInArrow(_negatives(second, negatives, low_percent, high_percent), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        far = _first(far, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
        far.select(*(f.split()[0] for f in schema.split(", "))).write.parquet(f"{folder}/block={block}")
        second.unpersist()
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/block=*")
