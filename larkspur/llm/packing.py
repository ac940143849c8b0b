"""Pack token sequences by bin completion over the histogram of piece lengths."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import materialise

CAPACITY = 1024
END = 2


@lru_cache(maxsize=2)
def _encoder(json_path: str, rank_path: str):
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(rank_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    full = Tokenizer.from_file(json_path)
    special = [t.content for t in full.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        # The rank file holds the same vocabulary and merges; only added tokens need the full tokenizer.
        if any(s in text for s in special):
            return full.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _cut(json_path: str, rank_path: str, capacity: int, with_ids: bool):
    def run(batches):
        encode = _encoder(json_path, rank_path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                first = len(ids) % capacity or capacity
                for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity)
                    part = ids[start:stop]
                    out.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), part.astype("<i4") if with_ids else None))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)][: 5 + with_ids], names[: 5 + with_ids])

    return run


def token_pieces(docs: DataFrame, json_path: str, rank_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token ids of whole texts plus the end token, cut where they exceed ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked,
    ids.  All pieces but the first are full, so only one per document needs
    company.  A null text counts as empty: one piece that holds the end token.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(json_path, rank_path, capacity, with_ids), schema)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for every small size, items above it that cannot share, plus the overflow of the rest."""
    most = 0
    for small in range(0, capacity // 2 + 1):
        big = sum(n for s, n in counts.items() if s > capacity - small)
        half = sum(n for s, n in counts.items() if capacity // 2 < s <= capacity - small)
        room = half * capacity - sum(s * n for s, n in counts.items() if capacity // 2 < s <= capacity - small)
        rest = sum(s * n for s, n in counts.items() if small <= s <= capacity // 2)
        most = max(most, big + half + max(0, -(-(rest - room) // capacity)))
    return most


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Incumbent: around each largest item, the largest items that still fit; equal bins are taken together."""
    left, plan = dict(counts), []
    while left:
        filling, room, free = [], capacity, dict(left)
        while True:
            size = max((s for s in free if s <= room), default=0)
            if not size:
                break
            filling.append(size)
            room -= size
            free[size] -= 1
            if not free[size]:
                del free[size]
        times = min(left[s] // filling.count(s) for s in set(filling))
        plan.append((times, tuple(filling)))
        _take(left, filling, times)
    return plan


def _take(left: dict[int, int], filling, times: int) -> None:
    for size in filling:
        left[size] -= times
        if not left[size]:
            del left[size]


def fillings(left: dict[int, int], capacity: int, fan: int) -> list[tuple[int, ...]]:
    """Undominated fillings around the largest item, fullest first, at most ``fan``.

    A filling is dominated if an unused item could take the place of some of
    its members: what they free serves later bins at least as well.
    """
    first = max(left)
    free = dict(left)
    _take(free, [first], 1)
    sizes = sorted(free, reverse=True)
    found: list[tuple[int, ...]] = []

    def grow(chosen: list[int], room: int, at: int) -> None:
        if len(found) >= fan:
            return
        if free.get(room, 0) > chosen.count(room) and (not chosen or room <= chosen[-1]):
            found.append((*chosen, room))  # exact: nothing else for this room is better
            return
        fits = False
        for k in range(at, len(sizes)):
            size = sizes[k]
            if size <= room and chosen.count(size) < free[size]:
                fits = True
                grow([*chosen, size], room - size, k)
                if len(found) >= fan:
                    return
        if not fits:
            found.append(tuple(chosen))

    grow([], capacity - first, 0)

    whole = 0  # bit x: a size of x is free
    for size in sizes:
        whole |= 1 << size

    def dominated(filling: tuple[int, ...]) -> bool:
        unused = whole
        for size in set(filling):
            if free[size] <= filling.count(size):
                unused ^= 1 << size
        one = two = three = 0  # bit x: one member, two or three members add up to x
        for size in filling:
            three |= two << size
            two |= one << size
            one |= 1 << size
        # Bit x: an unused size is x + 1 to x + slack.
        larger, reach, slack = unused >> 1, 1, capacity - first - sum(filling)
        while reach < slack:
            step = min(reach, slack - reach)
            larger |= larger >> step
            reach += step
        larger = larger if slack else 0
        return bool(one & larger or (two | three) & (larger | unused))

    kept = [f for f in dict.fromkeys(found) if not dominated(f)] or found[:1]
    return sorted(((first, *f) for f in kept), key=lambda f: (-sum(f), len(f)))


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = 20_000, fan: int = 32) -> list[tuple[int, tuple[int, ...]]]:
    """Fillings with their multiplicities that use as few bins as the search finds.

    Branch and bound: each node takes an undominated filling around the
    largest item left, as often as the counts allow.  A branch ends when its
    bins plus the bound of what is left reach the incumbent; the search ends at
    the bound of the whole or after ``nodes`` nodes.  The best-fit packing is
    the first incumbent, so the result is never worse than it.
    """
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit(counts, capacity)
    fewest, bound = sum(t for t, _ in best), lower_bound(counts, capacity)
    # An entry is a filling still to be taken from its parent's counts; the plan is a chain of (plan before, step).
    stack: list[tuple] = [(counts, None, 0, 0, None)] if counts and fewest > bound else []
    while stack and nodes and fewest > bound:
        nodes -= 1
        before, filling, times, used, chain = stack.pop()
        left = dict(before)
        if filling:
            _take(left, filling, times)
        if not left:
            if used < fewest:
                fewest, best = used, []
                while chain:
                    chain, step = chain
                    best.append(step)
            continue
        if used + -(-sum(s * n for s, n in left.items()) // capacity) >= fewest:
            continue
        for filling in reversed(fillings(left, capacity, fan)):
            times = min(left[s] // filling.count(s) for s in set(filling))
            stack.append((left, filling, times, used + times, (chain, (times, filling))))
    return best


def _plan_rows(plan: list[tuple[int, tuple[int, ...]]]) -> Iterator[tuple]:
    """(length, first rank, end rank, copies in a bin, first bin, offset of the first copy) of every filling."""
    next_rank: dict[int, int] = {}
    next_bin = 0
    for times, filling in plan:
        offset = 0
        for size in sorted(set(filling), reverse=True):
            copies = filling.count(size)
            low = next_rank.get(size, 0)
            next_rank[size] = low + times * copies
            yield size, low, next_rank[size], copies, next_bin, offset
            offset += size * copies
        next_bin += times


def pack(pieces: DataFrame, capacity: int = CAPACITY, salt_rows: int = 50_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: every piece in a sequence of at most ``capacity`` tokens.

    The search sees only the histogram of lengths, ``capacity`` numbers
    whatever the size of the corpus.  Pieces of one length are alike to it,
    so they are numbered and dealt to the plan's places by rank.  A length with many
    pieces is numbered in salted parts of about ``salt_rows`` rows.  The plan is
    broadcast: it has at most a few fillings for every length, of at most 44
    different lengths each, since those must add up to ``capacity``.
    Repeated pieces are packed as often as they occur; no pieces, no rows.
    """
    spark = pieces.sparkSession
    pieces = materialise(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(list(_plan_rows(bin_completion(counts, capacity))),
                                 "length long, low long, high long, copies long, first_bin long, first_offset long")
    parts = spark.createDataFrame([(s, -(-n // salt_rows)) for s, n in counts.items()], "length long, salts long")
    salted = pieces.join(F.broadcast(parts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), "salts")).drop("salts")
    sizes = salted.groupBy("length", "salt").count()
    before = sizes.select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    ranked = salted.withColumn("own", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")))
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1).alias("p")
    placed = ranked.join(F.broadcast(plan).alias("q"), F.expr("p.length = q.length and p.rank >= q.low and p.rank < q.high"))
    at = F.col("rank") - F.col("low")
    return placed.select(*(F.col(f"p.{c}") for c in pieces.columns), (F.col("first_bin") + F.floor(at / F.col("copies"))).cast("long").alias("sequence_id"),
                         (F.col("first_offset") + at % F.col("copies") * F.col("p.length")).cast("long").alias("offset"))
