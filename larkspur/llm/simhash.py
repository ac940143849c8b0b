"""Near-equal documents by SimHash fingerprints that meet at the anchors of a covering code."""

from __future__ import annotations

from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.session import materialise

BITS = 64


def fingerprint(text: str | bytes | None, k: int = 4, seed: int = 42) -> int:
    """SimHash of all k-word shingles with repeats: a bit is set if over half of the XXH64 values have it.

    Words are runs of bytes other than space and 0x09 to 0x0D; A to Z are lower-cased.  Fewer words make one shingle, none give zero.
    """
    raw = text.encode() if isinstance(text, str) else text or b""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, digest = memoryview(b" ".join(words)), xxhash.xxh64_intdigest
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts, total = np.zeros(BITS, np.int64), len(starts)
    for low in range(0, total, 1 << 16):
        part = [digest(joined[a:b], seed) for a, b in zip(starts[low : low + (1 << 16)], ends[low : low + (1 << 16)])]
        counts += np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(k: int, seed: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py(), k, seed) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return run


class Part:
    """A stretch of bits with a perfect Hamming code on its first 2**r - 1 bits and every word of the others.

    The code covers the stretch with radius one.  ``flips`` holds, for each
    syndrome, the bit patterns that lead from a word to all anchors within
    ``reach`` of it; the first of each leads to the nearest.
    """

    def __init__(self, number: int, low: int, width: int, threshold: int):
        self.number, self.low, self.width = number, low, width
        coded = 31 if width >= 31 else 15 if width >= 15 else 7
        self.coded, self.reach = coded, 1 + threshold
        # Column i of the parity check is i + 1, so the syndrome is the exclusive or of the set bits' places.
        places = np.array([i + 1 if i < coded else 0 for i in range(width)], np.int64)
        self.parity = np.array([sum(((places[i] >> b) & 1) << i for i in range(width)) for b in range(coded.bit_length())], np.uint64)
        flips: list[list[tuple[int, int]]] = [[] for _ in range(coded + 1)]
        for weight in range(self.reach + 1):
            for bits in combinations(range(width), weight):
                syndrome = 0
                for i in bits:
                    syndrome ^= int(places[i])
                free = sum(i >= coded for i in bits)
                flips[syndrome].append(((weight, free), sum(1 << i for i in bits)))
        self.flips = [np.array([mask for _, mask in sorted(f)], np.uint64) for f in flips]

    def words(self, fingerprints: np.ndarray) -> np.ndarray:
        return (fingerprints >> np.uint64(self.low)) & np.uint64((1 << self.width) - 1)

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for b, mask in enumerate(self.parity):
            out |= (np.bitwise_count(words & mask).astype(np.int64) & 1) << b
        return out

    def anchors(self, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor key, whether it is the row's nearest) of every anchor within reach."""
        words = self.words(fingerprints)
        syndrome = self.syndromes(words)
        rows, keys, homes = [], [], []
        for s in np.unique(syndrome).tolist():
            own = np.flatnonzero(syndrome == s)
            found = words[own][:, None] ^ self.flips[s][None, :]
            rows.append(np.repeat(own, found.shape[1]))
            keys.append(found.reshape(-1))
            homes.append(np.tile(np.arange(found.shape[1]) == 0, len(own)))
        empty = np.zeros(0, np.int64)
        return (np.concatenate(rows or [empty]), (np.concatenate(keys or [empty.view(np.uint64)]) | np.uint64(self.number << 40)).view(np.int64), np.concatenate(homes or [empty.astype(bool)]))


def layout(parts: int, threshold: int) -> list[Part]:
    """Two fingerprints within ``threshold`` differ in at most ``threshold // parts`` bits of one of these parts."""
    cuts = [BITS * i // parts for i in range(parts + 1)]
    return [Part(i, low, high - low, threshold // parts) for i, (low, high) in enumerate(zip(cuts, cuts[1:]))]


def _copies(parts: int, threshold: int, rows: int = 2048):
    def run(batches):
        plan = layout(parts, threshold)
        for batch in batches:
            every = batch.column("fingerprint").to_numpy()
            for low in range(0, len(every), rows):
                some = every[low : low + rows]
                for part in plan:
                    row, key, home = part.anchors(some.view(np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(home), pa.array(some[row])], ["anchor", "home", "fingerprint"])

    return run


class Forest:
    """Union by smallest index over the rows of one piece of work."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.up[a], self.up[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            while (self.up != self.up[self.up]).any():
                self.up = self.up[self.up]


def _crowd(forest: Forest, code: np.ndarray, fingerprints: np.ndarray, homes: int, threshold: int, area: int, tall: int = 64) -> None:
    """Compare the homes of a large group with all its rows, but for pairs that already hang together."""
    waiting = np.arange(homes)
    while len(waiting):
        some, waiting = waiting[:tall], waiting[tall:]
        for low in range(0, len(code), max(1, area // tall)):
            others = np.arange(low, min(len(code), low + max(1, area // tall)))
            own = forest.up[code[some]]
            if (own == own[0]).all():
                others = others[forest.up[code[others]] != own[0]]
            a, b = np.nonzero(np.bitwise_count(fingerprints[some][:, None] ^ fingerprints[others][None, :]) <= threshold)
            forest.link(code[some[a]], code[others[b]])
        waiting = waiting[np.argsort(forest.up[code[waiting]], kind="stable")]


def near_links(groups: np.ndarray, homes: np.ndarray, fingerprints: np.ndarray, threshold: int, area: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Links of equal effect among rows sorted by group, homes first: (fingerprint, a smaller-indexed one tied to it).

    Every home of a group is compared with every row of it.  What is returned
    ties the same rows together as all near pairs would, with at most one
    link a distinct fingerprint.
    """
    if not len(groups):
        return fingerprints, fingerprints
    distinct, code = np.unique(fingerprints, return_inverse=True)
    forest = Forest(len(distinct))
    cuts = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]])
    left = np.add.reduceat(homes.astype(np.int64), cuts[:-1])
    right = np.diff(cuts)
    work = left * right
    small = np.flatnonzero((work <= area // 8) & (left > 0) & (right > 1))
    at = 0
    while at < len(small):
        upto = at + max(1, int(np.searchsorted(np.cumsum(work[small[at:]]), area, "right")))
        some = small[at:upto]
        pairs = work[some]
        start = np.repeat(np.concatenate([[0], np.cumsum(pairs)[:-1]]), pairs)
        place = np.arange(int(pairs.sum())) - start
        base, many = np.repeat(cuts[some], pairs), np.repeat(right[some], pairs)
        x, y = base + place // many, base + place % many
        near = np.bitwise_count(fingerprints[x] ^ fingerprints[y]) <= threshold
        forest.link(code[x[near]], code[y[near]])
        at = upto
    for g in np.flatnonzero((work > area // 8) & (left > 0)).tolist():
        _crowd(forest, code[cuts[g] : cuts[g + 1]], fingerprints[cuts[g] : cuts[g + 1]], int(left[g]), threshold, area)
    root = forest.up
    tied = np.flatnonzero(root != np.arange(len(root)))
    return distinct[tied], distinct[root[tied]]


def _compare(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        key, cell, fingerprints = (table.column(c).to_numpy() for c in ("anchor", "cell", "fingerprint"))
        homes = table.column("home").to_numpy(zero_copy_only=False)
        order = np.lexsort((~homes, cell, key))
        key, cell = key[order], cell[order]
        change = np.zeros(len(key), np.int64)
        change[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
        a, b = near_links(np.cumsum(change), homes[order], fingerprints[order].view(np.uint64), threshold)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, threshold: int = 4, seed: int = 42,
                       parts: int | None = None, crowded: int = 4096, task_rows: int = 100_000) -> DataFrame:
    """Fingerprint every text and link fingerprints that differ in at most ``threshold`` bits.

    Returns one row per input row: ``doc_id``, ``fingerprint`` (16 lower-case
    hex digits) and ``component_id`` (smallest id reachable by links).

    * Equal fingerprints are one node from the start.
    * The fingerprint is cut into ``parts`` stretches; of a near pair, one
      stretch differs in at most ``threshold // parts`` bits.  A covering
      code over all 64 bits would copy a fingerprint to thousands of anchors
      before it told strangers apart; codes over stretches need tens.
    * The anchors of a stretch are the words of a perfect Hamming code times
      all words of the remaining bits, with covering radius one.  A
      fingerprint's home is its nearest anchor; it is copied to every anchor
      within the radius plus the stretch's threshold, so its home holds a
      copy of every near one.  Homes are compared with copies, exactly.
    * Any number of parts gives the same links.  Three make 42 to 45 copies
      with 2**17 anchors a stretch, two some 350 with 2**27; left open, two
      are taken beyond 30 million fingerprints.
    * An anchor with more than ``crowded`` copies is cut: homes into rows,
      copies into columns of a grid whose cells are compared apart.  A task
      sends on a spanning set of its links, never all pairs.

    A null or empty text, or one without words, has fingerprint zero and is
    linked like any other.  A null id takes part in links but is a
    component's id only where there is no other.  Repeated rows stay; extra
    columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(texts.mapInArrow(_fingerprints(k, seed), "doc_id long, fingerprint long"), "fingerprints")
    nodes = materialise(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    many = nodes.count()
    parts = parts or (3 if many <= 30_000_000 else 2)
    copies = nodes.select("fingerprint").mapInArrow(_copies(parts, threshold), "anchor long, home boolean, fingerprint long")

    size = copies.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count("*").alias("n")).where(F.col("n") > crowded)
    grid = size.select("anchor", F.ceil(F.col("homes") / crowded).cast("int").alias("down"), F.ceil(F.col("n") / crowded).cast("int").alias("across"))
    grid = materialise(grid, "crowded-anchors")
    cut = copies.join(grid, "anchor", "left").where("down is null or down > 0")
    place = F.pmod(F.xxhash64("fingerprint"), F.col("down")).cast("int"), F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("across")).cast("int")
    # A home is also a copy of its own anchor: as a home it lies in one row of the grid, as a copy in one column.
    whole = cut.where("down is null").select("anchor", F.lit(0).alias("cell"), "home", "fingerprint")
    split = cut.where("down is not null")
    across = split.where("home").withColumn("column", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
    across = across.select("anchor", (place[0] * F.col("across") + F.col("column")).alias("cell"), F.lit(True).alias("home"), "fingerprint")
    down = split.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("down") - 1)))
    down = down.select("anchor", (F.col("row") * F.col("across") + place[1]).alias("cell"), F.lit(False).alias("home"), "fingerprint")
    tasks = max(1, ceil(many * sum(int(np.mean([len(f) for f in p.flips])) + 1 for p in layout(parts, threshold)) / task_rows))
    dealt = whole.unionByName(across).unionByName(down).withColumn("part", F.pmod(F.xxhash64("anchor", "cell"), F.lit(tasks)))
    links = dealt.groupBy("part").applyInArrow(_compare(threshold), "a long, b long")

    tied = components(links).withColumnRenamed("node", "fingerprint")
    named = nodes.join(tied, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "component").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
