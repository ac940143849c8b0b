"""Exact Jaccard links between documents by vertical partitioning of the shingle order."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.llm.flat import PLACE, list_column, mix, slices
from larkspur.session import materialise

#: Shared tokens that a candidate pair needs among its longer prefixes, for sets that hold enough tokens.
SHARED = 4


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of every text; a text of fewer than k words is one shingle."""
    for low, _, flat in slices(column):
        words = flat.word_hashes(lower=True)
        hashes, at = flat.windows(words, k)
        cuts = np.searchsorted(flat.doc[at], np.arange(len(flat) + 1))
        for i in range(len(flat)):
            own = hashes[cuts[i] : cuts[i + 1]]
            if len(own):
                own = np.sort(own)
                keep = np.ones(len(own), bool)
                keep[1:] = own[1:] != own[:-1]
                own = own[keep]
            elif flat.bounds[i] < flat.bounds[i + 1]:
                few = words[flat.bounds[i] : flat.bounds[i + 1]]
                own = mix(np.array([(few * PLACE[: len(few)]).sum(dtype=np.uint64) + np.uint64(len(few))], np.uint64))
            yield low + i, own


def _set_id(tokens: np.ndarray) -> int:
    return int(mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _prefix_length(n: int, percent: int) -> int:
    """Tokens that must be looked at so that any partner shares SHARED of them (all, for a small set)."""
    return min(n, n - -(-percent * n // 100) + SHARED)


def _prefixes(k: int, percent: int, heavy):
    """Arrow task: each document's set and the first tokens in the global order (rare before heavy, then by hash)."""

    def run(batches):
        late = heavy.value if heavy is not None else np.zeros(0, np.uint64)
        for batch in batches:
            sizes, ids, light, hot = [], [], [], []
            none = np.zeros(0, np.int64)
            for _, own in shingle_sets(batch.column("text"), k):
                n = len(own)
                sizes.append(n)
                ids.append(_set_id(own) if n else None)
                take = _prefix_length(n, percent)
                if not len(late) or not n:
                    light.append(own[:take].view(np.int64))
                    hot.append(none)
                    continue
                at = np.searchsorted(late, own)
                slow = late[np.minimum(at, len(late) - 1)] == own
                rare = own[~slow][:take]
                light.append(rare.view(np.int64))
                hot.append(own[slow][: take - len(rare)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), list_column(light), list_column(hot)],
                ["doc_id", "n", "set_id", "light", "hot"],
            )

    return run


def _segments(k: int, fragments: int):
    """Arrow task: each set cut into the fragments of the hash order."""

    def run(batches):
        edges = (np.arange(1, fragments, dtype=np.uint64) * np.uint64((1 << 64) // fragments)) if fragments > 1 else np.zeros(0, np.uint64)
        for batch in batches:
            ids, at, cut = [], [], []
            for _, own in shingle_sets(batch.column("text"), k):
                if len(own):
                    for f, part in enumerate(np.split(own, np.searchsorted(own, edges))):
                        ids.append(_set_id(own))
                        at.append(f)
                        cut.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(cut, pa.binary())], ["set_id", "fragment", "tokens"])

    return run


def _by_unit(table: pa.Table) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
    """Rows of each (unit, i, j), ordered by block and set."""
    unit, i, j = (table.column(c).to_numpy() for c in ("unit", "i", "j"))
    order = np.lexsort((table.column("set_id").to_numpy(), table.column("block").to_numpy(), j, i, unit))
    unit, i, j = unit[order], i[order], j[order]
    change = np.flatnonzero((unit[1:] != unit[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    for low, high in zip([0, *change], [*change, len(order)]):
        if low < high:
            yield (int(unit[low]), int(i[low]), int(j[low])), order[low:high]


def _partial(table: pa.Table) -> pa.Table:
    """Overlaps of all pairs of a unit's two blocks within one fragment, as a packed matrix."""
    block, ids, n = (table.column(c).to_numpy() for c in ("block", "set_id", "n"))
    tokens = table.column("tokens").to_pylist()
    out = []
    for (unit, i, j), rows in _by_unit(table):
        parts = [np.frombuffer(tokens[r], np.uint64) for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
        seen, code = np.unique(np.concatenate(parts), return_inverse=True)
        left = int((block[rows] == i).sum())
        counts = np.zeros((left, len(rows) if i == j else len(rows) - left), np.int32)
        for low in range(0, len(seen), 4096):
            here = (code >= low) & (code < low + 4096)
            held = np.zeros((len(rows), min(4096, len(seen) - low)), np.float32)
            held[owner[here], code[here] - low] = 1
            counts += (held[:left] @ (held if i == j else held[left:]).T).astype(np.int32)
        out.append((unit, i, j, left, ids[rows].tobytes(), n[rows].tobytes(), counts.tobytes()))
    names = [("unit", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("left", pa.int32()), ("ids", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary())]
    columns = list(zip(*out)) if out else [[]] * len(names)
    part = pa.array(np.repeat(table.column("part").to_numpy()[:1], len(out)), pa.int64())
    return pa.table([part, *(pa.array(c, t) for c, (_, t) in zip(columns, names))], ["part", *(c for c, _ in names)])


def _sum(percent: int):
    """Sum the fragments' matrices, test each pair, and hang linked sets under a root of the block pair."""

    def run(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list] = {}
        for row in table.to_pylist():
            key = (row["unit"], row["i"], row["j"])
            counts = np.frombuffer(row["counts"], np.int32)
            if key in groups:
                groups[key][3] += counts
            else:
                groups[key] = [row["left"], np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), counts.copy()]
        nodes, roots, degrees = [], [], []
        for (_, i, j), (left, ids, n, counts) in groups.items():
            other = np.arange(len(ids)) if i == j else np.arange(left, len(ids))
            overlap = counts.reshape(left, len(other)).astype(np.int64)
            linked = 100 * overlap >= percent * (n[:left, None] + n[None, other] - overlap)
            if i == j:
                np.fill_diagonal(linked, False)
            a, b = np.nonzero(linked)
            b = other[b]
            degree = np.bincount(a, minlength=len(ids)) + (np.bincount(b, minlength=len(ids)) if i != j else 0)
            root = np.arange(len(ids))
            while len(a):
                low = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                root = root[root]
                if (root == before).all():
                    break
            keep = degree > 0
            nodes.append(ids[keep])
            roots.append(ids[root[keep]])
            degrees.append(degree[keep])
        empty = np.zeros(0, np.int64)
        return pa.table([np.concatenate(x or [empty]).astype(np.int64) for x in (nodes, roots, degrees)], ["a", "b", "links"])

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85,
                       crowded: int = 64, most_heavy: int = 1_000_000, fragments: int = 4, block: int = 256) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``percent`` per cent or more.

    Returns one row per input row: ``doc_id``, ``n_shingles``, ``component_id``
    (smallest id reachable by links) and ``n_links`` (other sets linked to this
    row's set; copies count once).

    * Equal sets are one node from the start, so copies never meet in pairs.
    * The global token order is: tokens outside the heavy list by hash, then
      the heavy list by hash.  The list holds tokens that more than
      ``crowded`` documents have near the start of the plain hash order, at
      most ``most_heavy`` of them.  Any list gives the same links; a good one
      keeps frequent passages out of the prefixes.  Its bound makes it fit
      for a broadcast.
    * Linked sets share at least four tokens of their prefixes (one, if a set
      holds fewer than eight).  Rare tokens count pairs; a heavy token ties
      its documents to one of them.  What hangs together is a unit.
    * Units are cut into blocks; each pair of blocks meets once per fragment
      of the order.  A fragment yields partial overlaps, packed as a matrix;
      the sum over fragments decides each pair exactly.

    A null or empty text has an empty set: 0 shingles, no link, its own id as
    component.  A null id takes part in links but never becomes a component's
    id unless the component has no other.  Repeated rows stay; extra columns
    are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n long, set_id long, light array<long>, hot array<long>"

    plain = texts.mapInArrow(_prefixes(k, percent, None), schema)
    counts = plain.select(F.explode("light").alias("token")).groupBy("token").count().where(F.col("count") > crowded)
    counts = materialise(counts, "heavy-tokens")
    limit = crowded
    while counts.where(F.col("count") > limit).count() > most_heavy:
        limit *= 2
    heavy = counts.where(F.col("count") > limit).select("token").toArrow().column(0).to_numpy()
    held = spark.sparkContext.broadcast(np.sort(heavy.astype(np.int64).view(np.uint64)))

    rows = materialise(texts.mapInArrow(_prefixes(k, percent, held), schema), "prefixes")
    sets = rows.where("n > 0").groupBy("set_id").agg(F.first("n").alias("n"), F.first("light").alias("light"), F.first("hot").alias("hot"), F.min("doc_id").alias("doc_id"))
    sets = materialise(sets, "sets")

    light = sets.select("set_id", "n", F.explode("light").alias("token"))
    one, two = light.alias("x"), light.alias("y")
    met = one.join(two, F.expr(f"x.token = y.token and x.set_id < y.set_id and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"))
    pairs = met.groupBy(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b")).agg(F.count("*").alias("c"), F.first(F.least("x.n", "y.n")).alias("n"))
    pairs = pairs.where(f"c >= {SHARED} or n < {2 * SHARED}").select("a", "b")
    hot = sets.select("set_id", F.explode("hot").alias("token"))
    pivot = hot.groupBy("token").agg(F.min("set_id").alias("b"))
    stars = hot.join(pivot, "token").where("set_id <> b").select(F.col("set_id").alias("a"), "b").distinct()
    units = materialise(components(pairs.unionByName(stars)).withColumnRenamed("node", "set_id").withColumnRenamed("component", "unit"), "units")

    cuts = units.groupBy("unit").count().select("unit", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    members = units.join(cuts, "unit").join(sets.select("set_id", "n", "doc_id"), "set_id")
    members = materialise(members.withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int")), "members")
    total = members.count()
    wanted = members.select("doc_id").distinct()
    if total <= 2_000_000:
        wanted = F.broadcast(wanted)
    # Rows without an id cannot be looked up by it, so all of them are read again.
    again = texts.where("doc_id is not null").join(wanted, "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
    cut = again.mapInArrow(_segments(k, fragments), "set_id long, fragment int, tokens binary")
    cut = cut.groupBy("set_id", "fragment").agg(F.first("tokens").alias("tokens"))
    bins = max(1, ceil(total / 2000))
    facing = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    facing = facing.select("set_id", "n", "unit", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                           F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("unit"), F.lit(bins)) - bins)
                           .otherwise(F.abs(F.xxhash64("unit", F.least("block", "other"), F.greatest("block", "other")))).alias("part"))
    partial = facing.join(cut, "set_id").groupBy("part", "fragment").applyInArrow(
        _partial, "part long, unit long, i int, j int, left int, ids binary, sizes binary, counts binary")
    found = materialise(partial.groupBy("part").applyInArrow(_sum(percent), "a long, b long, links long"), "found")

    linked = components(found.select("a", "b"))
    degree = found.groupBy("a").agg(F.sum("links").alias("links"))
    first = sets.select(F.col("set_id").alias("node"), F.col("doc_id").alias("first_id"))
    named = linked.join(first, "node")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("least_id"))
    named = first.join(linked, "node", "left").join(smallest, "component", "left").join(degree, first.node == degree.a, "left")
    named = named.select(F.col("node").alias("set_id"), F.coalesce("least_id", "first_id").alias("component_id"), F.coalesce("links", F.lit(0)).alias("n_links"))
    return rows.join(named, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
