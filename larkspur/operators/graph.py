"""Personalised rank on a user-item edge table."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import windows
from larkspur.session import cut_lineage, materialise

# Outgoing edges of one node kept together; a node with more is split.
EDGES_PER_SLICE = 100_000
# Nodes whose ranks travel as one array, for the exact form.
NODES_PER_BLOCK = 65_536


def prepare(edges: DataFrame, per_slice: int = EDGES_PER_SLICE) -> tuple[DataFrame, DataFrame]:
    """Edges with a slice number, and nodes with degree and number of slices.

    Rank values are copied once per slice of their node, so the edges of a node
    with very many neighbours spread over several tasks.
    """
    nodes = edges.groupBy("src").agg(F.count("*").alias("degree")).withColumn(
        "slices", F.ceil(F.col("degree") / F.lit(per_slice)).cast("int"))
    sliced = edges.join(nodes, "src").select(
        "src", "dst", F.pmod(F.hash("dst"), F.col("slices")).alias("slice"))
    return sliced, nodes


def one_round(sliced: DataFrame, nodes: DataFrame, roots: DataFrame, ranks: DataFrame, alpha: float) -> DataFrame:
    """Each node hands alpha x rank / degree to its neighbours; the root gets 1 - alpha."""
    spread = ranks.join(nodes, ranks["node"] == nodes["src"]).select(
        "root", "src", (F.lit(alpha) * F.col("score") / F.col("degree")).alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    moved = sliced.join(spread, ["src", "slice"]).select("root", F.col("dst").alias("node"), "part")
    restart = roots.select("root", F.col("root").alias("node"), F.lit(1 - alpha).alias("part"))
    return moved.unionByName(restart).groupBy("root", "node").agg(F.sum("part").alias("score"))


def personal_rank(edges: DataFrame, roots: DataFrame, alpha: float = 0.8, rounds: int = 10,
                  checkpoint_every: int = 5) -> DataFrame:
    """Scores (root, node, score) after a fixed number of rounds, for all roots at once."""
    sliced, nodes = prepare(edges)
    if rounds > checkpoint_every:
        sliced, nodes, roots = cut_lineage(sliced), cut_lineage(nodes), cut_lineage(roots)
    ranks = roots.select("root", F.col("root").alias("node"), F.lit(1.0).alias("score"))
    for i in range(1, rounds + 1):
        ranks = one_round(sliced, nodes, roots, ranks, alpha)
        if i % checkpoint_every == 0 and i < rounds:
            ranks = cut_lineage(ranks)
    return ranks


def _packed(table: pa.Table) -> pa.Table:
    """The edges of a cell as one row: places of their ends in the two blocks, and what an edge hands on."""
    arrays = [pa.array([table.column(c).to_numpy().tobytes()], pa.binary()) for c in ("a", "b", "w")]
    return pa.table([table.column("i").slice(0, 1), table.column("j").slice(0, 1), *arrays], ["i", "j", "a", "b", "w"])


def _handed_on(cells: pa.Table, ranks: pa.Table) -> pa.Table:
    """What a block of nodes gets from another one, for each root."""
    out = []
    for cell in cells.to_pylist():
        a, b, w = (np.frombuffer(cell[c], t) for c, t in (("a", np.int32), ("b", np.int32), ("w", np.float64)))
        for vec in ranks.column("vec").to_pylist():
            out.append((cell["j"], np.bincount(b, weights=_longer(np.frombuffer(vec), int(a.max()) + 1)[a] * w).tobytes()))
    roots = ranks.column("root").combine_chunks().take(pa.array(np.tile(np.arange(len(ranks)), len(cells)), pa.int64()))
    return pa.table([roots, pa.array([j for j, _ in out], pa.int32()), pa.array([v for _, v in out], pa.binary())], ["root", "block", "vec"])


def _longer(vec: np.ndarray, size: int) -> np.ndarray:
    return vec if len(vec) >= size else np.append(vec, np.zeros(size - len(vec)))


def _summed(table: pa.Table) -> pa.Table:
    """The arrays of one root and block, added up."""
    total = np.zeros(0)
    for x in table.column("vec").to_pylist():
        vec = np.frombuffer(x)
        total = _longer(total, len(vec)).copy()
        total[: len(vec)] += vec
    return pa.table([table.column("root").slice(0, 1), table.column("block").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["root", "block", "vec"])


def _single(batches):
    """Arrays that are zero but for one place."""
    for x in batches:
        vecs = [_longer(np.zeros(0), place + 1) for place in x.column("place").to_pylist()]
        for vec, score in zip(vecs, x.column("score").to_pylist()):
            vec[-1] = score
        yield pa.RecordBatch.from_arrays([x.column("root"), x.column("block"), pa.array([v.tobytes() for v in vecs], pa.binary())], ["root", "block", "vec"])


def _moved(batches):
    """Largest change between two arrays."""
    for x in batches:
        change = [0.0]
        for new, old in zip(x.column("vec").to_pylist(), x.column("old").to_pylist()):
            new, old = np.frombuffer(new), np.frombuffer(old or b"")
            size = max(len(new), len(old))
            change.append(np.abs(_longer(new, size) - _longer(old, size)).max(initial=0.0))
        yield pa.RecordBatch.from_arrays([pa.array([max(change)], pa.float64())], ["change"])


def _listed(batches):
    """A row for each node that was reached."""
    for x in batches:
        for k, vec in enumerate(x.column("vec").to_pylist()):
            vec = np.frombuffer(vec)
            place = np.flatnonzero(vec)
            root, block = (x.column(c).take(pa.array(np.full(len(place), k))) for c in ("root", "block"))
            yield pa.RecordBatch.from_arrays([root, block, pa.array(place, pa.int32()), pa.array(vec[place])], ["root", "block", "place", "score"])


def personal_rank_exact(edges: DataFrame, roots: DataFrame, alpha: float = 0.8, tolerance: float = 1e-8,
                        step: int = 10, most: int = 400) -> DataFrame:
    """Fixed point of the same rounds, scaled by 1 / (1 - alpha).

    Rounds go on until the largest change of one round is below ``tolerance``;
    only that one number comes back to the driver, every ``step`` rounds.
    Raises if ``most`` rounds do not reach it.

    Nodes are dealt into blocks by hash and edges into cells, one for each two
    blocks.  Cells are packed and dealt once and stay where they are; a round
    moves the arrays of ranks only.
    """
    spark = edges.sparkSession
    root_type = roots.schema["root"].dataType
    roots = materialise(roots.select("root"), "rank-roots")
    edges = materialise(edges.where("src is not null").select("src", "dst"), "rank-edges")
    found = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    found = found.unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).cast("long").alias("degree")))
    found = found.unionByName(roots.select(F.col("root").alias("node"), F.lit(0).cast("long").alias("degree")))
    found = materialise(found.groupBy("node").agg(F.sum("degree").alias("degree")), "rank-degrees")
    blocks = max(1, ceil(found.count() / NODES_PER_BLOCK))
    placed = found.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("node")) - 1
    nodes = materialise(placed.withColumn("place", place.cast("int")), "rank-nodes")

    tails = nodes.where("degree > 0").select(F.col("node").alias("src"), F.col("block").alias("i"), F.col("place").alias("a"), (F.lit(alpha) / F.col("degree")).alias("w"))
    heads = nodes.select(F.col("node").alias("dst"), F.col("block").alias("j"), F.col("place").alias("b"))
    ends = windows.rejoin(edges.join(tails, "src"), heads, ["dst"]).select("i", "j", "a", "b", "w")
    parts = min(blocks * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = ends.repartition(parts, "i", "j").groupBy("i", "j").applyInArrow(_packed, "i int, j int, a binary, b binary, w binary")
    cells = materialise(cells, "rank-cells").repartition(parts, "i", "j").persist()

    shape = T.StructType([T.StructField("root", root_type), T.StructField("block", T.IntegerType()), T.StructField("vec", T.BinaryType())])
    starts = windows.rejoin(roots, nodes.select(F.col("node").alias("root"), "block", "place"), ["root"])
    first, restart = (materialise(starts.withColumn("score", F.lit(x)).mapInArrow(_single, shape), "rank-starts") for x in (1.0, 1.0 - alpha))

    def one(ranks: DataFrame) -> DataFrame:
        sent = ranks.select("root", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("j"), "vec")
        got = cells.groupBy("i", "j").cogroup(sent.groupBy("i", "j")).applyInArrow(_handed_on, shape)
        return got.unionByName(restart).groupBy("root", "block").applyInArrow(_summed, shape)

    try:
        ranks, done = first, 0
        while done < most:
            for _ in range(step - 1):
                ranks = one(ranks)
            ranks = cut_lineage(ranks)
            moved = cut_lineage(one(ranks))
            both = windows.rejoin(moved, ranks.withColumnRenamed("vec", "old"), ["root", "block"])
            # A block is reached for good, so only in the first rounds one may lack an older array.
            new = moved.count() > ranks.count()
            change = both.select("vec", "old").mapInArrow(_moved, "change double").agg(F.max("change")).first()[0]
            ranks, done = moved, done + step
            if not new and (change or 0.0) < tolerance:
                break
        else:
            raise RuntimeError(f"ranks still moved by {change} after {done} rounds; allow more or lower alpha")
    finally:
        cells.unpersist()
    scores = ranks.mapInArrow(_listed, T.StructType([*shape.fields[:2], T.StructField("place", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    return scores.join(nodes.select("block", "place", "node"), ["block", "place"]).select("root", "node", (F.col("score") / (1 - alpha)).alias("score"))


def unseen_items(scores: DataFrame, edges: DataFrame, k: int, item_prefix: str = "item_") -> DataFrame:
    """``k`` best item nodes per root that the root is not linked to."""
    items = scores.filter(F.col("node").startswith(item_prefix))
    linked = edges.select(F.col("src").alias("root"), F.col("dst").alias("node"))
    fresh = items.join(linked, ["root", "node"], "left_anti").withColumn("score", F.round("score", 9))
    return windows.top_k(fresh, ["root"], [F.desc("score"), F.asc("node")], k).select("root", "node", "score", "rank")
