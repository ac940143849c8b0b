"""Best items of factor vectors by inner product, without crossing users and items."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import vectors as vx
from larkspur.operators import windows
from larkspur.operators.sampling import hash_number
from larkspur.session import materialise

CHUNK, STRIPE = 1024, 128  # users and items that meet in one product


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _lifted(vectors: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Unit vectors whose angle to a query orders a norm range by inner product: one more component fills up the length."""
    scaled = vectors / np.maximum(longest, 1e-300)[:, None]
    return np.concatenate([scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))[:, None]], axis=1)


def _assign(anchors, width: int):
    """Arrow task: each item's cell, the nearest anchor of its channel and norm range (cell 0 where there is none)."""

    def run(batches):
        known = anchors.value
        for batch in batches:
            channel, band, longest = (batch.column(c).to_numpy() for c in ("channel_id", "band", "longest"))
            vectors = _lifted(_matrix(batch.column("vec"), width), longest)
            cell = np.zeros(len(vectors), np.int64)
            for key in {*zip(channel.tolist(), band.tolist())} & known.keys():
                numbers, directions = known[key]
                own = np.flatnonzero((channel == key[0]) & (band == key[1]))
                for low in range(0, len(own), 1024):
                    some = own[low : low + 1024]
                    cell[some] = numbers[np.argmax(vectors[some] @ directions.T, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("channel_id"), pa.array(cell), batch.column("vec")], ["item_id", "channel_id", "cell", "vec"])

    return run


def _farthest(centres, width: int):
    """Arrow task: each item's distance to the centre of its cell."""

    def run(batches):
        known = centres.value
        for batch in batches:
            channel, cell = (batch.column(c).to_numpy() for c in ("channel_id", "cell"))
            vectors, distance = _matrix(batch.column("vec"), width), np.zeros(len(batch))
            for c in set(channel.tolist()):
                own = np.flatnonzero(channel == c)
                numbers, middle = known[c]
                distance[own] = np.linalg.norm(vectors[own] - middle[np.searchsorted(numbers, cell[own])], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("channel_id"), batch.column("cell"), pa.array(distance)], ["channel_id", "cell", "distance"])

    return run


class _Asking:
    """Users of one block of a channel and their best items so far; the channel's items pass by in the order of their cells.

    A user passes over a cell only where none of its items can enter the list: no product with an item of the cell
    exceeds that with its centre by more than the lengths of the user and of the cell's radius allow.
    """

    def __init__(self, cells, width: int):
        self.numbers, self.centres, self.radius, self.sample = cells
        self.reach = np.linalg.norm(self.centres, axis=1) + self.radius
        self.width, self.asked, self.lists = width, [], None

    def add(self, batch: pa.RecordBatch) -> None:
        users = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
        if users:
            self.asked.append(batch.slice(0, users))
        if self.asked and users < len(batch):
            self._start()
            self._meet(batch.slice(users))

    def _start(self) -> None:
        if self.lists is not None:
            return
        table = pa.Table.from_batches(self.asked)
        self.users, self.need = table.column("user_id").combine_chunks(), table.column("need").to_numpy()
        self.vectors = _matrix(table.column("vec").combine_chunks(), self.width)
        self.length, self.lists = np.linalg.norm(self.vectors, axis=1), [None] * math.ceil(len(self.users) / CHUNK)
        # The last place of a list is worth what it is among some of the items, at least.
        self.limit, some = np.full(len(self.users), -np.inf), len(self.sample)
        longest = np.linalg.norm(self.sample, axis=1).max(initial=0.0)
        for low in range(0, len(self.users), CHUNK):
            rows = low + np.flatnonzero(self.need[low : low + CHUNK] <= some)
            if len(rows):
                score = np.sort(self.vectors[rows] @ self.sample.T, axis=1)
                self.limit[rows] = score[np.arange(len(rows)), some - self.need[rows]] - 1e-9 * self.length[rows] * longest

    def _most(self, users: slice, cells) -> np.ndarray:
        """What a product of a user with an item of a cell may be at most."""
        return self.vectors[users] @ self.centres[cells].T + self.length[users, None] * (self.radius[cells] + 1e-9 * self.reach[cells])

    def _meet(self, items: pa.RecordBatch) -> None:
        vectors, cell = _matrix(items.column("vec"), self.width), items.column("cell").to_numpy()
        ids, longest = items.column("item_id"), np.linalg.norm(vectors, axis=1)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        ends, cells = np.r_[starts[1:], len(cell)], np.searchsorted(self.numbers, cell[starts])
        for number, low in enumerate(range(0, len(self.users), CHUNK)):
            own = slice(low, min(low + CHUNK, len(self.users)))
            opened = ~(self._most(own, cells) < self.limit[own, None])
            held, count = [], 0
            for j, (first, last) in enumerate(zip(starts, ends)):
                rows = np.flatnonzero(opened[:, j]) + low
                asking = self.vectors[own if len(rows) == opened.shape[0] else rows]
                for a in range(first, last if len(rows) else first, STRIPE):
                    b = min(a + STRIPE, last)
                    # A product may differ from the sum in order by its rounding; what comes close is summed again.
                    error = 1e-12 * self.length[rows] * longest[a:b].max()
                    row, column = np.nonzero(~(asking @ vectors[a:b].T < (self.limit[rows] - error)[:, None]))
                    held.append((rows[row], column + a))
                    count += len(row)
                    if count > max(CHUNK * 128, 0 if self.lists[number] is None else 2 * len(self.lists[number][0])):
                        self._merge(number, held, vectors, ids)
                        held, count = [], 0
            if count:
                self._merge(number, held, vectors, ids)

    def _merge(self, number: int, held: list, vectors: np.ndarray, ids: pa.Array) -> None:
        """Best first (NaN is above all numbers, as Spark has it), ties by item."""
        row, column = (np.concatenate(x) for x in zip(*held))
        score = np.concatenate([np.zeros(0), *(
            np.cumsum(self.vectors[row[p : p + 16384]] * vectors[column[p : p + 16384]], axis=1)[:, -1] + 0.0 for p in range(0, len(row), 16384))])
        item = ids.take(pa.array(column))
        if self.lists[number] is not None:
            old = self.lists[number]
            row, score, item = np.r_[old[0], row], np.r_[old[1], score], pa.concat_arrays([old[2], item])
        by_id = item.to_numpy() if pa.types.is_integer(item.type) else pc.rank(item, sort_keys="ascending", tiebreaker="dense").to_numpy()
        order = np.lexsort((by_id, -score, ~np.isnan(score), row))
        row = row[order]
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
        place = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
        kept = place < self.need[row]
        full = place == self.need[row] - 1
        order, row = order[kept], row[kept]
        score, last = score[order], full[kept]
        self.limit[row[last]] = score[last]
        self.lists[number] = row, score, item.take(pa.array(order))

    def rows(self, channel: int):
        for found in self.lists or []:
            if found is None:
                continue
            row, score, item = found
            for low in range(0, len(row), 1 << 16):
                some = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [self.users.take(pa.array(row[some])), pa.array(np.full(len(row[some]), channel, np.int64)), item.slice(low, 1 << 16),
                     pa.array(score[some])], ["user_id", "channel_id", "item_id", "score"])


def _best(cells, width: int):
    """Arrow task: rows sorted by block, users before items and items by cell; the ``need`` best items of each user."""

    def run(batches):
        known, place, channel, asking = cells.value, None, None, None
        for batch in batches:
            places = batch.column("place").to_numpy()
            cuts = np.r_[0, np.flatnonzero(places[1:] != places[:-1]) + 1, len(places)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if high > low and places[low] != place:
                    if asking is not None:
                        yield from asking.rows(channel)
                    place, channel = places[low], batch.column("channel_id")[low].as_py()
                    asking = _Asking(known[channel], width)
                if high > low:
                    asking.add(batch.slice(low, high - low))
        if asking is not None:
            yield from asking.rows(channel)

    return run


@dataclass(frozen=True)
class _Index:
    """Users (user_id, only, vec), items with their cells, their number by channel, and the cells: channel -> (cells, centres, radius, some items)."""

    users: DataFrame
    items: DataFrame
    sizes: dict
    table: dict
    width: int
    user_type: str
    item_type: str


def candidates(users: DataFrame, items: DataFrame, share: float = 0.1, least: int = 512, **index) -> DataFrame:
    """(user_id, channel_id, item_id, score): the best items of each channel for each user, ``share`` of its items and ``least`` at least (exact).

    ``users`` has user_id and vec, and may have channel_id: such a user looks
    into that channel only.  ``items`` has item_id, channel_id and vec.  Ids
    may be of any type, channels are numbers, all vectors have one width.
    Rows with a null id, channel or vector take no part.
    """
    found, spark = _index(users, items, **index), users.sparkSession
    if not found.width:
        return spark.createDataFrame([], f"user_id {found.user_type}, channel_id long, item_id {found.item_type}, score double")
    return _lists(found, {c: max(least, math.ceil(share * n)) for c, n in found.sizes.items()})


def _index(users: DataFrame, items: DataFrame, small: int = 1024, bands: int = 4, most_cells: int = 100_000, most_known: int = 4096) -> _Index:
    """Cells of the items' channels; they save work, and no list depends on them.

    A channel is cut into ``bands`` of the vectors' norms; in each band a hash
    sample of about the square root of the channel's items serves as anchors,
    and an item belongs to the cell of the anchor nearest to it once the band's
    norms are made equal.  Cells of long vectors come first.  A channel of up
    to ``small`` items is one cell.  Only anchors and cell centres are
    broadcast, about ``most_cells`` of each (more items make larger cells), and
    up to ``most_known`` items of a channel, which tell what a list is worth at least.
    """
    spark = users.sparkSession
    if "channel_id" in users.columns:
        users = users.where("channel_id is not null").withColumn("only", F.col("channel_id").cast("long"))
    else:
        users = users.withColumn("only", F.lit(None).cast("long"))
    users = users.where("user_id is not null and vec is not null").select("user_id", "only", F.col("vec").cast("array<double>").alias("vec"))
    items = items.where("item_id is not null and channel_id is not null and vec is not null").select(
        "item_id", F.col("channel_id").cast("long").alias("channel_id"), F.col("vec").cast("array<double>").alias("vec"))
    user_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((users, "user_id"), (items, "item_id")))
    width = items.agg(F.max(F.size("vec"))).first()[0]
    if not width:
        return _Index(users, items, {}, {}, 0, user_type, item_type)
    normed = items.withColumn("norm", vx.norm(F.col("vec")))
    cuts = F.percentile_approx("norm", F.array(*[F.lit(i / bands) for i in range(1, bands)]), F.lit(1000))
    channels = normed.groupBy("channel_id").agg(F.count("*").alias("n"), cuts.alias("cuts"))
    channels = materialise(channels.withColumn("root", F.when(F.col("n") > small, F.ceil(F.sqrt("n"))).otherwise(0)), "retrieval-channels")
    planned = channels.agg(F.sum(F.col("root") * bands)).first()[0]
    squeeze = min(1.0, most_cells / planned) if planned else 1.0

    norm = F.col("norm")
    banded = normed.join(channels, "channel_id").withColumn("band", F.when(F.col("root") > 0, F.size(F.filter("cuts", lambda c: c < norm))).otherwise(0))
    longest = banded.groupBy("channel_id", "band").agg(F.max("norm").alias("longest"))
    banded = banded.join(longest, ["channel_id", "band"]).withColumn("band", F.col("band").cast("long"))
    drawn = banded.where((F.col("root") > 0) & (hash_number(F.col("item_id"), F.lit(5)) < squeeze * bands * F.col("root") / F.col("n") * 2.0**32))
    held: dict[tuple[int, int], list] = {}
    for r in drawn.select("channel_id", "band", "item_id", "longest", "vec").toLocalIterator():
        held.setdefault((r["channel_id"], r["band"]), []).append((r["item_id"], r["longest"], r["vec"]))
    anchors, some, number = {}, {}, 1
    for key, rows in sorted(held.items(), key=lambda entry: (entry[0][0], -entry[0][1])):
        some.setdefault(key[0], []).extend(v for *_, v in rows[: most_known - len(some.get(key[0], []))])
        anchors[key] = np.arange(number, number + len(rows)), _lifted(np.array([v for *_, v in rows], float), np.array([m for _, m, _ in rows]))
        number += len(rows)
    known = spark.sparkContext.broadcast(anchors)
    celled = banded.select("item_id", "channel_id", "band", "longest", "vec").mapInArrow(_assign(known, width), f"item_id {item_type}, channel_id long, cell long, vec array<double>")
    celled = materialise(celled, "retrieval-cells")

    centres = celled.groupBy("channel_id", "cell").agg(vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("centre"), F.count("*").alias("n"))
    middles: dict[int, list] = {}
    for r in centres.toLocalIterator():
        middles.setdefault(r["channel_id"], []).append((r["cell"], r["centre"], r["n"]))
    sizes, middle = {}, {}
    for channel, rows in middles.items():
        rows.sort(key=lambda r: r[0])
        sizes[channel] = sum(n for *_, n in rows)
        middle[channel] = np.array([n for n, *_ in rows]), np.array([c for _, c, _ in rows])
    far = celled.select("channel_id", "cell", "vec").mapInArrow(_farthest(spark.sparkContext.broadcast(middle), width), "channel_id long, cell long, distance double")
    radius = {channel: np.zeros(len(numbers)) for channel, (numbers, _) in middle.items()}
    for r in far.groupBy("channel_id", "cell").agg(F.max("distance").alias("radius")).toLocalIterator():
        radius[r["channel_id"]][np.searchsorted(middle[r["channel_id"]][0], r["cell"])] = r["radius"]
    table = {c: (*middle[c], radius[c], np.array(some.get(c, []), float).reshape(-1, width)) for c in middle}
    return _Index(users, celled, sizes, table, width, user_type, item_type)


def best_products(users: DataFrame, items: DataFrame, k: int, history: DataFrame | None = None, patience: int | None = None,
                  block: int = 1 << 22, **index) -> DataFrame:
    """The ``k`` best items of each user and channel that are not in the user's history (user_id, item_id), with ``rank`` (exact).

    Tables are those of :func:`candidates`.  No pair is written: the users of a
    channel are dealt into blocks of up to ``block`` vector components, the
    channel's items are sent to each block once, in the order of their cells,
    and a task keeps the running lists.  A list holds k items and as many as
    the history may take out of it, so ``patience`` (the histories up to which
    lists used to be cut early) no longer matters.  The work is the number of
    users times items at most, less where cells can be passed over.
    """
    order = [F.desc("score"), F.asc("item_id")]
    key = ["user_id", "channel_id"]
    found, spark = _index(users, items, **index), users.sparkSession
    channel_type = items.schema["channel_id"].dataType
    if not found.width:
        return spark.createDataFrame([], f"user_id {found.user_type}, channel_id {channel_type.simpleString()}, item_id {found.item_type}, score double, rank int")
    seen = gone = None
    if history is not None:
        seen = materialise(history.select(F.col("user_id").cast(found.user_type).alias("user_id"), F.col("item_id").cast(found.item_type).alias("item_id")).distinct(), "retrieval-history")
        gone = seen.join(found.items.select("item_id", "channel_id"), "item_id").groupBy(*key).agg(F.count("*").alias("gone"))
        gone = materialise(gone, "retrieval-gone")
    best = _lists(found, dict.fromkeys(found.table, k), gone, block)
    if seen is not None:
        best = best.join(seen, ["user_id", "item_id"], "left_anti")
    best = windows.top_k(best, key, order, k).withColumn("channel_id", F.col("channel_id").cast(channel_type))
    return best.select(*key, "item_id", "score", "rank")


def _lists(found: _Index, need: dict[int, int], gone: DataFrame | None = None, block: int = 1 << 22) -> DataFrame:
    """(user_id, channel_id, item_id, score): ``need`` best items of a channel for each user, and as many as ``gone`` (user_id, channel_id, gone) says."""
    spark, longer = found.users.sparkSession, {}
    if gone is not None:
        longer = {r["channel_id"]: r["n"] for r in gone.groupBy("channel_id").agg(F.sum("gone").alias("n")).collect()}
    channels = sorted(found.table)
    sizes = {r["only"]: r["n"] for r in found.users.groupBy("only").agg(F.count("*").alias("n")).collect()}
    cores, starts, blocks, total = spark.sparkContext.defaultParallelism, [], [], 0
    for c in channels:
        n = sizes.get(None, 0) + sizes.get(c, 0)
        fewest = max(n * found.width / block, (n * min(need[c], found.sizes[c]) + longer.get(c, 0)) / block)
        starts.append(total)
        blocks.append(max(1, math.ceil(fewest), min(math.ceil(2 * cores / len(channels)), math.ceil(n / CHUNK))))
        total += blocks[-1]

    def of_channel(values: list[int]):
        return F.map_from_arrays(F.lit(channels).cast("array<bigint>"), F.lit(values).cast("array<int>"))[F.col("channel_id")]

    asking = found.users.select("user_id", F.explode(F.when(F.col("only").isNull(), F.lit(channels).cast("array<bigint>")).otherwise(F.array("only"))).alias("channel_id"), "vec")
    asking = asking.where(F.col("channel_id").isin(channels))
    asking = asking.withColumn("gone", F.lit(0).cast("long")) if gone is None else asking.join(gone, ["user_id", "channel_id"], "left")
    asking = asking.select(
        (of_channel(starts) + F.pmod(F.xxhash64("user_id"), of_channel(blocks))).cast("int").alias("place"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("cell"),
        "channel_id", "user_id", F.lit(None).cast(found.item_type).alias("item_id"), (F.coalesce("gone", F.lit(0)) + of_channel([need[c] for c in channels])).cast("int").alias("need"), "vec")
    every = F.explode(F.sequence(of_channel(starts), of_channel(starts) + of_channel(blocks) - 1))
    offered = found.items.select(
        every.alias("place"), F.lit(1).alias("kind"), "cell", "channel_id", F.lit(None).cast(found.user_type).alias("user_id"), "item_id", F.lit(0).alias("need"), "vec")
    dealt = asking.unionByName(offered).repartition(total, "place").sortWithinPartitions("place", "kind", "cell")
    return dealt.mapInArrow(_best(spark.sparkContext.broadcast(found.table), found.width),
                            f"user_id {found.user_type}, channel_id long, item_id {found.item_type}, score double")
