"""One key, value or vector holds a large part of the rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.operators import aggregates, graph, ranking, recall, sampling, similarity, windows


@pytest.fixture(scope="module")
def hot(spark):
    """1,200 rows; user 0 has a third of them, value 5 a half, and nulls never occur."""
    return spark.range(1200).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("user_id"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise((F.col("id") * 7 % 101).cast("double")).alias("value"),
        ((F.col("id") * 13) % 1200).alias("at")).cache()


def brute_positions(rows, keys):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append((r["value"], r["id"]))
    return {i: place for g in groups.values() for place, (_, i) in enumerate(sorted(g), 1)}


@pytest.mark.parametrize("keys", [[], ["user_id"]])
def test_position(hot, keys):
    want = brute_positions(hot.collect(), keys)
    got = {r["id"]: r["idx"] for r in windows.position(hot, "value", "id", keys=keys).collect()}
    assert got == want


def test_hot_value_is_cut_into_ranges(hot):
    ranged = windows.with_ranges(hot, "value", "id").groupBy("r1", "r2").count().collect()
    assert max(r["count"] for r in ranged) < 120


@pytest.mark.parametrize("rows_a_range, least, most", [(1_000_000, 25, 40), (10, 90, 160), (1, 400, 1100)])
def test_ranges_follow_the_number_of_rows(spark, rows_a_range, least, most):
    rows = spark.range(1200).select((F.col("id") * 7919 % 1201).alias("value"), "id")
    ranged = windows.with_ranges(rows, "value", "id", rows_a_range).cache()
    assert least <= ranged.select(F.floor((F.col("r1") + 1) / 2)).distinct().count() <= most
    placed = sorted((r["r1"], r["r2"], r["value"]) for r in ranged.collect())
    assert [v for *_, v in placed] == sorted(v for *_, v in placed)


def test_cume_dist(hot):
    rows = hot.collect()
    got = {(r["user_id"], r["value"]): r["cume"] for r in windows.cume_dist(hot, ["user_id"], "value").collect()}
    for (user, value), share in got.items():
        mine = [r["value"] for r in rows if r["user_id"] == user]
        assert share == pytest.approx(sum(v <= value for v in mine) / len(mine))


def test_neighbours(hot):
    sliced = hot.withColumn("part", F.floor(F.col("at") / 50))
    got = {r["id"]: (r["value_prev"], r["value_next"]) for r in windows.neighbours(
        sliced, ["user_id"], ["at", "id"], "part", "value", -1.0).collect()}
    groups = defaultdict(list)
    for r in hot.collect():
        groups[r["user_id"]].append((r["at"], r["id"], r["value"]))
    for g in groups.values():
        g.sort()
        for i, (_, row, _) in enumerate(g):
            assert got[row] == (g[i - 1][2] if i else -1.0, g[i + 1][2] if i + 1 < len(g) else -1.0)


def test_lists_stay_small_and_whole(hot):
    lists = aggregates.collect_chunks(hot, ["user_id"], "id", "id", size=50).collect()
    assert max(len(r["items"]) for r in lists) <= 50
    assert sorted(i for r in lists for i in r["items"]) == list(range(1200))
    # What a list holds does not depend on how many rows of the key follow it.
    more = hot.unionByName(hot.where("user_id is not null").withColumn("id", F.col("id") + 5000))
    for counted in (1_000_000, 100):
        again = {(r["user_id"], r["chunk"]): r["items"] for r in aggregates.collect_chunks(more, ["user_id"], "id", "id", size=50, counted=counted).collect()}
        assert all(again[r["user_id"], r["chunk"]] == r["items"] for r in lists if len(r["items"]) == 50)


def test_many_copies_of_one_vector(spark):
    """Half of the items share one vector; lists are still exact."""
    items = spark.range(120).select(
        F.col("id").alias("item_id"), F.lit(1).alias("channel_id"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0), F.lit(0.0)))
        .otherwise(F.array(F.cos(F.col("id")), F.sin(F.col("id")))).alias("vec")).cache()
    reps, members = similarity.collapse_copies(items)
    assert reps.count() == 61 and members.count() == 120
    got = defaultdict(list)
    for r in similarity.nearest(items, lambda x: similarity.pairs_within(x, 5.0), k=4).orderBy("item_id", "rank").collect():
        got[r["item_id"]].append(r["similar_id"])
    rows = {r["item_id"]: r["vec"] for r in items.collect()}
    for a, va in rows.items():
        order = sorted((round(sum((x - y) ** 2 for x, y in zip(va, vb)) ** 0.5, 12), b) for b, vb in rows.items() if b != a)
        assert got[a] == [b for _, b in order[:4]]


def test_rank_with_split_nodes_equals_plain(spark):
    edges = spark.createDataFrame(
        [("u0", f"item_{i}") for i in range(40)] + [(f"u{j}", f"item_{j}") for j in range(1, 8)], "a string, b string")
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(edges.select("b", "a")).cache()
    roots = spark.createDataFrame([("u1",)], "root string")
    sliced, nodes = graph.prepare(both, per_slice=5)
    ranks = roots.select("root", F.col("root").alias("node"), F.lit(1.0).alias("score"))
    for _ in range(3):
        ranks = graph.one_round(sliced, nodes, roots, ranks, 0.8)
    got = {r["node"]: r["score"] for r in ranks.collect()}
    want, out = {"u1": 1.0}, defaultdict(list)
    for r in both.collect():
        out[r["src"]].append(r["dst"])
    for _ in range(3):
        nxt = defaultdict(float, {"u1": 1 - 0.8})
        for node, score in want.items():
            for dst in out[node]:
                nxt[dst] += 0.8 * score / len(out[node])
        want = dict(nxt)
    assert sliced.filter("src = 'u0'").select("slice").distinct().count() > 1
    assert got == pytest.approx(want)


def test_negatives_are_unseen_and_bounded(spark):
    seen = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 20).alias("user_id"), (F.col("id") % 150).alias("item_id"))
    pool = windows.dense_ids(spark.range(400).withColumnRenamed("id", "item_id"), "item_id", "slot")
    drawn = windows.position(sampling.negatives(seen, pool), "luck", "item_id", keys=["user_id"], name="place").filter("place <= quota")
    known = {(r["user_id"], r["item_id"]) for r in seen.collect()}
    counts = defaultdict(int)
    for r in drawn.collect():
        assert (r["user_id"], r["item_id"]) not in known
        counts[r["user_id"]] += 1
    limit = defaultdict(int)
    for user, _ in known:
        limit[user] += 1
    assert all(n <= limit[user] for user, n in counts.items()) and counts[0] == limit[0]


def test_category_fill_is_exact(spark):
    predicted = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 11, 1)], "user_id int, cate_id int, place int")
    items = spark.range(90).select(F.when(F.col("id") < 60, 10).otherwise(11).cast("int").alias("cate_id"), F.col("id").alias("item_id"))
    rows = recall.category_fill(predicted, items, most=70).collect()
    mine = [r for r in rows if r["user_id"] == 1]
    assert len(mine) == 70 and sum(r["cate_id"] == 10 for r in mine) == 60
    assert sorted(r["position"] for r in mine) == list(range(1, 71))
    assert len([r for r in rows if r["user_id"] == 2]) == 30


def test_null_keys_and_null_order_values_keep_their_rows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from larkspur.operators import windows

    rows = [(None if i % 5 == 0 else i % 3, None if i % 4 == 0 else i * 7 % 11, i) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, x long, id long")
    w = Window.partitionBy("k").orderBy("x", "id")
    want = {r.id: r.p for r in df.withColumn("p", F.row_number().over(w)).collect()}
    assert {r.id: r.p for r in windows.position(df, "x", "id", keys=["k"], name="p").collect()} == want
    assert windows.position(df, "x", "id", name="p").count() == 40
    assert windows.normalise(df, ["k"], "id", "z").count() == 40
    assert windows.neighbours(df, ["k"], ["id"], "x", "id", -1).count() == 40
    assert windows.cume_dist(df, ["k"], "x").count() == df.select("k", "x").distinct().count()


def test_exact_rank_over_blocks_of_nodes(spark, monkeypatch):
    """Nodes in many blocks, two roots, repeated edges, an edge to nowhere and a root without edges."""
    monkeypatch.setattr(graph, "NODES_PER_BLOCK", 5)
    pairs = [(f"u{u}", f"item_{(u * u + i) % 7}") for u in range(12) for i in range(3)] + [("u0", "item_6")] * 2
    edges = [*pairs, *((b, a) for a, b in pairs), ("u1", None), (None, "u1")]
    degree = defaultdict(int)
    for a, _ in edges:
        degree[a] += 1
    want = {}
    for root in ("u0", "u1", "alone"):
        ranks = {root: 1.0}
        for _ in range(120):
            new = defaultdict(float, {root: 0.2})
            for a, b in edges:
                if a is not None and a in ranks:
                    new[b] += 0.8 * ranks[a] / degree[a]
            ranks = new
        want |= {(root, node): score / 0.2 for node, score in ranks.items()}
    got = graph.personal_rank_exact(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("u0",), ("u1",), ("alone",)], "root string"))
    got = {(r["root"], r["node"]): r["score"] for r in got.collect()}
    assert got == pytest.approx(want, abs=1e-6) and ("u1", None) in got


def test_ad_rows_of_samples_are_those_of_the_full_joins(spark):
    samples = spark.createDataFrame([(u, d * 86400, a, f"P{(a or 0) % 2}", c and 1 - c, c) for u, d, a, c in [
        (1, 1, 10, 1), (1, 2, 11, 0), (2, 1, 99, 1), (9, 3, 10, 0), (None, 1, 10, 1), (1, 1, None, 1), (1, 1, 10, 1), (2, 2, 12, None)]],
        "user_id long, ts long, adgroup_id long, pid string, nonclk int, clk int")
    ads = spark.createDataFrame([(10, 3, 1.5), (11, 4, None), (12, 5, 2.5), (13, 6, 2.0), (None, 1, 1.0)], "adgroup_id long, cate_id int, price double")
    users = spark.createDataFrame([(1, 0, 1, 2, None, 1, 0, 3), (2, 1, 0, 3, 2, 2, 1, None), (4, 2, 1, 1, 1, 1, 1, 1), (None, 3, 0, 0, 0, 0, 0, 0)],
                                  "user_id long, cms_group int, gender int, age_level int, pvalue_level int, shopping_level int, occupation int, class_level int")
    got, want = (df.na.drop(subset=["clk", "price", "cms_group"]) for df in (ranking.sample_rows(samples, ads, users), ranking.ad_rows(samples, ads, users)))
    assert got.count() == 2 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert ranking.sample_rows(samples, ads, users).agg(F.max("ts")).first()[0] == 3 * 86400
