"""Hard negatives against plain integer products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm.negatives import Best, block_scores, hard_negatives, pack_block

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def plain(rows, positives=5, negatives=5, scale=256, step=100):
    whole = {(i, label, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v, label in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    anchors = {}
    for i, label, v in sorted(whole):
        if i % step == 0:
            anchors.setdefault(i, (label, v))
    out = set()
    for i, (label, v) in anchors.items():
        score = {(sum(a * b for a, b in zip(v, w)), j, own == label) for j, own, w in whole}
        near = sorted((-s, j) for s, j, same in score if same and j != i)[:positives]
        for p, positive in near:
            far = sorted((-s, j) for s, j, same in score if not same and 80 * -p <= 100 * s <= 100 * -p)[:negatives]
            out |= {(i, positive, k + 1, j, -p, -s) for k, (s, j) in enumerate(far)}
    return out


def test_packed_products_are_exact():
    rng = np.random.default_rng(4)
    for bits in (1, 4, 9, 20, 27):
        dims, n = int(rng.integers(1, 12)), int(rng.integers(1, 40))
        block, anchors = (rng.integers(-(1 << bits), 1 << bits, (m, dims)) for m in (n, 9))
        ids = rng.permutation(n)
        square = max(sum(int(x) ** 2 for x in a) for a in anchors)
        held, width, bias, bound, order, words = pack_block(ids, block, square)
        got = block_scores(anchors, np.frombuffer(words, np.uint64).reshape(held, -1), n, width, bias, bound)
        assert (got == anchors @ block[np.argsort(ids)].T).all() and (np.frombuffer(order, np.int64) == np.arange(n)).all()
    assert pack_block(np.arange(5), np.full((5, 4), 10), 400)[1] * 3 <= 64  # several fields a word
    with pytest.raises(ValueError):
        pack_block(np.arange(2), np.full((2, 9), (1 << 31) - 1), 1 << 70)


def test_best_entries_keep_order_and_count_equals_once():
    best, seen, rng = Best(3, 4), {0: set(), 1: set(), 2: set()}, random.Random(2)
    for _ in range(40):
        rows = [(rng.randrange(3), rng.randrange(-3, 3), rng.randrange(30)) for _ in range(rng.randrange(12))]
        for a, s, i in rows:
            seen[a].add((-s, i))
        best.add(*(np.array([r[k] for r in rows], np.int64) for k in range(3)))
    at, score, ids = best.rows()
    for a in range(3):
        assert list(zip(-score[at == a], ids[at == a])) == sorted(seen[a])[:4]


@pytest.mark.parametrize("options", [{}, {"anchor_block": 2, "block_rows": 7}])
def test_negatives_equal_plain_products(spark, options):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0.05, 0.2) for _ in range(6)], rng.choice([0, 0, 0, 1, 2])) for i in range(700)]
    same = [0.25, -0.5, 0.125, 0.0, 0.75, 0.5]
    rows += [(1000 + i, same, i % 3) for i in range(240)]  # ties, every fifth hundred an anchor
    rows += [(2000, [], 1), (2001, [], 0), (2100, [0.5, 0.5], 1), (2102, [3.0] * 9, 0), (2103, [-40.0] * 6, 1)]
    rows += [(3000, None, 1), (None, same, 1), (3100, same, None), (3200, [float("nan")] * 6, 1), (3300, [float("inf")] + same[1:], 0), (3400, [None] + same[1:], 0)]
    rows += rows[:30] + [(100, same, 2), (101, same, 2)]  # repeated rows, two contents under one id
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_no_rows_or_no_anchor(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0
    some = spark.createDataFrame([(1, [0.5], 1, None, None), (2, [0.5], 0, None, None)], SCHEMA)
    assert hard_negatives(some, F.col("vec_id") % 100 == 0).count() == 0
    alone = spark.createDataFrame([(100, [0.5], 1, None, None), (2, [0.5], 0, None, None)], SCHEMA)
    assert hard_negatives(alone, F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="stay below"):
        hard_negatives(spark.createDataFrame([(100, [1e30], 1, None, None)], SCHEMA), F.col("vec_id") % 100 == 0).count()
