"""Fingerprints and their links against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import FOLDER

from larkspur.llm import queries
from larkspur.llm.simhash import fingerprint, layout, near_links, simhash_components
from tests.llm.test_pairs import Forest, edited


def plain_print(text, k=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, threshold=4):
    prints, forest = [(i, plain_print(t)) for i, t in rows], Forest()
    values = np.array([p for _, p in prints], np.uint64)
    for x in range(len(rows)):
        forest.root(("row", x))
        for y in np.flatnonzero(np.bitwise_count(values[:x] ^ values[x]) <= threshold).tolist():
            forest.link(("row", x), ("row", y))
    least = {}
    for x, (i, _) in enumerate(prints):
        root = forest.root(("row", x))
        least[root] = min((j for j in (i, least.get(root)) if j is not None), default=None)
    return sorted(((i, f"{p:016x}", least[forest.root(("row", x))]) for x, (i, p) in enumerate(prints)), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_fingerprints(words):
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join(rng.choice(words).title() for _ in range(rng.randrange(40))) + rng.choice(["", "\x0b\n", "\x85 \xa0 é", "\x1c"])
        assert fingerprint(text) == plain_print(text)
    assert fingerprint(None) == fingerprint(" \t") == 0


@pytest.mark.parametrize("parts", [1, 2, 3, 4, 5])
def test_every_near_pair_meets_at_a_home(parts):
    rng = random.Random(parts)
    plan = layout(parts, 2 if parts == 1 else 4)
    base = np.array([rng.getrandbits(64) for _ in range(60)], np.uint64)
    other = base.copy()
    for i in range(len(other)):
        for b in rng.sample(range(64), rng.randrange((2 if parts == 1 else 4) + 1)):
            other[i] ^= np.uint64(1 << b)
    met = np.zeros(len(base), bool)
    for part in plan:
        row, key, home = part.anchors(base)
        assert np.bincount(row[home], minlength=len(base)).tolist() == [1] * len(base)  # one home, within radius 1
        at = dict(zip(row[home].tolist(), key[home].tolist()))
        assert all(bin((int(k) & ((1 << part.width) - 1)) ^ int(part.words(base[r : r + 1])[0])).count("1") <= part.reach for r, k in zip(row, key))
        for r, k in zip(*part.anchors(other)[:2]):
            met[r] |= at[int(r)] == int(k)
    assert met.all()


def test_links_tie_what_near_pairs_tie():
    rng = random.Random(8)
    for area in (16, 4096, 1 << 21):
        rows = []
        for group in range(30):
            centre = rng.getrandbits(64)
            for _ in range(rng.randrange(1, 40)):
                rows.append((group, rng.random() < 0.6, centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))))
        rows.sort(key=lambda r: (r[0], not r[1]))
        groups, homes, prints = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], np.uint64)
        got, want = Forest(), Forest()
        a, b = near_links(groups, homes, prints, 4, area)
        assert len(a) < len(set(prints.tolist()))
        for x, y in zip(a.tolist(), b.tolist()):
            got.link(x, y)
        for x, (g, home, p) in enumerate(rows):
            for h, _, q in rows:
                if g == h and home and bin(p ^ q).count("1") <= 4:
                    want.link(p, q)
        assert {p: want.root(p) for p in set(prints.tolist())} == {p: want.root(got.root(p)) for p in set(prints.tolist())}
        assert all(got.root(p) == got.root(q) for p in want.up for q in [want.root(p)])


@pytest.mark.parametrize("options", [{}, {"parts": 2}, {"parts": 5, "crowded": 3, "task_rows": 500}, {"crowded": 20, "task_rows": 2000}])
def test_components_equal_plain_version(spark, words, options):
    rng = random.Random(11)
    rows = []
    for group in range(25):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([3, 30, 120, 400])))
        rows += [(len(rows) + i, edited(rng, text, words, rng.randrange(1 + i % 5)) if i else text) for i in range(rng.choice([1, 2, 3, 8, 60]))]
    rows += [(None, rows[0][1]), (None, None), (900, None), (901, ""), (902, " \n"), (3, rows[3][1]), (3, rows[9][1]), (-5, rows[20][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, fingerprint double").repartition(4)
    assert rows_of(simhash_components(df, **options)) == plain_components(rows)


def test_tables_and_odd_rows(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert rows_of(queries.op12_anchor_simhash(spark, FOLDER)) == plain_components(docs)
    assert rows_of(simhash_components(odd)) == plain_components([(r.doc_id, r.text) for r in odd.collect()])
    assert simhash_components(none).count() == 0
