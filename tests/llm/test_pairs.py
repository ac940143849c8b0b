"""Jaccard links, fuzzy lines, contamination and components against plain versions."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import oracle
import pyarrow as pa
import pytest
from conftest import FOLDER

from larkspur.llm import queries
from larkspur.llm.components import components
from larkspur.llm.decontaminate import Index, Plan, ShortIndex, _candidates, contaminated, least_distance
from larkspur.llm.jaccard import jaccard_components
from larkspur.llm.licences import KNOWN, licence_matches
from larkspur.llm.line_dedup import Profiles, all_within_edits, fuzzy_lines, within_edits


class Forest:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k=4):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def plain_jaccard(rows, percent=85):
    sets, forest = [(i, shingles(t)) for i, t in rows], Forest()
    for i, _ in sets:
        forest.root(i)
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                forest.link(i, j)
    return {i: (len(s), forest.root(i)) for i, s in sets}


def edited(rng, text, words, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(words) + str(rng.randrange(99))
    return " ".join(w)


@pytest.mark.parametrize("options", [{}, {"crowded": 2}, {"block": 16, "fragments": 3}, {"crowded": 3, "most_heavy": 40, "block": 8, "fragments": 1}])
def test_jaccard_equals_brute_force(spark, words, options):
    rng = random.Random(3)
    rows = []
    passage = " ".join(rng.choice(words) for _ in range(30))
    for base in range(6):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([6, 9, 40, 150])))
        for _ in range(30 if base < 2 else 6):
            rows.append((len(rows) + 1, edited(rng, text, words, rng.randint(0, 4))))
    for _ in range(25):
        rows.append((len(rows) + 1, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))))
    rows += [(len(rows) + 1 + i, " ".join(words[: i % 9])) for i in range(12)]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()}
    assert got == plain_jaccard(rows)


def test_jaccard_odd_rows(odd, none):
    rows = jaccard_components(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    by = {r.doc_id: r for r in rows if r.doc_id not in (3, None)}
    assert by[2].component_id == 1 and by[1].n_links == 0 and by[4].n_shingles == 0 and by[4].component_id == 4
    assert by[8].component_id == by[9].component_id == 8 and by[10].n_shingles == 1
    assert jaccard_components(none).count() == 0


def test_jaccard_and_licences_equal_sql(spark, duck):
    for name, sql in queries.ORACLE.items():
        got = oracle.spark_rows(queries.QUERIES[name](spark, FOLDER))
        assert oracle.difference(got, oracle.duck_rows(duck, sql)) is None, name


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(200)] + [(rng.randrange(400, 700), rng.randrange(400, 700)) for _ in range(150)] + [(7, 7), (None, 3)]
    forest = Forest()
    for a, b in links:
        if a is not None and a != b:
            forest.link(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: forest.root(x) for x in forest.up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def tidy(line):
    out = [re.sub(r"\d", "0", w).strip("".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))) for w in line.lower().split()]
    return " ".join(w for w in out if w)


def test_edit_bound_is_exact():
    draw = random.Random(3)
    for _ in range(1500):
        s = "".join(draw.choices("abé漢", k=draw.randrange(30)))
        t = list(s) if draw.random() < 0.5 else draw.choices("abé漢", k=draw.randrange(30))
        for _ in range(draw.randrange(4)):
            t.insert(draw.randrange(len(t) + 1), draw.choice("abc"))
        t = "".join(t)
        d = levenshtein(s, t)
        assert [within_edits(s, t, m) for m in (d - 1, d, d + 1)] == [False, True, True]


def test_lines_against_brute_force(spark, words):
    """Every equal normalised line goes but once; what else goes is near to a line that stays; most near lines go."""
    rng = random.Random(2)
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)]
    docs, near = [], []
    for d in range(60):
        lines = []
        for _ in range(4):
            line = rng.choice(base)
            kind = rng.randrange(4)
            if kind == 1:
                line = line.upper() + "!!"
            if kind == 2:
                line = edited(rng, line, words, 1)
                near.append(tidy(line))
            if kind == 3:
                line = " ".join(rng.choice(words) for _ in range(40))
            lines.append(line)
        docs.append((d, "\n".join(lines + ["", f"own {words[d]} {words[d + 1]} {words[d + 2]} {words[d + 3]}"])))
    got = {r.doc_id: r.text.split("\n") for r in fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    kept = [tidy(line) for lines in got.values() for line in lines if line]
    assert len(kept) == len(set(kept))
    for d, text in docs:
        lines = text.split("\n")
        left = iter(got[d])
        current = next(left, None)
        for line in lines:
            if line == current:
                current = next(left, None)
            else:
                assert any(levenshtein(tidy(line), k) <= 0.2 * max(len(k), len(tidy(line))) for k in kept)
        assert current is None and "" in got[d] and any(x.startswith("own ") for x in got[d])
    first = min(d for d, t in docs if base[0] in t.lower())
    assert any(tidy(x) == tidy(base[0]) or levenshtein(tidy(x), tidy(base[0])) < 30 for x in got[first])
    assert sum(n in kept for n in near) <= 0.7 * len(near)


def test_lines_odd_rows(odd, none):
    rows = fuzzy_lines(odd).collect()
    assert len(rows) == odd.count()
    assert fuzzy_lines(none).count() == 0
    texts = {r.doc_id: r for r in rows if r.doc_id not in (3, None)}
    assert texts[2].n_removed == 1 and texts[2].any_left is False and texts[1].n_removed == 0
    assert texts[4].text is None and texts[5].text == "" and texts[6].text == " \n\t" and texts[9].n_removed == 1
    assert [r.n_removed for r in rows if r.doc_id == 3].count(0) == 3
    assert set(odd.columns) <= set(rows[0].asDict())


def test_least_distance_is_exact():
    rng = random.Random(4)
    for _ in range(150):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 18)))
        want = min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert least_distance(a.encode(), b.encode()) == want


def test_contamination_recall_and_precision(spark, words):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(14, 60))).capitalize() + ".") for i in range(60)]
    docs, planted = [], {}
    for d in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 300)))
        if d % 2:
            item, passage = rng.choice(items)
            chars = list(passage)
            edits = int(len(chars) * rng.choice([0, 0, 0.02, 0.04]))
            for _ in range(edits):
                at = rng.randrange(len(chars))
                chars[at] = rng.choice(["", "x", chars[at] + "q"])
            passage = "".join(chars)
            planted[d] = (item, edits)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + ("\n" if rng.random() < 0.5 else " ") + (passage.upper() if d % 3 == 0 else passage) + "  " + text[at:]
        docs.append((d, text))
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    exact = {(d, i) for d, (i, e) in planted.items() if not e}
    assert exact <= got
    assert len(got & {(d, i) for d, (i, _) in planted.items()}) >= 0.95 * len(planted)
    assert all(d in planted for d, _ in got)


def test_contamination_exact_on_tables(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " ".join(t.lower().split())
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if flat(i.text) in flat(d.text)}
    rows = contaminated(docs, items, block_items=15).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in rows}


def test_contamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, odd.where("doc_id = 1").first().text), (None, "x"), (2, None), (3, ""), (1, "another item")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(odd, items).collect()} == {(1, 1), (2, 1)}
    assert contaminated(none, items).count() == 0 and contaminated(odd, items.limit(0)).count() == 0


def test_licences(spark, odd, none):
    known = spark.createDataFrame(list(KNOWN), "licence string, text string")
    mit = next(t for n, t in KNOWN if len(t) > 500 and n == "MIT")
    texts = ["Copyright (c) 2019 A. Person\n\n" + mit.replace(" ", "\n", 3), mit.lower().replace("license", "licence"), "x\n  RELEASED under the MIT Licence!\ny", "no licence", mit + " more", None, ""]
    rows = licence_matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), known).collect()
    assert sorted((r.doc_id, r.line, r.licence) for r in rows if r.line is None or r.doc_id == 2) == [(0, None, "MIT"), (1, None, "MIT"), (2, 1, "MIT")]
    assert licence_matches(odd, known).count() == 0 and licence_matches(none, known).count() == 0


def test_near_lines_are_found(spark, words):
    """Lines of 4 to 60 words with edits up to a similarity of 0.8: at least 0.9 of the pairs become one line."""
    rng = random.Random(12)
    docs, pairs = [], 0
    while pairs < 240:
        line = tidy(" ".join(rng.choice(words) for _ in range(rng.randint(4, 60))))
        other = tidy(edited(rng, line, words, rng.randint(1, max(1, line.count(" ") // 6))))
        if other != line and levenshtein(line, other) <= 0.2 * max(len(line), len(other)):
            docs += [(2 * pairs, line), (2 * pairs + 1, other)]
            pairs += 1
    got = fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got.where("n_removed = 1").count() >= 0.9 * pairs


def test_crowded_buckets_keep_near_lines(spark, words):
    """Lines that share a passage but are not near fill a bucket; the near pairs among them are still found."""
    rng = random.Random(13)
    passage, docs = " ".join(rng.choice(words) for _ in range(12)), []
    for i in range(120):
        docs.append((2 * i, passage + " " + " ".join(rng.choice(words) for _ in range(30))))
        docs.append((2 * i + 1, edited(rng, docs[-1][1], words, 2)))
    near = sum(levenshtein(tidy(docs[2 * i][1]), tidy(docs[2 * i + 1][1])) <= 0.2 * max(len(tidy(t)) for _, t in docs[2 * i : 2 * i + 2]) for i in range(120))
    got = fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string"), crowded=8)
    assert near > 100 and got.where("n_removed = 1").count() >= 0.9 * near


@pytest.mark.parametrize("crowded", [1, 64])
def test_crowded_buckets_lose_no_near_line(spark, crowded):
    """All lines share two words and nothing else with their near line, in which a letter of every other word is changed."""
    rng = random.Random(21)
    docs = []
    for i in range(130):
        own = ["".join(rng.choice("abcdefghijklm") for _ in range(8)) for _ in range(6)]
        changed = [w[:at] + "x" + w[at + 1 :] for w, at in ((w, rng.randrange(8)) for w in own)]
        docs += [(2 * i, " ".join(["common", "passage", *own])), (2 * i + 1, " ".join(["common", "passage", *changed]))]
    got = fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string"), crowded=crowded)
    assert {r.doc_id for r in got.where("n_removed = 1").collect()} == {2 * i + 1 for i in range(130)}


def test_profiles_never_hide_a_near_string():
    rng = random.Random(22)
    for _ in range(40):
        texts = ["".join(rng.choices("abé漢 ", k=rng.randrange(12))) for _ in range(12)]
        a, b = (x.ravel() for x in np.meshgrid(np.arange(12), np.arange(12)))
        distance = np.array([levenshtein(texts[x], texts[y]) for x, y in zip(a, b)])
        assert Profiles(texts).may_be_near(a, b, distance).all()
        for more in (-1, 0, 2):
            assert (all_within_edits([texts[x] for x in a], [texts[y] for y in b], distance + more) == (more >= 0)).all()


def test_short_items_are_all_found(words):
    """Items of 1 to 12 words, exact and with edits of 8 to 10 % of the bytes, inside longer texts."""
    rng, words = random.Random(14), [w for w in words if w.isascii()]
    for share in (0, 0.1):
        items = [(n, " ".join(rng.choice(words) for _ in range(n)).lower().encode()[:126]) for n in range(1, 13) for _ in range(15)]
        texts = []
        for _, item in items:
            passage = bytearray(item)
            for _ in range(int(len(item) * share)):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([b"", b"x", passage[at : at + 1] + b"q"])
            lead = lambda: " ".join(rng.choice(words) for _ in range(30)).lower().encode()
            texts.append(lead() + b" " + bytes(passage) + b" " + lead())
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(items))), pa.array([t.decode() for t in texts])], ["doc_id", "text"])
        listed = [(i, t) for i, (_, t) in enumerate(items)]
        held = SimpleNamespace(value=(Index(Plan.make(0.95, 0.7, 6, 2, 128, 17), listed), ShortIndex(listed, 0.1)))
        got = set()
        for out in _candidates(held, 0.1, 8, 0.5)([batch]):
            got |= {(d, i) for d, i, t in zip(*(c.to_pylist() for c in out.columns)) if least_distance(listed[i][1], t) <= int(len(listed[i][1]) * 0.1)}
        want = {(i, i) for i, t in listed if least_distance(t, texts[i]) <= int(len(t) * 0.1)}
        assert len(want) >= 0.9 * len(listed) and want <= got
        assert {(d, i) for d in range(0, len(texts), 7) for i, t in listed if least_distance(t, texts[d]) <= int(len(t) * 0.1)} <= got


def test_whole_licence_files(spark):
    """Files as they are published: with a title, wrapped, and long ones."""
    by = {n: t for n, t in reversed(KNOWN) if len(t) > 500}
    files = [("MIT", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + next(t for n, t in KNOWN if n == "MIT" and len(t) > 500).replace(" ", "\n", 9)), ("GPL-3.0", by["GPL-3.0"]), ("Apache-2.0", "\n" + by["Apache-2.0"].replace("\n", " \n")),
             ("BSD-2-Clause", by["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")), ("Unlicense", by["Unlicense"])]
    known = spark.createDataFrame(list(KNOWN), "licence string, text string")
    rows = licence_matches(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(files)], "doc_id long, text string"), known).where("line is null").collect()
    assert sorted((r.doc_id, r.licence) for r in rows) == [(i, n) for i, (n, _) in enumerate(files)]
