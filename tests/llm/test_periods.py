"""Runs of words against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import FOLDER

from larkspur.llm import queries
from larkspur.llm.periods import Factors, find_runs, periodic_runs, repeated_words


def plain_runs(s, exponent=4, shortest=6):
    out = []
    for q in range(1, len(s) // exponent + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            run = s[i : j + q]
            if j > i and len(run) >= max(shortest, exponent * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, letters):
    out = []
    for _ in range(rng.randrange(5)):
        out += [rng.randrange(letters) for _ in range(rng.randrange(1, 10))] * rng.randrange(1, 8)
        out += [rng.randrange(letters) for _ in range(rng.randrange(4))]
    return out


def test_runs_equal_plain_search():
    rng = random.Random(1)
    for _ in range(600):
        texts = [periodic(rng, rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 4))]
        want, base = [], 0
        for t in texts:
            want += [(i + base, n, q) for i, n, q in plain_runs(t)]
            base += len(t)
        got = find_runs(np.array(sum(texts, []), np.int64), np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        assert list(zip(*(v.tolist() for v in got))) == want
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), np.zeros(9, np.int64), exponent=3)


def test_factors_name_equal_stretches_only():
    rng = random.Random(2)
    s = periodic(rng, 3) + periodic(rng, 2) + [0, 1] * 9
    factors = Factors(np.array(s, np.int64), np.zeros(len(s), np.int64))
    for k, names in enumerate(factors.levels):
        pieces = [tuple(s[i : i + (1 << k)]) if i + (1 << k) <= len(s) else None for i in range(len(s))]
        for i, p in enumerate(pieces):
            again = [j for j in range(len(s)) if p is not None and pieces[j] == p]
            assert (names[i] >= 0) == (len(again) > 1)
            assert all(names[j] == names[i] for j in again) and (len(again) < 2 or {names[j] for j in range(len(s)) if j not in again} & {names[i]} == set())
            assert factors.next[k][i] == min((j for j in again if j > i and len(again) > 1), default=-1)


def plain_row(doc_id, text, plant=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if plant and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    lost = {i for s, m, q in runs for i in range(s + q, s + m)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in lost)


def test_rows_of_tables(spark):
    # plain search of every text is slow, so the SQL twin covers all; here the short texts
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op13_factor_runs(spark, FOLDER).collect()}
    assert rows.keys() == texts.keys()
    seen = 0
    for i, text in texts.items():
        if len(text) > 6000:
            continue
        runs, kept = plain_row(i, text)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if not runs else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5


def test_odd_rows(spark, odd, none):
    rng = random.Random(5)
    extra = [(50, "la " * 4), (51, "la " * 6), (52, "é ü " * 40 + "é"), (53, "\n".join(["same line here"] * 9)), (54, "x " * 70_000), (55, " ".join(rng.choice("ab") for _ in range(3000)))]
    df = odd.select("doc_id", "text", "key").unionByName(spark.createDataFrame([(*r, "k") for r in extra], "doc_id long, text string, key string")).withColumnRenamed("key", "runs")
    for words in (200_000, 50):
        got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df, slice_words=words).collect()), key=repr)
        want = sorted(((r.doc_id, *plain_row(r.doc_id, r.text, plant=False)) for r in df.collect() if r.doc_id not in (7, 54)), key=repr)
        assert [g for g in got if g[0] not in (7, 54)] == want
        assert [g for g in got if g[0] == 54] == [(54, [(0, 70_000, 1)], "x")]
    assert periodic_runs(none).count() == 0
    assert repeated_words([b"a", b"b"], 7) == [b"a", b"b"] and repeated_words([], 10) == []
