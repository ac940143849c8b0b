"""Statistics by hand, models by held-out accuracy."""

import re
from collections import Counter

import numpy as np
from conftest import FOLDER

from larkspur.llm.decision_list import learn_list, quality_rules
from larkspur.llm.quality import good_documents, quality_scores
from larkspur.llm.statistics import text_statistics
from larkspur.llm.toxicity import toxicity_scores

BIG = FOLDER.replace("sf0.001", "sf0.1")


def plain_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def test_counts(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()] + [(r.doc_id, r.text) for r in odd.collect()]
    got = text_statistics(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert got == Counter((i, *plain_counts(t)) for i, t in rows)
    assert text_statistics(none).count() == 0


def held(df, labels, column):
    return df.where("held_out").join(labels.where(f"{column} is not null"), "doc_id").select(column, "predicted", "score").toPandas()


def test_models_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    q = held(quality_scores(docs, labels), labels, "quality")
    assert (q.quality == q.predicted).mean() > 0.97 and q.score.between(0, 1).all()
    t = held(toxicity_scores(docs, labels), labels, "toxic")
    assert t[t.toxic == 0].predicted.mean() < 0.02 and t[t.toxic == 1].predicted.mean() > 0.75
    r = quality_rules(docs, labels).where("not base_failed and crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").join(labels, "doc_id").select("quality", "kept").toPandas()
    assert (r.quality.astype(bool) == r.kept).mean() > 0.97


def test_decision_list_finds_planted_rules():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    reject = (x[:, 0] > 0.9) | ((x[:, 1] <= 0.2) & (x[:, 2] > 0.5))
    rules = learn_list(x, reject, ("a", "b", "c"))
    hit = np.zeros(len(x), bool)
    for rule, _, _ in rules:
        now = np.ones(len(x), bool)
        for name, sign, value in rule:
            column = x[:, "abc".index(name)]
            now &= column <= value if sign == "<=" else column > value
        hit |= now
    assert (hit == reject).mean() > 0.97 and learn_list(x[:5], reject[:5], ("a", "b", "c")) == []


def test_offending_sentence_is_located(spark, words):
    plain = [" ".join(words[(7 * d + k) % 600] for k in range(12)) for d in range(400)]
    rows = [(d, f"{plain[d]}. Then came {'badword' if d % 4 == 0 else 'good'} {words[d]}. {plain[d - 1]}") for d in range(400)]
    labels = spark.createDataFrame([(d, int(d % 4 == 0)) for d in range(400)], "doc_id long, toxic int")
    got = toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got)
    assert all(len(r.offending) == 1 and "badword" in r.offending[0] for r in got if r.doc_id % 4 == 0)


def test_odd_rows(odd, none, no_labels, some_labels):
    n = odd.count()
    for labels in (no_labels, some_labels):
        for scores in (quality_scores, toxicity_scores):
            rows = scores(odd, labels).collect()
            assert len(rows) == n and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
            assert scores(none, labels).count() == 0
        rules = quality_rules(odd, labels).collect()
        assert len(rules) == n and all(r.base_failed and not r.kept for r in rules if not r.n_words)
        assert quality_rules(none, labels).count() == 0
        assert set(good_documents(odd, labels).columns) == set(odd.columns) and good_documents(none, labels).count() == 0
