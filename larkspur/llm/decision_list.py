"""Quality rules: a decision list learned by sequential covering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.quality import FEATURES, Condition, holds
from larkspur.llm.statistics import text_statistics, training_ids
from larkspur.session import materialise


def _covers(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for at, sign, value in rule:
        hit &= x[:, at] <= value if sign == "<=" else x[:, at] > value
    return hit


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], longest: int) -> list[tuple[int, str, float]]:
    """Add the condition with the best information gain over covered rejects until none is gained."""
    rule: list[tuple[int, str, float]] = []
    hit = np.ones(len(x), bool)
    while len(rule) < longest and not y[hit].all():
        rejects, all_ = int(y[hit].sum()), int(hit.sum())
        before = np.log2((rejects + 1) / (all_ + 2))
        best, choice = 1e-9, None
        for at, values in enumerate(cuts):
            if not len(values):
                continue
            # Rows at or below each cut, and the rejects among them, from one pass over the sorted bins.
            bins = np.searchsorted(values, x[hit, at], "left")
            below = np.cumsum(np.bincount(bins, minlength=len(values) + 1))[:-1]
            bad = np.cumsum(np.bincount(bins, weights=y[hit], minlength=len(values) + 1))[:-1]
            for sign, n, p in (("<=", below, bad), (">", all_ - below, rejects - bad)):
                gain = p * (np.log2((p + 1) / (n + 2)) - before)
                k = int(np.argmax(gain))
                if gain[k] > best and n[k] < all_:
                    best, choice = gain[k], (at, sign, float(values[k]))
        if choice is None:
            break
        rule.append(choice)
        hit &= _covers(x, [choice])
    return rule


def _worth(x: np.ndarray, y: np.ndarray, rule: list[tuple[int, str, float]]) -> float:
    hit = _covers(x, rule)
    p, n = int(y[hit].sum()), int(hit.sum())
    return (2 * p - n) / n if n else -1.0


def learn_list(x: np.ndarray, reject: np.ndarray, features: tuple[str, ...] = FEATURES, most_rules: int = 24, longest: int = 4,
               precision: float = 0.8, cuts_each: int = 48, seed: int = 11) -> list[tuple[tuple[Condition, ...], int, int]]:
    """Ordered rejecting rules, each with the rows and the rejects it covered when learned.

    Rows are split anew for every rule, two thirds to grow and one third to
    prune.  Pruning drops final conditions while that does not lower the
    rule's worth on the pruning part.  Learning stops at a rule that is less
    precise than ``precision`` there.  Rows covered by a rule leave.
    """
    random = np.random.default_rng(seed)
    learned = []
    while len(learned) < most_rules and reject.any() and len(x) >= 10:
        grow = random.random(len(x)) < 2 / 3
        cuts = [np.unique(np.quantile(x[grow, at], np.linspace(0, 1, cuts_each), method="lower")) for at in range(x.shape[1])] if grow.any() else []
        bad = x[grow & reject]
        if not len(bad):
            break
        # Rejects are few: their own quantiles give cuts where they lie.
        cuts = [np.unique(np.concatenate([c, np.quantile(bad[:, at], np.linspace(0, 1, cuts_each), method="lower")])) for at, c in enumerate(cuts)]
        rule = _grow(x[grow], reject[grow].astype(float), cuts, longest)
        while len(rule) > 1 and _worth(x[~grow], reject[~grow], rule[:-1]) >= _worth(x[~grow], reject[~grow], rule):
            rule = rule[:-1]
        hit = _covers(x, rule)
        if not rule or _worth(x[~grow], reject[~grow], rule) < 2 * precision - 1 or reject[hit].mean() < precision:
            break
        learned.append((tuple((features[at], sign, value) for at, sign, value in rule), int(hit.sum()), int(reject[hit].sum())))
        x, reject = x[~hit], reject[~hit]
    return learned


def verdict(rules: list[tuple[tuple[Condition, ...], int, int]]):
    """Spark column: number of the first rule that rejects, else null."""
    first = F.lit(None).cast("int")
    for at in reversed(range(len(rules))):
        first = F.when(holds(rules[at][0]), F.lit(at)).otherwise(first)
    return first


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, label: str = "quality") -> DataFrame:
    """Apply the base limits and a learned decision list to every document.

    Returns doc_id, the statistics, ``base_failed``, ``rule`` (the first rule
    that rejects, null for none), ``rule_text`` and ``kept``.  Rules are learned
    from at most ``sample_rows`` labelled rows outside the held-out fold that
    pass the base limits.  Null and empty texts have no words and fail the
    base limits.  Without labels the list is empty and only those limits hold.
    """
    counted = materialise(text_statistics(docs), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    picked = F.broadcast(training_ids(labels, label, sample_rows))  # at most sample_rows rows
    sample = counted.join(picked, "doc_id").where(~failed).select("doc_id", "label", *FEATURES).toPandas().sort_values(["doc_id", *FEATURES])
    rules = learn_list(sample[list(FEATURES)].to_numpy(float), sample["label"].to_numpy() == 0)
    texts = F.array(*(F.lit(" and ".join(f"{n} {s} {v:g}" for n, s, v in r)) for r, _, _ in rules)) if rules else F.array().cast("array<string>")
    judged = counted.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return judged.select("doc_id", *FEATURES, "base_failed", "rule", F.when(F.col("rule").isNotNull(), F.get(texts, F.col("rule"))).alias("rule_text"),
                         (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))
