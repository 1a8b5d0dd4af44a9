"""Quality rules as a short-circuit cascade. DataFrame functions only.

A rule is a condition on features of the text that rejects a document. On a bounded sample every rule is
run by itself, which gives its cost (seconds a document) and its selectivity (share rejected); the rules
are then asked in the order of rejections per cost, and the first that rejects ends the row's evaluation.
The order changes what is computed, not the verdict.

Words are runs outside white space. Null text has no words. Texts of any length are read whole; a repeated
five-word window is recognised by a 64-bit hash of its words. Rows that repeat an id are rows of their
own; an empty table gives an empty result; other columns of the input are neither read nor clash.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import SPACE, let, save, words

#: Documents (about) on which costs and selectivities are estimated, and how often each rule is timed.
SAMPLE, TURNS = 2000, 3
SPAN = 5


def repeat_words(tokens: Column, span: int = SPAN) -> Column:
    """Words in windows of ``span`` words that are found twice or more in the array ``tokens``."""
    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.lit(span), F.coalesce(
            F.get(places, k + 1) - p, F.lit(span))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)

    def repeated(ordered: Column) -> Column:
        again = F.filter(ordered, lambda e, j: (e["h"] == F.get(ordered, j - 1)["h"])
                         | (e["h"] == F.get(ordered, j + 1)["h"]))
        return let(F.sort_array(F.transform(again, lambda e: e["at"])), covered)

    def of_windows(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")) \
            .otherwise(let(F.sort_array(placed), repeated))

    def of_words(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - span)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(span)]))
        return F.when(F.size(h) <= span, F.lit(0).cast("long")).otherwise(let(windows, of_windows))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of_words)


def text_features(text: Column, tokens: Column | None = None) -> dict[str, Column]:
    """Features by name, each an expression of the text (and of its words, if they are at hand)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    tokens = words(text) if tokens is None else tokens
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.length(F.array_join(tokens, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(tokens),
        "n_same_words": let(tokens, lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
    }


Rule = Callable[[dict[str, Column]], Column]

#: The rules that make up base_failed in the contract.
BASE: dict[str, Rule] = {
    "few_words": lambda f: f["n_words"] < 10,
    "repeated_passages": lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 20,
}
RULES: dict[str, Rule] = {
    **BASE,
    "symbols": lambda f: f["n_symbols"] * 10 > f["n_words"] * 3,
    "word_length": lambda f: (f["word_chars"] < f["n_words"] * 2) | (f["word_chars"] > f["n_words"] * 15),
    "duplicate_lines": lambda f: (f["n_dup_lines"] >= 3) & (f["n_dup_lines"] * 10 > f["n_lines"] * 3),
    "same_words": lambda f: f["n_same_words"] * 4 > f["n_words"],
    "capitals": lambda f: f["n_capitals"] * 2 > f["n_letters"],
    "few_letters": lambda f: f["n_letters"] * 2 < f["word_chars"],
}


def measure(sample: DataFrame, rules: dict[str, Rule] = RULES) -> dict[str, tuple[float, float]]:
    """Rule -> (seconds a document, share rejected), every rule run by itself on a stored ``sample`` (text).

    Each rule first runs once untimed, so none pays for compilation; then the rules take turns, and a rule's
    cost is the median of its turns less that of a job that only reads the texts.
    """
    jobs = {"": F.sum(F.length("text")), **{n: F.count_if(r(text_features(F.col("text")))) for n, r in rules.items()}}
    n, took, hits = max(1, sample.count()), {name: [] for name in jobs}, {}
    for turn in range(TURNS + 1):
        for name, job in jobs.items():
            began = time.perf_counter()
            hits[name] = sample.agg(job).first()[0]
            if turn:
                took[name].append(time.perf_counter() - began)
    idle = median(took[""])
    return {name: (max(median(took[name]) - idle, 0.0) / n, hits[name] / n) for name in rules}


def cascade_order(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> list[str]:
    """The rules, most rejections per cost first."""
    n = docs.count()
    drawn = save(docs.select("text").sample(min(1.0, sample / max(1, n)), seed=17), "rule-sample")
    cost = measure(drawn, rules)
    return sorted(rules, key=lambda r: (-cost[r][1] / max(cost[r][0], 1e-9), r))


def rejected_by(features: dict[str, Column], order: list[str], rules: dict[str, Rule] = RULES) -> Column:
    """Name of the first rule in ``order`` that rejects, else null; later rules are then not evaluated."""
    verdict = None
    for name in order:
        hit = F.coalesce(rules[name](features), F.lit(False))
        verdict = F.when(hit, name) if verdict is None else verdict.when(hit, name)
    return verdict


def quality_cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, rejected_by (null: kept), kept. Features are made only as asked."""
    order = cascade_order(docs, rules, sample)
    verdict = rejected_by(text_features(F.col("text")), order, rules)
    return docs.select("doc_id", verdict.alias("rejected_by")) \
        .withColumn("kept", F.col("rejected_by").isNull())


def quality_table(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The cascade's verdict beside the counts that its rules rest on, for every row of ``docs``."""
    order = cascade_order(docs, rules, sample)
    given = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    split = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("__words", words(F.col("text")))
    made = text_features(F.col("text"), F.col("__words"))
    counted = split.select("doc_id", "text", *[made[c].alias(c) for c in given])
    features = {**text_features(F.col("text")), **{c: F.col(c) for c in given}}
    base_failed = F.lit(False)
    for rule in BASE.values():
        base_failed = base_failed | rule(features)
    rest = [r for r in order if r not in BASE]
    return counted.withColumn("base_failed", base_failed).select(
        "doc_id", *given, "base_failed",
        (~F.col("base_failed") & rejected_by(features, rest, rules).isNull()).alias("kept"))
