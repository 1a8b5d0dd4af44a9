import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import quality_rules
from lakestrata.llm.common import words
from lakestrata.llm.quality_rules import RULES, quality_cascade, quality_table, rejected_by, repeat_words, text_features
from tests.llm.conftest import AWKWARD, PROSE, frame, with_clashes


def plain(text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


TEXTS = ["a b c d e", "a b c d e a b c d e", "a b c d e f a b c d e", "a a a a a a", "a a a a a", "a b " * 40,
         "x y z\nx y z\n\nx y z\n \nx y z\nq", "A*B #c $d %e &f |g <h >i", PROSE + " " + PROSE + " end " + PROSE,
         PROSE.upper() * 2, "word " * 3000 + "1 2 3 4 5 6", "\n\n\n"]
ROWS = AWKWARD + [(100 + k, t) for k, t in enumerate(TEXTS)]


def test_counts_match_brute_force(spark):
    got = quality_table(with_clashes(frame(spark, ROWS))).collect()
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got], key=str) == sorted([(r[0], *plain(r[1])) for r in ROWS], key=str)
    assert not any(r.kept and r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} >= {5}
    assert 111 not in {r.doc_id for r in got if r.kept}


def test_empty_table(nothing):
    assert quality_table(nothing).collect() == []
    assert quality_cascade(nothing).collect() == []


def test_verdict_does_not_depend_on_the_order(spark):
    df = frame(spark, ROWS)
    f = text_features(F.col("text"))
    some = list(itertools.islice(itertools.permutations(RULES), 0, 5040, 1200))
    verdicts = [rejected_by(f, list(o)).isNull().alias(f"v{k}") for k, o in enumerate(some)]
    assert all(len(set(r)) == 1 for r in df.select(*verdicts).collect())
    assert sorted((r.doc_id is None, r.doc_id, r.kept) for r in quality_cascade(df).where("doc_id >= 100").collect()) \
        == sorted((False, r.doc_id, r.kept) for r in quality_table(df).where("doc_id >= 100").collect())


def test_order_is_rejections_per_cost(spark, monkeypatch):
    cost = {"few_words": (1.0, 0.1), "symbols": (2.0, 0.6), "capitals": (0.1, 0.0)}
    monkeypatch.setattr(quality_rules, "measure", lambda sample, rules: cost)
    order = quality_rules.cascade_order(frame(spark, ROWS), {k: RULES[k] for k in cost})
    assert order == ["symbols", "few_words", "capitals"]


def test_measured_costs_and_shares(spark):
    sample = frame(spark, [(k, PROSE * (30 if k % 4 else 0)) for k in range(2000)]).persist()
    rules = {"dear": lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 20, "cheap": lambda f: F.col("text") == "",
             "dear again": lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 20}
    cost = quality_rules.measure(sample, rules)
    assert {n: c[1] for n, c in cost.items()} == {"dear": 0.75, "cheap": 0.25, "dear again": 0.75}
    assert cost["cheap"][0] < 0.3 * cost["dear"][0]  # without the job itself, nor the first rule's warm-up
    assert 0.5 < cost["dear"][0] / cost["dear again"][0] < 2
    sample.unpersist()
    assert quality_rules.measure(frame(spark, []), rules)["dear"][1] == 0


@pytest.mark.parametrize("n", [4, 5, 6, 60])
def test_repeats_of_a_period(spark, n):
    texts = [" ".join(str(i % p) for i in range(n)) for p in range(1, 12)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        repeat_words(words(F.col("t"))).alias("n"), "t").collect()
    assert {r.t: r.n for r in got} == {t: plain(t)[4] for t in texts}


def test_clean_labels_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_table(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where("not base_failed")
    rows = got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.98 and kept[0] < 0.2
