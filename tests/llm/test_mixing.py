import math
import re
import struct
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lakestrata.llm.mixing import SEED, mix, mixed_documents, source_targets
from tests.llm.conftest import AWKWARD, frame, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop at the cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def plain_key(doc_id, text):
    h = xxh64_intdigest(struct.pack("<i", SEED), 42)
    if doc_id is not None:
        h = xxh64_intdigest(struct.pack("<q", doc_id), h)
    if text is not None:
        h = xxh64_intdigest(text.encode(), h)
    unit = ((h >> 11) + 0.5) / (1 << 53)
    text = text or ""
    chars = len(re.sub(r"[\x20\x09-\x0D]", "", text))
    plain = len(regex.sub(r"[^\p{L}\p{N}]+", "", text))
    return -math.log(unit) / max(0.05, (plain / chars if chars else 0) ** 4)


def plain_mix(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3] if len(r) > 3 else None].append((plain_key(r[0], r[1]), r[0], len(WORD.findall(r[1] or ""))))
    sizes = {s: sum(x[2] for x in g) for s, g in groups.items()}
    targets, out = plain_targets(sizes), []
    for s, g in groups.items():
        epochs = int(targets[s] // sizes[s]) if sizes[s] else 0
        rest, at = targets[s] - epochs * sizes[s], 0
        for _, doc_id, size in sorted(g, key=lambda x: x[0]):
            extra = at + size <= rest or (at < rest and rest - at >= at + size - rest)
            at += size
            out.append((doc_id, size, sizes[s], round(targets[s], 6), size * (epochs + extra) if size else 0))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()], key=str)


def test_awkward_rows(awkward):
    assert result(mix(awkward)) == plain_mix(AWKWARD)


def test_extra_columns_empty_table_and_no_words(spark, awkward, nothing):
    assert result(mix(with_clashes(awkward))) == plain_mix(AWKWARD)
    assert mix(nothing).collect() == []
    assert mixed_documents(with_clashes(awkward)).columns == with_clashes(awkward).columns
    assert result(mix(frame(spark, [(1, None, None, "a"), (2, " ", None, "b")]))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


SIZES = [{"a": 10, "b": 1000, "c": 100}, {"a": 5, None: 7, "b": 0}, {"only": 12}, {"a": 0, "b": 0},
         {f"s{k}": (k * 37) % 101 for k in range(50)}, {"a": 1, "b": 1, "c": 10**9, "é": 3, "Z": 10}]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s, t in want.items():
        assert got[s] == pytest.approx(t, rel=1e-9, abs=1e-9)


def test_documents_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert result(mix(docs)) == plain_mix(rows)
    taken = mix(docs)
    assert taken.where("taken > 3 * size").count() == 0
    copies = {r.doc_id: r["count"] for r in mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in taken.where("copies > 0").collect()}


def test_quality_weight_favours_clean_text(spark):
    clean, dirty = "plain words of a calm text " * 4, "pl*** wo&&& of$$$ a### ca%%% te*** " * 4
    df = frame(spark, [(k, (clean if k % 2 else dirty) + str(k), None, "big") for k in range(400)]
               + [(1000 + k, "w " * 30, None, "small") for k in range(400)])
    drawn = mix(df).where("doc_id < 1000").withColumn("clean", F.col("doc_id") % 2).groupBy("clean") \
        .agg(F.avg("copies").alias("c")).collect()
    share = {r.clean: r.c for r in drawn}
    assert share[1] >= share[0]
