import zlib

import numpy as np
from pyspark.sql import functions as F

from lakestrata.llm.quality_model import DIMS, _neighbour_sums, index_vectors, quality_scores, shape, word_vectors
from tests.llm.conftest import AWKWARD, frame, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (7, 0, 1), (7, 1, 1), (99, 1, 0)],
                                   LABELS)
    for docs in (awkward, with_clashes(awkward)):
        got = quality_scores(docs, labels).collect()
        assert sorted([(r.doc_id, r.held_out) for r in got], key=str) == sorted(
            [(r[0], zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 5 == 0) for r in AWKWARD], key=str)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        empties = {r.score for r in got if r.doc_id in (2, 3, 4)}
        assert len(empties) == 1
    assert quality_scores(nothing, labels).collect() == []
    none = quality_scores(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_held_out_documents_and_labels_not_used(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    held = [r for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r.quality for r in held)
    assert right >= 0.95 * len(held)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_scores(docs, flipped).collect()}
    assert all(abs(again[k] - r.score) < 1e-9 for k, r in got.items())


def test_vectors_equal_brute_force(spark):
    texts = ["a b c a b", "", "c", "B b!! 12 b"]
    index, slot = index_vectors(), lambda w: zlib.crc32(w) % len(index_vectors())
    want, n = {}, {}
    for t in texts:
        w = t.encode().split()
        for i, x in enumerate(w):
            v = sum((index[slot(y)] + index[zlib.crc32(shape(y), 77) % len(index)]
                     for j, y in enumerate(w) if j != i and abs(i - j) <= 2), np.zeros(DIMS, int))
            want[slot(x)] = want.get(slot(x), 0) + v
            n[slot(x)] = n.get(slot(x), 0) + 1
    table = word_vectors(frame(spark, list(enumerate(texts))).repartition(3))
    total = sum(n.values())
    for s, v in want.items():
        length = max(1e-9, np.sqrt((v * v).sum()))
        assert np.allclose(table[s], v / length * (1e-3 / (1e-3 + n[s] / total)) ** 0.5, atol=1e-5)
    assert np.count_nonzero(np.abs(table).sum(axis=1)) <= len(want)


def test_shapes_and_neighbours():
    assert shape("Abc-12!!".encode()) == b"Aa-0!"
    assert shape("ÉTé***".encode()) == b"aAa*"
    v = np.arange(5)[:, None]
    assert _neighbour_sums(v)[:, 0].tolist() == [1 + 2, 0 + 2 + 3, 0 + 1 + 3 + 4, 1 + 2 + 4, 2 + 3]
