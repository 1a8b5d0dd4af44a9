import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.exact_dedup import chunks, drop_copies, exact_dedup
from tests.llm.conftest import AWKWARD, PROSE, frame, with_clashes

SPACE = re.compile(r"[\x20\x09-\x0D]")


def norm(text):
    return SPACE.sub("", text or "")


def brute(rows):
    """doc_id, keep_id, group size, sha per row, sorted."""
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[norm(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0, k))
    out = []
    for r in rows:
        best = min(groups[norm(r[1])])
        out.append((r[0], rows[best[3]][0], len(groups[norm(r[1])]),
                    hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


def check(rows, result):
    got = result.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({norm(r[1]) for r in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_awkward_rows(spark, awkward):
    check(AWKWARD, exact_dedup(awkward))


def test_extra_columns_with_clashing_names(spark, awkward):
    check(AWKWARD, exact_dedup(with_clashes(awkward)))
    assert drop_copies(with_clashes(awkward)).columns == with_clashes(awkward).columns


def test_empty_table(nothing):
    assert exact_dedup(nothing).collect() == []


LONG = " ".join(f"{PROSE} {k * 7919 % 1009}" for k in range(60))
FAMILY = [(10, LONG), (11, LONG.replace(" ", "\n")), (12, LONG + "."), (13, "x" + LONG), (14, LONG[:3000]),
          (15, LONG.replace(" ", "  ")), (16, LONG[:-1]), (17, "y" * 9000), (18, "y" * 9000), (19, "y" * 8999)]


def test_long_texts_and_near_misses(spark):
    check(FAMILY, exact_dedup(frame(spark, FAMILY)))


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_a_hash_that_stands_for_several_chunks(spark, bits):
    rows = FAMILY + AWKWARD
    check(rows, exact_dedup(frame(spark, rows), hash_bits=bits, least=16, most=64))


def test_chunks_are_the_whole_text_and_resynchronise(spark):
    a, b = norm(LONG), "inserted" + norm(LONG)
    got = [r.c for r in spark.createDataFrame([(a,), (b,)], "t string").select(
        chunks(F.col("t"), 64, 512).alias("c")).collect()]
    assert ["".join(c) for c in got] == [a, b]
    assert len(set(got[0]) & set(got[1])) > 0.7 * len(got[0])
    assert max(map(len, got[0])) <= 512
