import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakestrata.llm.packing import WordIds, best_configuration, pack, packing_plan, token_bytes, tokenizer_path
from tests.llm.conftest import AWKWARD, frame, with_clashes

ODD = ["á ́b x y it's 'S <|endoftext|> q\x1cr Σας ΑΣ 10\x85 3½ é", "", "  \n\t ", "don't!!!  12a 日本 語",
       "a b c 　d", "\U0001f600" * 50, "x" * 30_000]


def plain_ids(text, tokenizer):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, result, length=4096):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows:
        ids = plain_ids(r[1], tokenizer)
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at:at + length]
            want[r[0], k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = result.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    return len(places)


def test_awkward_rows(awkward, nothing):
    check(AWKWARD, pack(awkward))
    check(AWKWARD, pack(with_clashes(awkward)))
    assert pack(nothing).collect() == []


def test_short_sequences_cut_long_documents(spark, awkward):
    check(AWKWARD, pack(awkward, length=64), length=64)


def test_word_ids_equal_the_whole_text(spark):
    tokenizer, ids = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path())
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert token_bytes(text.encode(), ids) == np.array(plain_ids(text, tokenizer), "<u4").tobytes()


def best_fit(histogram, capacity):
    import bisect

    rooms, count = [], 0
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            k = bisect.bisect_left(rooms, n)
            if k == len(rooms):
                count, room = count + 1, capacity
            else:
                room = rooms.pop(k)
            if room > n:
                bisect.insort(rooms, room - n)
    return count


HISTOGRAMS = [Counter({1500: 1000, 1300: 500, 700: 3000, 10: 50}), Counter({2048: 7, 1366: 10, 4096: 3, 5: 1}),
              Counter({1: 1}), Counter({1: 100_000}), Counter({n: 1 for n in range(1, 4097)}), Counter({4096: 5}),
              Counter({1800: 10_000, 900: 10_001, 390: 30_000}), Counter({2049: 999, 2047: 999}), Counter()]


@pytest.mark.parametrize("histogram", HISTOGRAMS)
def test_plan_is_valid_and_near_best_fit(histogram):
    runs, sequences = packing_plan(dict(histogram), rounds=300)
    filled = defaultdict(list)
    for n, table in runs.items():
        at = 0
        for first, after, sequence, each, offset in table:
            assert first == at < after
            at = after
            for j in range(after - first):
                filled[sequence + j // each].append((offset + j % each * n, n))
        assert at == histogram[n]
    assert set(runs) == set(histogram) and set(filled) == set(range(sequences))
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 4096
    least = -(-sum(n * m for n, m in histogram.items()) // 4096)
    assert least <= sequences <= max(least + 1, best_fit(histogram, 4096) * 1.005 + 1)


@pytest.mark.parametrize("times, most_left", [(1, 0.4), (600, 0.15)])
def test_configurations_place_most_pieces_of_real_lengths(times, most_left):
    import pyarrow.parquet as pq

    ids = WordIds(tokenizer_path())
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    sizes = Counter()
    for text in texts:
        n = len(token_bytes((text or "").encode(), ids)) // 4
        sizes.update([4096] * (n // 4096) + [n % 4096] * (n % 4096 > 0))
    histogram = {n: m * times for n, m in sizes.items()}
    left = {}
    _, sequences = packing_plan(histogram, best_fit=left)
    whole = sum(histogram.values()) - histogram.get(4096, 0)
    assert sum(left.values()) < most_left * whole
    assert sequences <= -(-sum(n * m for n, m in histogram.items()) // 4096) * 1.005 + 1


def test_knapsack_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(1, 30), 6, replace=False))
        values = rng.random(6)
        taken = best_configuration(values, sizes, 60)
        best = [0.0] * 61
        for room in range(1, 61):
            best[room] = max([best[room - 1]] + [best[room - s] + v for s, v in zip(sizes, values, strict=True) if s <= room])
        assert sum(sizes[j] * k for j, k in taken.items()) <= 60
        assert sum(values[j] * k for j, k in taken.items()) == pytest.approx(best[60])


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    used = check(rows, pack(docs))
    tokens = sum(len(plain_ids(t, Tokenizer.from_file(tokenizer_path()))) for _, t in rows)
    assert used <= -(-tokens // 4096) + 1
