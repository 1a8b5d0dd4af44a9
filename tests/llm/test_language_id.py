import math
import zlib

import pytest

from lakestrata.llm.language_id import EMBED, FILTERS, WIDTHS, ByteCnn, identified, language_id, windows_of
from tests.llm.conftest import AWKWARD, frame, with_clashes


def test_awkward_rows(awkward):
    got = language_id(awkward).collect()
    assert sorted([(r.doc_id, r.held_out) for r in got], key=str) == sorted(
        [(r[0], zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 4 == 2) for r in AWKWARD], key=str)
    by_id = {r.doc_id: r for r in got}
    for k in (2, 3, 4):  # null, empty, white space
        assert (by_id[k].lang_pred, by_id[k].score) == ("und", 0.0)
    assert all(0 < r.score <= 1 and r.lang_pred in ("en", "fr", "es") for r in got if r.doc_id not in (2, 3, 4))


def test_extra_columns_empty_table_and_no_labels(spark, awkward, nothing):
    assert language_id(with_clashes(awkward)).count() == len(AWKWARD)
    assert language_id(nothing).collect() == []
    assert identified(with_clashes(awkward)).columns == with_clashes(awkward).columns
    alone = language_id(frame(spark, [(1, "words without any label")])).collect()
    assert [(r.lang_pred, r.score) for r in alone] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 0.97 * len(got)


def test_rejected_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    junk = frame(spark, [(10**6, "12 34 !!"), (10**6 + 1, None), (10**6 + 2, "")])
    kept = identified(docs.unionByName(junk))
    assert kept.where("doc_id >= 1000000").count() == 0
    assert kept.count() > 0.97 * docs.count()


def test_windows_cover_the_whole_text():
    data = bytes(range(1, 200)) * 7
    cut = windows_of(data, 64)
    assert cut.tobytes().rstrip(b"\0") == data


def plain_probabilities(net, window):
    """One window through the network, one byte, filter and label at a time."""
    span = max(WIDTHS)
    hidden = []
    for f in range(net.filters.shape[1]):
        best = -math.inf
        for at in range(len(window) - span + 1):
            total = 0.0
            for k in range(WIDTHS[f // FILTERS]):  # a narrow filter has no taps beyond its width
                for e in range(EMBED):
                    total += float(net.embed[window[at + k]][e]) * float(net.filters[k * EMBED + e][f])
            best = max(best, total)
        hidden.append(max(0.0, best + float(net.bias[f])))
    z = [sum(h * float(net.out[f][label]) for f, h in enumerate(hidden)) + float(net.out_bias[label])
         for label in range(len(net.labels))]
    top = max(z)
    return [math.exp(v - top) / sum(math.exp(u - top) for u in z) for v in z]


def test_forward_pass_matches_a_plain_one():
    import numpy as np

    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 256, (3, 24)), rng.integers(97, 123, (2, 24))]).astype(np.uint8)
    x[2, 15:] = 0  # padding
    for net in (ByteCnn(["a", "b", "c"]), ByteCnn(["a", "b", "c"]).train(x, np.array([0, 1, 2, 0, 1]), epochs=3)):
        got = net.probabilities(x, rows=2)
        for row, p in zip(x, got, strict=True):
            assert p.tolist() == pytest.approx(plain_probabilities(net, row.tolist()), abs=1e-4)


def test_a_step_goes_against_the_numerical_slope():
    """Adam's first step moves every parameter by the rate, against the sign of its slope."""
    import numpy as np

    rng = np.random.default_rng(0)
    x, y = rng.integers(1, 255, (8, 32)).astype(np.uint8), rng.integers(0, 3, 8)

    def loss(net):
        return -np.log(net.probabilities(x)[np.arange(8), y].astype(float)).mean()

    before, after = ByteCnn(["a", "b", "c"]), ByteCnn(["a", "b", "c"]).train(x, y, epochs=1, batch=8)
    checked = 0
    for name in ("filters", "bias", "out", "out_bias"):
        table = getattr(before, name)
        for place in list(np.ndindex(table.shape))[::7]:
            if name == "filters" and not before.taps[place]:
                continue  # a narrow filter's missing tap
            kept, step = table[place], 0.01
            table[place] = kept + step
            up = loss(before)
            table[place] = kept - step
            slope = (up - loss(before)) / (2 * step)
            table[place] = kept
            if abs(slope) > 5e-3:
                assert np.sign(kept - getattr(after, name)[place]) == np.sign(slope)
                checked += 1
    assert checked > 30
    longer = ByteCnn(["a", "b", "c"]).train(x, y, epochs=40, batch=8)
    assert loss(longer) < 0.2 * loss(before)
