import random

import pytest
from xxhash import xxh64_intdigest

from lakestrata.llm.simhash import covering_masks, drop_near_copies, fingerprint, links, simhash_components
from tests.llm.conftest import AWKWARD, PROSE, frame, with_clashes


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, radius):
    """Least reachable node per node, by comparing all pairs."""
    nodes = sorted(set(nodes))
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def check(rows, result):
    prints = [plain_fingerprint(r[1]) for r in rows]
    comp = plain_components(prints, 2)
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[comp[p]] = min(r[0], least.get(comp[p], r[0]))
    got = result.collect()
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=str) == sorted(
        [(r[0], p, least.get(comp[p])) for r, p in zip(rows, prints, strict=True)], key=str)
    assert sum(r.kept for r in got) == len(set(comp.values()))


def test_awkward_rows(awkward):
    check(AWKWARD, simhash_components(awkward))


def test_extra_columns_and_empty_table(awkward, nothing):
    check(AWKWARD, simhash_components(with_clashes(awkward)))
    assert simhash_components(nothing).collect() == []
    assert drop_near_copies(with_clashes(awkward)).columns == with_clashes(awkward).columns


@pytest.mark.parametrize("pairwise", [48, 0])
def test_near_copies_match_all_pairs(spark, pairwise):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(500)]
    rows = []
    for k in range(30):
        words = rng.choices(vocabulary, k=400)
        for j in range(6):
            copy = list(words)
            for _ in range(j):
                copy[rng.randrange(400)] = rng.choice(vocabulary)
            rows.append((k * 10 + j, " ".join(copy)))
    check(rows, simhash_components(frame(spark, rows), pairwise=pairwise))


@pytest.mark.parametrize("pairwise", [48, 3, 0])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_lose_nothing(spark, radius, pairwise):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(5)]
    prints = {0, (1 << 64) - 1, *base}
    for b in base:
        for _ in range(40):
            prints.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.choice([1, 2, 3, 5]))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in
             links(spark.createDataFrame(signed, "fp long"), radius, pairwise).collect()]
    want = plain_components(prints, radius)
    parent = {p: p for p in prints}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        assert (a ^ b).bit_count() <= radius
        parent[root(a)] = root(b)
    got = {}
    for p in prints:
        got.setdefault(root(p), set()).add(p)
    classes = {}
    for p, c in want.items():
        classes.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


def test_masks_cover_every_difference():
    for radius in (1, 2, 3):
        masks = covering_masks(radius)
        rng = random.Random(3)
        for _ in range(2000):
            difference = sum(1 << i for i in rng.sample(range(64), radius))
            assert any(difference & m == 0 for m in masks)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"{PROSE} {k}" for k in range(300))
    whole = plain_fingerprint(text)
    import lakestrata.llm.common as common

    monkeypatch.setattr(common.word_blocks, "__defaults__", (100,))
    assert fingerprint(text.encode()) == whole
