import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakestrata.llm.source_divergence import count_terms, radix_order, source_divergence, term_counts
from tests.llm.conftest import AWKWARD, frame, with_clashes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain_audit(rows, least_docs=10, top=10):
    """The contract, counted and compared one pair and one term at a time."""
    occurs, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        text, lang, source = r[1], (r[2] if len(r) > 2 else None) or "", (r[3] if len(r) > 3 else None) or ""
        groups[lang].add(source)
        occurs[lang, source].update(plain_terms(text))
        docs[lang].update(set(plain_terms(text)))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        all_of = sum((occurs[lang, s] for s in sources), Counter())

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1000000000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        of_lang, of_source = shares(all_of), {s: shares(occurs[lang, s]) for s in sources}
        for s in sources:
            p = of_source[s]
            pairs = [(sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), o)
                     for o, q in of_source.items() if o != s]
            terms = [((p[t] - of_lang[t]) ** 2 // (p[t] + of_lang[t]), t) for t in kept
                     if occurs[lang, s][t] and p[t] > of_lang[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(order, 1)}
    return out


def result(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def prose(seed, n=240, sources=7):
    rng = random.Random(seed)
    words = ["a", "Zz", "éa", "ünïcödé", "日本語テキスト", "eightbyt", "ninebytes", "sixteenbyteslong", "seventeenbyteslon",
             "a" * 40, "b" * 33, "c" * 700] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    return [(k, " ".join(rng.choices(words, k=rng.choice([0, 3, 30]))) + rng.choice([".", "!9", " x\x00y"]),
             rng.choice(["en", "de", None, ""]), rng.choice([None, *[f"s{j}" for j in range(sources)]]))
            for k in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"tile": 2, "block_rows": 40, "block_bytes": 300}, {"top": 2, "least_docs": 1}])
def test_same_as_plain(spark, sizes):
    rows = prose(1) + [(1000 + k, f"lonely{k}", "xx", f"s{k % 3}") for k in range(5)] + [(1, None, "yy", "alone")]
    want = plain_audit(rows, sizes.get("least_docs", 10), sizes.get("top", 10))
    assert result(source_divergence(frame(spark, rows), **sizes)) == want
    assert any(part == "pair" and value == 0 for _, _, part, _, value, _ in want)


def test_awkward_clashes_and_nothing(spark, awkward, nothing):
    want = plain_audit(AWKWARD, 1)
    assert result(source_divergence(with_clashes(awkward), least_docs=1)) == want
    assert source_divergence(nothing).collect() == []


def test_ties_go_by_utf8(spark):
    rows = [(k, "zeta Ünder alpha", "en", "a") for k in range(10)] + [(99, "other", "en", "b")]
    got = result(source_divergence(frame(spark, rows)))
    assert got == plain_audit(rows)


def test_very_long_text_counts_one_document(spark):
    text = " ".join(f"{chr(97 + k % 7)}{chr(97 + k % 11)}" for k in range(50_000)) + " " + "ß" * 300_000
    got = {r.term: (r.n, r.docs) for r in term_counts(frame(spark, [(1, text, "en", "a")]), 4096).collect()}
    assert got == {t: (n, 1) for t, n in Counter(plain_terms(text)).items()}


def test_radix_order_is_stable_and_whole():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 4, 5000, dtype=np.uint64) << np.uint64(s) for s in (48, 3)]
    words[1] |= rng.integers(0, 2**63, 5000, dtype=np.uint64) * (rng.random(5000) < 0.5)
    assert radix_order(words).tolist() == sorted(range(5000), key=lambda k: (int(words[0][k]), int(words[1][k]), k))


def test_count_terms_by_bucket():
    texts = [b"Ab ab " + b"x" * 9 + b" " + b"y" * 17, b"", b"ab " + b"x" * 9 + b"." + b"x" * 9]
    got = set()
    for rows, group, n, docs in count_terms(texts, [0, 1, 1]):
        got |= {(bytes(r).rstrip(b"\0"), int(g), int(k), int(d)) for r, g, k, d in zip(rows, group, n, docs, strict=True)}
    assert got == {(b"ab", 0, 2, 1), (b"x" * 9, 0, 1, 1), (b"y" * 17, 0, 1, 1), (b"ab", 1, 1, 1), (b"x" * 9, 1, 2, 1)}
