import re

import pytest

from lakestrata.llm.license_scan import (
    COMMON, TEMPLATES, license_scan, size_bounds, telling_words, template_bigrams,
)
from tests.llm.conftest import AWKWARD, PROSE, frame, with_clashes

WORDING = {t[0]: t[2] for t in TEMPLATES}


def test_awkward_rows_and_empty_table(awkward, nothing):
    got = license_scan(with_clashes(awkward)).collect()
    assert len(got) == len(AWKWARD)
    assert all((r.license, r.dice, r.n_matches, r.licenses) == (None, 0.0, 0, "") for r in got)
    assert license_scan(nothing).collect() == []


def test_every_template_is_found_in_prose(spark):
    rows = [(k, f"{PROSE}\n{t[2].upper()}\n{PROSE}") for k, t in enumerate(TEMPLATES)]
    got = {r.doc_id: r for r in license_scan(frame(spark, rows)).collect()}
    for k, (name, license_id, _) in enumerate(TEMPLATES):
        assert (got[k].template, got[k].license, got[k].dice) == (name, license_id, 1.0)


def test_wrapped_and_changed_text(spark):
    wrapped = re.sub(r"((?:\S+ ){9})", r"\1\n", WORDING["mit-warranty"])
    near = WORDING["gpl-warranty"].replace("useful", "helpful")
    far = " ".join(WORDING["gpl-warranty"].split()[::2])
    rows = [(1, f"{PROSE}\n\n{wrapped}\n\n{PROSE}"), (2, near), (3, far), (4, "All rights reserved"),
            (5, "some rights reserved"), (6, f"{WORDING['mit-notice']}\n{WORDING['apache-short']}")]
    got = {r.doc_id: r for r in license_scan(frame(spark, rows)).collect()}
    assert got[1].license == "MIT" and got[1].dice == 1.0
    assert got[2].license == "GPL-3.0" and 0.8 <= got[2].dice < 1
    assert got[3].license is None
    assert got[4].license == "proprietary" and got[5].license is None
    assert got[6].licenses == "Apache-2.0,MIT" and got[6].n_matches >= 2


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_brute_force_over_every_line(spark, threshold):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    for r in docs.collect():
        gap = r"\n(?:[^\w\n]*\n)+"
        sentences = re.sub(r"([.!?])[\x20\x09-\x0D]+", r"\1\n\n", r.text)
        units = {*r.text.split("\n"), *re.split(gap, r.text), *re.split(gap, sentences), r.text}
        hits = []
        for u in units:
            w = [x for x in re.split(r"[\W_]+", u.lower()) if x]
            grams = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
            hits += [(-d, t[0]) for t in TEMPLATES if (d := dice(grams, set(template_bigrams(t[2])))) >= threshold]
        want[r.doc_id] = (len(hits), min(hits) if hits else None)
    got = license_scan(docs, threshold).collect()
    assert {r.doc_id: (r.n_matches, (-r.dice, r.template) if r.template else None) for r in got} == want
    assert any(h for _, h in want.values())


def test_bounds_are_sound():
    for size in range(1, 80):
        low, high = size_bounds(size)
        for a in range(1, 200):
            if 2 * min(a, size) / (a + size) >= 0.8:
                assert low <= a <= high


@pytest.mark.parametrize("text, license_id", [
    ("This project was written by Jane Doe in 2019. Released under the MIT License. See the site for more.", "MIT"),
    ("Posted on our blog yesterday. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Copyright (c) 2020 Acme Inc. All rights reserved.", "proprietary"),
    (" ".join(WORDING[n] for n in ("mit-grant", "mit-notice", "mit-warranty")), "MIT"),
    ("\n".join(f"# {line}" for line in [*re.findall(r"(?:\S+ ?){1,9}", WORDING["gpl3-notice"]), "",
                                       *re.findall(r"(?:\S+ ?){1,9}", WORDING["gpl-warranty"]), "",
                                       *re.findall(r"(?:\S+ ?){1,9}", WORDING["gpl-copy"])]), "GPL-3.0"),
    ("/*\n" + "\n".join(f" * {line}" for line in re.findall(r"(?:\S+ ?){1,9}", WORDING["lgpl-notice"])) + "\n */", "LGPL-2.1"),
    (WORDING["agpl3-notice"], "AGPL-3.0"), (WORDING["gpl2-notice"], "GPL-2.0"), (WORDING["cc-by-sa-notice"], "CC-BY-SA-4.0"),
    (WORDING["bsd3-name"], "BSD-3-Clause")])
def test_licences_as_they_are_written(spark, text, license_id):
    rows = [(1, f"{PROSE}. {text} {PROSE}."), (2, text), (3, f"{PROSE}\n\n{text}\n\n{PROSE}")]
    got = {r.doc_id: r for r in license_scan(frame(spark, rows)).collect()}
    assert got[2].license == license_id == got[3].license
    if text[0].isalpha():
        assert license_id in got[1].licenses.split(",") or len(text) > 300


def test_telling_words_lose_no_match():
    import random
    rng = random.Random(2)
    for threshold in (0.5, 0.8):
        words = set(telling_words(TEMPLATES, threshold))
        for _, _, wording in TEMPLATES:
            grams = template_bigrams(wording)
            tokens = re.sub(r"[^a-z0-9]+", " ", wording.lower()).split()
            without = [t for t in tokens if t not in words]  # the most a text without these words can share
            assert dice({f"{a} {b}" for a, b in zip(without, without[1:])}, set(grams)) < threshold
            for _ in range(200):
                cut = [t for t in tokens if rng.random() > 0.15]
                if dice({f"{a} {b}" for a, b in zip(cut, cut[1:])}, set(grams)) >= threshold:
                    assert words & set(cut)
    assert not set(telling_words(TEMPLATES)) & COMMON
