import datetime
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm.pseudonyms import KINDS, Feistel, Pseudonyms, luhn_digit, pseudonymise
from tests.llm.conftest import AWKWARD, frame, with_clashes

KEY = b"test key"
VALUES = {"card": "4111 1111 1111 1111", "phone": "+1 (415) 555-0132", "ssn": "123-45-6789", "ip": "192.168.0.77",
          "date": "2024-02-29", "email": "Jane.Doe-7@mail.example.com",
          "iban": "DE89 3704 0044 0532 0130 00", "secret": "0aadf1133b9e4c5d6e7f8091a2b3c4d5e6f70812"}
INVALID = ["4111 1111 1111 1112", "000-12-3456", "666-12-3456", "999.1.1.1", "1.2.3", "2023-02-29", "13/13/2020",
           "2024-00-10", "version 1.2.3.4.5", "1234567890123", "31.02.2020", "32/01/1999", "1700000000", "DE88 3704 0044 0532 0130 00", "std::dec",
           "_@x.com", "12:30:45", "no digits at all"]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 1024])
def test_feistel_is_a_permutation(size):
    f = Feistel(KEY, "x", size)
    image = [f.permute(x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert [f.permute(y, inverse=True) for y in image] == list(range(size))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 10**19), st.data())
def test_feistel_inverts_on_large_ranges(size, data):
    x = data.draw(st.integers(0, size - 1))
    f = Feistel(KEY, "y", size)
    assert 0 <= f.permute(x) < size and f.permute(f.permute(x), inverse=True) == x


@pytest.mark.parametrize("kind", KINDS)
def test_formats(kind):
    value = VALUES[kind]
    new, found = Pseudonyms(KEY).text(f"before {value} after")
    assert found == {k: int(k == kind) for k in KINDS}
    new = new.removeprefix("before ").removesuffix(" after")
    assert new != value
    if kind not in ("ip",):
        digits = re.sub(r"\d", "0", value) if kind != "secret" else re.sub(r"[0-9a-f]", "0", value)
        assert (re.sub(r"\d", "0", new) if kind not in ("secret", "email") else digits) == digits
    if kind == "card":
        d = new.replace(" ", "")
        assert luhn_digit(d[:-1]) == d[-1]
    if kind == "date":
        datetime.date.fromisoformat(new)
    if kind == "ip":
        assert all(0 <= int(p) <= 255 for p in new.split("."))
    if kind == "email":
        assert new.endswith("@mail.example.com") and len(new) == len(value)
    assert Pseudonyms(KEY, inverse=True).text(f"before {new} after")[0] == f"before {value} after"
    assert Pseudonyms(KEY).text(f"other {value}!")[0] == f"other {new}!"  # equal values stay linked
    assert Pseudonyms(b"another").text(f"other {value}!")[0] != f"other {new}!"


@pytest.mark.parametrize("text", INVALID)
def test_invalid_values_are_left(text):
    assert Pseudonyms(KEY).text(f"a {text} b") == (f"a {text} b", dict.fromkeys(KINDS, 0))


@pytest.mark.parametrize("value", ["01/31/1999", "31/01/1999", "2099-12-31", "1900/01/01", "12-31-2020", "31.01.1999",
                                   "25-12-2021", "05.06.2007"])
def test_date_layouts(value):
    new, found = Pseudonyms(KEY).text(value)
    assert found["date"] == 1 and new != value
    assert Pseudonyms(KEY, inverse=True).text(new)[0] == value


def test_awkward_rows(awkward, nothing):
    got = pseudonymise(with_clashes(awkward), KEY).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == sorted([(r[0], r[1]) for r in AWKWARD], key=str)
    assert pseudonymise(nothing, KEY).collect() == []


def test_round_trip_over_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    done = pseudonymise(docs, KEY)
    first = {r.doc_id: r for r in done.collect()}
    back = {r.doc_id: r.text for r in pseudonymise(done, KEY, inverse=True).collect()}
    plain = {r.doc_id: r.text for r in docs.collect()}
    assert back == plain
    assert sum(r.n_card for r in first.values()) > 10 and sum(r.n_phone for r in first.values()) > 5
    for k, r in first.items():
        changed = sum(r[f"n_{kind}"] for kind in KINDS)
        assert (r.text == plain[k]) == (changed == 0)


def test_equal_values_in_many_documents(spark):
    rows = [(k, f"doc {k} card {VALUES['card']} and {VALUES['ip']}") for k in range(40)]
    got = pseudonymise(frame(spark, rows).repartition(5), KEY).collect()
    assert len({re.sub(r"^doc \d+", "", r.text) for r in got}) == 1


@pytest.mark.parametrize("before, value, after, kind", [
    ("dns ", "8.8.8.8", " used", "ip"), ("", "4111 1111 1111 1111", " 12/27", "card"),
    ("", "4111-1111-1111-1111", " 737", "card"), ("room 7 ", "4111 1111 1111 1111", "", "card"),
    ("7 ", "4111111111111111", " 737 12", "card"), ("amex ", "3782 822463 10005", ".", "card"),
    ("", "25/12/2021", "", "date"), ("am ", "25.12.2021", ".", "date"), ("call ", "+44 20 7946 0958", " now", "phone"),
    ("call ", "5551234567", ",", "phone"), ("5 ", "415 555 0132", "", "phone"), ("konto ", "GB82 WEST 1234 5698 7654 32", "", "iban"),
    ("host ", "2001:db8:85a3:8d3:1319:8a2e:370:7348", ";", "ip"), ("host ", "2001:db8::ff00:42:8329", "", "ip"),
    ("+1 ", "415-555-0132", "", "phone"), ("mail ", "a@x.com", "", "email")])
def test_values_in_their_surroundings(before, value, after, kind):
    """Found wherever they stand, and equal values alike in every document."""
    new, found = Pseudonyms(KEY).text(before + value + after)
    assert found == {k: int(k == kind) for k in KINDS}
    assert value not in new and new.endswith(after) and len(new) >= len(before + after)
    alone = Pseudonyms(KEY).text(value)[0]
    if kind != "phone" or before != "+1 ":
        assert new == before + alone + after
    assert Pseudonyms(KEY, inverse=True).text(new)[0] == before + value + after


def plain_values(text):
    """Values by trying every stretch between separators, without the patterns under test."""
    words, out = text.split("|"), []
    for w in words:
        d = "".join(c for c in w if c.isdigit())
        if "@" in w:
            out.append("email")
        elif w.count(".") == 3 and all(p.isdigit() and str(int(p)) == p and int(p) < 256 for p in w.split(".")):
            out.append("ip")
        elif w.replace(" ", "").isdigit() and 13 <= len(d) <= 19:
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
            out += ["card"] * (total % 10 == 0 and len(set(d)) > 1)
        elif len(w) == 10 and w[4] == w[7] == "-":
            try:
                out += ["date"] * (1900 <= datetime.date.fromisoformat(w).year < 2100)
            except ValueError:
                pass
    return {k: out.count(k) for k in KINDS}


_digit_text = st.text("0123456789", min_size=13, max_size=19)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    _digit_text, _digit_text.map(lambda d: d[:-1] + luhn_digit(d[:-1])), st.just("plain words"),
    st.tuples(*[st.integers(0, 300)] * 4).map(lambda p: ".".join(map(str, p))),
    st.tuples(st.integers(1890, 2110), st.integers(0, 13), st.integers(0, 32)).map(lambda t: f"{t[0]:04d}-{t[1]:02d}-{t[2]:02d}"),
    st.text("abc.7", min_size=1, max_size=6).filter(lambda n: any(c.isalnum() for c in n)).map(lambda n: n + "@x.org")), max_size=6))
def test_finds_what_a_plain_search_finds(values):
    text = "|".join(values)
    new, found = Pseudonyms(KEY).text(text)
    assert found == plain_values(text) == plain_values(new)
    assert Pseudonyms(KEY, inverse=True).text(new)[0] == text


@pytest.mark.parametrize("unit", ["xz9k7", "1 2 3 4 ", "4111 ", "a.b-", "12.12.", "dead:", "+1 2", "0f", "1-", "AB12 CDEF "])
def test_long_runs_take_linear_time(unit):
    import time
    text = unit * (4_000_000 // len(unit))
    began = time.process_time()
    Pseudonyms(KEY).text(text[:400_000])
    small = time.process_time() - began
    began = time.process_time()
    Pseudonyms(KEY).text(text)
    assert time.process_time() - began < max(1.5, 25 * small)
