"""PII: format-preserving Feistel pseudonyms.

Personal values are found by pattern and replaced only if they are valid: card numbers by their Luhn
digit, bank accounts by their check digits, social security numbers by their number ranges, phone numbers by
their layout, addresses by their octets or groups, dates by the calendar. The digits (or letters) of a value, as
one number below the size of its format, go through a keyed Feistel permutation of exactly that range: rounds
alternate over two unequal halves, and a result outside the format, or one that would be read as another, is
permuted again until it is inside (cycle walking). So a pseudonym has the same format and is valid too, equal
values get equal pseudonyms in every document, and the key's holder can invert it. E-mail names and hexadecimal
secrets are permuted as strings of their character classes.

A card may stand among other digit groups (an expiry date, a check number, a room): groups of 13 to 19 digits and
the usual groupings are tried from every group on, and a run of another grouping as a whole. Dates are read
year first, month first, day first where the first number is no month, and day first with dots. If two card
groupings overlap, the way back may read another one of them.

Null text stays null, empty stays empty. Rows that repeat an id are rows of their own; an empty table
gives an empty result; other input columns are not read. Texts are handled whole, in time linear in their length.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import ipaddress
import re
from functools import partial

from pyspark.sql import DataFrame

from lakestrata.llm.common import small_batches

ROUNDS = 10
KINDS = ("card", "phone", "ssn", "ip", "date", "email", "secret", "iban")
REMEMBERED = 100_000


class Feistel:
    """A keyed permutation of range(size), one for each ``tweak``."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size, self.key, self.tweak = size, hashlib.sha256(key).digest(), tweak.encode()
        root = max(2, int(size ** 0.5))
        while root * root < size:
            root += 1
        self.a, self.b = root, -(-size // root)

    def _round(self, k: int, value: int, modulus: int) -> int:
        text = b"%s|%d|%d|%d" % (self.tweak, self.size, k, value)
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=24).digest(), "big") % modulus

    def _once(self, x: int, inverse: bool) -> int:
        left, right = divmod(x, self.b)
        for k in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            sign = -1 if inverse else 1
            if k % 2:
                right = (right + sign * self._round(k, left, self.b)) % self.b
            else:
                left = (left + sign * self._round(k, right, self.a)) % self.a
        return left * self.b + right

    def permute(self, x: int, inverse: bool = False) -> int:
        while True:
            x = self._once(x, inverse)
            if x < self.size:
                return x


# ---- formats: (value -> number, size) and back -------------------------------------------------

def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(pattern: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``pattern``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def walk(crypt, x: int, size: int, inside) -> int:
    """Permute until the result is one of those numbers, like ``x``, that are ``inside``: a permutation of these."""
    x = crypt(x, size)
    while not inside(x):
        x = crypt(x, size)
    return x


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1


def _card(value, crypt):
    d = _digits(value)
    if not is_card(d):
        return None

    def whole(x: int) -> str:
        body = str(x).zfill(len(d) - 1)
        return body + luhn_digit(body)

    return _refill(value, whole(walk(crypt, int(d[:-1]), 10 ** (len(d) - 1), lambda x: len(set(whole(x))) > 1)))


#: Usual groupings of card numbers besides one group (fixed values of the format).
CARD_GROUPS = ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 5))
_GROUP = re.compile(r"\d+")


def card_span(run: str) -> int:
    """Length of the card that a run of digit groups begins with; 0 if it does not."""
    first = _GROUP.match(run).end()
    if first != 4 and not 13 <= first <= 19 and len(run) > 37:  # no grouping begins so, and over 19 digits
        return 0
    groups = [m.span() for m in _GROUP.finditer(run)]
    sizes = tuple(b - a for a, b in groups)

    def begins(k: int) -> int:
        ends = [k] if 13 <= sizes[k] <= 19 else []
        ends += [k + len(g) - 1 for g in CARD_GROUPS if sizes[k:k + len(g)] == g]
        return next((groups[e][1] for e in ends if is_card(_digits(run[groups[k][0]:groups[e][1]]))), 0)

    found = begins(0)
    if not found and sum(sizes) <= 19 and not any(begins(k) for k in range(1, len(groups))) and is_card(_digits(run)):
        found = groups[-1][1]
    return found


def _phone(value, crypt):
    d = _digits(value)
    if value[0] == "+":  # the country code stays: the digits before the first separator, else one to three
        first = re.match(r"\+(\d{1,3})(?!\d)", value)
        keep = len(first.group(1)) if first else 1 if d[0] in "17" else 2
        if not 8 <= len(d) <= 15:
            return None
    else:
        keep = len(d) - 10
    size = 10 ** (len(d) - keep)
    if value.isdigit():  # ten digits in a row: the first is no 0 or 1, before and after
        return str(walk(crypt, int(d), size, lambda x: x >= 2 * 10 ** 9))
    return _refill(value, d[:keep] + str(crypt(int(d[keep:]), size)).zfill(len(d) - keep))


#: Areas of social security numbers that are never given out.
_NO_AREA = (0, 666)


def _ssn(value, crypt):
    area, group, serial = (int(x) for x in value.split("-"))
    areas = [a for a in range(1, 900) if a not in _NO_AREA]
    if area not in areas or not group or not serial:
        return None
    x = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(crypt(x, len(areas) * 99 * 9999), 9999)
    return f"{areas[x // 99]:03d}-{x % 99 + 1:02d}-{serial + 1:04d}"


def _ip(value, crypt):
    if ":" in value:
        return _ip6(value, crypt)
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = 0
    for p in parts:
        x = x * 256 + int(p)
    return ".".join(map(str, crypt(x, 1 << 32).to_bytes(4, "big")))


def _ip6(value, crypt):
    """The hexadecimal digits that are written, in their places."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return None
    digits = value.replace(":", "")
    if len(digits) < 4 or not any(c.isdigit() for c in digits):
        return None

    def written(x: int) -> str:
        new = iter(f"{x:0{len(digits)}x}")
        out = "".join(c if c == ":" else next(new) for c in value)
        return out.upper() if value.upper() == value else out

    return written(walk(crypt, int(digits, 16), 16 ** len(digits), lambda x: any(c.isdigit() for c in written(x))))


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


def _date(value, crypt):
    sep = next(c for c in value if not c.isdigit())
    parts = value.split(sep)
    year_first = len(parts[0]) == 4
    day_first = not year_first and (sep == "." or int(parts[0]) > 12)
    y, m, d = (int(p) for p in (parts if year_first else (parts[2], parts[1], parts[0]) if day_first else
                                (parts[2], parts[0], parts[1])))
    if not (1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]):
        return None
    days = (LAST_DAY - FIRST_DAY).days + 1

    def day(x: int) -> datetime.date:
        return FIRST_DAY + datetime.timedelta(x)

    shown = day_first and sep != "."  # only a day beyond 12 shows that it comes first
    new = day(walk(crypt, (datetime.date(y, m, d) - FIRST_DAY).days, days, lambda x: not shown or day(x).day > 12))
    fields = (new.year, new.month, new.day) if year_first else (new.day, new.month, new.year) if day_first else \
        (new.month, new.day, new.year)
    return sep.join(f"{v:04d}" if v > 99 else f"{v:02d}" for v in fields)


def _iban_digits(text: str) -> str:
    """Check digits of an account number whose own two are any."""
    moved = text[4:] + text[:2] + "00"
    return f"{98 - int(''.join(str(int(c, 36)) for c in moved)) % 97:02d}"


def _iban(value, crypt):
    bare = value.replace(" ", "")
    if not 15 <= len(bare) <= 34 or _iban_digits(bare) != bare[2:4]:
        return None
    account = _classes(bare[4:], crypt)
    new = iter(bare[:2] + _iban_digits(bare[:4] + account) + account)
    return "".join(c if c == " " else next(new) for c in value)


def _classes(value, crypt):
    """Letters and digits permuted within their classes, others kept; long values in cuts of 24."""
    out = list(value)
    for start in range(0, len(value), 24):
        places = [k for k in range(start, min(len(value), start + 24)) if value[k].isascii() and value[k].isalnum()]
        x, size = 0, 1
        for k in places:
            base = 10 if value[k].isdigit() else 26
            x = x * base + (int(value[k]) if base == 10 else ord(value[k].lower()) - 97)
            size *= base
        x = crypt(x, size) if size > 1 else 0
        for k in reversed(places):
            base = 10 if value[k].isdigit() else 26
            x, r = divmod(x, base)
            out[k] = str(r) if base == 10 else chr((65 if value[k].isupper() else 97) + r)
    return "".join(out)


def _email(value, crypt):
    name, at, host = value.partition("@")
    if not any(c.isalnum() for c in name):
        return None
    return _classes(name, crypt) + at + host


def _secret(value, crypt):
    """Hexadecimal digits as one number, sixteen at a time."""
    out, upper = [], value.upper() == value
    for k in range(0, len(value), 16):
        part = value[k:k + 16]
        out.append(f"{crypt(int(part, 16), 16 ** len(part)):0{len(part)}x}")
    return "".join(out).upper() if upper else "".join(out)


FORMATS = {"card": _card, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date, "email": _email, "secret": _secret,
           "iban": _iban}
_NAME = "A-Za-z0-9._%+-"
_PATTERN = re.compile("|".join([
    rf"(?P<email>(?<![{_NAME}])[{_NAME}]{{1,64}}@[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}})+)",
    r"(?P<secret>(?<![0-9A-Za-z])(?:[0-9a-f]{24,}|[0-9A-F]{24,})(?![0-9A-Za-z]))",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<ip6>(?<![\w:])(?=[0-9A-Fa-f:]{2,39}(?![\w:]))(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?![\w:]))",
    r"(?P<date>(?<![\d.-])(?:(?:19|20)\d\d-\d\d-\d\d|(?:19|20)\d\d/\d\d/\d\d|\d\d/\d\d/(?:19|20)\d\d"
    r"|\d\d-\d\d-(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?![\d-]|\.\d))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
    r"(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))",
    r"(?P<card>(?<![\d.-])\d(?:[ -]?\d){12,40})",
    r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,5}(?![\d-])"
    r"|(?<![\w.+-])[2-9]\d{9}(?![\w-]|\.\d))",
]))
#: What else may begin where a run of digits holds no card.
_NOT_CARD = re.compile(_PATTERN.pattern[_PATTERN.pattern.index("(?P<phone>"):])
#: Test that a text can hold a value at all: every pattern but that of a secret needs a digit or @.
_MAYBE = re.compile(r"[@0-9]|[A-Fa-f]{24}|[A-Fa-f]::?[A-Fa-f]")


class Pseudonyms:
    """Value -> pseudonym under one key, with the number of values found by kind."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = key, inverse
        self.known: dict[tuple[str, str], str | None] = {}
        self.feistel: dict[tuple[str, int], Feistel] = {}

    def value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None if the value isn't valid."""
        if (kind, text) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()

            def crypt(x: int, size: int) -> int:
                if (kind, size) not in self.feistel:
                    self.feistel[kind, size] = Feistel(self.key, kind, size)
                return self.feistel[kind, size].permute(x, self.inverse)

            self.known[kind, text] = FORMATS[kind](text, crypt)
        return self.known[kind, text]

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        found = dict.fromkeys(KINDS, 0)
        if not _MAYBE.search(text):
            return text, found
        out, done, at = [], 0, 0
        while m := _PATTERN.search(text, at):
            kind, end = m.lastgroup, m.end()
            if kind == "card":  # up to the last whole group, then only the card that the run begins with
                run = m.group() if not text[end:end + 1].isdigit() else _GROUP.sub("", m.group()[::-1], 1)[::-1]
                end = m.start() + card_span(run) if run else m.start()
            elif kind == "ip6":
                kind = "ip"
            new = self.value(kind, text[m.start():end]) if end > m.start() else None
            if new is None and m.lastgroup == "card" and (other := _NOT_CARD.match(text, m.start())):
                kind, end = other.lastgroup, other.end()
                new = self.value(kind, other.group())
            if new is None:
                at = _GROUP.match(text, m.start()).end() if m.lastgroup == "card" else m.start() + 1
                continue
            found[kind] += 1
            out += [text[done:m.start()], new]
            done = at = end
        return "".join([*out, text[done:]]), found


def _batches(batches, key, inverse):
    import pyarrow as pa

    names = Pseudonyms(key, inverse)
    for batch in small_batches(batches):
        done = [(None, dict.fromkeys(KINDS, 0)) if t is None else names.text(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([d[0] for d in done], pa.string()),
             *[pa.array([d[1][k] for d in done], pa.int64()) for k in KINDS]],
            ["doc_id", "text", *[f"n_{k}" for k in KINDS]])


def pseudonymise(docs: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text with pseudonyms, and n_<kind> of the values replaced.

    ``inverse`` restores the values of a pseudonymised text under the same key.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", docs["text"].cast("string").alias("text")) \
        .mapInArrow(partial(_batches, key=key, inverse=inverse), f"doc_id {kind}, text string, {counts}")
