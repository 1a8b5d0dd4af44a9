import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import lakestrata.llm.conversation_repair as repair
from lakestrata.llm.conversation_repair import (
    Grammar, Summary, conversation_repair, folded, repair_grammar, repairs, symbol_summaries, text_of,
)

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")
ORDER = {"D": 4, "I": 3, "K": 0, "R": 3}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv, turn, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Best (cost, audit, repaired rows) by extending whole audits row by row; the state is the last role."""
    def after(state, role):
        return {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}.get(role[:1], {}).get(state)

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 3, audit + "I", lines + [(role, "")])
                to = after(state, role)
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = inserted({"": (0, "", [])})
    for (role, text), mark in zip(rows, marks, strict=True):
        nxt = {}

        def offer(state, cost, audit, lines, nxt=nxt):
            if state is not None and (state not in nxt or (cost, audit) < nxt[state][:2]):
                nxt[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 4, audit + "D", lines)
            if mark not in ("blank", "duplicate"):
                more = 3 if mark == "truncated" else 0
                offer(after(state, role), cost + more, audit + "K", lines + [(role, text)])
                for name in ("user", "assistant"):
                    offer(after(state, name), cost + more + 3, audit + "R", lines + [(name, text)])
        best = inserted(nxt)
    return min(best[s] for s in ("", "a") if s in best)


def plain(rows):
    of = defaultdict(list)
    for r in damage(rows):
        of[r[0]].append(r)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(of[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = {r[1] for r in mine if r[1] is not None}
        body = [r[2:] for r in mine]
        marks = faults(body)
        cost, audit, lines = cheapest(body, marks)
        assert GOOD.match("".join(role[:1] for role, _ in lines))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"),
                    marks.count("duplicate"), marks.count("truncated"),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(body, body[1:])),
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, conversations=120, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "under", "sys", "a", None])
            text = rng.choice(["Hi.", "Hi.", "Why? \n", "cut off", " \t", "", None, f"number {rng.randrange(3)}!", "ß…", "x" * 9])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn * 3, None]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_plain(spark, seed):
    rows = made(seed) + [(7777, 0, "user", "only a row"), (7777, 0, "user", "only a row")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cost", F.lit("clash")).withColumn("a.b", F.lit(1))
    assert sorted(map(tuple, conversation_repair(df.repartition(3)).collect()), key=str) == plain(rows)


def test_long_conversation_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 8)
    monkeypatch.setattr(repair.repairs, "__defaults__", (3,))
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), f"text {rng.randrange(150)}{rng.choice('.!x')}")
            for k in range(400)] + [(1, 10**6, "user", "same.")] * 30 + made(3, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, conversation_repair(df).collect()), key=str) == plain(rows)


def test_no_rows(spark):
    assert conversation_repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = [(k, t, "user", "x") for k in range(400) for t in (0,) if zlib.crc32(f"{k}:{t}".encode()) % 20 == 0]
    nothing = hashlib.sha256(b"").hexdigest()
    got = conversation_repair(spark.createDataFrame(gone, SCHEMA)).collect()
    assert got and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", nothing) for r in got)


def test_largest_gap(spark):
    turns = [t for t in (-(1 << 63), (1 << 63) - 1, -(1 << 63) + 1, (1 << 63) - 2)]
    rows = [(k, t, "user", "x.") for k in range(8) for t in turns]
    got = {r.conv_id: r.gaps for r in conversation_repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert max(got.values()) == (1 << 63) - 1


def test_matrix_against_every_audit():
    """Up to three rows and five letters: no audit is cheaper, and none of equal cost is less."""
    roles, symbols = "sua?", symbol_summaries()

    def cost_of(sequence, audit):
        out, cost, k = "", 0, 0
        for letter in audit:
            if letter == "I":
                out += "a" if out[-1:] == "u" else "u"
                cost += 3
                continue
            if k == len(sequence):
                return None
            role, fault = divmod(sequence[k], 4)
            k += 1
            cost += ORDER[letter]
            if letter == "D":
                continue
            if fault in (1, 2):
                return None
            cost += 3 if fault == 3 else 0
            out += roles[role] if letter == "K" else "a" if out[-1:] == "u" else "u"
        return cost if k == len(sequence) and GOOD.match(out) else None

    rng = random.Random(4)
    for _ in range(100):
        sequence = [rng.randrange(16) for _ in range(rng.randrange(1, 4))]
        found = [(c, "".join(a)) for n in range(1, 7) for a in itertools.product("DIKR", repeat=n)
                 if (c := cost_of(sequence, a)) is not None]
        assert folded([symbols[s] for s in sequence]).best() == min(found)


def test_grammar_is_exact_and_shared(spark):
    rng = random.Random(6)
    sequences = ["".join(rng.choice("EIEIEIAF") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    grammar = repair_grammar(spark.createDataFrame([(s,) for s in sequences], "seq string"), rules=40, per_round=6)
    rules = {symbol: pair for rounds in grammar.rounds for pair, symbol in rounds.items()}
    assert 6 < len(rules) <= 40

    def expanded(symbol):
        return [symbol] if symbol < 16 else [x for part in rules[symbol] for x in expanded(part)]

    plain_symbols = symbol_summaries()
    for s in sequences:
        assert "".join(chr(65 + x) for symbol in grammar.compressed(s) for x in expanded(symbol)) == s
        want = plain_symbols[ord(s[0]) - 65]
        for c in s[1:]:
            want = want * plain_symbols[ord(c) - 65]
        assert grammar.summary(s).packed() == want.packed()
    assert sum(len(grammar.compressed(s)) for s in sequences) < sum(map(len, sequences)) / 2


def test_summary_packs_whole():
    s = symbol_summaries()[4] * symbol_summaries()[11]
    again = Summary.unpacked(s.packed())
    assert again.packed() == s.packed() and text_of(("a", ("b", ""))) == "ab" and Grammar().rounds == [] and repairs
