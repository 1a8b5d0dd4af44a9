"""Cheapest repair of the role structure of conversations, with an audit of every edit.

A row of a conversation becomes a symbol: the class of its role's first letter and its fault. Spark builds a
Re-Pair grammar over all symbol sequences: rounds count adjacent pairs over the whole table, the most frequent
become rules. Every symbol and rule has one summary: a min-plus matrix over the four states of the wanted role
sequence ``(s?(ua)+)?`` with the least cost from state to state, a rope for the cheapest audit behind each cost,
and the counts of faults. A rule's summary is the product of its two parts', so it is computed once, bottom-up,
and shared by all conversations. Products are associative: long conversations are cut into segments that tasks
evaluate apart, and the segments' summaries are multiplied in groups of bounded size until one is left.

Ties go to the audit that is least in ASCII order. That is sound for products: audits of equal cost over the same
rows from state to state never begin with one another, as what one had more would be insertions, which cost.

Rows are ordered by turn (nulls first), then role and text; equal rows of one turn are counted, not carried. The
hash of a repaired conversation is taken by streaming its rows in order, a batch in memory at a time: SHA-256 runs
from front to back, so one task reads each conversation once. An audit is one string, as long as the conversation.

Nulls: a null conv_id is one conversation of its own, a null turn sorts first and is no part of the gaps, a null
role or text is one space. A conversation without rows gives zeros, the empty audit and the hash of nothing; a gap
beyond the largest long stays at it. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import partial, reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import ROW, SPACE, save, small_batches

#: Fixed values of the repair: edit costs, what a kept truncated row adds, the adjacent roles that may stand.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_ROW = 0, 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
CLASSES = "sua"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Next state of the wanted sequence by role class; states: start, after s, after u, after a. Start and a may end.
STEPS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
ENDS = (0, 3)
STATES, FIRST_SYMBOL = 4, ord("A")
#: Rows of a segment, summaries multiplied at once, rules of a round and of the grammar, rounds.
SEGMENT, FAN, ROUND_RULES, RULES, ROUNDS = 4096, 64, 24, 192, 10


# ---- ropes, matrices and summaries -------------------------------------------------------------

def _leaves(rope):
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += [top[1], top[0]]
        elif top:
            yield top


def text_of(rope) -> str:
    return "".join(_leaves(rope))


def _before(a, b) -> bool:
    """Is the text of rope ``a`` less than that of ``b``?"""
    left, right, x, y = _leaves(a), _leaves(b), "", ""
    while True:
        x, y = x or next(left, ""), y or next(right, "")
        n = min(len(x), len(y))
        if not n:
            return bool(y)
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and _before(new[1], old[1]))


def product(a: list, b: list) -> list:
    """Min-plus product of two matrices of (cost, rope) or None."""
    out = []
    for row in a:
        line = [None] * STATES
        for via, left in enumerate(row):
            if left is not None:
                for to, right in enumerate(b[via]):
                    if right is not None:
                        new = (left[0] + right[0], (left[1], right[1]))
                        if _better(new, line[to]):
                            line[to] = new
        out.append(line)
    return out


def _insertions() -> list:
    """Cheapest insertions from state to state."""
    out = [[(0, "") if p == q else None for q in range(STATES)] for p in range(STATES)]
    for start in range(STATES):
        state, audit = start, ""
        for _ in range(STATES):
            state, audit = _inserted(state)[1], audit + "I"
            new = (INSERT * len(audit), audit)
            if _better(new, out[start][state]):
                out[start][state] = new
    return out


def _inserted(state: int) -> tuple[str, int]:
    """Role that an inserted or re-roled row takes in ``state``, and the state behind it."""
    for role, steps in (("user", STEPS[1]), ("assistant", STEPS[2])):
        if state in steps:
            return role, steps[state]
    raise AssertionError(state)


INSERTIONS = _insertions()


def _symbol_matrix(role: int, fault: int) -> list:
    row = [[(DELETE, "D") if p == q else None for q in range(STATES)] for p in range(STATES)]
    if fault in (FINE, TRUNCATED):
        extra = TRUNCATED_ROW if fault == TRUNCATED else 0
        ways = [(steps, REROLE, "R") for steps in STEPS[1:3]] + [(STEPS[role], KEEP, "K")]
        for steps, cost, edit in ways:
            for p, q in steps.items():
                if _better((cost + extra, edit), row[p][q]):
                    row[p][q] = (cost + extra, edit)
    return product(INSERTIONS, row)


class Summary:
    """What a run of symbols amounts to: matrix, fault counts, illegal neighbours, first and last role class."""

    __slots__ = ("matrix", "faults", "illegal", "first", "last")

    def __init__(self, matrix, faults, illegal, first, last):
        self.matrix, self.faults, self.illegal, self.first, self.last = matrix, faults, illegal, first, last

    def __mul__(self, other: Summary) -> Summary:
        apart = (CLASSES + "?")[self.last] + (CLASSES + "?")[other.first] not in LEGAL
        return Summary(product(self.matrix, other.matrix),
                       tuple(x + y for x, y in zip(self.faults, other.faults, strict=True)),
                       self.illegal + other.illegal + apart, self.first, other.last)

    def packed(self) -> dict:
        cells = list(chain.from_iterable(self.matrix))
        return {"costs": [-1 if c is None else c[0] for c in cells],
                "audits": [None if c is None else text_of(c[1]) for c in cells],
                "faults": list(self.faults), "illegal": self.illegal, "first": self.first, "last": self.last}

    @staticmethod
    def unpacked(row: dict) -> Summary:
        cells = [None if c < 0 else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)]
        return Summary([cells[k:k + STATES] for k in range(0, STATES * STATES, STATES)], tuple(row["faults"]),
                       row["illegal"], row["first"], row["last"])

    def best(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of a whole conversation."""
        ends = product([self.matrix[0]], INSERTIONS)[0]
        found = None
        for q in ENDS:
            if ends[q] is not None and _better(ends[q], found):
                found = ends[q]
        return found[0], text_of(found[1])


def symbol_summaries() -> list[Summary]:
    return [Summary(_symbol_matrix(role, fault), tuple(int(fault == f) for f in (BLANK, DUPLICATE, TRUNCATED)),
                    0, role, role) for role in range(4) for fault in range(4)]


def folded(parts: list[Summary]) -> Summary:
    """Product of summaries as a balanced tree."""
    while len(parts) > 1:
        parts = [parts[k] * parts[k + 1] if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


class Grammar:
    """Re-Pair rules in rounds: {(left, right): symbol}; symbols below 16 are rows, the rest rules."""

    def __init__(self):
        self.rounds: list[dict[tuple[int, int], int]] = []
        self.summaries = symbol_summaries()

    def add(self, pairs: list[tuple[int, int]]) -> None:
        rules = {}
        for a, b in pairs:
            rules[a, b] = len(self.summaries)
            self.summaries.append(self.summaries[a] * self.summaries[b])
        self.rounds.append(rules)

    def compressed(self, sequence: str) -> list[int]:
        symbols = [ord(c) - FIRST_SYMBOL for c in sequence]
        for rules in self.rounds:
            out, k = [], 0
            while k < len(symbols):
                rule = rules.get((symbols[k], symbols[k + 1])) if k + 1 < len(symbols) else None
                out.append(symbols[k] if rule is None else rule)
                k += 1 if rule is None else 2
            symbols = out
        return symbols

    def summary(self, sequence: str) -> Summary:
        return folded([self.summaries[s] for s in self.compressed(sequence)])


def _pair_batches(batches, grammar: Grammar):
    """Adjacent pairs of the sequences as the grammar leaves them; equal symbols in a row pair without overlap."""
    import pyarrow as pa

    pairs: Counter = Counter()
    for batch in batches:
        for sequence, n in zip(batch["seq"].to_pylist(), batch["n"].to_pylist(), strict=True):
            symbols, taken = grammar.compressed(sequence), -1
            for k in range(len(symbols) - 1):
                if symbols[k] == symbols[k + 1]:
                    if k <= taken:
                        continue
                    taken = k + 1
                pairs[symbols[k], symbols[k + 1]] += n
    if pairs:
        yield pa.RecordBatch.from_pydict({"a": [a for a, _ in pairs], "b": [b for _, b in pairs],
                                          "n": list(pairs.values())},
                                         pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))


def repair_grammar(sequences: DataFrame, rules: int = RULES, per_round: int = ROUND_RULES,
                   rounds: int = ROUNDS) -> Grammar:
    """The rules for all ``sequences`` (column seq). Pairs of one round share no symbol that could overlap."""
    distinct = save(sequences.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "repair-sequences")
    grammar = Grammar()
    for _ in range(rounds):
        counts = distinct.where(F.length("seq") > 1).mapInArrow(partial(_pair_batches, grammar=grammar),
                                                                "a int, b int, n long")
        ranked = counts.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") > 1) \
            .orderBy(F.desc("n"), "a", "b").limit(8 * per_round).collect()  # bounded by the grammar's size
        left = min(per_round, rules - sum(map(len, grammar.rounds)))
        chosen: list[tuple[int, int]] = []
        for r in ranked:
            clash = any(r.a == b or r.b == a for a, b in chosen)
            if len(chosen) < left and not clash:
                chosen.append((r.a, r.b))
        if not chosen:
            break
        grammar.add(chosen)
    return grammar


# ---- tables ------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped) of every row, damaged by the checksum of its key."""
    space = F.lit(" ")
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    what = F.crc32(key.cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn", F.when(what == 4, "user").otherwise(role).alias("role"),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).cast("long").alias("copies"))


def _symbol(role: Column, fault: Column) -> Column:
    return F.char(F.lit(FIRST_SYMBOL) + 4 * role + fault)


def _segments(rows: DataFrame) -> DataFrame:
    """conv_id, seg, seq: the symbols of up to SEGMENT stored rows of a conversation, in order."""
    leads = rows.where(~F.col("blank")).groupBy("conv_id", "same").agg(F.min(ROW).alias(ROW)) \
        .select(ROW, F.lit(True).alias("lead"))
    place = F.col(ROW).bitwiseAND(F.lit((1 << 33) - 1))
    most = rows.agg(F.max(place)).first()[0] or 0
    seg = F.shiftright(F.col(ROW), 33) * (most // SEGMENT + 1) + F.floor(place / SEGMENT)
    role = F.col("class")
    again = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    fault = F.when(F.col("blank"), BLANK).when(F.col("lead").isNull(), DUPLICATE) \
        .when(F.col("truncated"), TRUNCATED).otherwise(FINE)
    # what one row adds: itself, then its equal copies
    piece = F.concat(_symbol(role, fault), F.repeat(_symbol(role, again), (F.col("n") - 1).cast("int")))
    narrow = rows.select(ROW, "conv_id", "class", "blank", "truncated", "n").join(leads, ROW, "left") \
        .select("conv_id", seg.cast("long").alias("seg"), F.struct(ROW, piece.alias("s")).alias("at"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["s"]), "")
    return narrow.groupBy("conv_id", "seg").agg(joined.alias("seq"))


_PACKED = "costs array<int>, audits array<string>, faults array<long>, illegal long, first int, last int"


def _batch_of(rows: list[dict], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(rows, schema)


def _packed_schema(first):
    import pyarrow as pa

    return pa.schema([*first, ("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
                      ("faults", pa.list_(pa.int64())), ("illegal", pa.int64()), ("first", pa.int32()),
                      ("last", pa.int32())])


def _evaluated_batches(batches, grammar: Grammar):
    known: dict[str, dict] = {}
    for batch in small_batches(batches):
        rows = []
        for sequence in batch["seq"].to_pylist():
            if sequence not in known:
                if len(known) > 5000:
                    known.clear()
                known[sequence] = grammar.summary(sequence).packed()
            rows.append(known[sequence])
        done = _batch_of(rows, _packed_schema([]))
        yield _with_columns(batch, ["conv_id", "seg"], done)


def _with_columns(batch, names, done):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([*[batch[c] for c in names], *done.columns], [*names, *done.schema.names])


def _merged_batches(batches):
    for batch in small_batches(batches, 64):
        rows = [folded([Summary.unpacked(p) for p in parts]).packed() for parts in batch["parts"].to_pylist()]
        yield _with_columns(batch, ["conv_id", "seg"], _batch_of(rows, _packed_schema([])))


def _final_batches(batches):
    import pyarrow as pa

    schema = pa.schema([(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
                       + [("audit", pa.string())])
    for batch in small_batches(batches):
        rows = []
        for parts in batch["parts"].to_pylist():
            whole = folded([Summary.unpacked(p) for p in parts])
            cost, audit = whole.best()
            rows.append(dict(zip(schema.names, (*whole.faults, whole.illegal, cost, audit), strict=True)))
        yield _with_columns(batch, ["conv_id"], _batch_of(rows, schema))


def _grouped(parts: DataFrame, *keys) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("seg", "costs", "audits", "faults", "illegal", "first", "last")))
    return parts.groupBy(*keys).agg(listed.alias("parts"))


def repairs(sequences: DataFrame, grammar: Grammar, kind: str, fan: int = FAN) -> DataFrame:
    """conv_id, fault counts, illegal, cost and audit from the segments' symbol sequences."""
    parts = save(sequences.mapInArrow(partial(_evaluated_batches, grammar=grammar),
                                      f"conv_id {kind}, seg long, {_PACKED}"), "repair-parts")
    while (parts.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > fan:
        grouped = _grouped(parts.withColumn("block", F.expr(f"seg div {fan}")), "conv_id", "block")
        parts = save(grouped.withColumnRenamed("block", "seg")
                     .mapInArrow(_merged_batches, f"conv_id {kind}, seg long, {_PACKED}"), "repair-parts")
    return _grouped(parts, "conv_id").mapInArrow(
        _final_batches, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Repaired:
    """Takes a conversation's rows in order and the edits of its audit; hashes what the repair leaves."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines, self.hash = audit, 0, 0, 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            role, self.state = _inserted(self.state)
            self._line(role, "")
            self.at += 1

    def take(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[CLASSES.index(role[0])][self.state]
            self._line(role, text)
        elif edit == "R":
            name, self.state = _inserted(self.state)
            self._line(name, text)

    def digest(self) -> str:
        self._inserts()
        if self.at != len(self.audit):
            raise AssertionError("an audit has more edits than its conversation has rows")
        return self.hash.hexdigest()


def _hash_batches(batches):
    """Rows sorted by conversation, a conversation's header (the result so far) first -> header with the hash."""
    import pyarrow as pa

    header, run = None, None
    for batch in small_batches(batches, 1024):
        done, digests = [], []
        for head, role, text, n in zip(*(batch[c].to_pylist() for c in ("head", "role", "text", "n")), strict=True):
            if head is None:
                for _ in range(n):
                    run.take(role, text)
                continue
            if header is not None:
                done.append(header)
                digests.append(run.digest())
            header, run = head, _Repaired(head["audit"])
        if done:
            yield _hashed(done, digests, batch.schema)
        schema = batch.schema
    if header is not None:
        yield _hashed([header], [run.digest()], schema)


def _hashed(done, digests, schema):
    import pyarrow as pa

    heads = pa.array(done, schema.field("head").type)
    names = [f.name for f in heads.type]
    return pa.RecordBatch.from_arrays([*heads.flatten(), pa.array(digests, pa.string())], [*names, "repaired_sha256"])


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    kind = dict(conversations.dtypes)["conv_id"]
    all_rows = damaged(conversations)
    here = F.when(F.col("copies") > 0, F.col("turn"))
    gaps = _wide(F.max(here)) - _wide(F.min(here)) + 1 - _wide(F.count_distinct(here))
    largest = F.lit((1 << 63) - 1).cast("decimal(23,0)")
    stats = all_rows.groupBy("conv_id").agg(F.least(F.coalesce(gaps, F.lit(0)), largest).cast("long").alias("gaps"))

    role, text = F.col("role"), F.col("text")
    initial = F.substring(role, 1, 1)
    keys = ["conv_id", "turn", "role"]
    rows = all_rows.where(F.col("copies") > 0).groupBy(*keys, "text").agg(F.sum("copies").alias("n")) \
        .repartitionByRange(*keys, F.substring(text, 1, 64)).sortWithinPartitions(*keys, "text") \
        .select(F.monotonically_increasing_id().alias(ROW), "conv_id", "role", "text", "n",
                F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("same"),
                F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("class"),
                (~text.rlike(f"[^{SPACE}]")).alias("blank"), (~text.rlike(f"[.!?][{SPACE}]*\\z")).alias("truncated"))
    rows = save(rows, "repair-rows")
    sequences = save(_segments(rows), "repair-segments")
    found = repairs(sequences, repair_grammar(sequences), kind)

    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = stats.alias("s").join(found.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left") \
        .select("conv_id", F.lit(-1).cast("long").alias(ROW), F.struct(
            "conv_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names],
            F.coalesce("audit", F.lit("")).alias("audit")).alias("head"))
    ordered = rows.select("conv_id", ROW, "role", "text", "n").unionByName(heads, allowMissingColumns=True) \
        .repartition("conv_id").sortWithinPartitions("conv_id", ROW).select("head", "role", "text", "n")
    return ordered.mapInArrow(_hash_batches, f"conv_id {kind}, " + "".join(f"{c} long, " for c in names)
                              + "audit string, repaired_sha256 string")
