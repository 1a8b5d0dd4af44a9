"""Best-fit packing by a configuration linear program.

Texts become token ids (an end id closes each), documents longer than a sequence are cut into pieces of
full length, and the pieces are packed by the histogram of their lengths alone. The covering program
"few configurations, every length covered" is solved by multiplicative weights: a knapsack dynamic
program prices the best configuration for the current weights, the configuration gets a share of the
solution, and the weights of the lengths that it covers fall. For the program, lengths are grouped into at
most CLASSES classes of about equal room, each as long as its longest member, so that the rounds cover all of
them; a class's place in a configuration is filled with its exact lengths, longest first, and the room that
this leaves is known exactly. Uses are rounded down; what stays is placed best-fit, longest first, in the room
the configurations leave and then in new sequences.

Only the histogram (one row per length, so at most as many as a sequence has tokens) and the plan made
from it reach the driver. A piece finds its place from its rank among the pieces of its length, counted
per task and offset by the earlier tasks' counts; no length is gathered in one task.

Null text is empty: one piece holding the end id alone. Rows that repeat an id are packed each. An empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from functools import partial

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import as_bytes, save, small_batches, word_blocks

LENGTH, END_ID = 4096, 1
#: Rounds of the multiplicative weights.
ROUNDS = 300
#: Most classes of lengths that the program covers; fewer than the rounds, so that none stays uncovered.
CLASSES = 96
#: Words, and parts of words, whose ids a Python worker remembers before it starts afresh.
REMEMBERED = 700_000
TOKENIZER = "word_bpe_49k.json"
_PRINTABLE = re.compile(rb"[!-~]+")
# Fixed value: the tokenizer's split pattern, for lower-case ASCII.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordIds(dict):
    """Ids of a word as little-endian uint32 bytes. White space never joins two words in this tokenizer,
    so a text's ids are those of its words in a row, and each word is tokenized once while it is known.

    A word is normalised and split by the tokenizer's own steps and its parts go to the tokenizer's model;
    for printable ASCII those steps are lower-casing and the split pattern below. A word that may hold a
    special token is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.parts: dict[str, bytes] = {}
        self.tokenize = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        if b"<|" in word:
            ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
            found = b"".join(i.to_bytes(4, "little") for i in ids)
        elif _PRINTABLE.fullmatch(word):
            found = b"".join([self._part(p) for p in _SPLIT.findall(word.lower().decode())])
        else:
            text = self.normalizer.normalize_str(word.decode("utf-8", "replace"))
            found = b"".join([self._part(p) for p, _ in self.splitter.pre_tokenize_str(text)])
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def _part(self, part: str) -> bytes:
        if (found := self.parts.get(part)) is None:
            found = b"".join([t.id.to_bytes(4, "little") for t in self.tokenize(part)])
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            self.parts[part] = found
        return found


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The words that this Python worker knows already; tasks that it runs later start from them."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def token_bytes(data: bytes, ids: WordIds, end_id: int = END_ID) -> bytes:
    if b"<|" not in data:  # the tokenizer lower-cases, and only a special token has to be seen before that
        data = data.lower()
    return b"".join([b"".join(map(ids.__getitem__, block)) for block in word_blocks(data)]
                    + [end_id.to_bytes(4, "little")])


def _piece_batches(batches, path, length, end_id):
    import pyarrow as pa

    ids, task, ranks = word_ids(path), TaskContext.get().partitionId(), defaultdict(int)
    for batch in small_batches(batches):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            data = token_bytes(text, ids, end_id)
            for piece, at in enumerate(range(0, len(data), 4 * length)):
                part = data[at:at + 4 * length]
                n = len(part) // 4
                rows.append((doc_id, piece, at // 4, n, zlib.crc32(part), task, ranks[n]))
                ranks[n] += 1
        kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds, strict=True)], names)


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, for its place, task and rank among its length there."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_piece_batches, path=path or tokenizer_path(), length=length, end_id=end_id),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long")


# ---- the plan, from the histogram ------------------------------------------------------------

def best_configuration(values, sizes, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: how often each item of ``sizes`` (ascending) is taken for the greatest value."""
    import numpy as np

    # an item is of use only if no smaller one is worth as much
    useful = np.flatnonzero(values > np.r_[0.0, np.maximum.accumulate(values)[:-1]])
    sizes, values = sizes[useful], values[useful]
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fits[room]:
            gain = best[room - sizes[:k]] + values[:k]
            j = int(gain.argmax())
            if gain[j] > best[room]:
                best[room], pick[room] = gain[j], j
    taken: dict[int, int] = defaultdict(int)
    room = capacity
    while room > 0:
        if (j := int(pick[room])) < 0:
            room -= 1
        else:
            taken[int(useful[j])] += 1
            room -= int(sizes[j])
    return dict(taken)


def fractional(classes: dict[int, int], capacity: int, rounds: int) -> list[tuple[dict[int, int], float]]:
    """Configurations (length -> times) and their uses, towards covering every length of ``classes``."""
    import numpy as np

    if not classes:
        return []
    sizes = np.array(sorted(classes), np.int64)
    need = np.array([classes[int(s)] for s in sizes], float)
    covered, uses = np.zeros(len(sizes)), defaultdict(float)
    weight = (sizes / capacity) ** 1.15 / need  # a length starts a little above the room that it takes
    for _ in range(rounds):
        weight /= weight.max()
        taken = best_configuration(weight, sizes, capacity)
        index = np.array(list(taken), np.int64)
        times = np.array([taken[int(j)] for j in index], float)
        step = float((need[index] / times).min())
        covered[index] += step * times / need[index]
        uses[tuple(sorted((int(sizes[j]), taken[int(j)]) for j in index))] += step
        weight[index] *= 0.5 ** (step * times / need[index])
    # a length that no configuration has got yet gets one of its own, so that every length is covered
    for j in np.flatnonzero(covered == 0):
        times = int(capacity // sizes[j])
        uses[((int(sizes[j]), times),)] += need[j] / times
        covered[j] = 1.0
    scale = 1 / float(covered.min())
    return [(dict(c), u * scale) for c, u in uses.items()]


def length_classes(histogram: dict[int, int], most: int = CLASSES) -> list[list[int]]:
    """The lengths, longest first, in at most ``most`` groups of neighbours that take about equal room."""
    lengths = sorted((n for n, m in histogram.items() if m > 0), reverse=True)
    if len(lengths) <= most:
        return [[n] for n in lengths]
    groups: list[list[int]] = []
    share, held = 2 * sum(n * histogram[n] for n in lengths) / (most - 1), 0  # two neighbours have more than a share
    for n in lengths:
        size = n * histogram[n]
        if not groups or held + size > share:
            groups.append([])
            held = 0
        groups[-1].append(n)
        held += size
    return groups


def _exact(config: dict[int, int], members: dict[int, list[int]], left: dict[int, int], length: int) -> dict[int, int]:
    """Lengths that are left, and how often, for the places of a configuration of classes; empty if a class is used up.

    If they are shorter than their classes, the shortest one makes place for the longest that fit.
    """
    each: dict[int, int] = {}
    room = length
    for top, k in config.items():
        for n in members[top]:
            if k and (m := min(k, left[n])):
                each[n] = m
                k -= m
                room -= n * m
        if k:
            return {}
    if room > length - sum(top * k for top, k in config.items()):
        last = min(each)
        each[last] -= 1
        room += last
        for group in members.values():  # longest first
            for n in group:
                if n <= room and (m := min(room // n, left[n] - each.get(n, 0))) > 0:
                    each[n] = each.get(n, 0) + m
                    room -= n * m
    return {n: k for n, k in each.items() if k}


def packing_plan(histogram: dict[int, int], length: int = LENGTH, rounds: int = ROUNDS,
                 best_fit: dict[int, int] | None = None):
    """length -> [(first rank, rank after, first sequence, per sequence, offset)] and the number of sequences.

    The pieces of one length, in rank order, fill the runs of that length's list. ``best_fit`` gets the lengths,
    and how many, that no configuration has placed.
    """
    left = {n: m for n, m in histogram.items() if m > 0}
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list] = defaultdict(list)
    room_of: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first sequence, sequences)]
    rooms: list[int] = []
    sequences = 0

    def leave(room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if not room_of[room]:
                bisect.insort(rooms, room)
            room_of[room].append((first, count))

    def put(n: int, first: int, count: int, each: int, offset: int) -> None:
        runs[n].append((used[n], used[n] + count * each, first, each, offset))
        used[n] += count * each
        left[n] -= count * each

    if left.get(length):
        count = left[length]
        put(length, sequences, count, 1, 0)
        sequences += count
    open_ = {n: m for n, m in left.items() if m}
    members = {group[0]: group for group in length_classes(open_)}
    program = fractional({top: sum(open_[n] for n in group) for top, group in members.items()}, length, rounds)
    for config, use in sorted(program, key=lambda x: (-x[1], sorted(x[0].items()))):
        times = int(use)
        # the same exact lengths for as many sequences as they last
        while times > 0 and (each := _exact(config, members, left, length)):
            count, at = min([times, *(left[n] // k for n, k in each.items())]), 0
            for n, k in sorted(each.items(), reverse=True):
                put(n, sequences, count, k, at)
                at += n * k
            leave(length - at, sequences, count)
            sequences += count
            times -= count
    if best_fit is not None:
        best_fit.update({n: m for n, m in left.items() if m})
    for n in sorted(left, reverse=True):
        while left[n] > 0:
            k = bisect.bisect_left(rooms, n)
            if k == len(rooms):
                each = min(length // n, left[n])
                count = left[n] // each
                put(n, sequences, count, each, 0)
                leave(length - n * each, sequences, count)
                sequences += count
                continue
            room = rooms[k]
            first, count = room_of[room].pop()
            if not room_of[room]:
                rooms.pop(k)
            each = min(room // n, left[n])
            filled = min(count, left[n] // each)
            put(n, first, filled, each, length - room)
            leave(room - n * each, first, filled)
            leave(room, first + filled, count - filled)
    return dict(runs), sequences


def _placed_batches(batches, plan):
    import numpy as np
    import pyarrow as pa

    runs = {n: np.array(r, np.int64) for n, r in plan.value.items()}
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n in np.unique(lengths):
            here = lengths == n
            table = runs[int(n)]
            run = table[np.searchsorted(table[:, 0], ranks[here], side="right") - 1]
            within = ranks[here] - run[:, 0]
            sequence[here] = run[:, 2] + within // run[:, 3]
            offset[here] = run[:, 4] + within % run[:, 3] * n
        keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(keep + [pa.array(sequence), pa.array(offset)],
                                         ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, end_id: int = END_ID,
         rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = save(pieces(docs, length, path, end_id), "pieces")
    counts = save(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = packing_plan(histogram, length, rounds)
    shared = spark.sparkContext.broadcast(plan)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    # counts grow with tasks times lengths: joined by shuffles at every size, not broadcast
    ranked = cut.join(offsets.hint("shuffle_merge"), ["task", "length"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("ahead")).alias("rank"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        partial(_placed_batches, plan=shared),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
