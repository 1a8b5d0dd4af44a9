"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Random indexing: every word has a sparse ternary index vector drawn from its hash (its own plus one of its
shape: letters, digits and other characters in runs), and a word's vector is the sum of the index vectors
of its neighbours within WINDOW words, over every occurrence in the whole corpus. Words live in SLOTS
hashed slots, so the table has a fixed size; the sums are whole numbers, added per task and then per slot
by Spark, and don't depend on order. A document is the mean of its words' scaled vectors, the mean
absolute step between neighbouring words, and three counts (words, share of distinct words, share of
words equal to the one before). A network with one hidden layer, trained in numpy on at most
``most_labels`` labelled documents, gives a logit; a temperature fitted on a part of the labelled rows
that the network has not seen turns it into a probability.

Null text is empty and is scored like an empty text. A label is a non-null ``quality``; a document with
several labels counts with each. Without labels of both kinds every score is the share of good labels
(0.5 without any). Rows that repeat an id are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from lakestrata.llm.common import as_bytes, fold, save, small_batches, word_blocks

SLOTS, DIMS, NONZERO, WINDOW = 1 << 15, 32, 4, 2
HIDDEN, MOST_LABELS, THRESHOLD = 24, 30_000, 0.3
FOLDS, HELD_OUT = 5, 0
REMEMBERED = 700_000
EXTRA = 3
_CLASSES = bytes(ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128
                 else ord("0") if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def shape(word: bytes) -> bytes:
    """Runs of a word: A capitals, a small or non-ASCII letters, 0 digits, others as they are, once."""
    return _RUN.sub(rb"\1", word.translate(_CLASSES))[:8]


class Slots(dict):
    """Word -> its slot and its shape's slot, as one number."""

    def __missing__(self, word: bytes) -> int:
        found = (zlib.crc32(word) % SLOTS) * SLOTS + zlib.crc32(shape(word), 77) % SLOTS
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


#: The words that this Python worker knows already; tasks that it runs later start from them.
_KNOWN = Slots()


def index_vectors():
    """(SLOTS, DIMS) sparse ternary vectors, the same in every task."""
    import numpy as np

    rng = np.random.default_rng(4242)
    table = np.zeros((SLOTS, DIMS), np.int32)
    rows = np.arange(SLOTS)
    for k in range(NONZERO):
        table[rows, rng.integers(0, DIMS, SLOTS)] += np.where(rng.random(SLOTS) < 0.5, 1, -1)
    return table


def _neighbour_sums(values):
    """For each row the sum of the rows up to WINDOW before and after it."""
    import numpy as np

    total = np.zeros_like(values)
    for d in range(1, WINDOW + 1):
        total[d:] += values[:-d]
        total[:-d] += values[d:]
    return total


def _slot_blocks(data: bytes, slots: Slots):
    import numpy as np

    for block in word_blocks(data):
        if block:
            both = np.fromiter(map(slots.__getitem__, block), np.int64, len(block))
            yield both // SLOTS, both % SLOTS


def _indexed_batches(batches):
    """Per task: the neighbour sums and the count of every slot that it has seen."""
    import numpy as np
    import pyarrow as pa

    index, slots = index_vectors(), _KNOWN
    sums, counts = np.zeros((SLOTS, DIMS), np.int64), np.zeros(SLOTS, np.int64)
    for batch in small_batches(batches, 256):
        held, size = [], 0
        gap = (np.full(WINDOW, -1), np.zeros(WINDOW, np.int64))  # no neighbours across documents

        def flush():
            word, form = (np.concatenate(x) for x in zip(*held, strict=True))
            vectors = index[word] + index[form]
            vectors[word < 0] = 0
            around, real = _neighbour_sums(vectors), word >= 0
            for d in range(DIMS):
                sums[:, d] += np.bincount(word[real], weights=around[real, d], minlength=SLOTS).astype(np.int64)
            counts[:] += np.bincount(word[real], minlength=SLOTS)
            held.clear()

        for data in as_bytes(batch.column(0)):
            for word, form in _slot_blocks(data, slots):
                held.append((word, form))
                size += len(word)
                if size > 200_000:
                    flush()
                    size = 0
            held.append(gap)
        flush()
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), *[pa.array(sums[seen, d])
                                      for d in range(DIMS)]], ["slot", "n", *[f"v{d}" for d in range(DIMS)]])


def word_vectors(docs: DataFrame):
    """(SLOTS, DIMS) float32: the slots' neighbour sums over the whole table, each scaled to length one and
    frequent slots damped. SLOTS rows reach the driver, whatever the input."""
    import numpy as np

    columns = ["slot", "n", *[f"v{d}" for d in range(DIMS)]]
    parts = docs.select("text").mapInArrow(_indexed_batches, ", ".join(f"{c} long" for c in columns))
    rows = parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns[1:]]).toPandas()
    table = np.zeros((SLOTS, DIMS), np.float32)
    if len(rows):
        v = rows[columns[2:]].to_numpy(float)
        v /= np.maximum(1e-9, np.sqrt((v * v).sum(axis=1, keepdims=True)))
        n = rows["n"].to_numpy(float)
        table[rows["slot"].to_numpy()] = v * (1e-3 / (1e-3 + n / n.sum()))[:, None] ** 0.5
    return table


def _pooled_batches(batches, table):
    import numpy as np
    import pyarrow as pa

    vectors, slots = table.value, _KNOWN
    for batch in small_batches(batches, 512):
        pooled = []
        for data in as_bytes(batch.column("text")):
            mean, step, n, same, last, seen = np.zeros(DIMS), np.zeros(DIMS), 0, 0, None, set()
            for word, _ in _slot_blocks(data, slots):
                v = vectors[word]
                mean += v.sum(axis=0)
                step += np.abs(v[1:] - v[:-1]).sum(axis=0)
                same += int((word[1:] == word[:-1]).sum())
                if last is not None:
                    step += np.abs(vectors[last] - v[0])
                    same += int(last == word[0])
                last = word[-1]
                n += len(word)
                seen.update(np.unique(word).tolist())
            pooled.append(np.concatenate([mean / max(1, n), step / max(1, n - 1), [
                np.log1p(n), len(seen) / max(1, n), same / max(1, n - 1)]]))
        flat = pa.array(np.concatenate(pooled).astype(np.float32))
        width = 2 * DIMS + EXTRA
        offsets = pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.ListArray.from_arrays(offsets, flat)],
                                         ["row", "features"])


def pooled(rows: DataFrame, table) -> DataFrame:
    """``rows`` (row: any struct, text) -> row, features (array<float>)."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    schema = rows.select("row").schema.add("features", ArrayType(FloatType()))
    return rows.select("row", "text").mapInArrow(partial(_pooled_batches, table=shared), schema)


class TwoLayers:
    """Standardised features -> tanh layer -> logit / temperature."""

    def __init__(self, x, y, seed: int = 3, epochs: int = 60, rate: float = 0.01, decay: float = 1e-3):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.prior, self.net, self.temperature = (float(y.mean()) if len(y) else 0.5), None, 1.0
        if len(set(y.tolist())) < 2:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = self._ready(x)
        kept = rng.random(len(x)) < 0.85  # the rest fits the temperature
        p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        first, second, step = [0 * a for a in p], [0 * a for a in p], 0
        xs, ys = x[kept], y[kept].astype(float)
        epochs = max(epochs, -(-600 * 64 // max(1, len(xs))))
        for _ in range(min(epochs, 400)):
            order = rng.permutation(len(xs))
            for k in range(0, len(xs), 64):
                step += 1
                a, t = xs[order[k:k + 64]], ys[order[k:k + 64]]
                h = np.tanh(a @ p[0] + p[1])
                e = (self._sigmoid(h @ p[2] + p[3]) - t) / len(a)
                back = np.outer(e, p[2]) * (1 - h * h)
                for i, g in enumerate([a.T @ back + decay * p[0], back.sum(axis=0), h.T @ e + decay * p[2], e.sum()]):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    p[i] = p[i] - rate * first[i] / (1 - 0.9 ** step) / (
                        np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        self.net = p
        logit, t = self._logit(x[~kept]), y[~kept]
        if len(t):
            def loss(temperature):
                q = np.clip(self._sigmoid(logit / temperature), 1e-6, 1 - 1e-6)
                return -(t * np.log(q) + (1 - t) * np.log(1 - q)).mean()

            self.temperature = float(min(np.geomspace(0.5, 8, 60), key=loss))

    @staticmethod
    def _sigmoid(z):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def _ready(self, x):
        import numpy as np

        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, ready):
        import numpy as np

        return np.tanh(ready @ self.net[0] + self.net[1]) @ self.net[2] + self.net[3]

    def scores(self, x):
        import numpy as np

        if self.net is None:
            return np.full(len(x), self.prior)
        return self._sigmoid(self._logit(self._ready(x)) / self.temperature)


def _scored_batches(batches, model):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        x = np.array(batch.column("features").flatten().to_numpy(zero_copy_only=False), float)
        scores = model.value.scores(x.reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])


def training_rows() -> Column:
    return fold(F.col("doc_id"), FOLDS) != HELD_OUT


def quality_scores(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score >= threshold).

    ``labels`` (doc_id, quality) of rows in the held-out fold are never read.
    """
    import numpy as np

    features = save(pooled(docs.select(F.struct("doc_id").alias("row"), "text"), word_vectors(docs)), "features")
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & training_rows()) \
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
    n = known.count()
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 11) / float(1 << 53)
    sample = features.select("row.doc_id", "features") \
        .join(known.where(drawn < min(1.0, most_labels / max(1, n))), "doc_id") \
        .select("doc_id", "quality", "features").limit(2 * most_labels).toPandas() \
        .sort_values(["doc_id", "quality"], kind="stable")
    x = np.array(sample["features"].tolist(), float).reshape(len(sample), 2 * DIMS + EXTRA)
    model = TwoLayers(x, sample["quality"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = features.select("row").schema.add("score", "double")
    scored = features.mapInArrow(partial(_scored_batches, model=shared), schema)
    return scored.select("row.doc_id", (fold(F.col("row.doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
