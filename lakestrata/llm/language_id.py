"""Language identification with a byte convolutional network, trained here in numpy.

A text's UTF-8 bytes are cut into windows of fixed length that cover it whole. Bytes are embedded,
filters of several widths slide over a window, each filter's greatest response is kept (max pooling over
the window, then ReLU) and a softmax layer turns the responses into language probabilities. A document's
probabilities are the mean over its windows, weighted by their bytes.

Training reads at most ``per_language`` rows of each language, chosen by a hash over all labelled rows,
and ``windows`` windows of each, spread evenly over its text. The model's size is fixed, so every task
gets a copy.

Null texts and texts without a letter are ``und`` with score 0; so is everything if no row is labelled.
Rows that repeat an id are rows of their own; null ids stay null. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import as_bytes, fold, named, small_batches

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
#: Bounds of the training sample: rows of a language, windows of a row.
PER_LANGUAGE, WINDOWS = 1500, 3
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


class ByteCnn:
    """Embedding, one bank of filters of several widths, max pooling, softmax. Byte 0 is padding."""

    def __init__(self, labels: list[str], seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.labels, span = list(labels), max(WIDTHS)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        # a narrower filter is a wide one whose last taps are zero, so one product serves all widths
        self.taps = np.concatenate([np.repeat([[k < w] for k in range(span)], FILTERS, axis=1) for w in WIDTHS],
                                   axis=1).repeat(EMBED, axis=0).astype(np.float32)
        self.filters = (rng.normal(0, 0.2, self.taps.shape) * self.taps).astype(np.float32)
        self.bias = np.zeros(self.taps.shape[1], np.float32)
        self.out = rng.normal(0, 0.1, (self.taps.shape[1], len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def _patches(self, x):
        import numpy as np

        span = max(WIDTHS)
        e = self.embed[x]
        cut = np.lib.stride_tricks.sliding_window_view(e, span, axis=1)  # rows, places, embed, span
        return np.ascontiguousarray(cut.transpose(0, 1, 3, 2)).reshape(len(x), x.shape[1] - span + 1, span * EMBED)

    def probabilities(self, x, rows: int = 64):
        """Windows (n, WINDOW) of bytes -> (n, labels); a few rows at a time, so a batch stays in cache."""
        import numpy as np

        found = []
        for k in range(0, len(x), rows):
            part = self._patches(x[k:k + rows])
            n, places, width = part.shape
            pooled = (part.reshape(-1, width) @ self.filters).reshape(n, places, -1).max(axis=1)
            found.append(self._softmax(np.maximum(pooled + self.bias, 0)))
        return np.concatenate(found) if found else np.zeros((0, len(self.labels)), np.float32)

    def _softmax(self, hidden):
        import numpy as np

        z = hidden @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, x, y, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> ByteCnn:
        import numpy as np

        rng = np.random.default_rng(seed)
        names = ("embed", "filters", "bias", "out", "out_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        step, span = 0, max(WIDTHS)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                step += 1
                rows = order[k:k + batch]
                part = self._patches(x[rows])
                n, places, width = part.shape
                raw = (part.reshape(-1, width) @ self.filters).reshape(n, places, -1)
                where = raw.argmax(axis=1)
                pooled = np.take_along_axis(raw, where[:, None, :], axis=1)[:, 0] + self.bias
                hidden = np.maximum(pooled, 0)
                slope = self._softmax(hidden)
                slope[np.arange(n), y[rows]] -= 1
                slope /= n
                back = (slope @ self.out.T) * (pooled > 0)
                chosen = part[np.arange(n)[:, None], where]  # rows, filters, span * embed
                to_patch = back[:, :, None] * self.filters.T[None]
                embed = np.zeros_like(self.embed)
                at = where[:, :, None] + np.arange(span)
                np.add.at(embed, x[rows][np.arange(n)[:, None, None], at],
                          to_patch.reshape(n, -1, span, EMBED))
                embed[0] = 0
                slopes = {"embed": embed, "filters": np.einsum("nf,nfw->wf", back, chosen) * self.taps,
                          "bias": back.sum(axis=0), "out": hidden.T @ slope, "out_bias": slope.sum(axis=0)}
                for name, g in slopes.items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    move = first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-7)
                    setattr(self, name, (getattr(self, name) - rate * move).astype(np.float32))
        return self


def windows_of(data: bytes, window: int = WINDOW):
    """All windows of a text, (n, window) bytes, the last one padded with zeros."""
    import numpy as np

    n = max(1, -(-len(data) // window))
    return np.frombuffer(data.ljust(n * window, b"\0"), np.uint8).reshape(n, window)


def train_language_model(docs: DataFrame, per_language: int = PER_LANGUAGE, windows: int = WINDOWS,
                         learn: Column | None = None) -> ByteCnn | None:
    """A model from rows with a non-null ``lang`` and ``learn`` (default: all), or None without any."""
    import numpy as np

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows if learn is None else rows.where(learn)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(99), "doc_id", "text"), 11) / float(1 << 53)
    data = F.col("text").cast("binary")
    size = F.length(data)
    cuts = [F.substring(data, F.greatest(F.lit(1), (size - WINDOW) * k / max(1, windows - 1) + 1).cast("int"),
                        F.lit(WINDOW)) for k in range(windows)]
    sample = rows.where(drawn < share).select("lang", *[c.alias(f"w{k}") for k, c in enumerate(cuts)]) \
        .limit(2 * per_language * len(counts)).collect()
    labels = sorted(counts)
    seen = sorted({(labels.index(r["lang"]), bytes(w)) for r in sample for w in r[1:]})
    if not seen:
        return None
    x = np.concatenate([windows_of(w)[:1] for _, w in seen])
    y = np.array([k for k, _ in seen])
    return ByteCnn(labels).train(x, y)


def _predicted_batches(batches, model, keep):
    import numpy as np
    import pyarrow as pa

    net = model.value
    for batch in small_batches(batches, 256):
        texts, letters = as_bytes(batch.column("__text")), batch.column("__letter").to_pylist()
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        todo = [k for k, has in enumerate(letters) if has and net is not None]
        sums = np.zeros((len(texts), len(net.labels) if net else 1))
        # a very long text is handled some megabytes at a time
        held, owner, held_bytes = [], [], 0

        def flush():
            if held:
                x = np.concatenate(held)
                weight = np.maximum(1, (x != 0).sum(axis=1))
                np.add.at(sums, np.concatenate(owner), net.probabilities(x) * weight[:, None])
            held.clear()
            owner.clear()

        for k in todo:
            for at in range(0, max(1, len(texts[k])), 1 << 22):
                cut = windows_of(texts[k][at:at + (1 << 22)])
                held.append(cut)
                owner.append(np.full(len(cut), k))
                held_bytes += cut.size
                if held_bytes > 1 << 21:
                    flush()
                    held_bytes = 0
        flush()
        for k in todo:
            best = int(sums[k].argmax())
            names[k], scores[k] = net.labels[best], float(sums[k][best] / sums[k].sum())
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(names, pa.string()),
                                          pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])


def predict_language(rows: DataFrame, model: ByteCnn | None) -> DataFrame:
    """``rows`` (row: any struct, text) -> row, lang_pred, score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    ready = rows.select("row", F.col("text").alias("__text"),
                        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    schema = ready.select("row").schema.add("lang_pred", "string").add("score", "double")
    return ready.mapInArrow(partial(_predicted_batches, model=shared, keep=["row"]), schema)


def training_rows() -> Column:
    return fold(F.col("doc_id"), FOLDS) != HELD_OUT


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score; learns from the rows not held out."""
    model = train_language_model(docs, per_language, learn=training_rows())
    found = predict_language(docs.select(F.struct("doc_id").alias("row"), "text"), model)
    return found.select("row.doc_id", (fold(F.col("row.doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                        "lang_pred", "score")


def identified(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``, with the columns of ``docs``."""
    model = train_language_model(docs, learn=training_rows())
    names = [f"c{k}" for k in range(len(docs.columns))]
    row = F.struct(*[named(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    found = predict_language(docs.select(row.alias("row"), "text"), model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)) \
        .select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names, strict=True)])
