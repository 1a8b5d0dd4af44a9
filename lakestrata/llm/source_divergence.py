"""How the word use of each source differs from its language and from the other sources of the language.

Terms are runs of letters (ASCII letters in lower case, and every character beyond ASCII). Tasks count them
with numpy, bucketed by length: a term of up to 8 bytes is one uint64 word, up to 16 bytes two, and both
buckets are radix-sorted and run-counted; longer terms go to buckets of doubling width that are sorted byte by
byte. The counts of a block of documents leave the task as (lang, source, term, count, documents); Spark adds
them up. A language keeps the terms that ``least_docs`` of its documents hold (every row is a document).

With V kept terms and N occurrences of them, a group gives a term the share
p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), in whole numbers, and two shares differ by
f = floor((p - q)^2 / (p + q)). Part ``pair`` adds f over all kept terms for every two sources of a language;
part ``term`` lists a source's terms that stand above the language. Pairs are counted in numpy by blocks of
terms and tiles of sources, so no task holds a language; terms that neither source of a pair has are added in
closed form.

Null text, lang and source count as empty. A language without kept terms has pairs of value 0 and no terms; a
source alone in its language has no pairs; repeated rows count each; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import as_bytes, save

LEAST_DOCS, TOP_TERMS, SCALE = 10, 10, 1_000_000_000
#: Bytes of text that are counted at once, sources a tile has, rows a block of terms has, cells of a matrix.
BLOCK_BYTES, TILE, BLOCK_ROWS, CELLS = 4 << 20, 128, 250_000, 1 << 21
_BETWEEN = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_COUNTS = "lang string, source string, term string, n long, docs long"


def _lower_table():
    import numpy as np

    byte = np.arange(256)
    letter = ((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)
    return np.where(byte >= 128, byte, np.where(letter, byte | 32, 0)).astype(np.uint8)


def radix_order(words: list):
    """Stable order of rows by their uint64 words, the first the most significant: counting sort by 16 bits."""
    import numpy as np

    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _windows(low, starts, lengths, width: int):
    """The bytes of terms as rows of ``width`` bytes, zeros behind the end."""
    import numpy as np

    rows = np.lib.stride_tricks.sliding_window_view(low, width)[starts]
    rows[np.arange(width) >= lengths[:, None]] = 0
    return rows


def _runs(rows, order, new_term, group, doc):
    """(bytes of term, group, occurrences, documents) of the sorted terms; documents are sorted by group."""
    import numpy as np

    group, doc = group[order], doc[order]
    new_run = new_term.copy()
    new_run[1:] |= group[1:] != group[:-1]
    new_doc = new_run.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_run)
    n = np.diff(np.append(at, len(order)))
    return rows[order[at]], group[at], n, np.add.reduceat(new_doc.astype(np.int64), at)


def count_terms(texts: list[bytes], groups):
    """Yields (term rows, group, occurrences, documents) by length bucket; ``groups`` ascends over the texts."""
    import numpy as np

    data = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    low = _lower_table()[data]
    edge = np.flatnonzero(np.diff((low != 0).astype(np.int8), prepend=0))
    starts, ends = edge[0::2], edge[1::2]
    lengths = ends - starts
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
    group = np.asarray(groups)[doc]
    width, least = 8, 0
    while len(lengths) and least < lengths.max():
        if width > 16:
            width = 1 << int(lengths[lengths > least].min() - 1).bit_length()
        here = np.flatnonzero((lengths > least) & (lengths <= width))
        if len(here):
            low = np.pad(low, (0, max(0, starts[here[-1]] + width - len(low))))
            rows = _windows(low, starts[here], lengths[here], width)
            new = np.ones(len(here), bool)
            if width <= 16:
                words = list(rows.view(">u8").astype(np.uint64).T)
                order = radix_order(words)
                new[1:] = np.logical_or.reduce([w[order][1:] != w[order][:-1] for w in words])
            else:
                key = rows.view(f"S{width}")[:, 0]
                order = np.argsort(key, kind="stable")
                new[1:] = key[order][1:] != key[order][:-1]
            yield _runs(rows, order, new, group[here], doc[here])
        least, width = width, width * 2


def _strings(rows):
    import numpy as np
    import pyarrow as pa

    rows = np.ascontiguousarray(rows)
    ends = np.cumsum(np.count_nonzero(rows, axis=1))
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(rows[rows != 0].tobytes()))
    return text.cast(pa.string())


def _long_text_counts(text: bytes, size: int) -> dict[bytes, int]:
    """Occurrences in one text longer than a block, in pieces cut between terms."""
    out: dict[bytes, int] = {}
    start = 0
    while start < len(text):
        hit = _BETWEEN.search(text, min(len(text), start + size))
        end = hit.start() if hit else len(text)
        for rows, _, n, _ in count_terms([text[start:end]], [0]):
            for term, k in zip(_strings(rows).to_pylist(), n.tolist(), strict=True):
                out[term] = out.get(term, 0) + k
        start = end
    return out


def _count_batches(batches, size: int):
    import numpy as np
    import pyarrow as pa

    def out(names, terms, group, n, docs):
        sides = [pa.array([names[g][k] for g in group.tolist()], pa.string()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*sides, terms, pa.array(n), pa.array(docs)],
                                          ["lang", "source", "term", "n", "docs"])

    def counted(block):
        block.sort(key=lambda x: x[0])
        names = sorted({k for k, _ in block})
        place = {k: i for i, k in enumerate(names)}
        for rows, group, n, docs in count_terms([t for _, t in block], [place[k] for k, _ in block]):
            for k in range(0, len(n), 50_000):
                cut = slice(k, k + 50_000)
                yield out(names, _strings(rows[cut]), group[cut], n[cut], docs[cut])

    block, held = [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            keys = zip(part["lang"].to_pylist(), part["source"].to_pylist(), strict=True)
            for key, text in zip(keys, as_bytes(part["text"]), strict=True):
                if len(text) > size:
                    found = _long_text_counts(text, size)
                    if found:
                        terms = pa.array(list(found), pa.string())
                        zeros = np.zeros(len(found), np.int64)
                        yield out([key], terms, zeros, np.array(list(found.values()), np.int64), zeros + 1)
                    continue
                block.append((key, text))
                held += len(text)
                if held > size:
                    yield from counted(block)
                    block, held = [], 0
    if block:
        yield from counted(block)


def term_counts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it): a row per term of each group."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return read.mapInArrow(partial(_count_batches, size=block_bytes), _COUNTS) \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE * (n + 2) / (total + 2 kept)), exact; null where nothing is kept."""
    top = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", top, F.nullif(total + 2 * kept, F.lit(0)).cast("decimal(20,0)"))
    return (whole + 1).cast("long")


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_table(table, cells: int):
    """The pairs of sources of one tile pair over one block of terms: sum of f, and the terms it covers.

    Rows without a term introduce a source and its share of an absent term.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["lang", "source", "item", "f", "terms", "absent"]
    intro = table.filter(pc.is_null(table["term"])).to_pylist()
    rows = table.filter(pc.is_valid(table["term"]))
    intro.sort(key=lambda r: (r["tile"] != r["tile_a"], r["source"]))
    lang, first, second = intro[0]["lang"], intro[0]["tile_a"], intro[0]["tile_b"]
    sources = [r["source"] for r in intro]
    absent = np.array([r["p"] or 0 for r in intro], np.int64)
    split = sum(r["tile"] == first for r in intro)
    place = {s: i for i, s in enumerate(sources)}
    coded = rows["term"].combine_chunks().dictionary_encode() if len(rows) else None
    width = len(coded.dictionary) if coded is not None else 0
    sums = np.zeros((len(sources), len(sources)), np.int64)
    if width:
        term = coded.indices.to_numpy()
        who = np.array([place[s] for s in rows["source"].to_pylist()], np.int64)
        p = rows["p"].combine_chunks().to_numpy()
        step = max(1, cells // len(sources))
        for low in range(0, width, step):
            here = (term >= low) & (term < low + step)
            grid = np.repeat(absent[:, None], min(step, width - low), axis=1)
            grid[who[here], term[here] - low] = p[here]
            for a in range(split):
                b = slice(a + 1 if first == second else split, None)
                gap = grid[b] - grid[a]
                sums[a, b] += (gap * gap // (grid[b] + grid[a])).sum(axis=1)
    out = []
    for a in range(split):
        for b in range(a + 1 if first == second else split, len(sources)):
            gap, both = int(absent[a] - absent[b]), int(absent[a] + absent[b])
            out.append((lang, sources[a], sources[b], int(sums[a, b]), width, gap * gap // both if both else 0))
    columns = list(zip(*out, strict=True)) or [[]] * 6
    kinds = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, tile: int = TILE,
                      block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module."""
    counts = save(term_counts(docs, block_bytes), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")) \
        .where(F.col("docs") >= least_docs).select("lang", "term", "of_lang")
    used = save(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = used.groupBy("lang", "term").agg(F.first("of_lang").alias("n")) \
        .groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    groups = texts.distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left") \
        .fillna(0, ["total", "kept", "lang_total"])
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    groups = save(groups.join(sizes, "lang").withColumn("tile", F.expr("pmod(xxhash64(source), tiles)").cast("int")),
                  "divergence-groups")

    placed = used.join(groups, ["lang", "source"]) \
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    ahead = placed.withColumn("q", share(F.col("of_lang"), F.col("lang_total"), F.col("kept"))) \
        .where((F.col("n") > 0) & (F.col("p") > F.col("q"))) \
        .select("lang", "source", F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))

    blocks = max(1, -(-used.count() // block_rows))
    both = F.explode(F.expr("transform(sequence(0, tiles - 1), t -> struct(least(t, tile) AS a, greatest(t, tile) AS b))"))
    narrow = ["lang", "source", "tile", "term", "p", "block", F.col("at.a").alias("tile_a"), F.col("at.b").alias("tile_b")]
    cells = placed.withColumn("block", F.expr(f"pmod(xxhash64(term), {blocks})").cast("int")) \
        .withColumn("at", both).select(*narrow)
    intro = groups.withColumn("term", F.lit(None).cast("string")) \
        .withColumn("p", share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))) \
        .withColumn("block", F.explode(F.expr(f"sequence(0, {blocks - 1})"))).withColumn("at", both).select(*narrow)
    pairs = cells.unionByName(intro).groupBy("lang", "tile_a", "tile_b", "block") \
        .applyInArrow(lambda table: _pair_table(table, CELLS),
                      "lang string, source string, item string, f long, terms long, absent long") \
        .groupBy("lang", "source", "item").agg(F.sum("f").alias("f"), F.sum("terms").alias("terms"),
                                               F.max("absent").alias("absent")) \
        .join(groups.groupBy("lang").agg(F.max("kept").alias("kept")), "lang") \
        .withColumn("value", F.col("f") + (F.col("kept") - F.col("terms")) * F.col("absent"))
    ways = F.explode(F.array(F.struct(F.col("source").alias("a"), F.col("item").alias("b")),
                             F.struct(F.col("item").alias("a"), F.col("source").alias("b"))))
    pairs = pairs.select("lang", "value", ways.alias("way")) \
        .select("lang", F.col("way.a").alias("source"), F.col("way.b").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    listed = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order)).select(*listed) \
        .unionByName(ahead.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(order))
                     .where(F.col("rank") <= top).select(*listed))
