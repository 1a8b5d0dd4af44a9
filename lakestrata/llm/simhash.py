"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: 64 bits over the XXH64 values of a text's word shingles. Pairs within ``radius`` bits are
found with masks built so that every such pair collides under at least one of them: bit i gets a vector
phi(i) of radius+1 bits, and mask v keeps the bits with <phi(i), v> = 1. Any ``radius`` vectors leave some
v orthogonal to all of them, and under that mask the differing bits vanish. Copies share a fingerprint,
so only distinct fingerprints enter the tables.

Small buckets are compared pair by pair. A bucket of many fingerprints is not: there, two fingerprints
at most two bits apart share a point at most one bit from both, so each fingerprint is dealt to itself
and its one-bit neighbours and linked with the least fingerprint of every such point. That finds the same
components exactly, with rows that grow with the bucket and not with its square.

Null text is empty; a text without words has fingerprint zero and is linked like any other. Rows that
repeat an id are rows of their own; component ids ignore null ids (null if a component has no other).
An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import ROW, as_bytes, fields, numbered, save, small_batches, stored_rows, unpacked, word_blocks
from lakestrata.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Buckets up to this many fingerprints are compared pair by pair, larger ones through shared points.
PAIRWISE = 48


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: A-Z lower-cased, word shingles joined by a space."""
    import numpy as np
    from xxhash import xxh64_intdigest

    ones, total, carry = np.zeros(64, np.int64), 0, []
    for block in word_blocks(data.lower()):
        seq = carry + block
        if len(seq) >= shingle:
            hashes = [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(seq[k:] for k in range(shingle)))]
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carry = seq[len(seq) - shingle + 1:] if len(seq) >= shingle else seq
    if not total:
        if not carry:
            return 0
        return xxh64_intdigest(b" ".join(carry), SEED)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches, shingle):
    import pyarrow as pa

    for batch in small_batches(batches):
        prints = [fingerprint(x, shingle) for x in as_bytes(batch.column(2))]
        signed = pa.array([p - (1 << 64) if p >> 63 else p for p in prints], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), signed], [ROW, "doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """ROW, doc_id, fp (the fingerprint as a signed long) of every row."""
    return _fingerprints(numbered(docs).select(ROW, "doc_id", "text"), shingle)


def _fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    return docs \
        .mapInArrow(partial(_fingerprint_batches, shingle=shingle),
                    f"{ROW} long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """2**(radius+1) - 1 masks; the non-zero vectors are dealt to the bits in turn, which balances the masks."""
    vectors = (1 << (radius + 1)) - 1
    phi = [1 + i % vectors for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (phi[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = RADIUS, pairwise: int = PAIRWISE) -> DataFrame:
    """Distinct fingerprints ``fp`` -> edges a, b whose components are those of "at most radius bits apart"."""
    if radius not in (1, 2):
        raise ValueError("buckets of many fingerprints are linked through shared points, for one or two bits")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for k, m in enumerate(masks)])
    dealt = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = dealt.groupBy("t", "key").count().where("count > 1")
    shared = save(dealt.join(sizes, ["t", "key"]), "buckets")

    def near(a, b):
        return (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= radius)

    small = shared.where(F.col("count") <= pairwise).groupBy("t", "key").agg(F.collect_list("fp").alias("f"))
    pairs = small.select(F.explode(F.flatten(F.transform("f", lambda a: F.transform(
        F.filter("f", lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("e")) \
        .select("e.a", "e.b")

    flips = F.array(*[F.array(*[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1], F.lit(0).cast("long"))
                      for m in masks])
    points = shared.where(F.col("count") > pairwise).select("t", "fp", F.explode(flips[F.col("t")]).alias("flip"))
    # a point has at most as many fingerprints as the mask leaves bits free, plus itself
    stars = points.groupBy("t", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")) \
        .agg(F.collect_set("fp").alias("f")).where(F.size("f") > 1) \
        .select(F.array_min("f").alias("a"), F.explode("f").alias("b"))
    if radius == 1:  # two fingerprints that share a point may be two bits apart
        stars = points.alias("p").where("flip <> 0") \
            .join(prints.select(F.col("fp").alias("q")), F.expr("p.fp ^ p.flip = q")) \
            .select(F.col("fp").alias("a"), F.col("q").alias("b"))
    return pairs.union(stars.where("a <> b")).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                       pairwise: int = PAIRWISE) -> DataFrame:
    """One row per row of ``docs``: ROW, doc_id, fp, component_id (least doc_id of the component), kept.

    ``kept`` marks one row of each component: its least doc_id (null last), then its first row.
    """
    return _simhash_components(numbered(docs).select(ROW, "doc_id", "text"), shingle, radius, pairwise)


def _simhash_components(docs: DataFrame, shingle: int, radius: int, pairwise: int = PAIRWISE) -> DataFrame:
    """simhash_components() of ROW, ``doc_id``, ``text``."""
    prints = save(_fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW))
    classes = save(prints.groupBy("fp").agg(first.alias("first")), "classes")
    linked = components(links(classes.select("fp"), radius, pairwise))
    labelled = save(classes.join(linked, F.col("fp") == F.col("node"), "left")
                    .select("fp", "first", F.coalesce("label", "fp").alias("label")), "labelled")
    heads = labelled.groupBy("label").agg(F.min("first").alias("head"))
    table = save(labelled.select("fp", "label").join(heads, "label")
                 .select("fp", F.col("head.doc_id").alias("component_id"), F.col(f"head.{ROW}").alias("head_row")),
                 "components")
    return prints.join(table, "fp").select(ROW, "doc_id", "fp", "component_id",
                                           (F.col(ROW) == F.col("head_row")).alias("kept"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with the columns of ``docs``."""
    rows = stored_rows(docs)
    kept = _simhash_components(fields(rows, docs.columns, "doc_id", "text"), shingle, radius).where("kept").select(ROW)
    return unpacked(rows.join(kept, ROW, "left_semi"), docs.columns)
