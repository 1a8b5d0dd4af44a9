"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are word counts. The sources, ordered by code point (null last), weigh 5, 2, 1 in turn and share the
words of the whole table; a target stops at ``epochs_cap`` times its source's size and the excess is
shared again by weight. A source first gives its complete epochs (all documents that often); the rest of
its target is drawn without replacement: every document has an exponential key, scaled by its quality
weight, and the documents of the source with the least keys fill the rest. The document at the edge of
the budget is taken if that ends nearer the target.

No source is ever sorted in one task: keys fall into logarithmic buckets whose sizes are summed per source; the
buckets before the one where the budget ends are taken whole, those after it not. That one is split into finer
buckets, and the one of these where the budget ends again, so a task sums at most a few thousand buckets of a
source, and orders only what falls into the last one. The documents themselves are not shuffled.

Null text has size zero and is taken zero times; null sources are a source of their own; rows that repeat
an id are rows of their own. Keys come from doc_id and text by a hash, so reruns agree. An empty table
gives an empty result. One row per source (not per document) passes through one task for the targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import ROW, fields, numbered, save, stored_rows, unpacked, without_space, words

WEIGHTS, EPOCHS_CAP, SEED = (5, 2, 1), 3, 20240229
#: A key's bucket has a digit a level: its doubling, then its place in that, FINE parts each time.
FINE, LEVELS = 4096, 3


def quality_weight(text: Column) -> Column:
    """Weight of a document from 0.05 to 1: the share of its characters (white space aside) that are letters
    or digits, to the fourth power."""
    chars = F.length(without_space(text))
    plain = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", ""))
    return F.greatest(F.lit(0.05), F.pow(F.when(chars > 0, plain / chars).otherwise(0.0), 4))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = EPOCHS_CAP) -> DataFrame:
    """source, source_size -> also target (double): the shares by weight, levelled at ``cap`` times the size.

    The levelling is closed: with the sources ordered by capacity per weight, those before the first one
    that a common level does not fill are at their cap, and the others get the level times their weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "rank")
    everything = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1) \
        .withColumn("weight", weight[F.col("rank") % len(weights)]) \
        .withColumn("cap", cap * F.col("source_size").cast("double")) \
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("weight").over(onward)
    levelled = ranked.withColumn("level", level) \
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level")))
                    .over(everything)["level"])
    return levelled.select("source", "source_size",
                           F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = EPOCHS_CAP, seed: int = SEED,
        weight: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ROW, doc_id, size, source_size, target, copies (int), taken (words)."""
    return _mix(numbered(docs), weights, cap, seed, weight)


def _digits(key: Column) -> list[Column]:
    """The bucket of a key as digits, coarsest first; their order is the keys' order."""
    place, out = F.log2(F.greatest(key, F.lit(1e-300))), []
    for _ in range(LEVELS):
        digit = F.floor(place)
        out.append(digit.cast("int"))
        place = (place - digit) * FINE
    return out


def _edges(drawn: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """``plan`` with the bucket of ``level`` where a source's budget ends, and the words ``ahead`` of it.

    Only documents in the bucket found at the level before are looked at.
    """
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    for k in range(level):
        same = same & (F.col(f"b{k}") == F.col(f"e{k}"))
    digit, until = F.col("digit"), F.col("until")
    sums = drawn.alias("d").join(plan.alias("p"), same) \
        .groupBy("p.source", F.col(f"b{level}").alias("digit"), "rest", "ahead").agg(F.sum("size").alias("words"))
    prefix = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    found = sums.withColumn("until", F.col("ahead") + F.sum("words").over(prefix)) \
        .groupBy("source").agg(F.min(F.when(until > F.col("rest"), F.struct(digit, (until - F.col("words")).alias("ahead")))).alias("edge"))
    merged = plan.alias("p").join(found.alias("f"), F.col("p.source").eqNullSafe(F.col("f.source")), "left")
    kept = [F.col(f"p.{c}") for c in plan.columns if c != "ahead"]
    return merged.select(*kept, F.col("edge.digit").alias(f"e{level}"), F.coalesce(F.col("edge.ahead"), F.lit(0)).alias("ahead"))


def _mix(docs: DataFrame, weights=WEIGHTS, cap: int = EPOCHS_CAP, seed: int = SEED,
         weight: Column | None = None) -> DataFrame:
    """mix() of ROW, ``doc_id``, ``text``, ``source``."""
    weight = quality_weight(F.col("text")) if weight is None else weight
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") + 0.5) / float(1 << 53)
    narrow = docs.select(ROW, "doc_id", F.col("source").cast("string").alias("source"),
                         F.size(words(F.col("text"))).cast("long").alias("size"),
                         (-F.ln(unit) / weight).alias("key"))
    drawn = save(narrow.select("*", *[d.alias(f"b{k}") for k, d in enumerate(_digits(F.col("key")))]), "mix")
    targets = source_targets(drawn.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = save(targets.withColumn("epochs", epochs.cast("int"))
                .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
                .withColumn("ahead", F.lit(0).cast("long")), "mix-plan")
    for level in range(LEVELS):
        plan = save(_edges(drawn, plan, level), "mix-plan")
    placed = drawn.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))) \
        .select(ROW, "doc_id", F.col("d.source").alias("source"), "size", "key", "source_size", "target", "epochs", "rest",
                "ahead", F.struct(*[f"b{k}" for k in range(LEVELS)]).alias("bucket"),
                F.when(F.col(f"e{LEVELS - 1}").isNotNull(), F.struct(*[F.col(f"e{k}").alias(f"b{k}") for k in range(LEVELS)]))
                .alias("edge"))
    # earlier buckets are taken whole and later ones not at all: only the budget's own bucket is put in order
    inside = Window.partitionBy("source").orderBy("key", "doc_id", ROW).rowsBetween(Window.unboundedPreceding, 0)
    at_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    end, rest = F.col("end"), F.col("rest")
    begin = end - F.col("size")
    ordered = placed.where(at_edge).withColumn("end", F.col("ahead") + F.sum("size").over(inside)) \
        .withColumn("extra", (end <= rest) | ((begin < rest) & (rest - begin >= end - rest))).drop("end")
    others = placed.where(~at_edge).withColumn("extra", F.coalesce(F.col("bucket") < F.col("edge"), F.lit(True)))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.when(F.col("extra"), 1).otherwise(0)).otherwise(0).cast("int")
    return others.union(ordered).withColumn("copies", copies).select(
        ROW, "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = EPOCHS_CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, with the columns of ``docs``."""
    rows = stored_rows(docs)
    taken = _mix(fields(rows, docs.columns, "doc_id", "text", "source"), weights, cap, seed) \
        .where("copies > 0").select(ROW, "copies")
    often = rows.join(taken, ROW).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpacked(often, docs.columns)
