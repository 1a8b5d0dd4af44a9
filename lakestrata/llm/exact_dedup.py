"""Exact dedup by content-defined chunk recipes. DataFrame functions only.

A text without its white space is cut where its content says so (a pair of characters after a least
length), every chunk gets an identifier, and a document becomes its ordered identifier list, its
recipe. An identifier is the chunk's 64-bit hash once the distinct chunk texts have shown that the hash
stands for one text only; chunks of a hash that stands for several texts get a number beside it. So each
distinct chunk text moves once, long documents never do, and documents are equal exactly if their
recipes are.

Null text is empty; empty texts are equal to each other. Rows that repeat a doc_id are rows of their
own: of a group exactly one row stays (longest original, then smallest doc_id, null ids last, then first
row). An empty table gives an empty result; other columns of the input are neither read nor clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import ROW, fields, numbered, save, stored_rows, unpacked, without_space

#: Least and greatest code points of a chunk, and the pair of characters after which a chunk may end.
LEAST, MOST = 512, 4096
BOUNDARY = "[b-dk-m0-4][e-gn-p5-9]"


def chunks(norm: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a normalised text, in order; together they are the whole text."""
    pattern = f"(?s).{{{least - 2},{most - 2}}}?{BOUNDARY}|.{{1,{most}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def exact_dedup(docs: DataFrame, hash_bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ROW, doc_id, keep_id, group_size, kept, text_sha256.

    ``hash_bits`` below 64 weakens the chunk hash (tests make hashes stand for several texts with it).
    """
    return _exact_dedup(numbered(docs).select(ROW, "doc_id", "text"), False, hash_bits, least, most)


def _exact_dedup(docs: DataFrame, stored: bool, hash_bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """exact_dedup() of ROW, ``doc_id``, ``text``; ``stored``: ROW is a stored column, the same in every scan."""
    mask = F.lit(-1 if hash_bits >= 64 else (1 << hash_bits) - 1).cast("long")

    def chunk_hash(c: Column) -> Column:
        return F.xxhash64(c).bitwiseAND(mask)

    rows = docs.select(ROW, "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"),
                       without_space(F.col("text")).alias("norm"))
    cut = rows.select(ROW, "doc_id", "n", "norm", chunks(F.col("norm"), least, most).alias("chunks"))
    recipes = save(cut.select(ROW, "doc_id", "n", F.sha2("norm", 256).alias("text_sha256"),
                              F.transform("chunks", chunk_hash).alias("recipe")), "recipes")

    # each distinct chunk text moves once; a hash seen with two texts is not an identifier by itself
    pieces = cut.select(F.explode("chunks").alias("c")).select(chunk_hash(F.col("c")).alias("h"), "c").distinct()
    shared = save(pieces.groupBy("h").count().where("count > 1").select("h"), "shared-hashes")
    if shared.isEmpty():
        named = recipes.withColumn("codes", F.array().cast("array<int>"))
    elif not stored:  # the rows are cut once more and matched by number
        return _exact_dedup(save(docs, "numbered"), True, hash_bits, least, most)
    else:
        named = recipes.join(_codes(cut, pieces, recipes, shared, chunk_hash), ROW, "left") \
            .withColumn("codes", F.coalesce("codes", F.array().cast("array<int>")))

    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW))
    groups = named.groupBy("recipe", "codes").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")) \
        .where("group_size > 1") \
        .select("recipe", "codes", "group_size", F.col("best.doc_id").alias("best_id"),
                F.col(f"best.{ROW}").alias("best_row"), F.xxhash64("recipe", "codes").alias("key"))
    # joined by one more key than the groups are partitioned by, so both sides are dealt anew and a group
    # of very many copies can be split
    joined = named.withColumn("key", F.xxhash64("recipe", "codes")).join(groups, ["key", "recipe", "codes"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(ROW, "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         (alone | (F.col(ROW) == F.col("best_row"))).alias("kept"), "text_sha256")


def _codes(cut: DataFrame, pieces: DataFrame, recipes: DataFrame, shared: DataFrame, chunk_hash) -> DataFrame:
    """ROW, codes for the rows with a chunk whose hash stands for several texts: the texts' numbers, in order."""
    variants = pieces.join(shared, "h", "left_semi").select(
        "h", "c", F.row_number().over(Window.partitionBy("h").orderBy("c")).alias("code"))
    affected = recipes.select(ROW, F.explode("recipe").alias("h")).join(shared, "h", "left_semi") \
        .select(ROW).distinct()
    return cut.join(affected, ROW, "left_semi").select(ROW, F.posexplode("chunks").alias("pos", "c")) \
        .select(ROW, "pos", "c", chunk_hash(F.col("c")).alias("h")).join(variants, ["h", "c"], "left") \
        .groupBy(ROW).agg(F.transform(F.array_sort(F.collect_list(F.struct(
            "pos", F.coalesce("code", F.lit(0)).alias("code")))), lambda e: e["code"]).alias("codes"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    rows = stored_rows(docs)
    kept = _exact_dedup(fields(rows, docs.columns, "doc_id", "text"), True).where("kept").select(ROW)
    return unpacked(rows.join(kept, ROW, "left_semi"), docs.columns)
