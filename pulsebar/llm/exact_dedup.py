"""Exact dedup by content-defined chunk recipes.

A text is cut where its own content says so (after a line or sentence end, within bounds), so equal
texts have equal chunks. A chunk's identifier is its 64-bit digest, with a rank added for the
digests that verification finds to stand for more than one content. Documents are then compared by
their ordered identifier lists. Chunk contents move once, merged before the shuffle; whole
documents never move.

Defined cases: null and empty texts are one group; a null doc_id ranks below all others; rows that
repeat both doc_id and text are all counted and share one decision; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import stored, text_of

LEAST, MOST = 512, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """``text`` cut after the first line or sentence end past ``least`` characters."""
    cut = rf"(?s)(?:.{{{least},{most}}}?(?:\n|[.!?]\s)|.{{1,{most}}})"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def digest(chunk: Column, bits: int = 64) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits) if bits < 64 else F.xxhash64(chunk)


def crowded_digests(docs: DataFrame, least: int, most: int, bits: int) -> DataFrame:
    """(digest) of those that stand for several contents: each distinct content is compared whole."""
    parts = docs.select(F.explode(chunks(text_of(), least, most)).alias("chunk"))
    return (
        parts.select(digest(F.col("chunk"), bits).alias("digest"), "chunk")
        .distinct()
        .groupBy("digest")
        .agg(F.count("*").alias("contents"))
        .where("contents > 1")
        .select("digest")
    )


def _ranked_recipes(docs: DataFrame, crowded: DataFrame, least: int, most: int, bits: int) -> DataFrame:
    """Recipes with ranks for crowded digests."""
    # The row number comes first: beside a generator it would number the generated rows.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").select(
        "row", "doc_id",
        F.sha2(text_of(), 256).alias("text_sha256"), F.xxhash64(text_of()).alias("text_hash"),
        F.posexplode_outer(chunks(text_of(), least, most)).alias("place", "chunk"),
    ).withColumn("digest", digest(F.col("chunk"), bits))
    contents = rows.select("digest", "chunk").join(crowded, "digest", "left_semi").distinct()
    ranks = contents.withColumn(
        "rank", F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))
    )
    return (
        rows.join(ranks, ["digest", "chunk"], "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("text_sha256").alias("text_sha256"),
            F.max("text_hash").alias("text_hash"),
            F.array_sort(F.collect_list(F.when(
                F.col("chunk").isNotNull(), F.struct("place", "digest", F.coalesce("rank", F.lit(0)).alias("rank"))
            ))).alias("parts"),
        )
        .select("doc_id", "text_sha256", "text_hash", F.transform("parts", lambda p: F.struct(p.digest, p.rank)).alias("recipe"))
    )


def recipes(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """doc_id, text_sha256, text_hash and the recipe, an ordered list of verified chunk identifiers."""
    crowded = stored(crowded_digests(docs, least, most, bits), "crowded-digests")
    if not crowded.isEmpty():
        return _ranked_recipes(docs, crowded, least, most, bits)
    return docs.select(
        "doc_id", F.sha2(text_of(), 256).alias("text_sha256"), F.xxhash64(text_of()).alias("text_hash"),
        F.transform(chunks(text_of(), least, most), lambda c: digest(c, bits)).alias("recipe"),
    )


def exact_groups(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """Each document with its group: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    Of equal texts the row with the largest doc_id stays.
    """
    listed = stored(recipes(docs, least, most, bits), "recipes")
    # Written, so that adaptive execution can split the join where one recipe has most rows.
    repeated = stored(
        listed.groupBy("recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "repeated-recipes",
    )
    joined = listed.join(repeated, "recipe", "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "text_hash",
    )
