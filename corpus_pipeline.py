"""The training-text pipeline: documents in, packed sequences out.

Each stage works on all that its predecessor kept, is written as Parquet to the shared folder, and is read
again as the next one's documents. All stages but the last return the columns of documents.

Decisions are joined to the documents by doc_id and text hash, null-safe, so documents that share only one
of the two are told apart. Of rows that repeat both, the exact stage keeps one.

Defined cases: a null text counts as empty and is judged like one; null doc_ids are matched by their text; an empty table
gives an empty one; texts are taken whole, however long; other columns of the documents, whatever
their names, come through unchanged up to packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.llm import common, decontaminate, exact_dedup, near_dedup, pack, quality


def _wrapped(docs: DataFrame, *more: Column) -> DataFrame:
    """The documents as one column, so that whatever columns they have cannot meet those of the stage."""
    return docs.select(F.struct(*docs.columns).alias("doc"), *more)


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The documents that have (left_semi), or don't have (left_anti), their key among ``keys``."""
    ids = keys.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).distinct()
    marked = _wrapped(docs, F.col("doc_id").alias("own_id"), F.xxhash64(common.text_of()).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("of_id")) & (F.col("own_hash") == F.col("of_hash"))
    return marked.join(ids, same, how).select("doc.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality: documents scored below the cut go. No shuffle."""
    trees = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = quality.score(_wrapped(docs, "text"), trees)
    return scored.where(F.col("score") >= quality.CUT).select("doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the largest doc_id stays."""
    groups = common.stored(exact_dedup.exact_groups(docs), "exact-groups")
    left = _matching(docs, groups.where("NOT kept"), "left_anti")
    again = groups.where("kept AND group_size > 1").groupBy("doc_id", "text_hash").count().where("count > 1")
    again = common.stored(again, "repeated-rows")
    if again.isEmpty():
        return left
    return _matching(left, again, "left_anti").unionByName(
        _matching(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of linked documents the smallest doc_id stays."""
    groups = near_dedup.near_groups(docs)
    return _matching(docs, groups.where("NOT kept"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a window of an item go."""
    found = decontaminate.contamination(docs, common.table(spark, sf_dir, "benchmark"))
    return _matching(docs, found.where("n_hit > 0"), "left_anti")


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: sequences of a power of two each, with their ids."""
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_all),
]

#: Trained trees, registers and tokenizers have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; what a stage has written goes when the next one's result is there."""
    docs = common.table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        begun = common.mark()
        result = stage(spark, docs, sf_dir)
        since = common.mark()
        docs = common.stored(result, f"stage-{name.replace(' ', '-')}")
        common.clear(spark, begun - min(number, 1), since)
    return docs
