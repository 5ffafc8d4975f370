"""Sharding by sampled splitters, under the law ``bytes``: shards of near equal size.

The key of a row is its text's hash, then its doc_id, so equal texts lie side by side. A sample
weighted by size gives the splitters: quantile boundaries of the keys. Rows are range-partitioned
by them and each range is summed; a range that is too full for one shard is subdivided at the exact
running size inside it, so a text that a third of all rows share spreads over several shards.
The sample has ``shards * per_shard`` rows on average, whatever the table's size; one range
is the most that a task sorts, of narrow rows.

Shards are cut where their bytes are full, so a group of equal texts lies in one shard unless an edge falls inside it;
near equal sizes go before whole groups.

Defined cases: a null text has size 16; a null doc_id sorts first; rows that repeat a key share
a range and are numbered in any order among themselves; an empty table gives none; texts count whole, however long; other columns are ignored
unless carried, under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import stored, text_of

OVERHEAD = 16
_LOWEST = -(2**63) + 1


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, the two parts of the key and the carried columns."""
    kept = [F.col(name).alias(f"carried_{name}") for name in carry]
    return docs.select(
        "doc_id",
        (F.octet_length(text_of()) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.xxhash64(text_of()).alias("key_text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key_id"),
        *kept,
    )


def splitters(rows: DataFrame, total: int, expected: int) -> list[tuple[int, int]]:
    """Keys of a sample in which a row's chance is in proportion to its size.

    ``expected`` bounds the mean number of keys; the draw is a hash of the key, so a lost
    task draws the same again.
    """
    draw = F.pmod(F.xxhash64("key_text", "key_id", F.lit("splitter")), F.lit(2**31)) / F.lit(2.0**31)
    drawn = rows.where(draw * F.lit(float(total)) < F.col("size") * F.lit(float(expected)))
    # One key a text and id; the sample is bounded by ``expected``.
    return sorted({(r[0], r[1]) for r in drawn.select("key_text", "key_id").distinct().collect() if r[0] > _LOWEST})


def range_of(bounds: list[tuple[int, int]]) -> Column:
    """How many splitters are not above the row's key, by binary search."""
    if not bounds:
        return F.lit(0)
    texts = F.expr("array(" + ",".join(f"{t}L" for t, _ in bounds) + ")")
    ids = F.expr("array(" + ",".join(f"{i}L" for _, i in bounds) + ")")
    steps = [2**k for k in reversed(range(len(bounds).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        to = at + step
        text, key = F.get(texts, to - 1), F.get(ids, to - 1)
        reached = (text < F.col("key_text")) | ((text == F.col("key_text")) & (key <= F.col("key_id")))
        return F.when(reached, to).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def assign(docs: DataFrame, shards: int = 40, per_shard: int = 64, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the carried columns.

    Only the law ``key`` knows what one more shard takes, so grown_shard is null here.
    """
    rows = sized(docs, carry)
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds = splitters(rows, total, shards * per_shard)
    ranged = rows.withColumn("range", range_of(bounds))
    # One row a range, so bounded by the sample; the running sums over them fit one task.
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range").orderBy("key_text", "key_id").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("bytes_before") + F.sum("size").over(inside) - F.col("size") / 2
    placed = stored(
        ranged.join(F.broadcast(starts), "range").select(
            *[c for c in rows.columns if c not in ("key_text", "key_id")],
            F.least(F.floor(middle * shards / max(total, 1)).cast("int"), F.lit(shards - 1)).alias("shard"),
            (F.col("rows_before") + F.count("*").over(inside) - 1).alias("place"),
        ),
        "placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # a row a shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"carried_{name}").alias(name) for name in carry],
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, carry: tuple[str, ...] = ("text",)) -> None:
    """Write the rows with their texts to one folder a shard, in slot order inside each file."""
    placed = assign(docs, shards, carry=carry)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
