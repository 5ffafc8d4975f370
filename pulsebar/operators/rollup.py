"""Counts and mean prices per time bucket.

Each is one aggregate over one scan. Spark merges partial results before the
shuffle, so a bucket that holds most of the rows costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebar.functions import clock
from pulsebar.functions.text import mentions
from pulsebar.layout import BUCKET_SECONDS, KEYWORDS, PAIR, TICK_CELLS, TICK_FAMILY


#: columns that add up when buckets are folded
SOCIAL_PARTS = ("messages", "btc", "bitcoin")
PRICE_PARTS = ("total", "n")


def _bucket(width: int) -> Column:
    return clock.bucket_start(F.col("epoch_s"), width).alias("key")


def keyword_counts(keywords: dict[str, str]) -> list[Column]:
    """One count per word of the rows whose text holds it."""
    return [F.count_if(mentions(F.col("text"), word)).alias(name) for name, word in keywords.items()]


def message_count(posts: DataFrame, width: int = BUCKET_SECONDS) -> DataFrame:
    """Posts per bucket."""
    return posts.groupBy(_bucket(width)).agg(F.count(F.lit(1)).alias("messages"))


def keyword_count(
    posts: DataFrame, keywords: dict[str, str] = KEYWORDS, width: int = BUCKET_SECONDS
) -> DataFrame:
    """Posts holding each word, per bucket; a bucket may count 0."""
    return posts.groupBy(_bucket(width)).agg(*keyword_counts(keywords))


def social(
    posts: DataFrame,
    keywords: dict[str, str] = KEYWORDS,
    width: int = BUCKET_SECONDS,
    keep: str = "matched",
) -> DataFrame:
    """Posts and posts per word in one pass.

    ``keep='matched'`` gives the buckets where every count is above zero, as an
    inner join of the separate counts would; ``keep='all'`` gives every bucket.
    """
    counts = posts.groupBy(_bucket(width)).agg(
        F.count(F.lit(1)).alias("messages"), *keyword_counts(keywords)
    )
    return matched(counts, keywords) if keep == "matched" else counts


def matched(counts: DataFrame, keywords: dict[str, str] = KEYWORDS) -> DataFrame:
    """The buckets where every word was found at least once."""
    return counts.where(reduce(lambda a, b: a & b, [F.col(name) > 0 for name in keywords]))


def price_parts(ticks: DataFrame, pair: str = PAIR, width: int = BUCKET_SECONDS) -> DataFrame:
    """What the mean price of a pair is made of, per bucket: ``total`` and ``n`` of the prices that are numbers, and the
    number of ticks (``counted``). Buckets add up to larger ones."""
    return ticks.where(F.col("pair") == pair).groupBy(_bucket(width)).agg(
        F.sum("last").alias("total"), F.count("last").alias("n"), F.count(F.lit(1)).alias("counted")
    )


def mean(parts: DataFrame) -> DataFrame:
    """Mean price per bucket; null where no price was a number."""
    return parts.select("key", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("last"))


def merged(parts: DataFrame, columns: list[str], width: int) -> DataFrame:
    """Buckets folded into buckets of ``width`` seconds, a multiple of theirs."""
    bucket = clock.bucket_start(F.col("key"), width).alias("key")
    return parts.groupBy(bucket).agg(*[F.sum(name).alias(name) for name in columns])


def price(ticks: DataFrame, pair: str = PAIR, width: int = BUCKET_SECONDS) -> DataFrame:
    """Mean last price of a pair per bucket; a price that is no number is left out."""
    return ticks.where(F.col("pair") == pair).groupBy(_bucket(width)).agg(F.avg("last").alias("last"))


def price_from_cells(cells: DataFrame, pair: str = PAIR, width: int = BUCKET_SECONDS) -> DataFrame:
    """The same mean from cells: the ``last`` cells of rows with a cell that
    holds the pair.

    Rows are put together by one aggregate on ``row``, which reads the cells
    once where a join of the cells with themselves would read them twice.
    """
    last = next(name for name, column in TICK_CELLS.items() if column == "last")
    value, is_last = F.col("value"), F.col("qualifier") == last
    second = clock.key_second(F.col("row").try_cast("bigint"))
    return (
        cells.where((F.col("columnFamily") == TICK_FAMILY) & (is_last | (value == pair)))
        .groupBy("row")
        .agg(
            F.bool_or(value == pair).alias("named"),
            F.bool_or(is_last).alias("priced"),
            F.max(F.when(is_last, value.try_cast("double"))).alias("price"),
        )
        .where("named AND priced")
        .groupBy(clock.bucket_start(second, width).alias("key"))
        .agg(F.avg("price").alias("last"))
    )
