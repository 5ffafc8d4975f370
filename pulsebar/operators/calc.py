"""Combines, updates and reads the calculated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsebar.functions import clock
from pulsebar.layout import CALC_CELLS, CALC_SCHEMA, CALC_VALUES

_TYPES = {field.name: field.dataType for field in CALC_SCHEMA}


def combine(counts: DataFrame, prices: DataFrame) -> DataFrame:
    """Both series side by side: every bucket either of them has, gaps as 0.

    Both sides come hashed on ``key`` by their aggregates, so the join adds no
    shuffle.
    """
    both = counts.join(prices, "key", "full_outer")
    return both.na.fill(0, [name for name in both.columns if name != "key"])


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column a frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest(
    updates: DataFrame,
    key: str = "key",
    version: str = "version",
    values: tuple[str, ...] = CALC_VALUES,
) -> DataFrame:
    """The newest value of each cell of each key.

    A null is a cell the update did not write, so it hides no older value.
    ``version`` is one number, unique among a key's values of one cell; with
    numeric values all buffers are fixed width and the aggregate hashes.
    """
    newest = [
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col(version))).alias(name)
        for name in values
    ]
    return updates.groupBy(key).agg(*newest)


def history(calc: DataFrame, start: int, stop: int, zone: str = "UTC") -> DataFrame:
    """Buckets of ``[start, stop)`` in key order, gaps as 0, with local time."""
    shown = calc.where((F.col("key") >= start) & (F.col("key") < stop))
    return (
        shown.na.fill(0, [name for name in CALC_VALUES if name in calc.columns])
        .withColumn("date_time", clock.civil_time(F.col("key"), zone))
        .orderBy("key")
    )


def as_cells(table: DataFrame) -> DataFrame:
    """The calculated table as cells: ``row, columnFamily, qualifier, value``; nulls give none."""
    named = table.select(
        F.col("key").cast("string").alias("row"),
        *[F.col(column).cast("string").alias(name) for name, column in CALC_CELLS.items()],
    )
    long = named.unpivot("row", list(CALC_CELLS), "cell", "value").where("value IS NOT NULL")
    family, qualifier = F.split_part("cell", F.lit(":"), F.lit(1)), F.split_part("cell", F.lit(":"), F.lit(2))
    return long.select("row", family.alias("columnFamily"), qualifier.alias("qualifier"), "value")


def conform(frame: DataFrame) -> DataFrame:
    """``frame`` with exactly the columns and types of the calculated table."""
    return frame.select(*[
        (F.col(name) if name in frame.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in _TYPES.items()
    ])
