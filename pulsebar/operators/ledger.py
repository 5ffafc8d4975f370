"""Which offsets of a topic have been looked at, as ranges: ``topic, partition, start, stop``, both ends included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.operators.sequence import SPAN

LANE = ["topic", "partition"]
#: offsets per cell in which messages meet ranges, which are half as many at most
CELL = 1 << 10


def _place(offset: Column, size: int) -> Column:
    """The number of the piece of ``size`` offsets that holds an offset."""
    wide = F.lit(size).cast("bigint")
    return F.call_function("div", offset - F.pmod(offset, wide), wide)


def intervals(messages: DataFrame, span: int = SPAN) -> DataFrame:
    """The offsets of messages as disjoint ranges, as few as there are gaps.

    Runs are found inside chunks of ``span`` offsets, so no task sorts a whole topic partition, and then
    joined over chunks, of which a run without gaps gives one row each.
    """
    offset = F.col("offset")
    piece = [*LANE, "chunk"]
    chunked = messages.select(*LANE, "offset", _place(offset, span).alias("chunk"))
    # an offset that occurs twice has one rank, so it stays in its run
    run = offset - F.dense_rank().over(Window.partitionBy(*piece).orderBy("offset"))
    runs = chunked.withColumn("run", run).groupBy(*piece, "run")
    return _over_chunks(runs.agg(F.min("offset").alias("start"), F.max("offset").alias("stop")), span)


def merged(ranges: DataFrame, span: int = SPAN) -> DataFrame:
    """The same offsets in the fewest ranges; those given may overlap or touch.

    A partition may have as many ranges as messages, so they are cut at the edges of chunks and merged inside
    them first.
    """
    first, last = _place(F.col("start"), span), _place(F.col("stop"), span)
    cut = ranges.select(*LANE, "start", "stop", F.explode_outer(F.sequence(first, last)).alias("chunk"))
    begin = F.col("chunk") * span
    inside = cut.select(
        *LANE, "chunk", F.greatest("start", begin).alias("start"), F.least("stop", begin + (span - 1)).alias("stop")
    )
    return _over_chunks(_runs(inside, [*LANE, "chunk"]), span)


def _runs(ranges: DataFrame, by: list[str]) -> DataFrame:
    """Ranges that overlap or touch, as one, among those that are equal in ``by``."""
    ordered = Window.partitionBy(*by).orderBy("start", "stop")
    reached = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("start") > reached + 1).cast("int"), F.lit(1))
    marked = ranges.select(*by, "start", "stop", begins.alias("begins"))
    grouped = marked.withColumn("run", F.sum("begins").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*by, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def _over_chunks(runs: DataFrame, span: int) -> DataFrame:
    """Runs of single chunks joined where they touch over an edge; only those at an edge, two a chunk, meet in one task."""
    begin = F.col("chunk") * span
    inner = (F.col("start") > begin) & (F.col("stop") < begin + (span - 1))
    return _runs(runs.withColumn("alone", F.when(inner, F.col("chunk"))), [*LANE, "alone"]).drop("alone")


def marked(messages: DataFrame, ranges: DataFrame, name: str = "again") -> DataFrame:
    """The messages with whether their offset is in one of the ranges, which are disjoint.

    They meet in cells of ``CELL`` offsets, so a message is held against the ranges of its cell alone, however many
    gaps its partition has.
    """
    cells = F.sequence(_place(F.col("start"), CELL), _place(F.col("stop"), CELL))
    inside = ranges.select(*LANE, "start", "stop", F.explode(cells).alias("cell"))
    known = inside.groupBy(*LANE, "cell").agg(F.collect_list(F.struct("start", "stop")).alias("known"))

    def holds(one: Column) -> Column:
        return F.col("offset").between(one["start"], one["stop"])

    seen = F.coalesce(F.exists("known", holds), F.lit(False))
    placed = messages.withColumn("cell", _place(F.col("offset"), CELL))
    return placed.join(known, [*LANE, "cell"], "left").select(*messages.columns, seen.alias(name))


def outside(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """The messages whose offset is in none of the ranges."""
    return marked(messages, ranges).where("NOT again").drop("again")
