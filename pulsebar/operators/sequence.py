"""Numbers the rows of one second in arrival order, and keys rows by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.layout import KEYS_PER_SECOND

#: positions per chunk; bounds the rows one task has to sort together
SPAN = 1 << 16


def number_in_second(
    rows: DataFrame,
    scope: str = "topic",
    second: str = "epoch_s",
    lane: str = "partition",
    position: str = "offset",
    prior: DataFrame | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Add ``seq``: 0, 1, 2... within ``(scope, second)``, by ``(lane, position)``.

    A window over the second alone would put a busy second in one task, so the
    numbering has two levels. A second is cut into chunks of ``span``
    consecutive positions of a lane. Rows are numbered inside their chunk, which
    never holds more than ``span`` rows since a position occurs once per lane.
    What stands before a chunk comes from a running sum over chunk *counts*:
    partial counts are merged before the shuffle, and one second has at most
    ``last position / span`` chunks per lane. Only chunks with something
    before them are joined back, on the chunk, so the join is as even as the
    chunks are.

    ``prior`` may hold rows counted earlier: ``scope, second, n``.
    """
    key = [scope, second]
    piece = [*key, lane, "chunk"]
    chunk = F.call_function("div", F.col(position), F.lit(span).cast("bigint"))
    cut = rows.withColumn("chunk", chunk)

    before = (
        Window.partitionBy(*key)
        .orderBy(lane, "chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = cut.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select(*piece, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if prior is not None:
        bases = bases.join(prior.select(*key, F.col("n").alias("earlier")), key, "left").select(
            *piece, (F.col("base") + F.coalesce("earlier", F.lit(0))).alias("base")
        )
    bases = bases.where("base > 0")

    inside = Window.partitionBy(*piece).orderBy(position)
    numbered = cut.withColumn("place", F.row_number().over(inside) - 1)
    return (
        numbered.join(bases, piece, "left")
        .withColumn("seq", F.col("place") + F.coalesce("base", F.lit(0)))
        .drop("chunk", "place", "base")
        .select(*rows.columns, "seq")
    )


def with_row_key(numbered: DataFrame, second: str = "epoch_s") -> DataFrame:
    """Replace ``seq`` by ``row_key = second * 1000 + seq``."""
    key = F.col(second) * KEYS_PER_SECOND + F.col("seq")
    return numbered.withColumn("row_key", key).drop("seq")
