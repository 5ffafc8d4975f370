"""Wide rows to cells (one row per stored value) and back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsebar.layout import CELL_SCHEMA, Feed


def _texts(feed: Feed, columns: list[str]) -> dict[str, Column]:
    """Cell texts: of a number the text it came as, where the row has kept it."""

    def text(column: str) -> Column:
        own = F.col(column).cast("string")
        if column in feed.numbers and "texts" in columns:
            return F.when(F.col("texts").isNull(), own).otherwise(F.get(F.col("texts"), feed.numbers.index(column)))
        return own

    return {qualifier: text(column) for qualifier, column in feed.cells.items() if column in columns}


def melt(rows: DataFrame, feed: Feed, row: str = "row_key") -> DataFrame:
    """Cells of a feed's rows: ``row, columnFamily, qualifier, value``.

    A null is a cell that was never stored, so it gives no row.
    """
    texts = _texts(feed, rows.columns)
    wide = rows.select(
        F.col(row).cast("string").alias("row"),
        *[text.alias(qualifier) for qualifier, text in texts.items()],
    )
    return (
        wide.unpivot("row", list(texts), "qualifier", "value")
        .where("value IS NOT NULL")
        .select("row", F.lit(feed.family).alias("columnFamily"), "qualifier", "value")
    )


def cell_lines(rows: DataFrame, feed: Feed, row: str = "row_key") -> DataFrame:
    """Each row's cells as JSON text, one cell per line: ``row, lines``."""
    texts = _texts(feed, rows.columns)
    name = F.col(row).cast("string")
    lines = [
        F.when(
            text.isNotNull(),
            F.to_json(
                F.struct(
                    name.alias("row"),
                    F.lit(feed.family).alias("columnFamily"),
                    F.lit(qualifier).alias("qualifier"),
                    text.alias("value"),
                )
            ),
        )
        for qualifier, text in texts.items()
    ]
    return rows.select(name.alias("row"), F.concat_ws("\n", *lines).alias("lines"))


def _lines(stored: DataFrame, lines: str) -> DataFrame:
    return stored.select(F.explode(F.split(F.col(lines), "\n")).alias("line"))


def explode_lines(stored: DataFrame, lines: str = "lines") -> DataFrame:
    """Cells from newline-joined JSON text, read with a fixed schema."""
    line = _lines(stored, lines)
    return line.select(F.from_json("line", CELL_SCHEMA).alias("cell")).select("cell.*")


def _widened(kind: T.DataType) -> T.DataType:
    """The type a column of inferred type is read as: fractions as doubles, what is nothing or of several kinds as text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(field.name, _widened(field.dataType)) for field in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_widened(kind.elementType))
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return T.DoubleType() if isinstance(kind, T.DecimalType) and kind.scale else kind


def inferred_schema(stored: DataFrame, lines: str = "lines") -> T.StructType:
    """The schema that all lines of JSON objects fit; lines that are no objects say nothing.

    One aggregate that merges the schemas of lines, and then of tasks, over the lattice of JSON types: whole
    numbers, then fractions, then text, which also takes values of different kinds; objects merge field by field. Only the
    merged schema comes to the driver.
    """
    parsed = _lines(stored, lines).select(F.try_parse_json("line").alias("v"))
    objects = parsed.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")))
    found = objects.agg(F.schema_of_variant_agg("v").alias("schema")).first().schema
    if not found.startswith("OBJECT<"):
        return T.StructType()
    # a name in backticks may hold anything
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return _widened(T.DataType.fromDDL(ddl))


def explode_inferred(stored: DataFrame, lines: str = "lines") -> DataFrame:
    """Rows from newline-joined JSON text, read with the schema inferred from all of it."""
    schema = inferred_schema(stored, lines)
    return _lines(stored, lines).select(F.from_json("line", schema).alias("cell")).select("cell.*")


def widen(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """One row per ``row`` with a column per named qualifier, of which a row has one cell each.

    The cells of a row are collected in one hash aggregate; a maximum per qualifier would
    be sorted, since text does not fit its fixed buffers.
    """
    return (
        cells.where(F.col("qualifier").isin(qualifiers))
        .groupBy("row")
        .agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("qualifier", "value")))).alias("cells"))
        .select("row", *[F.col("cells")[name].alias(name) for name in qualifiers])
    )


def family_profile(cells: DataFrame) -> DataFrame:
    """Number of cells in each family."""
    return cells.groupBy("columnFamily").agg(F.count(F.lit(1)).alias("cells"))


def of_family(cells: DataFrame, family: str) -> DataFrame:
    """The cells of one family."""
    return cells.where(F.col("columnFamily") == family)
