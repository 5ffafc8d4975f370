"""Helpers of the training-text operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.sources import workdir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\f\r"

#: most bits of a bitmap: 2 MB
MOST_BITS = 1 << 24

#: about as many bytes a Python task works on at once
PORTION_BYTES = 4 << 20

_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` alone would change other letters too."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again.

    Cuts the lineage, is computed once however often it is used, and lets Spark choose
    joins by its true size.
    """
    spark = frame.sparkSession
    path = workdir.new_folder(spark, name)
    frame.write.parquet(path)
    _written.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def mark() -> int:
    """A point to which ``clear`` goes back."""
    return len(_written)


def clear(spark: SparkSession, since: int, until: int) -> None:
    """Delete what ``stored`` has written between two marks; its readers must be done."""
    for path in _written[since:until]:
        workdir.remove(spark, path)
    del _written[since:until]


def _lane(hash_: Column, bits: int) -> Column:
    return F.floor(F.pmod(hash_, F.lit(bits)) / 64).cast("int")


def _bit(hash_: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hash_, F.lit(64)).cast("int"))


def bitmap(hashes: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """One row with an array of longs, ``b``, that has a bit for each ``hash``; and its size in bits.

    An early sieve for what is joined by equality afterwards. It reaches a filter as a scalar
    subquery, so it is computed once and nothing is shuffled.

    64 bits a hash or more, at most ``most_bits`` (2 MB): beyond that more places pass the sieve.
    """
    bits = min(most_bits, 1 << max(10, (64 * hashes.count()).bit_length()))
    lanes = hashes.groupBy(_lane(F.col("hash"), bits).alias("lane")).agg(F.bit_or(_bit(F.col("hash"))).alias("set"))
    every = hashes.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("lane"))
    filled = every.join(lanes, "lane", "left").select(F.struct("lane", F.coalesce("set", F.lit(0)).alias("set")).alias("l"))
    whole = filled.agg(F.array_sort(F.collect_list("l")).alias("l")).select(F.transform("l", lambda x: x.set).alias("b"))
    return stored(whole, "bitmap"), bits


def in_bitmap(bitmap_: Column, bits: int, hash_: Column) -> Column:
    return F.get(bitmap_, _lane(hash_, bits)).bitwiseAND(_bit(hash_)) != 0


def give_back() -> None:
    """Return memory that is free again to the system: a Python worker lives on, and holds it beside those of later tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)


def portions(batches: Iterator[pa.RecordBatch], size: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, or a row where that is larger.

    Spark cuts batches by rows, and what is made of a whole batch of long texts is many times its size. Memory
    that a batch has taken is given back when it is done, as a worker lives on for later tasks.
    """
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        give_back()


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Each group of rows with equal keys, from batches in which they follow one another."""
    key, held = None, []
    for batch in portions(batches):
        if not batch.num_rows:
            continue
        names = list(zip(*(batch.column(name).to_pylist() for name in keys)))
        starts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for start, stop in zip(starts, starts[1:]):
            if names[start] != key:
                if held:
                    yield key, pa.Table.from_batches(held)
                key, held = names[start], []
            held.append(batch.slice(start, stop - start))
    if held:
        yield key, pa.Table.from_batches(held)
