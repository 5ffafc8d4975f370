"""Line dedup with two Bloom filters, one of keys seen once and one of keys seen twice.

Keys are hashed, and the filters are split by ranges of hashes: only the hashes move, eight bytes a key, to
the two filters of their range. A hash that is in ``twice`` when it comes again has been met three times,
so its key is suspected. Suspected hashes fill the filter that is broadcast. Just the suspected keys of a text
shuffle, to be counted exactly and to find the document that keeps them; false positives cost traffic, never a result.

The two filters have a number of bits that follows the table's bytes, without an upper limit; a task holds one range of
them, at most ``MOST_RANGE_BITS`` each. The one that is broadcast follows the number of suspected hashes up to
``most_bits``; with more of them than that more keys are counted exactly.

Defined cases: a null or empty text is one empty line; every row counts as a document, so fully
repeated rows count each, and rows that share the largest doc_id all keep their lines; a null
doc_id ranks below all others; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebar.llm.common import BLANKS, ascii_lower, stored, text_of

LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
MOST_BITS = 1 << 28
_BLOCK = 4096
#: Ranges the filters are split into, as long as a range has bits within the bounds: 8 KB to 16 MB a filter.
RANGES, LEAST_RANGE_BITS, MOST_RANGE_BITS = 512, 1 << 16, 1 << 27
#: Lines a task hashes before it sends their hashes; bits broadcast for a suspected hash.
SENT, _BITS_A_HASH = 1 << 18, 16


def line_keys(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """Distinct keys of a text's lines, without the short ones."""
    lines = F.split(text, "\n", -1)
    trimmed = F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS)))
    long_ones = F.filter(trimmed, lambda line: F.char_length(line) >= least_chars)
    return F.array_distinct(F.transform(long_ones, ascii_lower))


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places of each hash."""
    unsigned = hashes.view(np.uint64)
    return unsigned & np.uint64(bits - 1), (unsigned >> np.uint64(32)) & np.uint64(bits - 1)


def _holds(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1 > 0


def _put(bitmap: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))


def filter_bits(docs: DataFrame) -> int:
    """A bit for every 16 bytes of text, as a power of two."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << max(16, (total // 16).bit_length())


def repeated_hashes(hashes: DataFrame, bits: int, times: int) -> DataFrame:
    """``hash``: all that ``times`` (at most 3) rows of ``hashes`` have (arrays, distinct in a row), and few others."""
    range_bits = min(bits, max(LEAST_RANGE_BITS, min(MOST_RANGE_BITS, bits // RANGES)))
    depth = (bits // range_bits).bit_length() - 1

    def range_of(values: np.ndarray) -> np.ndarray:
        return (values.view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(values), np.int64)

    def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In their range; multiplied, as all hashes of a range begin alike."""
        return _places((values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), range_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct hashes of some lines with how often they came, a row a range."""
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            order = np.argsort(range_of(values), kind="stable")
            values, counts = values[order], np.minimum(counts[order], times).astype(np.int8)
            ranges, starts = np.unique(range_of(values), return_index=True)
            offsets = pa.array(np.append(starts, len(values)), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(values)),
                 pa.ListArray.from_arrays(offsets, pa.array(counts))],
                names=["range", "hashes", "counts"],
            )

        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            for part in np.array_split(flat, len(flat) // SENT + 1):
                if len(part):
                    held.append(part)
                    size += len(part)
                if size >= SENT:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a range follow one another, so a task holds the filters of one range."""
        once, twice = np.zeros(range_bits // 8, np.uint8), np.zeros(range_bits // 8, np.uint8)
        at = None
        for batch in batches:
            for here, given, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if here != at:
                    at = here
                    once[:], twice[:] = 0, 0
                values = given.values.to_numpy()
                a, b = places(values)
                met = (_holds(once, a) & _holds(once, b)).astype(np.int8) + (_holds(twice, a) & _holds(twice, b))
                met = met + counts.values.to_numpy()
                for spots in (a, b):
                    _put(once, spots)
                    _put(twice, spots[met >= 2])
                yield pa.RecordBatch.from_arrays([pa.array(values[met >= times], pa.int64())], names=["hash"])

    sent = hashes.mapInArrow(send, "range long, hashes array<long>, counts array<tinyint>")
    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(sift, "hash long").distinct()


def filter_of(hashes: DataFrame, bits: int) -> bytes:
    """A Bloom filter of the column ``hash``, filled by all tasks and merged block by block."""
    size = min(_BLOCK, bits // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for spots in _places(batch.column(0).to_numpy(), bits):
                _put(held, spots)
        blocks = np.flatnonzero(held.reshape(-1, size).any(axis=1))
        for part in np.array_split(blocks, max(1, len(blocks) // 512)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([held.reshape(-1, size)[k].tobytes() for k in part], pa.binary())],
                names=["block", "held"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block follow one another, so a task holds one block however many tasks have filled it."""
        block, held = None, np.zeros(size, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["block", "held"])

        for batch in batches:
            for place, given in zip(batch.column(0).to_pylist(), batch.column(1)):
                if place != block:
                    if block is not None:
                        yield done()
                    block = place
                    held[:] = 0
                held |= np.frombuffer(given.as_buffer(), np.uint8)
        if block is not None:
            yield done()

    filled = hashes.mapInArrow(fill, "block int, held binary")
    blocks = filled.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, held binary")
    whole = bytearray(bits // 8)  # at most most_bits / 8 bytes
    for row in blocks.collect():
        whole[row["block"] * size : (row["block"] + 1) * size] = row["held"]
    return bytes(whole)


def suspects_filter(hashes: DataFrame, bits: int, most_bits: int, times: int) -> tuple[bytes, int]:
    """A filter of at most ``most_bits`` that holds every hash of ``times`` rows, and its bits."""
    repeated = stored(repeated_hashes(hashes, bits, times), "repeated-lines")
    small = min(most_bits, 1 << max(16, (_BITS_A_HASH * repeated.count()).bit_length()))
    return filter_of(repeated, small), small


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of each document."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", text_of().alias("text")).withColumn("keys", line_keys(F.col("text"), least_chars))
    keyed = keyed.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
    # Two filters tell what is met for the third time; a lower threshold asks for less.
    held, bits = suspects_filter(keyed.select("hashes"), filter_bits(docs), most_bits, min(3, least_documents))
    shared = spark.sparkContext.broadcast(held)

    @F.pandas_udf("array<boolean>")
    def suspected(column: pd.Series) -> pd.Series:
        twice = np.frombuffer(shared.value, np.uint8)
        ends = np.cumsum(column.map(len).to_numpy(dtype=np.int64))
        flat = np.concatenate([np.asarray(x, np.int64) for x in column]) if len(column) else np.zeros(0, np.int64)
        a, b = _places(flat, bits)
        return pd.Series(np.split(_holds(twice, a) & _holds(twice, b), ends[:-1]))

    flagged = keyed.withColumn("flags", suspected("hashes"))
    suspects = F.filter("keys", lambda key, k: F.get("flags", k))
    looked = stored(
        flagged.select(
            "doc_id", F.xxhash64("text").alias("text_hash"),
            F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), "text", suspects.alias("suspects"),
        ),
        "line-suspects",
    )
    lines = looked.select("doc_id", "text_hash", F.explode("suspects").alias("key"))
    frequent = stored(
        lines.groupBy("key")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        .where(F.col("documents") >= least_documents)
        .select("key", "keeper"),
        "frequent-lines",
    )
    dropped = stored(
        lines.join(frequent, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("key").alias("dropped")),
        "dropped-lines",
    ).select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "dropped")

    @F.pandas_udf("n_dropped long, text string")
    def without(text: pd.Series, keys: pd.Series) -> pd.DataFrame:
        rows = []
        blanks = BLANKS.encode()
        for whole, given in zip(text, keys):
            if given is None:
                rows.append((0, whole))
                continue
            out = set(given)
            lines = whole.split("\n")
            kept = [line for line in lines if line.encode().strip(blanks).lower().decode() not in out]
            rows.append((len(lines) - len(kept), "\n".join(kept)))
        return pd.DataFrame(rows, columns=["n_dropped", "text"])

    suspicious = F.size("suspects") > 0
    clean = looked.where(~suspicious).select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), "text")
    joined = looked.where(suspicious).join(
        dropped, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left"
    )
    rest = joined.withColumn("result", without("text", "dropped")).select(
        "doc_id", "n_lines", "result.n_dropped", "result.text"
    )
    return clean.unionByName(rest)
