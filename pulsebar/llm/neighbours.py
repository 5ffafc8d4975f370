"""Approximate nearest neighbours by multi-index hashing.

Largest inner product becomes nearest point once each vector gets one more component that brings all to the same length.
Codes are the signs of the centred vectors after rotations learned (ITQ) on a bounded sample. A code is cut into
substrings; of two codes within a Hamming radius, some substring pair is within its share of the radius, so probing each
substring's index within that share retrieves every code in the radius. What is retrieved is compared by whole
codes, and what is within the radius is ranked by the exact inner product of the original vectors.

The radius is learned, too: it holds 97 % of the true neighbours inside the sample, and in a larger table neighbours only
get nearer. Queries that find too few in it are searched among all rows, so none comes back short.

Where the index lies is decided by counted cost. With a small radius each substring value is a cell of one
shared index, rows go to a cell a substring and queries to the cells they probe. With a large one, where a
query would probe most cells, rows are dealt into blocks, each with its own substring index, and the queries go to all blocks.
Cells and blocks are split by their counted rows and queries, pairs are met inside tasks only, and a task
gives back as many rows a query as can be in the result. A pair that shares several cells counts in the first.

Equal vectors are one class, however many rows have them: a class is searched once and its smallest ids are put in its
place in the end, as many as a result can hold.

Defined cases: rows whose vector is null, empty or zero, or has a null or non-finite component, take no part, nor do those without
vec_id or of another length than most (of equally frequent lengths, the longest); rows that repeat a vec_id count once,
with the smallest of their vectors (by bytes); ties go to the smaller vec_id; an empty table, or a single row, gives no row;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from pulsebar.llm.common import stored

NEAREST, EVERY = 20, 20
BITS, PART = 128, 16
PARTS = BITS // PART
#: rows and bytes of the sample that rotations and radius are learned on, and its queries
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_QUERIES = 8192, 16 << 20, 256
HELD = 0.97
ROW_BLOCK, QUERY_BLOCK = 4096, 4096


@dataclass(frozen=True)
class Coder:
    """Codes of vectors: ``PARTS`` unsigned 16-bit substrings each."""

    rotation: np.ndarray
    centre: np.ndarray
    longest: float

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        length = np.linalg.norm(vectors, axis=1)
        if query:
            wide = np.column_stack([vectors * (self.longest / length)[:, None], np.zeros(len(vectors))])
        else:
            wide = np.column_stack([vectors, np.sqrt(np.maximum(self.longest**2 - length**2, 0))])
        return np.packbits((wide - self.centre) @ self.rotation > 0, axis=1).view(np.uint16)


def learn_rotation(wide: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Directions whose signs make the code, and the centre: principal components, rotated so signs lose least."""
    centre = wide.mean(axis=0)
    _, _, axes = np.linalg.svd(wide - centre, full_matrices=False)
    axes = axes[:BITS].T
    flat = (wide - centre) @ axes
    draws, found = np.random.default_rng(seed), []
    for _ in range(-(-BITS // axes.shape[1])):
        turn = np.linalg.qr(draws.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(20):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        found.append(axes @ turn)
    return np.hstack(found)[:, :BITS], centre


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn(vectors: np.ndarray, longest: float, nearest: int = NEAREST) -> tuple[Coder, int]:
    """The coder, and the radius that holds ``HELD`` of the true neighbours of the sample's queries."""
    length = np.linalg.norm(vectors, axis=1)
    coder = Coder(*learn_rotation(np.column_stack([vectors, np.sqrt(np.maximum(longest**2 - length**2, 0))])), longest)
    codes, asked = coder.codes(vectors, False), vectors[:SAMPLE_QUERIES]
    scores = asked @ vectors.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(nearest, len(vectors) - 1)]
    apart = _bits_apart(coder.codes(asked, True)[:, None, :], codes[near])
    return coder, int(np.ceil(np.quantile(apart, HELD))) if apart.size else BITS


def shares(radius: int) -> list[int]:
    """Each substring's part of a radius: codes within it agree within its part in some substring."""
    whole, rest = divmod(radius, PARTS)
    return [whole if part <= rest else whole - 1 for part in range(PARTS)]


def probes(radius: int) -> int:
    """Cells a query probes."""
    return sum(comb(PART, k) for share in shares(radius) for k in range(min(share, PART) + 1))


def shared_index_pays(rows: int, queries: int, radius: int) -> bool:
    """Whether cells cost less than blocks: in rows moved (a microsecond each), pairs met (forty nanoseconds)."""
    cells = probes(radius)
    by_cell = rows * PARTS + queries * cells + 0.04 * rows * queries * cells / 2**PART
    by_block = queries * rows / ROW_BLOCK + rows * queries / QUERY_BLOCK + 0.04 * rows * queries
    return by_cell < by_block


def _vectors(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def _valid(table: DataFrame, vector: str) -> tuple[DataFrame, type]:
    """vec_id and the vector as bytes, of the rows that take part."""
    single = isinstance(table.schema[vector].dataType.elementType, FloatType)
    kind = np.float32 if single else np.float64
    given = table.where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for vec_id, v in zip(batch.column(0), batch.column(1)):
                if v.is_valid and len(v) and v.values.null_count == 0:
                    x = v.values.to_numpy(zero_copy_only=False)
                    if np.isfinite(x).all() and x.any():
                        ids.append(vec_id.as_py())
                        found.append(x.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["vec_id", "v"])

    read = stored(given.mapInArrow(check, "vec_id long, v binary"), "vectors")
    lengths = read.groupBy(F.octet_length("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "size")).alias("m")).first().m
    if most is not None:
        read = read.where(F.octet_length("v") == most["size"])
    again = stored(read.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "repeated-ids")
    one = read.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return read.join(again, "vec_id", "left_anti").unionByName(one), kind


def _coded(rows: DataFrame, coder: Coder, kind: type, query: bool) -> DataFrame:
    """class, code and vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = coder.codes(_vectors(batch.column(1), kind), query)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([c.tobytes() for c in found], pa.binary()), batch.column(1)],
                    names=["class", "code", "v"],
                )

    return rows.select("vec_id", "v").mapInArrow(code, "class long, code binary, v binary")


def _cells(coded: DataFrame, reach: list[int] | None) -> DataFrame:
    """The rows under each cell (substring's number and value), or, of queries, under each cell they probe."""
    flips = [np.flatnonzero(np.bitwise_count(np.arange(2**PART, dtype=np.uint16)) <= k).astype(np.uint16) for k in reach or []]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                codes = np.frombuffer(b"".join(some.column(1).to_pylist()), np.uint16).reshape(-1, PARTS)
                for part in range(PARTS):
                    values = codes[:, part, None] ^ (flips[part][None, :] if flips else np.zeros((1, 1), np.uint16))
                    of = pa.array(np.repeat(np.arange(len(codes)), values.shape[1]))
                    cells = pa.array(values.ravel().astype(np.int64) + (part << PART))
                    yield pa.RecordBatch.from_arrays([cells, *[c.take(of) for c in some.columns]], names=["cell", "class", "code", "v"])

    return coded.mapInArrow(dealt, "cell long, class long, code binary, v binary")


def _near(rows: DataFrame, queries: DataFrame, radius: int, kind: type, nearest: int, cells: bool) -> DataFrame:
    """query, class, score: of each query's classes within the radius the nearest ones, one more than asked for."""
    reach = shares(radius)
    row_blocks, query_blocks = (F.ceil(F.col(n) / size).cast("int") for n, size in (("rows", ROW_BLOCK), ("queries", QUERY_BLOCK)))
    if cells:
        rows, queries = _cells(rows, None), _cells(queries, reach)
        counted = [x.groupBy("cell").agg(F.count(F.lit(1)).alias(name)) for x, name in ((rows, "rows"), (queries, "queries"))]
        sizes = stored(counted[0].join(counted[1], "cell").select(
            "cell", row_blocks.alias("row_blocks"), query_blocks.alias("query_blocks")
        ), "cells")
    else:
        whole = [F.lit(max(1, -(-x.count() // size))) for x, size in ((rows, ROW_BLOCK), (queries, QUERY_BLOCK))]

    def blocks(frame: DataFrame, own: str, other: str, asked: bool) -> DataFrame:
        if cells:
            frame = frame.join(sizes, "cell")
        else:
            frame = frame.select(F.lit(-1).cast("long").alias("cell"), "*", *[n.alias(f"{k}_blocks") for n, k in zip(whole, ("row", "query"))])
        mine = F.pmod(F.xxhash64("class"), F.col(f"{own}_blocks")).cast("int").alias(own)
        all_ = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other)
        return frame.select("cell", F.lit(asked).alias("asked"), "class", "code", "v", mine, all_).select(
            "cell", "row", "query", "asked", "class", "code", "v"
        )

    met = blocks(rows, "row", "query", False).unionByName(blocks(queries, "query", "row", True))
    met = met.repartition("cell", "row", "query").sortWithinPartitions("cell", "row", "query", "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index = None, [], None

        def build() -> tuple:
            classes = np.concatenate([b.column("class").to_numpy() for b in held])
            codes = np.frombuffer(b"".join(c for b in held for c in b.column("code").to_pylist()), np.uint16).reshape(-1, PARTS)
            vectors = np.concatenate([_vectors(b.column("v"), kind) for b in held])
            lists = [] if cells else [np.unique(codes[:, part], return_inverse=True) for part in range(PARTS)]
            return classes, codes, vectors, lists

        def answers(batch: pa.RecordBatch, cell: int) -> pa.RecordBatch:
            classes, codes, vectors, lists = index
            asked = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint16).reshape(-1, PARTS)
            out = ([], [], [])
            for query, code, vector in zip(batch.column("class").to_pylist(), asked, _vectors(batch.column("v"), kind)):
                if cells:
                    earlier = np.bitwise_count(codes[:, : cell >> PART] ^ code[: cell >> PART]) <= reach[: cell >> PART]
                    found = np.flatnonzero(~earlier.any(axis=1))
                else:
                    probed = np.zeros(len(codes), bool)
                    for part, (values, where) in enumerate(lists):
                        probed |= (np.bitwise_count(values ^ code[part]) <= reach[part])[where]
                    found = np.flatnonzero(probed)
                found = found[_bits_apart(codes[found], code) <= radius]
                scores = (vectors[found] * vector).sum(axis=1)
                if len(found) > nearest + 1:
                    least = np.partition(scores, -nearest - 1)[-nearest - 1]
                    best = np.flatnonzero(scores >= least)
                    best = best[np.lexsort((classes[found[best]], -scores[best]))[: nearest + 1]]
                    found, scores = found[best], scores[best]
                for column, values in zip(out, (np.full(len(found), query), classes[found], scores)):
                    column.append(values)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(column), type_) for column, type_ in zip(out, (pa.int64(), pa.int64(), pa.float64()))],
                names=["query", "class", "score"],
            )

        for batch in batches:
            spots = np.column_stack([batch.column(name).to_numpy() for name in ("cell", "row", "query")])
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(spots, axis=0) != 0).any(axis=1) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for start, stop in zip([0, *turns], [*turns, batch.num_rows]):
                if start == stop:
                    continue
                some, spot = batch.slice(start, stop - start), tuple(spots[start])
                if spot != key:
                    key, held, index = spot, [], None
                if not asked[start]:
                    held.append(some)
                elif held:
                    index = index or build()
                    yield answers(some, spot[0])

    found = met.mapInArrow(search, "query long, class long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    return found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= nearest + 1).drop("at")


def nearest_rows(
    table: DataFrame, vector: str = "embedding", every: int = EVERY, nearest: int = NEAREST, cells: bool | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``nearest`` other rows of each row whose vec_id ``every`` divides.

    ``cells`` forces the shared index (True) or blocks (False).
    """
    spark = table.sparkSession
    rows, kind = _valid(table, vector)
    rows = stored(rows, "rows")
    keys = rows.select("vec_id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    grouped = keys.groupBy("h1", "h2").agg(F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("n"))
    several = stored(grouped.where("n > 1").drop("n"), "copied")
    copies = stored(keys.join(several, ["h1", "h2"]).select("vec_id", "class"), "copies")
    classes = stored(rows.join(copies.where("vec_id <> class"), "vec_id", "left_anti"), "classes")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id").join(copies, "vec_id", "left")
    queries = stored(queries.select(F.col("vec_id").alias("query_id"), F.coalesce("class", "vec_id").alias("query")), "queries")

    schema = "query_id long, rank int, vec_id long, score double"
    first = classes.select("v").limit(1).collect()
    if not first:
        return spark.createDataFrame([], schema)
    size = np.dtype(kind).itemsize
    most = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * (len(first[0].v) // size))))
    sample = classes.orderBy(F.xxhash64(F.lit("sample"), "vec_id"), "vec_id").limit(most).select("v").collect()
    sample = np.frombuffer(b"".join(r.v for r in sample), kind).reshape(len(sample), -1).astype(np.float64)

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                norms = np.linalg.norm(_vectors(batch.column(0), kind), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([norms.max()]), pa.array([batch.num_rows], pa.int64())], names=["norm", "n"])

    total = classes.select("v").mapInArrow(longest, "norm double, n long").agg(F.max("norm").alias("norm"), F.sum("n").alias("n")).first()
    coder, radius = learn(sample, total.norm, nearest)

    asked = classes.join(queries.select(F.col("query").alias("vec_id")).distinct(), "vec_id", "left_semi")
    coded = stored(_coded(classes, coder, kind, False), "codes")
    asked = stored(_coded(asked, coder, kind, True), "query-codes")
    if cells is None:
        cells = shared_index_pays(total.n, asked.count(), radius)
    found = stored(_near(coded, asked, radius, kind, nearest, cells), "found")
    enough = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(nearest + 1, total.n)).select(F.col("query").alias("class"))
    short = stored(asked.join(enough, "class", "left_anti"), "short")
    if not short.isEmpty():
        wider = _near(coded, short, BITS, kind, nearest, False)
        found = found.join(short.select(F.col("class").alias("query")), "query", "left_anti").unionByName(wider)

    listed = Window.partitionBy("class").orderBy("vec_id")
    members = copies.withColumn("at", F.row_number().over(listed)).where(F.col("at") <= nearest + 1).drop("at")
    result = queries.join(found, "query").join(members, "class", "left").select(
        "query_id", F.coalesce("vec_id", "class").alias("vec_id"), "score"
    ).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = result.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
