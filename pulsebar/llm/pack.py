"""Packing by power-of-two decomposition.

A document's ids, closed by the end id, are cut into pieces whose lengths are powers of two: as many
of the full length as fit, then one for each set bit of the rest, longest first. Pieces of one
length form a bucket, and each piece is a sequence of its own, so none crosses documents and none
is padded. Nothing is shuffled.

Defined cases: a null or empty text has the end id alone, one piece of length 1; repeated rows are
packed each; an empty table gives none; a run of blanks too long for tiktoken's pattern engine (about
a million) is encoded by tokenizers, from the .json vocabulary beside the ranks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsebar.llm.common import portions

LONGEST, END_ID = 2048, 1
_BATCH_BYTES = 8 << 20
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long"


def encoder(ranks_path: str, pattern: str, end_of_text: int):
    """text -> array of unsigned 32-bit ids, by a byte-level BPE vocabulary."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding(
        "packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": end_of_text}
    )

    @cache
    def slower() -> Tokenizer:
        return Tokenizer.from_file(f"{ranks_path.removesuffix('.tiktoken')}.json")

    def encode(text: str) -> np.ndarray:
        try:
            return coding.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the pattern's stack is used up by a long run of blanks
            return np.asarray(slower().encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Full pieces, then the powers of two that add up to the rest, longest first."""
    full, rest = divmod(tokens, longest)
    return [longest] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pieces(
    docs: DataFrame, ranks_path: str, pattern: str, end_of_text: int = 50256,
    end_id: int = END_ID, longest: int = LONGEST,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, one row a piece."""
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def batch(doc_ids: list, held: list[np.ndarray]) -> pa.RecordBatch:
        """Pieces of some documents. The ids stay in one buffer; pieces are offsets into it."""
        tokens = np.asarray([len(ids) for ids in held], dtype=np.int64)
        sizes = [lengths(n, longest) for n in tokens.tolist()]
        counts = np.asarray([len(s) for s in sizes], dtype=np.int64)
        length = np.fromiter(chain.from_iterable(sizes), np.int64, counts.sum())
        stop = np.cumsum(length)
        start = stop - length - np.repeat(np.cumsum(tokens) - tokens, counts)
        offsets = np.concatenate([[0], 4 * stop]).astype(np.int32)
        ids = np.concatenate(held).astype("<u4", copy=False)
        binary = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        of_doc = pa.array(np.repeat(np.arange(len(held)), counts))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()).take(of_doc), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             binary, pa.array(np.repeat(tokens, counts))],
            names=["doc_id", "start", "length", "ids", "doc_tokens"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern, end_of_text)
        end = np.asarray([end_id], dtype=np.uint32)
        doc_ids, held, size = [], [], 0
        for given in portions(batches):
            for doc_id, text in zip(given.column(0).to_pylist(), given.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                doc_ids.append(doc_id)
                held.append(ids)
                size += ids.nbytes
                if size > _BATCH_BYTES:
                    yield batch(doc_ids, held)
                    doc_ids, held, size = [], [], 0
        if held:
            yield batch(doc_ids, held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _SCHEMA)


def pack(docs: DataFrame, ranks_path: str, pattern: str, **options) -> DataFrame:
    """The pieces with their bucket (length), sequence_id and offset."""
    return pieces(docs, ranks_path, pattern, **options).select(
        "*", F.col("length").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder of sequences a length."""
    packed.repartition("bucket", F.pmod("sequence_id", F.lit(64))).write.partitionBy("bucket").parquet(path)
