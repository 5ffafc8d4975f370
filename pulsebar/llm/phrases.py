"""Phrase collocations by a weighted de Bruijn graph of words.

Per language, nodes are pairs of neighbouring words, and an edge (a b) -> (b c) is a triple with its number of
occurrences. Triples are all that is counted: each word of a piece gives one row, its triple or, at the end of the
piece, the pair or the single word that is left. Shorter counts follow from the graph. A pair occurs as
often as its node's edges together and the pieces that end in it; a word as often as the pairs that begin with
it together and the pieces that end in it.

Rows are counted per two million words inside tasks, then dealt by node, so triples, pairs and a task's share
of the words are summed behind one shuffle; only words are summed across tasks again. Nodes with more
than a 4,096th of all rows, so at most 4,096 of them, are found beforehand and dealt by their third word too.

What is frequent is small, and joined as tables: unary paths of the frequent graph (nodes with one edge in and
one out) are compacted by pointer doubling, so a passage that is repeated as a whole is one row. A pair inside a
path meets its longer phrases there; only the ends of paths are grouped by node.

Defined cases: a null text is empty and a null language is ``und``; empty texts and pieces count nothing; repeated rows
count each; texts of any length are read whole, in portions; an empty table gives none; extra columns are
ignored, whatever their names. Products are exact decimals of 38 digits, enough for counts up to 10^16.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import stored

LEAST, SHARE, BEST = 10, 50, 2000
MOST_HOT, SALTS, PARTS = 4096, 64, 64
#: words counted at once: three codes of them fit 63 bits
_WORDS = 2_000_000
_BYTES = 16 << 20
_ROWS = 100_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 32]] = 1
_CLASS[[ord(mark) for mark in ".,;:!?\n\x0b\x0c\r"]] = 2


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of some texts in order, and the number of the piece each stands in."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _CLASS[raw]
    marks = np.flatnonzero(kind == 2)
    inside = kind == 0
    del kind
    # places where a word begins or ends, by turns
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = turns[::2], turns[1::2] - turns[::2]
    piece = np.searchsorted(marks, starts).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))
    return words, piece


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, about 16 MB at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py().encode("utf-8", "surrogatepass")
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= _BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _triples(texts: list[bytes]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Portions of at most two million words: their vocabulary, a row a distinct triple with its three codes, and counts.

    Code 0 stands for the end of the piece; the others count from 1.
    """
    words, piece = _words(texts)
    for at in range(0, len(words), _WORDS):
        n = min(_WORDS, len(words) - at)
        coded = words.slice(at, n + 2).dictionary_encode()
        codes = np.zeros(n + 2, np.int32)
        own = np.full(n + 2, -1, np.int32)
        codes[: len(coded)] = coded.indices.to_numpy() + 1
        own[: len(coded)] = piece[at : at + n + 2]
        base = len(coded.dictionary) + 1
        keys = codes[:n].astype(np.int64)
        for ahead in (1, 2):
            keys *= base
            keys += np.where(own[ahead : n + ahead] == own[:n], codes[ahead : n + ahead], 0)
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.diff(first, append=n)
        rest = keys[first]
        rows = np.empty((3, len(first)), np.int32)
        for k in (2, 1):
            rest, rows[k] = np.divmod(rest, base)
        rows[0] = rest
        del keys, rest, first, own, codes
        yield coded.dictionary, rows, counts


def _strings(vocabulary: pa.Array, codes: np.ndarray) -> pa.Array:
    return vocabulary.take(pa.array(codes - 1, pa.int64(), mask=codes == 0)).cast(pa.string())


def _nodes(vocabulary: pa.Array, rows: np.ndarray) -> pa.Array:
    """First and second word, with a blank between; the first alone at the end of a piece."""
    first, second = (_strings(vocabulary, rows[k]) for k in (0, 1))
    return pc.binary_join_element_wise(first, second, " ", null_handling="skip")


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, node, rows, words: nodes with many rows in a portion; and the portion's totals, without node."""
    for lang, texts in _portions(batches):
        for vocabulary, rows, counts in _triples(texts):
            new = np.diff(rows[0], prepend=-1) != 0
            starts = np.flatnonzero(new | (np.diff(rows[1], prepend=-1) != 0))
            many = np.diff(starts, append=rows.shape[1])
            hot = many >= max(2, rows.shape[1] / (2 * MOST_HOT))
            nodes = _nodes(vocabulary, rows[:, starts[hot]]).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(nodes) + 1)), pa.array([*nodes, None], pa.string()),
                 pa.array([*many[hot], rows.shape[1]], pa.int64()), pa.array([*[0] * len(nodes), counts.sum()], pa.int64())],
                names=["lang", "node", "rows", "words"],
            )


def _counted(batches: Iterator[pa.RecordBatch], hot: dict[str, list[str]]) -> Iterator[pa.RecordBatch]:
    """lang, node, hot, next (null at the end of a piece), n."""
    for lang, texts in _portions(batches):
        crowded = pa.array(hot.get(lang, []), pa.string())
        for vocabulary, rows, counts in _triples(texts):
            for at in range(0, len(counts), _ROWS):
                some = rows[:, at : at + _ROWS]
                nodes = _nodes(vocabulary, some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(len(nodes), np.int8))), nodes, pc.is_in(nodes, crowded),
                     _strings(vocabulary, some[2]), pa.array(counts[at : at + _ROWS], pa.int64())],
                    names=["lang", "node", "hot", "next", "n"],
                )


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """lang, node, next, f of what occurs ``least`` times: words (one word as node), pairs, and triples (with next).

    And lang, n: the number of words.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    seen = texts.mapInArrow(_crowded, "lang string, node string, rows long, words long")
    seen = stored(seen.groupBy("lang", "node").agg(F.sum("rows").alias("rows"), F.sum("words").alias("words")), "crowded")
    totals = seen.where("node IS NULL")
    every = totals.agg(F.sum("rows")).first()[0] or 0
    crowded: dict[str, list[str]] = {}
    # at most MOST_HOT of them, as each has so large a share
    for row in seen.where(F.col("node").isNotNull() & (F.col("rows") * MOST_HOT >= every)).collect():
        crowded.setdefault(row.lang, []).append(row.node)

    rows = texts.mapInArrow(partial(_counted, hot=crowded), "lang string, node string, hot boolean, next string, n long")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("next"), F.lit(SALTS)).cast("int")).alias("salt")
    dealt = rows.select("lang", "node", salt, "next", "n").repartition("lang", "node", "salt")
    spot = ["lang", "node", "salt"]
    triples = dealt.groupBy(*spot, "next").agg(F.sum("n").alias("n"))
    # edges that are frequent, and the flow through each node
    flow = F.struct(F.lit(None).cast("string").alias("next"), "n")
    edge = F.struct("next", "n")
    kept = F.when(F.col("next").isNotNull() & (F.col("n") >= least), F.array(edge, flow)).otherwise(F.array(flow))
    nodes = triples.select(*spot, F.inline(kept)).groupBy(*spot, "next").agg(F.sum("n").alias("n"))
    # the same for words, whose sums go over all tasks; of a hot node all parts are needed
    word = F.struct(F.substring_index("node", " ", 1).alias("node"), F.lit(None).cast("string").alias("next"), "n")
    own = F.struct("node", "next", "n")
    pair = F.col("node").contains(" ") & ((F.col("n") >= least) | F.col("salt").isNotNull())
    parts = F.when(F.col("next").isNotNull(), F.array(own)).when(pair, F.array(word, own)).otherwise(F.array(word))
    summed = nodes.select("lang", F.inline(parts)).groupBy("lang", "node", "next").agg(F.sum("n").alias("f"))
    return stored(summed.where(F.col("f") >= least), "counts"), totals.select("lang", F.col("words").alias("n"))


def compacted(edges: DataFrame) -> DataFrame:
    """Unary paths of a graph with edges (lang, source, target, word, f): lang, source, and steps (target, word, f) in order.

    Each edge lies in one path. A path goes on through nodes with one edge in and one out. Pointers to the edge
    before are doubled until all have reached the first of their path; a ring is cut at edges whose number is
    the smallest of those before it.
    """
    known = stored(edges.withColumn("edge", F.monotonically_increasing_id()), "edges")
    into = known.groupBy("lang", F.col("target").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.max("edge").alias("before"))
    out = known.groupBy("lang", F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("m"), F.max("edge").alias("edge"))
    links = into.where("n = 1").join(out.where("m = 1"), ["lang", "node"]).select("edge", "before")
    at = stored(
        known.select("edge").join(links, "edge", "left")
        .select("edge", F.col("before").alias("to"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("edge").alias("low")),
        "pointers",
    )

    def doubled(at: DataFrame) -> DataFrame:
        # ``to`` is null for a first edge; the others end up pointing to one
        ahead = at.select(F.col("edge").alias("to"), F.col("to").alias("further"), F.col("steps").alias("more"), F.col("low").alias("lower"))
        met = at.join(ahead, "to", "left")
        return stored(met.select(
            "edge", F.coalesce("further", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.least("low", F.coalesce("lower", "low")).alias("low"),
            F.col("further").isNotNull().alias("open"),
        ), "pointers")

    def settled(at: DataFrame) -> tuple[DataFrame, int]:
        left = None
        while True:
            at = doubled(at)
            now = at.where("open").count()
            # of a path some edges arrive in every round, so if none does, rings are left
            if now == 0 or now == left:
                return at, now
            left = now

    at, left = settled(at)
    while left:
        ring = at.where("open").select("edge", (F.col("low") == F.col("edge")).alias("cut")).join(links, "edge")
        again = ring.select(
            "edge", F.when(~F.col("cut"), F.col("before")).alias("to"), F.when(F.col("cut"), 0).otherwise(1).cast("long").alias("steps"),
            F.col("edge").alias("low"),
        )
        rings, left = settled(stored(again, "rings"))
        at = at.where("NOT open").unionByName(rings)
    placed = known.join(at.select("edge", F.coalesce("to", "edge").alias("first"), "steps"), "edge")
    step = F.struct("steps", "target", "word", "f")
    source = F.max(F.when(F.col("steps") == 0, F.col("source"))).alias("source")
    paths = placed.groupBy("lang", "first").agg(source, F.array_sort(F.collect_list(step)).alias("s"))
    return paths.select("lang", "source", F.transform("s", lambda s: F.struct(s.target, s.word, s.f)).alias("steps"))


def _heaviest(paths: DataFrame) -> DataFrame:
    """lang, node, longer: of a node's edges the largest count."""
    n = F.size("steps")
    inner = F.transform(
        F.slice("steps", 1, n - 1), lambda s, k: F.struct(s.target.alias("node"), F.greatest(s.f, F.get(F.col("steps"), k + 1).f).alias("longer"))
    )
    last = F.element_at("steps", -1)
    ends = F.array(
        F.struct(F.col("source").alias("node"), F.get("steps", 0).f.alias("longer")), F.struct(last.target.alias("node"), last.f.alias("longer"))
    )
    junctions = paths.select("lang", F.inline(ends)).groupBy("lang", "node").agg(F.max("longer").alias("longer"))
    return paths.select("lang", F.inline(inner)).unionByName(junctions)


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exactly."""
    a, l, r = (x.cast("decimal(19,0)") for x in (a, l, r))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l * r)


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``best`` phrases of two and three words."""
    found, totals = counts(docs, least)
    words = found.where("next IS NULL AND NOT contains(node, ' ')").select("lang", F.col("node").alias("word"), "f")
    pairs = found.where("next IS NULL AND contains(node, ' ')").select("lang", "node", "f")
    second = F.substring_index("node", " ", -1)
    target = F.concat(second, F.lit(" "), "next")
    edges = found.where("next IS NOT NULL").select(
        "lang", F.col("node").alias("source"), target.alias("target"), F.col("next").alias("word"), "f"
    )
    longer = _heaviest(compacted(edges))

    def having(rows: DataFrame, frame: DataFrame, key: str, of: Column, name: str) -> DataFrame:
        return rows.withColumn(key, of).join(frame.withColumnRenamed("f", name), ["lang", key]).drop(key)

    two = pairs.join(longer, ["lang", "node"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f"))
    )
    two = two.select("lang", F.col("node").alias("phrase"), F.col("f").alias("a"))
    two = having(two, words, "word", F.substring_index("phrase", " ", 1), "l")
    two = having(two, words, "word", F.substring_index("phrase", " ", -1), "r")
    two = two.select("lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    three = edges.select("lang", F.concat_ws(" ", "source", "word").alias("phrase"), F.col("f").alias("a"), "source", "target", "word")
    three = having(three, words.withColumnRenamed("word", "first"), "first", F.substring_index("phrase", " ", 1), "l1")
    three = having(three, pairs, "node", F.col("target"), "r1")
    three = having(three, pairs, "node", F.col("source"), "l2")
    three = having(three, words, "word", F.col("word"), "r2")
    cuts = [
        F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in (1, 2)
    ]
    three = three.select("lang", "phrase", "a", F.least(*cuts).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # The best of each of a language's parts first, so however many tasks there are the last one sees PARTS * best rows a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", "part").orderBy(*order)
    scored = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    scored = scored.withColumn("place", F.row_number().over(part)).where(F.col("place") <= best).drop("part", "place")
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
