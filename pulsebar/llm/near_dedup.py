"""Near-duplicate groups by SetSketch registers.

Each text is the set of its distinct five-word shingles. A register holds the exponentially spaced,
truncated minimum of one hash over the set, so the registers of a union are the larger ones of the
two, and two sets agree in a register about as often as they overlap. Bands of register values
propose pairs: at 50 bands of 5, a pair at the threshold is missed with a chance of 1.3e-6. A pair's
overlap is estimated from the registers and both set sizes by joint likelihood; pairs five standard
errors below the threshold go, and all others are verified on the full sets.

Equal sets are one class from the start, however many copies there are. A band shared by many
classes is not turned into all pairs: its members are compared with the smallest of them, classes
found linked are contracted, and only bands whose members are still in different components go on to
be compared in blocks. There each pair is estimated and verified inside the task, in the first band it
shares, and just the links that join components come back, so no link is lost and no list of pairs is made.

Texts of one template that overlap just too little share many bands, most of them with the same others. Bands with more
than a block of members that have members in common are one group if that makes fewer rows: its members then meet
once, not once a band. Blocks with many members count all their overlaps at once, as products of matrices over
the shingles both sides have, so there the estimate is not needed.

Defined cases: a text of fewer than five words is one shingle; one without words, or null, has none
and is alone; copies and repeated rows share a class; a null doc_id is linked like others and is never
the smallest; an empty table gives none. A shingle is known by a 64-bit hash of its words, and a
set by a 128-bit hash of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsebar.llm.common import bitmap, give_back, groups, in_bitmap, portions, stored, text_of

WORDS, BANDS, ROWS = 5, 50, 5
REGISTERS = BANDS * ROWS
BASE, RATE = 1.001, 20.0
PERCENT = 75
DOUBT = 12.5  # in log likelihood: five standard errors
BLOCK = 512
MATRIX, COLUMNS = 64, 2048  # members from which overlaps are counted together, and shingles at a time
STAR_ROUNDS = 1
PAIRS = 1000  # estimated at a time

_draws = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _draws.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _draws.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_PLACES = _draws.integers(0, 2**64, max(WORDS, ROWS), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; bytes lower and split just as the words are defined."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total += _mixed(hashed[k : len(hashed) - width + 1 + k] + _PLACES[k]) * _PLACES[k]
    return np.unique(_mixed(total + np.uint64(width)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """max over the set of floor(1 - log_BASE(x)), x exponential with RATE, cut to 16 bits."""
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    room = np.empty((128, REGISTERS), np.uint32)
    for at in range(0, len(small), 128):
        part = small[at : at + 128]
        out = room[: len(part)]
        np.multiply(part[:, None], _FACTORS, out=out)
        np.add(out, _SHIFTS, out=out)
        np.minimum(least, out.min(axis=0), out=least)
    x = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 2**16 - 1).astype(np.uint16)


def band_keys(values: np.ndarray) -> np.ndarray:
    """Keys of the bands of registers, of one set or of several (a row each)."""
    parts = values.reshape(*values.shape[:-1], BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _STEP, parts.shape[:-1])
    for k in range(ROWS):
        total = _mixed(total + parts[..., k] * _PLACES[k])
    return total.view(np.int64)


def likely(equal: np.ndarray, more: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated overlap, and whether the threshold is not ruled out.

    ``equal`` and ``more`` count registers where a equals b and where a is larger.
    """
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    lean = (BASE - 1) / BASE

    def chance(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.maximum(x, 0) * lean) / np.log(BASE), 1e-12)

    larger, smaller = chance(u - v * grid), chance(v - u * grid)
    same = np.maximum(1 - larger - smaller, 1e-12)
    less = REGISTERS - equal - more
    score = more[:, None] * np.log(larger) + less[:, None] * np.log(smaller) + equal[:, None] * np.log(same)
    best = score.argmax(axis=1)
    rows = np.arange(len(best))
    over = np.where(grid >= PERCENT / 100 - 1e-9, score, -np.inf).max(axis=1)
    return grid[rows, best], score[rows, best] - over <= DOUBT


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_hash and bands of each document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sizes, sets, bands = [], [], []
            for text in batch.column(2):
                hashes = shingles(text.as_py())
                sizes.append(len(hashes))
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                bands.append(band_keys(registers(hashes)) if len(hashes) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "set_hash", "bands"],
            )

    read = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    return read.mapInArrow(sketch, "doc_id long, text_hash long, n_shingles long, set_hash binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, n, registers and the whole set, for the classes in ``wanted`` (node, doc_id, text_hash)."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [shingles(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, found), pa.int64()),
                 pa.array([registers(s).tobytes() for s in found], pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())],
                names=["node", "n", "registers", "hashes"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("of_id"), F.xxhash64(text_of()).alias("of_hash"), text_of().alias("text"))
    held, bits = bitmap(wanted.select(F.col("text_hash").alias("hash")))
    read = read.withColumn("held", held.scalar()).where(in_bitmap(F.col("held"), bits, F.col("of_hash"))).drop("held")
    joined = read.join(
        wanted, F.col("of_id").eqNullSafe(F.col("doc_id")) & (F.col("of_hash") == F.col("text_hash"))
    )
    # Fully repeated rows would give a node twice.
    return joined.select("node", "text").mapInArrow(whole, "node long, n long, registers binary, hashes binary").dropDuplicates(["node"])


def _estimated(n_a: pd.Series, registers_a: pd.Series, n_b: pd.Series, registers_b: pd.Series) -> pd.DataFrame:
    overlap, possible = np.zeros(len(n_a)), np.zeros(len(n_a), bool)
    # a hundred numbers a pair, several times over
    for at in range(0, len(n_a), PAIRS):
        part = slice(at, at + PAIRS)
        a = np.frombuffer(b"".join(registers_a[part]), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(registers_b[part]), np.uint16).reshape(-1, REGISTERS)
        sizes = n_a[part].to_numpy(float), n_b[part].to_numpy(float)
        overlap[part], possible[part] = likely((a == b).sum(axis=1), (a > b).sum(axis=1), *sizes)
    give_back()
    return pd.DataFrame({"overlap": overlap, "possible": possible})


def similar(a: bytes, b: bytes) -> bool:
    """Whether two full sets reach the threshold."""
    left, right = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= PERCENT * (len(left) + len(right) - both)


def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """The same for the pairs of a batch; the sets are read where they lie."""
    found = pa.array([similar(x.as_buffer(), y.as_buffer()) for x, y in zip(a, b)], pa.bool_())
    give_back()
    return found


def _sized(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    for side in "ab":
        own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def estimate(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, overlap) of the pairs that sizes and registers don't rule out."""
    both = _sized(pairs, sets, "n", "registers")
    sizes_fit = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    estimated = F.pandas_udf(_estimated, "overlap double, possible boolean")
    judged = both.where(sizes_fit).withColumn("e", estimated("n_a", "registers_a", "n_b", "registers_b"))
    return judged.where("e.possible").select("a", "b", "e.overlap")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) on the full sets."""
    both = _sized(pairs.select("a", "b"), sets, "hashes")
    linked = F.arrow_udf(_linked, "boolean")
    return stored(both.select("a", "b", linked("hashes_a", "hashes_b").alias("linked")), "verified")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes in ``links`` (a, b): the smallest node each can reach.

    Labels move to neighbours and then jump to the label of their label.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        offered = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("offer"))
        )
        lower = labels.join(offered, "node").select("node", F.col("root").alias("old"), F.least("root", "offer").alias("root"))
        targets = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = stored(
            lower.join(targets, "root").select("node", F.least("root", "next").alias("root"), "old"), "labels"
        )
        labels = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return labels


def _rooted(rows: DataFrame, roots: DataFrame | None, node: str, root: str) -> DataFrame:
    if roots is None:
        return rows.withColumn(root, F.col(node))
    own = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(own, node, "left").withColumn(root, F.coalesce(root, node))


def _open_bands(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members (band, node, root) of the bands that hold several components."""
    rooted = stored(_rooted(members, roots, "node", "root"), "rooted")
    open_ = stored(
        rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("root", "node")).alias("m"), F.count("*").alias("size"))
        .where("low < high").select("band", F.col("m.node").alias("centre"), F.col("m.root").alias("centre_root"), "size"),
        "open-bands",
    )
    return rooted.join(open_, "band")


def _regrouped(large: DataFrame) -> DataFrame:
    """Members (band, node, root, size, whole) of bands larger than a block, in the groups that make fewer rows.

    Bands with a member in common form a group; where its members are fewer rows, by blocks, than
    the bands' are, it takes their place (``whole``), and all pairs in it are looked at.
    """
    firsts = large.groupBy("node").agg(F.min("band").alias("first"))
    met = large.join(firsts, "node").where("band <> first").select(F.col("first").alias("a"), F.col("band").alias("b")).distinct()
    met = stored(met, "bands-met")
    if met.isEmpty():
        return large.withColumn("whole", F.lit(False))
    named = stored(_rooted(large.select("band", "node", "root", "size"), components(met), "band", "group"), "named-bands")
    squares = named.groupBy("group", "band").agg(F.max("size").alias("size")).groupBy("group").agg(
        F.sum(F.col("size") * F.col("size")).alias("squares"), F.count(F.lit(1)).alias("bands")
    )
    sizes = named.select("group", "node").distinct().groupBy("group").agg(F.count(F.lit(1)).alias("nodes"))
    better = stored(
        squares.join(sizes, "group").where("bands > 1 AND nodes * nodes < squares").select("group", "nodes"), "groups"
    )
    as_groups = named.join(better, "group").groupBy("group", "node").agg(F.min("root").alias("root"), F.max("nodes").alias("size"))
    as_bands = named.join(better, "group", "left_anti").select("band", "node", "root", "size", F.lit(False).alias("whole"))
    return as_bands.unionByName(as_groups.select(F.col("group").alias("band"), "node", "root", "size", F.lit(True).alias("whole")))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the sorted sets on the left has in common with each on the right."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        of, every = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, every), max(len(shared) - 1, 0))
        known = shared[at] == every if len(shared) else np.zeros(len(every), bool)
        order = np.argsort(at[known], kind="stable")
        return of[known][order], at[known][order]

    out, sides = np.zeros((len(left), len(right)), np.float32), (placed(left), placed(right))
    for first in range(0, len(shared), COLUMNS):
        parts = []
        for (of, at), size in zip(sides, out.shape):
            low, high = np.searchsorted(at, (first, first + COLUMNS))
            part = np.zeros((size, COLUMNS), np.float32)
            part[of[low:high], at[low:high] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _compared(group: pa.Table, whole: bool, band: int, halves: bool) -> list[tuple]:
    """Verified links between components among the members of a block, or between the halves of two."""
    values = np.frombuffer(b"".join(group["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
    bands = None if whole else band_keys(values)
    node, n, own, root = (group[c].to_numpy().copy() for c in ("node", "n", "own", "root"))
    hashes = group["hashes"].to_pylist()
    rows, linked = [], None
    if len(node) > MATRIX:
        side = own == own.min() if halves else np.ones(len(node), bool)
        sets = [np.frombuffer(h, np.uint64) for h in hashes]
        picked = [np.flatnonzero(side), np.flatnonzero(~side) if halves else np.arange(len(node))]
        if not all(map(len, picked)):
            return rows
        common = overlaps(*[[sets[k] for k in one] for one in picked])
        sums = n[picked[0]][:, None] + n[picked[1]][None, :]
        linked = np.zeros((len(node), len(node)), bool)
        linked[np.ix_(*picked)] = 100 * common >= PERCENT * (sums - common)
        linked |= linked.T
    for i in range(len(node)):
        mask = (root != root[i]) & (node > node[i])
        if linked is not None:
            for j in np.flatnonzero(mask & linked[i]):
                if root[j] != root[i]:
                    rows.append((int(node[i]), int(node[j])))
                    root[root == root[j]] = root[i]
            continue
        mask &= 100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])
        if halves:
            mask &= own != own[i]
        others = np.flatnonzero(mask)
        if not whole:  # a pair is looked at in the first band it shares
            others = others[bands[i, (bands[others] == bands[i]).argmax(axis=1)] == band]
        if not len(others):
            continue
        equal, more = (values[others] == values[i]).sum(axis=1), (values[i] > values[others]).sum(axis=1)
        overlap, possible = likely(equal, more, np.full(len(others), float(n[i])), n[others].astype(float))
        for k in np.argsort(-overlap, kind="stable"):
            j = others[k]
            if possible[k] and root[j] != root[i] and similar(hashes[i], hashes[j]):
                rows.append((int(node[i]), int(node[j])))
                root[root == root[j]] = root[i]
    return rows


def _block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): verified links between components in one band, found block by block inside tasks.

    A pair is looked at in the first band it shares, verified on the full sets if the likelihood
    does not rule it out, and given back only if nothing in its block links its components already.
    So a block gives fewer rows than it has members, and leaves no link out. Large bands are regrouped
    beforehand (see ``_regrouped``).
    """
    members = members.select("band", "node", "root", "size", F.lit(False).alias("whole"))
    large = stored(members.where(F.col("size") > BLOCK).drop("whole"), "large-bands")
    if not large.isEmpty():
        members = members.where(F.col("size") <= BLOCK).unionByName(_regrouped(large))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    keyed = members.select("whole", "band", "node", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    keys = ["whole", "band", "low", "high"]
    keyed = keyed.select(
        "whole", "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "root", "own"
    ).join(sets, "node").select(*keys, "node", "root", "own", "n", "registers", "hashes")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (whole, band, low, high), group in groups(batches, keys):
            if len(group) > 1:
                rows = _compared(group, whole, band, low != high)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b"])

    dealt = keyed.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(stream, "a long, b long")


def _best(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """For each component the likeliest pair with another of a smaller root; the rest waits."""
    rooted = _rooted(_rooted(pairs, roots, "a", "root_a"), roots, "b", "root_b").where("root_a <> root_b")
    pick = F.max(F.struct("overlap", "a", "b")).alias("p")
    return rooted.groupBy(F.greatest("root_a", "root_b").alias("of")).agg(pick).select("p.a", "p.b")


def linked_classes(docs: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, root) of all classes with a verified link; None without any."""
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_hash")
    sets = stored(full_sets(docs, stored(wanted, "wanted")), "full-sets")
    roots, links, failed = None, None, None

    def settle(pairs: DataFrame) -> None:
        nonlocal roots, links, failed
        judged = verify(pairs, sets)
        good, bad = judged.where("linked").select("a", "b"), judged.where("NOT linked").select("a", "b")
        links = good if links is None else links.union(good)
        failed = bad if failed is None else failed.union(bad)
        if not good.isEmpty():
            roots = components(links)

    for _ in range(STAR_ROUNDS):
        opened = _open_bands(members, roots)
        pairs = opened.where("root <> centre_root").select(
            F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")
        ).distinct()
        if failed is not None:
            pairs = pairs.join(failed, ["a", "b"], "left_anti")
        settle(stored(_best(stored(estimate(pairs, sets), "star-pairs"), roots), "best-pairs"))
    more = stored(_block_links(_open_bands(members, roots), sets), "block-links")
    if not more.isEmpty():
        roots = components(more if links is None else links.union(more))
    return roots


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept and text_hash."""
    known = stored(sketches(docs), "sketches")
    # The smallest document stands for its class; its bands are those of all its copies.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "bands")).alias("f")
    grouped = known.where("n_shingles > 0").groupBy("set_hash").agg(first, F.count("*").alias("copies"))
    classes = stored(
        grouped.select(F.monotonically_increasing_id().alias("node"), "set_hash", "copies", "f.doc_id", "f.text_hash", "f.bands"),
        "classes",
    )
    # A class has each of its bands once, so a band counted twice is shared.
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = stored(banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "shared-bands")
    held, bits = bitmap(shared.select(F.col("band").alias("hash")))
    sieved = (
        classes.select("node", "bands", held.scalar().alias("held"))
        .select("node", F.explode(F.filter("bands", lambda b: in_bitmap(F.col("held"), bits, b))).alias("band"))
    )
    members = stored(sieved.join(shared, "band", "left_semi"), "members")
    roots = None if members.isEmpty() else linked_classes(docs, members, classes)
    placed = _rooted(classes, roots, "node", "root")
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("size"))
    several = stored(
        placed.join(smallest.where("size > 1"), "root").select("set_hash", "component_id"), "several"
    )
    joined = known.select("doc_id", "text_hash", "n_shingles", "set_hash").join(several, "set_hash", "left")
    component = F.coalesce("component_id", "doc_id")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(component)
    return joined.select(
        "doc_id", "n_shingles", alone.alias("component_id"), F.col("doc_id").eqNullSafe(alone).alias("kept"),
        "text_hash",
    )
