"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Conversations that begin with the same turns share those turns' nodes. A node is a sequence of first turns; it
is known by its depth and a 128-bit sum (exclusive or) of the hashes of its turns, each salted with its
place, so every prefix of a conversation is a running sum of slim rows and texts are hashed where they are read.

Turns are numbered and summed in two levels: rows are range-partitioned by (conversation, turn), so that a long
conversation spreads over several lanes; windows run inside a lane, and what stands before a lane comes
from a running sum over lanes. Copies of a turn or a conversation are merged by partial aggregates.

Subtree totals take rounds of two steps. Rake: nodes without children are settled, and each parent gets
the sum of theirs. Compress: of each chain of nodes with one child, those that drew heads
above a node that did not are taken out, and the child keeps what they held as a weight on its edge. Rounds
are as many as the logarithm of the tree, however deep it is. Then the rounds are gone
through backwards: a node that was taken out has its own sum, the edge's and the child's.

Defined cases: a null role or text is empty; null turns come first, and turns of one number stand by role, then text;
repeated rows are turns each; rows without a conv_id are left out; a conversation without turns
(after rebuilding) is a member of the root alone; an empty table gives no node; very long texts are hashed whole;
extra columns are ignored, whatever their names. ``%`` on negative ids keeps the sign, as in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import stored

GROUP, MOST_SHARED = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
#: ids a chunk of a node's list of members spans
CHUNK_BITS = 12

_LANE = ["conv_id", "lane"]
_NODE = ["depth", "p1", "p2"]


def shared_turns(conv_id: Column, most: int = MOST_SHARED) -> Column:
    """How many first turns a conversation takes from the head of its group."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(most))


def _mark(side: int, place: Column) -> Column:
    """Hash of a turn at its place, one for each half of a node's id."""
    return F.xxhash64(F.lit(side), place.cast("long"), "digest")


def _slim(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, tie (role and text where the turn's number occurs more than once), digest, words."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    several = turns.groupBy("conv_id", "turn").count().where("count > 1").select(
        F.col("conv_id").alias("of_conv"), F.col("turn").alias("of_turn"), F.lit(True).alias("tied")
    )
    several = stored(several, "tied-turns")
    same = (F.col("conv_id") == F.col("of_conv")) & F.col("turn").eqNullSafe(F.col("of_turn"))
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return turns.join(several, same, "left").select(
        "conv_id", "turn", F.when(F.col("tied"), F.struct("role", "text")).alias("tie"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )


def _in_lanes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The slim turns with their lane; and conv_id, lane, before (turns in earlier lanes), total."""
    slim = stored(_slim(conversations), "turns").withColumn("row", F.monotonically_increasing_id())
    ranged = slim.repartitionByRange("conv_id", "turn", "tie", "row")
    laid = stored(ranged.withColumn("lane", F.spark_partition_id()), "lanes")
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    runs = laid.groupBy(*_LANE).agg(F.count(F.lit(1)).alias("n"))
    runs = runs.select(
        *_LANE, "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total")
    )
    return laid, stored(runs, "runs")


def _placed(laid: DataFrame, runs: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, from 0."""
    inside = Window.partitionBy(*_LANE).orderBy("turn", "tie", "row")
    numbered = laid.withColumn("at", F.row_number().over(inside) - 1).drop("turn", "tie", "row")
    return numbered.join(runs, _LANE).withColumn("place", F.col("at") + F.col("before")).drop("at", "before")


def members(conversations: DataFrame, group: int = GROUP, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations.

    First, a row a turn: conv_id, depth, p1, p2 (node), q1, q2 (its parent), words, last. Second, conv_id and
    length of every conversation. The first turns of conversation ``c - c % group`` stand in for those of c.
    """
    laid, runs = _in_lanes(conversations)
    source = F.col("conv_id") - F.col("conv_id") % group
    convs = runs.where("before = 0").select("conv_id", "total", shared_turns(F.col("conv_id"), most_shared).alias("shared"))
    heads = _placed(laid.where(F.col("conv_id") % group == 0), runs).where(F.col("place") < most_shared - 1)
    given = (
        convs.select("conv_id", "shared", source.alias("source")).where("shared > 0")
        .join(heads.select(F.col("conv_id").alias("source"), "place", "digest", "words"), "source")
        .where("place < shared").withColumn("depth", F.col("place") + 1)
        .select("conv_id", "depth", "words", _mark(1, F.col("depth")).alias("f1"), _mark(2, F.col("depth")).alias("f2"))
    )
    given = stored(given, "given")
    taken = given.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor("f1").alias("g1"), F.bit_xor("f2").alias("g2")
    )
    convs = convs.join(taken, "conv_id", "left").na.fill(0, ["m", "g1", "g2"])
    convs = stored(convs.withColumn("length", F.col("m") + F.greatest(F.col("total") - F.col("shared"), F.lit(0))), "convs")

    own = (
        _placed(laid, runs.join(convs.drop("total"), "conv_id")).where("place >= shared")
        .withColumn("depth", F.col("place") - F.col("shared") + F.col("m") + 1)
        .select(
            *_LANE, "depth", "words", "length", "g1", "g2", (F.col("n") < F.col("total")).alias("spread"),
            _mark(1, F.col("depth")).alias("f1"), _mark(2, F.col("depth")).alias("f2"),
        )
    )
    own = stored(own, "own-turns")
    # at most a row a lane: the conversations that stand in several
    earlier = Window.partitionBy("conv_id").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.where("spread").groupBy(*_LANE).agg(F.bit_xor("f1").alias("s1"), F.bit_xor("f2").alias("s2"))
    sums = sums.select(*_LANE, F.bit_xor("s1").over(earlier).alias("b1"), F.bit_xor("s2").over(earlier).alias("b2"))

    def running(rows: DataFrame, by: list[str], side: str) -> Column:
        so_far = Window.partitionBy(*by).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        return F.bit_xor(f"f{side}").over(so_far)

    def nodes(rows: DataFrame, by: list[str], bases: dict[str, Column]) -> DataFrame:
        summed = rows.select("*", *[running(rows, by, k).bitwiseXOR(base).alias(f"p{k}") for k, base in bases.items()])
        return summed.select(
            "conv_id", *_NODE, *[F.col(f"p{k}").bitwiseXOR(F.col(f"f{k}")).alias(f"q{k}") for k in bases],
            "words", (F.col("depth") == F.col("length")).alias("last"),
        )

    first = nodes(given.join(convs.select("conv_id", "length"), "conv_id"), ["conv_id"], {"1": F.lit(0), "2": F.lit(0)})
    later = own.join(sums, _LANE, "left")
    rest = nodes(later, _LANE, {k: F.col(f"g{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in "12"})
    return stored(first.unionByName(rest), "members"), convs.select("conv_id", "length")


def _list_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256: digest of the ids of (conv_id, depth, p1, p2), ascending.

    Ids are joined in chunks, which any number of tasks do, and a node's chunks are streamed through one digest,
    which is a chain by its nature; a task holds one chunk.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy(*_NODE, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, sha256()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_NODE, "ends_sha256"])

        for batch in batches:
            rows = []
            for *node, text in zip(*(batch.column(name).to_pylist() for name in (*_NODE, "ids"))):
                if node != key:
                    if key is not None:
                        rows.append((*key, state.hexdigest()))
                    key, state = node, sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield out(rows)
        if key is not None:
            yield out([(*key, state.hexdigest())])

    dealt = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids")
    return dealt.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def _sum(columns: list[str], *parts: str) -> list[Column]:
    """For each value, the parts of it added up."""
    return [reduce(lambda a, b: a + b, [F.col(f"{part}{name}") for part in parts]).alias(name) for name in columns]


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """node and each value summed over the node's subtree, of a tree given as (node, parent, values).

    Roots have no parent; nodes are longs. See the module for the method.
    """
    spliced: list[DataFrame] = []
    settled: list[DataFrame] = []
    edge = [f"up_{name}" for name in values]
    alive = tree.select("node", "parent", *values, *[F.lit(0).cast("long").alias(name) for name in edge])
    while True:
        kids = alive.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
        marked = stored(alive.join(kids, "node", "left"), "marked")
        # rake
        raked = marked.where("kids IS NULL")
        settled.append(raked.select("node", *values))
        gifts = raked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("raked"), *[F.sum(F.col(v) + F.col(f"up_{v}")).alias(f"gift_{v}") for v in values]
        )
        rest = marked.where("kids IS NOT NULL").join(gifts, "node", "left").na.fill(0, ["raked", *[f"gift_{v}" for v in values]])
        heads = F.pmod(F.xxhash64("node", F.lit(len(settled))), F.lit(2)) == 0
        one = (F.col("kids") - F.col("raked") == 1) & F.col("parent").isNotNull()
        rest = stored(rest.select("node", "parent", *_sum(values, "", "gift_"), *edge, (one & heads).alias("out")), "raked")
        if rest.isEmpty():
            break
        # compress
        above = rest.where("out").select(
            F.col("node").alias("above"), F.col("parent").alias("above_parent"),
            *[F.col(name).alias(f"above_{name}") for name in (*values, *edge)],
        )
        met = rest.join(above, (F.col("parent") == F.col("above")) & ~F.col("out"), "left")
        met = stored(met, "compressed")
        joins = met.where("above IS NOT NULL")
        spliced.append(joins.select(
            F.col("above").alias("node"), F.col("node").alias("child"),
            *[(F.col(f"above_{v}") + F.col(f"up_{v}")).alias(v) for v in values],
        ))
        moved = [
            (F.col(f"up_{v}") + F.coalesce(F.col(f"above_{v}") + F.col(f"above_up_{v}"), F.lit(0))).alias(f"up_{v}") for v in values
        ]
        parent = F.when(F.col("above").isNull(), F.col("parent")).otherwise(F.col("above_parent")).alias("parent")
        alive = met.select("node", parent, *values, *moved).join(spliced[-1].select("node"), "node", "left_anti")
    # backwards: what a round took out hangs on what later rounds settled
    for turn in reversed(range(len(spliced))):
        known = reduce(DataFrame.union, settled[turn + 1 :])
        known = known.select(F.col("node").alias("child"), *[F.col(v).alias(f"known_{v}") for v in values])
        found = spliced[turn].join(known, "child").select("node", *_sum(values, "", "known_"))
        settled[turn + 1] = settled[turn + 1].union(stored(found, "expanded"))
    return reduce(DataFrame.union, settled)


def prefix_trie(conversations: DataFrame, group: int = GROUP, most_shared: int = MOST_SHARED) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = members(conversations, group, most_shared)
    several = rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("words"),
        F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"),
    )
    nodes = stored(several.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    linked = stored(nodes.join(above, ["depth", "q1", "q2"], "left").drop("q1", "q2"), "linked")
    kids = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = stored(linked.join(kids, "node", "left").na.fill(0, ["n_children"]), "tree")
    own = tree.select(
        "node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    sums = subtree_sums(own, ["n_leaves", "saved_tokens"])
    ends = rows.where("last").select("conv_id", *_NODE).unionByName(
        convs.where("length = 0").select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    )
    found = tree.join(sums, "node").join(_list_digests(ends), _NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )
