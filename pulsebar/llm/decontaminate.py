"""Benchmark decontamination as a prefix-filtered set join.

A window is so many consecutive words of a benchmark item; its elements are its word shingles.
Containment must be whole, so the necessary prefix of a window is one shingle, the rarest in the
corpus. One pass over the texts finds where benchmark shingles stand, each with the words around it;
counting those gives the rarity; then only prefix shingles are joined, positions and lengths must
leave room for the window, and the words around are compared with the window's own.

Places are found first by a bitmap of shingle hashes, whose size follows the benchmark's and is at
most ``most_bits``; it is an early sieve, and every place is confirmed by an equi-join on the words.
No document text is shuffled, and no side is broadcast unless Spark measures it to be small.

Defined cases: null and empty texts have no words; an item without words has no window; an item of
fewer words than a window is one; repeated rows are reported each; a null item_id is left out of
the items but its windows hit; empty tables give no rows or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import MOST_BITS, ascii_lower, bitmap, in_bitmap, stored, text_of

WINDOW, SHINGLE = 10, 3
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; split leaves an empty string before a leading separator."""
    return F.filter(F.split(ascii_lower(text), _NOT_WORD), lambda w: w != "")


def _shingle(of: Column, at: Column, width: int) -> Column:
    """``width`` words from place ``at`` (0-based) as one string."""
    return F.concat_ws(" ", *[F.get(of, at + k) for k in range(width)])


def _hash(of: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(of, at + k) for k in range(width)])


def _places(of: Column, width: int) -> Column:
    return F.when(F.size(of) >= width, F.sequence(F.lit(0), F.size(of) - width)).otherwise(F.array().cast("array<int>"))


def windows_of(benchmark: DataFrame, length: int = WINDOW, width: int = SHINGLE) -> DataFrame:
    """(item_id, window, width): each window's words and the width of its shingles."""
    listed = benchmark.select("item_id", words(text_of()).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    return listed.select("item_id", "w", F.explode(starts).alias("start")).select(
        "item_id", F.slice("w", F.col("start") + 1, F.lit(length)).alias("window"),
        F.least(F.size("w"), F.lit(width)).alias("width"),
    )


def _places_with_words(width: int, reach: int, bits: int) -> Column:
    """Places in ``w`` that pass the bitmap of this width, with ``reach`` words on both sides."""
    every = _places(F.col("w"), width)
    passed = F.filter(every, lambda i: in_bitmap(F.col(f"bits_{width}"), bits, _hash(F.col("w"), i, width)))

    def near(i: Column) -> Column:
        low = F.greatest(i - reach, F.lit(0))
        return F.struct(
            i.alias("at"), F.lit(width).alias("width"), _shingle(F.col("w"), i, width).alias("shingle"),
            low.alias("low"), F.slice(F.col("w"), low + 1, i + width + reach - low).alias("around"),
        )

    return F.transform(passed, near)


def places(docs: DataFrame, windows: DataFrame, length: int = WINDOW, most_bits: int = MOST_BITS) -> DataFrame:
    """row, doc_id, text_hash, n_words, and the places where benchmark shingles may stand, with words around."""
    found = []
    base = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), words(text_of()).alias("w"))
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())  # at most SHINGLE
    for width in widths:
        own = windows.where(F.col("width") == width).select(
            F.explode(F.transform(_places(F.col("window"), width), lambda i: _hash(F.col("window"), i, width))).alias("hash")
        ).distinct()
        set_bits, bits = bitmap(own, most_bits)
        base = base.withColumn(f"bits_{width}", set_bits.scalar())
        found.append(_places_with_words(width, length - width, bits))
    if not found:
        found = [F.array().cast(
            "array<struct<at:int,width:int,shingle:string,low:int,around:array<string>>>"
        )]
    return base.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash",
        F.size("w").cast("long").alias("n_words"), F.concat(*found).alias("places"),
    )


def _parts(windows: DataFrame, width: int) -> DataFrame:
    """(window, width, within, shingle): the shingles of windows of this width and where they stand."""
    each = F.transform(
        _places(F.col("window"), width),
        lambda i: F.struct(i.alias("within"), _shingle(F.col("window"), i, width).alias("shingle")),
    )
    own = windows.where(F.col("width") == width).select("window", "width", F.explode(each).alias("s"))
    return own.select("window", "width", "s.*")


def contamination(
    docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, width: int = SHINGLE, most_bits: int = MOST_BITS,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as strings) and text_hash of each document."""
    items = stored(windows_of(benchmark, length, width), "windows")
    looked = stored(places(docs, items, length, most_bits), "places")
    hits = looked.select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.*")

    # Shingles of each distinct window, and how often each stands in the corpus.
    distinct = items.select("window", "width").distinct()
    parts = stored(
        reduce(DataFrame.unionByName, [_parts(distinct, size) for size in range(1, width + 1)]), "window-shingles"
    )
    wanted = stored(parts.select("width", "shingle").distinct(), "shingles")
    rarity = stored(
        hits.groupBy("width", "shingle").agg(F.count("*").alias("uses")).join(wanted, ["width", "shingle"], "left_semi"),
        "shingle-rarity",
    )
    # The prefix: the rarest shingle. A window with one that stands nowhere is nowhere.
    first = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "shingle", "within"))
    prefix = stored(
        parts.join(rarity, ["width", "shingle"], "left").groupBy("window", "width").agg(first.alias("f"))
        .where("f.uses > 0")
        .select("window", "width", "f.shingle", "f.within", F.size("window").alias("length")),
        "prefixes",
    )
    start = F.col("at") - F.col("within")
    fits = (start >= F.col("low")) & (start + F.col("length") <= F.col("n_words"))
    same = F.slice("around", start - F.col("low") + 1, F.col("length")) == F.col("window")
    matched = stored(
        hits.join(prefix, ["width", "shingle"]).where(fits & same)
        .select("row", start.alias("start"), "length", "window"),
        "matches",
    )

    # Words under any match: what each reaches past those that start before it.
    spans = matched.groupBy("row", "start").agg((F.col("start") + F.max("length")).alias("end"))
    earlier = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(earlier), F.lit(0))
    fresh = spans.select("row", F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0)).alias("fresh"))
    words_hit = fresh.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    found = (
        matched.select("row", "window").distinct()
        .join(items.select("window", "item_id").where("item_id IS NOT NULL").distinct(), "window")
        .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    summary = words_hit.join(found, "row", "left")
    return looked.select("row", "doc_id", "text_hash", "n_words").join(summary, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "text_hash",
    )
