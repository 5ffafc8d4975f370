"""Calculated series: mergeable bucket values, each with the revision of the landed rows it was counted from.

``<root>/calc/<name>/<what is counted>/values/part=/day=``   bucket values
``<root>/calc/<name>/<what is counted>/log``                 commits over them (see ``sources.log``)

A series is known by what it counts (pair, or words) and its bucket width, so values of two pairs never mix. Buckets
hold counts and sums, not means, so any multiple of the width is folded from them.

Of the values of a bucket the one that was counted from the latest state of the landed rows holds: a batch
roll-up's revision is the version of the feed's log it has read. Live values have none; they hold until a
batch has counted the bucket, and among themselves the one counted from most rows, then the newest. A bucket that
has lost its rows gets a tombstone, which outranks older values like any other value.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.functions import clock
from pulsebar.layout import BUCKET_SECONDS, CALC_SCHEMA, KEYWORDS, PAIR, POSTS, TICKS, Feed
from pulsebar.operators import calc, rollup
from pulsebar.sources import tables, workdir
from pulsebar.sources.log import Change, Log, State

SOCIAL, PRICE, VALUES = "social", "price", "values"
#: version of the feed's log up to which touched buckets are counted
COUNTED_TO = "counted_to"
LIVE = -1
_OWN = "counted BIGINT, revision BIGINT, gone BOOLEAN, written BIGINT, day DATE, part STRING"


@dataclass(frozen=True)
class Series:
    """What is counted (a pair, or the words for the two counts) and the seconds in a bucket."""

    name: str
    of: tuple[str, ...]
    width: int = BUCKET_SECONDS

    @property
    def feed(self) -> Feed:
        return TICKS if self.name == PRICE else POSTS

    @property
    def columns(self) -> list[str]:
        return list(rollup.PRICE_PARTS if self.name == PRICE else rollup.SOCIAL_PARTS)

    @property
    def schema(self) -> str:
        kinds = {"total": "DOUBLE"}
        return f"key BIGINT, {', '.join(f'{name} {kinds.get(name, "BIGINT")}' for name in self.columns)}, {_OWN}"

    def path(self, root: str) -> str:
        return f"{root}/calc/{self.name}/{self.width},{','.join(quote(x, safe='') for x in self.of)}"

    def buckets(self, rows: DataFrame) -> DataFrame:
        """Mergeable values of the feed's rows, with the number of rows (``counted``)."""
        if self.name == PRICE:
            return rollup.price_parts(rows, self.of[0], self.width)
        words = dict(zip(KEYWORDS, self.of))
        return rollup.social(rows, words, self.width, keep="all").withColumn("counted", F.col("messages"))


def price(pair: str = PAIR, width: int = BUCKET_SECONDS) -> Series:
    return Series(PRICE, (pair,), width)


def social(keywords: dict[str, str] = KEYWORDS, width: int = BUCKET_SECONDS) -> Series:
    return Series(SOCIAL, tuple(keywords[name] for name in KEYWORDS), width)


def stored(spark: SparkSession, root: str, name: str) -> list[Series]:
    """The series of a name there are."""
    found = []
    for folder in workdir.folders(spark, f"{root}/calc/{name}"):
        width, *of = folder.split(",")
        found.append(Series(name, tuple(map(unquote, of)), int(width)))
    return found


def the_only(spark: SparkSession, root: str, name: str) -> Series | None:
    """The series of a name, where there is one; which one is meant has to be said where there are several."""
    found = stored(spark, root, name)
    if len(found) > 1:
        raise ValueError(f"say which {name} series is meant: {found}")
    return found[0] if found else None


def log_of(spark: SparkSession, root: str, series: Series) -> Log:
    return Log(spark, f"{series.path(root)}/log")


# -- writing ----------------------------------------------------------------------


def _put(values: DataFrame, root: str, series: Series, seen: State, facts: dict | None = None) -> None:
    """Commit bucket values (key, columns, counted, revision, gone) beside what is stored."""
    dated = values.withColumn("written", F.lit(time.time_ns())).withColumn("day", clock.day_of(F.col("key")))
    pieces = tables.write_part(dated, f"{series.path(root)}/{VALUES}")
    if pieces or facts:
        log_of(values.sparkSession, root, series).commit(seen, Change(add={VALUES: pieces}, facts=facts or {}))


def put_live(buckets: DataFrame, root: str, series: Series) -> None:
    """Put running values of a stream beside what is stored; nothing stored is touched."""
    spark = buckets.sparkSession
    marked = buckets.withColumn("revision", F.lit(LIVE).cast("bigint")).withColumn("gone", F.lit(False))
    tables.retried(lambda: _put(marked, root, series, log_of(spark, root, series).read()))


def _recounted(values: DataFrame, old: DataFrame | None, series: Series, revision: int) -> DataFrame:
    """The new values, and tombstones for buckets (key) that had one and have none now.

    Values come hashed by key from their aggregate, so the join shuffles the keys alone.
    """
    names = [*series.columns, "counted"]
    whole = values.withColumn("gone", F.lit(False))
    if old is not None:
        had = old.select(F.col("key").alias("had"))
        whole = whole.join(had, F.col("key") == F.col("had"), "full_outer").select(
            F.coalesce("key", "had").alias("key"), *names, F.col("key").isNull().alias("gone")
        )
    return whole.withColumn("revision", F.lit(revision).cast("bigint"))


def whole_buckets(start: int, stop: int, width: int = BUCKET_SECONDS) -> tuple[int, int]:
    """The range widened to bucket edges: part of a bucket must not be counted
    as the whole of it."""
    return start - start % width, stop + -stop % width


def roll_up(spark: SparkSession, root: str, series: Series, start: int, stop: int) -> None:
    """Count the buckets of ``[start, stop)`` from the landed rows; what they say now holds from now on."""
    start, stop = whole_buckets(start, stop, series.width)

    def once() -> None:
        seen = log_of(spark, root, series).read()
        landed = tables.log_of(spark, root, series.feed).read()
        values = series.buckets(tables.scan(spark, root, series.feed, start, stop, landed))
        old = _range(spark, root, series, seen, start, stop)
        _put(_recounted(values, old, series, landed.version), root, series, seen)

    tables.retried(once)


def recount(spark: SparkSession, root: str, series: Series) -> None:
    """Count the buckets again that landed rows have touched since this was last done: late, replaced or simply new ones.

    The ``seconds`` that commits since then have added tell which; only their days are read, and of those the
    rows of these buckets are counted. Before the first time, all are new.
    """
    def once() -> None:
        feed = series.feed
        seen, landed = log_of(spark, root, series).read(), tables.log_of(spark, root, feed).read()
        since = seen.facts.get(COUNTED_TO, 0)
        pieces = [piece for piece, (version, _) in landed.of(tables.SECONDS).items() if version > since]
        if not pieces:
            return
        second = F.col("epoch_s")
        touched = tables.read_table(spark, root, feed, tables.SECONDS, pieces)
        touched = touched.select(clock.bucket_start(second, series.width).alias("key")).distinct()
        # a bucket may reach over the end of a day
        days = {date.fromisoformat(tables.day_of(piece)) for piece in pieces}
        around = {near for day in days for near in clock.days_around(day, series.width)}
        rows = tables.read_table(spark, root, feed, tables.ROWS, landed.on(tables.ROWS, around)).drop("part")
        rows = rows.withColumn("key", clock.bucket_start(second, series.width)).join(touched, "key", "left_semi").drop("key")
        old = _days(spark, root, series, seen, around)
        if old is not None:
            old = old.join(touched, "key", "left_semi")
        values = _recounted(series.buckets(rows), old, series, landed.version)
        _put(values, root, series, seen, {COUNTED_TO: landed.version})

    tables.retried(once)


def fold(spark: SparkSession, root: str, series: Series) -> None:
    """Fold the small writes of each day into one, in one commit; values keep their rank, so later or slower writes still
    meet them as they were. Replaced parts are swept later."""
    log = log_of(spark, root, series)

    def once() -> None:
        seen = log.read()
        by_day: dict[str, list[str]] = {}
        for piece in seen.of(VALUES):
            by_day.setdefault(tables.day_of(piece), []).append(piece)
        old = [piece for pieces in by_day.values() if len(pieces) > 1 for piece in pieces]
        if old:
            rows = _held(tables.read_pieces(spark, f"{series.path(root)}/{VALUES}", old, series.schema), series)
            new = tables.write_part(rows.withColumn("day", clock.day_of(F.col("key"))), f"{series.path(root)}/{VALUES}")
            log.commit(seen, Change(add={VALUES: new}, remove={VALUES: old}))

    tables.retried(once)


def sweep(spark: SparkSession, root: str, series: Series, seconds: float = tables.SWEEP_SECONDS) -> None:
    """Delete parts no commit holds."""
    seen = log_of(spark, root, series).read()
    tables.sweep_parts(spark, f"{series.path(root)}/{VALUES}", seen.of(VALUES), seconds)


# -- reading ----------------------------------------------------------------------


def _rank() -> Column:
    """What decides which value of a bucket holds."""
    live = F.when(F.col("revision") == LIVE, F.col("counted")).otherwise(F.lit(0))
    return F.struct("revision", live.alias("live"), "written")


def _held(rows: DataFrame, series: Series) -> DataFrame:
    """The row that holds of each bucket, tombstones included; its rank makes it one."""
    names = [*series.columns, "counted", "revision", "gone", "written"]
    return rows.groupBy("key").agg(F.max_by(F.struct(*names), _rank()).alias("v")).select("key", "v.*")


def _pieces(spark: SparkSession, root: str, series: Series, pieces: list[str]) -> DataFrame | None:
    if not pieces:
        return None
    rows = tables.read_pieces(spark, f"{series.path(root)}/{VALUES}", pieces, series.schema)
    return _held(rows, series).where("NOT gone")


def _range(
    spark: SparkSession, root: str, series: Series, seen: State, start: int | None, stop: int | None
) -> DataFrame | None:
    """Values that hold of the buckets in ``[start, stop)``; only its days are read. None where there is no file."""
    first = clock.utc_date(start) if start is not None else date.min
    last = clock.utc_date(stop - 1) if stop is not None else date.max
    values = _pieces(spark, root, series, seen.between(VALUES, first, last))
    if values is not None and start is not None:
        values = values.where(F.col("key") >= start)
    if values is not None and stop is not None:
        values = values.where(F.col("key") < stop)
    return values


def _days(spark: SparkSession, root: str, series: Series, seen: State, days: set[date]) -> DataFrame | None:
    return _pieces(spark, root, series, seen.on(VALUES, days))


def read_values(
    spark: SparkSession, root: str, series: Series, start: int | None = None, stop: int | None = None, width: int | None = None
) -> DataFrame | None:
    """Mergeable values of a series that hold; ``width`` folds them into larger buckets, without a look at the landed rows.

    None where nothing is stored.
    """
    width = width or series.width
    if width % series.width:
        raise ValueError(f"buckets of {width} s cannot be made of {series.width} s")
    if start is not None:
        start, _ = whole_buckets(start, start, width)
    if stop is not None:
        _, stop = whole_buckets(stop, stop, width)
    values = _range(spark, root, series, log_of(spark, root, series).read(), start, stop)
    if values is None:
        return None
    values = values.select("key", *series.columns)
    return values if width == series.width else rollup.merged(values, series.columns, width)


def read_calc(
    spark: SparkSession, root: str, start: int | None = None, stop: int | None = None,
    counts: Series | None = None, prices: Series | None = None, keep: str = "matched", width: int | None = None,
) -> DataFrame:
    """The calculated table: post counts and mean prices side by side.

    Without ``counts`` or ``prices`` the only series of its kind is taken. ``[start, stop)`` limits the keys, and only its
    days are read. ``keep='matched'`` leaves out counts of buckets where a word does not occur, as an inner join of
    the separate counts would. ``width`` folds buckets.
    """
    sides = []
    finish: dict[str, Callable[[DataFrame], DataFrame]] = {
        SOCIAL: (lambda values: rollup.matched(values)) if keep == "matched" else (lambda values: values), PRICE: rollup.mean
    }
    for name, asked in ((SOCIAL, counts), (PRICE, prices)):
        asked = asked or the_only(spark, root, name)
        values = read_values(spark, root, asked, start, stop, width) if asked else None
        if values is not None:
            sides.append(finish[name](values))
    if not sides:
        return spark.createDataFrame([], CALC_SCHEMA)
    whole = sides[0].join(sides[1], "key", "full_outer") if len(sides) == 2 else sides[0]
    whole = calc.conform(whole)
    if start is not None:
        whole = whole.where(F.col("key") >= start)
    return whole if stop is None else whole.where(F.col("key") < stop)
