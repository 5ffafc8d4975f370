"""Landed tables: parquet under one root, and the log that says which files count.

``<root>/<feed>/rows/part=/day=``       typed rows of a feed
``<root>/<feed>/seconds/part=/day=``    rows per second: for numbering, and to know what a commit touched
``<root>/<feed>/rejects/part=``         refused messages
``<root>/<feed>/covered/part=``         ranges of offsets that were looked at
``<root>/<feed>/log``                   commits over these four (see ``sources.log``)

A part is what one job has written. Its name begins with the time, so what was never committed can be swept.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from pulsebar.functions import clock
from pulsebar.layout import COVERED_SCHEMA, FEEDS, IDENTITY, REJECT_SCHEMA, SECOND_SCHEMA, Feed
from pulsebar.operators import ledger, parse, sequence
from pulsebar.sources import workdir
from pulsebar.sources.log import Change, Conflict, Log, State, day_of

ROWS, SECONDS, REJECTS, COVERED = "rows", "seconds", "rejects", "covered"
BY_DAY = (ROWS, SECONDS)
ZONE = "zone"
#: times a job starts again when others keep changing what it was made from
ATTEMPTS = 20
#: pieces below this are packed together, and how old an uncommitted or replaced part is when it is swept
SMALL_BYTES, SWEEP_SECONDS = 64 << 20, 86_400
#: small pieces of a day a landing leaves before it packs them itself
TIDY = 32


def folder(root: str, feed: Feed, table: str) -> str:
    return f"{root}/{feed.name}/{table}"


def log_of(spark: SparkSession, root: str, feed: Feed) -> Log:
    return Log(spark, f"{root}/{feed.name}/log")


def schema_of(feed: Feed, table: str) -> str:
    return {ROWS: feed.schema, SECONDS: SECOND_SCHEMA, REJECTS: REJECT_SCHEMA, COVERED: COVERED_SCHEMA}[table]


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def new_part() -> str:
    return f"{time.time_ns():020d}-{new_run()}"


# -- parts ----------------------------------------------------------------------


def write_part(frame: DataFrame, path: str, by_day: bool = True, packed: bool = True) -> dict[str, list]:
    """Write rows as a part of their own; its pieces with their bytes, for a commit. No rows give no piece.

    Rebalancing sends a day's rows to few tasks, so that it gets few files, and lets adaptive execution
    split the large ones again.
    """
    spark, part = frame.sparkSession, f"part={new_part()}"
    if by_day:
        (frame.hint("rebalance", "day") if packed else frame).write.partitionBy("day").parquet(f"{path}/{part}")
        pieces = [f"{part}/{name}" for name in workdir.folders(spark, f"{path}/{part}") if name.startswith("day=")]
    else:
        (frame.hint("rebalance") if packed else frame).write.parquet(f"{path}/{part}")
        pieces = [part] if any(name.endswith(".parquet") for name in workdir.files(spark, f"{path}/{part}")) else []
    return {piece: [workdir.size_of(spark, f"{path}/{piece}"), None] for piece in pieces}


def read_pieces(spark: SparkSession, path: str, pieces: Iterable[str], schema: str | StructType) -> DataFrame:
    """The rows of some pieces with their part. They are named, so nothing else is listed."""
    paths = [f"{path}/{piece}" for piece in pieces]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def read_table(spark: SparkSession, root: str, feed: Feed, table: str, pieces: Iterable[str] | None = None) -> DataFrame:
    """Rows of a table as committed; ``pieces`` limits them to some of it."""
    if pieces is None:
        pieces = log_of(spark, root, feed).read().of(table)
    return read_pieces(spark, folder(root, feed, table), pieces, schema_of(feed, table))


def read_rows(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """All landed rows of a feed."""
    return read_table(spark, root, feed, ROWS).drop("part")


def scan(spark: SparkSession, root: str, feed: Feed, start: int, stop: int, seen: State | None = None) -> DataFrame:
    """Rows with ``start <= epoch_s < stop``; only the days in range are read."""
    seen = seen or log_of(spark, root, feed).read()
    pieces = seen.between(ROWS, clock.utc_date(start), clock.utc_date(stop - 1))
    second = F.col("epoch_s")
    return read_table(spark, root, feed, ROWS, pieces).drop("part").where((second >= start) & (second < stop))


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Refused messages of all feeds, each once however often it was replayed."""
    every = [read_table(spark, root, feed, REJECTS).drop("part") for feed in FEEDS.values()]
    return reduce(DataFrame.unionByName, every).dropDuplicates(["source", *IDENTITY])


def read_covered(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """The ranges of offsets that have been landed or refused, as few as there are gaps."""
    return ledger.merged(read_table(spark, root, feed, COVERED))


def check_zone(seen: State, feed: Feed, zone: str) -> None:
    """Refuse another zone than the feed's, under which its messages would land a second time."""
    known = seen.facts.get(ZONE, zone)
    if known != zone:
        raise ValueError(f"{feed.name} were landed under {known}, not {zone}")


# -- landing --------------------------------------------------------------------


def retried(made: Callable[[], None], attempts: int | None = None) -> None:
    """Run a job that ends in a commit, again while others get in its way."""
    for left in reversed(range(attempts or ATTEMPTS)):
        try:
            return made()
        except Conflict:
            if not left:
                raise


def _days_held(good: DataFrame, seen: State, root: str, feed: Feed) -> tuple[set[date], set[date]]:
    """Days of the batch that the table has rows of, and those of them with a message looked at before.

    No more than the table has, whatever dates senders write.
    """
    known = seen.days(ROWS)
    if not known:
        return set(), set()
    spark = good.sparkSession
    # one literal, so no Python process starts for it
    listed = F.from_json(F.lit(json.dumps(sorted(day.isoformat() for day in known))), "array<date>")
    held = spark.range(1).select(F.explode(listed).alias("day"))
    ranges = ledger.merged(read_table(spark, root, feed, COVERED, seen.of(COVERED)))
    met = ledger.marked(good.select(*IDENTITY, "day"), ranges).join(held, "day", "left_semi")
    found = met.select("day", "again").distinct().collect()
    return {row.day for row in found}, {row.day for row in found if row.again}


def land_parsed(
    parsed: DataFrame, feed: Feed, root: str, zone: str = "UTC", refused: int | None = None,
    run: tuple[str, int] | None = None, replace: bool = False,
) -> None:
    """Land parsed messages in one commit: rows, their seconds, refusals and the offsets looked at.

    A message that is there stays; with ``replace``, one that is there with other content is replaced where it
    lies. ``run`` names a stream and its batch, which is landed once. ``refused`` tells how many are refused, if known.
    ``parsed`` is read several times.

    Row keys go on from the seconds in the state the commit is made from; if another commit has
    numbered rows of the same days meanwhile, this one starts again, so no key is given twice.
    """
    spark = parsed.sparkSession
    log = log_of(spark, root, feed)

    def once() -> None:
        seen = log.read()
        check_zone(seen, feed, zone)
        if run is not None and seen.runs.get(run[0], -1) >= run[1]:
            return
        change = Change(facts={ZONE: zone}, runs=dict([run] if run else []), exclusive=[SECONDS])
        _add(change, parsed, seen, feed, root, replace)
        if refused != 0:
            change.add[REJECTS] = write_part(parse.rejects(parsed, feed), folder(root, feed, REJECTS), by_day=False)
        change.add[COVERED] = write_part(ledger.intervals(parsed), folder(root, feed, COVERED), by_day=False)
        if any(change.add.values()):
            log.commit(seen, change)

    retried(once)
    tidy(spark, root, feed)


def _add(change: Change, parsed: DataFrame, seen: State, feed: Feed, root: str, replace: bool) -> None:
    """Write new and changed rows and the seconds they touch, and note them."""
    spark, good = parsed.sparkSession, parse.accepted(parsed)
    keys = [*IDENTITY, "day"]
    days, doubtful = _days_held(good, seen, root, feed)
    touched = []
    new, met = good, None
    # an offset never looked at is no row's, so only the others are held against what has landed
    if doubtful:
        landed = read_table(spark, root, feed, ROWS, seen.on(ROWS, doubtful))
        content = [name for name in good.columns if name not in keys]
        # only what identifies a message, and a hash of the rest, meets the landed rows
        there = landed.select(*keys, F.xxhash64(*content).alias("there"), "part", F.col("epoch_s").alias("old_s"))
        new = good.join(there.select(*keys), keys, "left_anti")
        if replace:
            ours = good.select(*keys, F.xxhash64(*content).alias("ours"), "epoch_s")
            # kept, as all that follows needs the landed rows for nothing else; without a part a message is new
            met = ours.join(there, keys, "left").where("part IS NULL OR there <> ours").drop("there", "ours")
            met = met.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if met is not None:
            changed = met.where("part IS NOT NULL")
            known = F.col("part").isNotNull()
            found = met.select("part", F.when(known, F.col("day")).alias("day")).distinct().collect()  # the table's pieces, one more
            where = [row for row in found if row.part is not None]
            if where:
                pieces = [f"part={row.part}/day={row.day.isoformat()}" for row in where]
                change.remove[ROWS] = pieces
                change.add[ROWS] = _replaced(good.join(changed.select(*keys), keys, "left_semi"), pieces, feed, root)
                for second in ("old_s", "epoch_s"):
                    touched.append(changed.select("topic", "day", F.col(second).alias("epoch_s"), F.lit(0).cast("bigint").alias("n")))
            if len(where) == len(found):
                new = None
        _add_new(change, new, touched, seen.on(SECONDS, days), feed, root, spark)
    finally:
        if met is not None:
            met.unpersist()


def _add_new(
    change: Change, new: DataFrame | None, touched: list[DataFrame], held: list[str], feed: Feed, root: str, spark: SparkSession
) -> None:
    """Number and write the new rows, if there are any, and the seconds they and the ``touched`` are of."""
    pieces = {}
    if new is not None:
        prior = None
        if held:
            prior = read_table(spark, root, feed, SECONDS, held).groupBy("topic", "epoch_s").agg(F.sum("n").alias("n"))
        keyed = sequence.with_row_key(sequence.number_in_second(new, prior=prior))
        pieces = write_part(keyed, folder(root, feed, ROWS))
        change.add[ROWS] = change.add.get(ROWS, {}) | pieces
    if pieces:
        written = read_table(spark, root, feed, ROWS, pieces)
        touched.append(written.groupBy("topic", "day", "epoch_s").agg(F.count(F.lit(1)).alias("n")))
    if touched:
        seconds = reduce(DataFrame.unionByName, touched).groupBy("topic", "epoch_s", "day").agg(F.sum("n").alias("n"))
        change.add[SECONDS] = write_part(seconds, folder(root, feed, SECONDS))


def _replaced(changed: DataFrame, pieces: list[str], feed: Feed, root: str) -> dict[str, list]:
    """The rows of some pieces, written anew with changed messages in place of the landed ones, under the same row keys."""
    keys = [*IDENTITY, "day"]
    columns = [name for name in changed.columns if name not in keys]
    whole = read_table(changed.sparkSession, root, feed, ROWS, pieces).select(*keys, "row_key", F.struct(*columns).alias("old"))
    both = whole.join(changed.select(*keys, F.struct(*columns).alias("new")), keys, "left")
    return write_part(both.select(*keys, "row_key", F.coalesce("new", "old").alias("kept")).select(*keys, "row_key", "kept.*"), folder(root, feed, ROWS))


# -- upkeep -----------------------------------------------------------------------


def _crowded(seen: State, table: str, small: int, least: int = 2) -> dict[str, list[str]]:
    """Small pieces by day, of the days that have ``least`` of them."""
    by_day: dict[str, list[str]] = {}
    for piece, (_, size) in seen.of(table).items():
        if size < small:
            by_day.setdefault(day_of(piece) if table in BY_DAY else "", []).append(piece)
    return {day: pieces for day, pieces in by_day.items() if len(pieces) >= least}


def tidy(spark: SparkSession, root: str, feed: Feed) -> None:
    """Pack what many small commits have left, if it has become much; what a running stream reads stays few files.

    Whether it is done makes no difference to rows, so it gives way to other commits.
    """
    seen = log_of(spark, root, feed).read()
    if any(_crowded(seen, table, SMALL_BYTES, TIDY) for table in (ROWS, SECONDS, REJECTS, COVERED)):
        try:
            compact(spark, root, feed, least=TIDY, attempts=1)
        except Conflict:
            pass


def compact(
    spark: SparkSession, root: str, feed: Feed, small: int = SMALL_BYTES, least: int = 2, attempts: int | None = None
) -> None:
    """Pack the small pieces of each day into few files: rows in the order of their keys, seconds added up, ranges merged.

    One commit, so readers see all of it or nothing. Rows, keys and what a commit has touched stay as they are.
    """
    log = log_of(spark, root, feed)

    def packed(table: str, pieces: list[str]) -> dict[str, list]:
        path = folder(root, feed, table)
        rows = read_table(spark, root, feed, table, pieces).drop("part")
        if table == ROWS:
            ordered = rows.repartitionByRange("day", "row_key").sortWithinPartitions("day", "row_key")
            return write_part(ordered, path, packed=False)
        if table == SECONDS:
            return write_part(rows.groupBy("topic", "epoch_s", "day").agg(F.sum("n").alias("n")), path)
        if table == COVERED:
            return write_part(ledger.merged(rows), path, by_day=False)
        return write_part(rows.dropDuplicates(["source", *IDENTITY]), path, by_day=False)

    def once() -> None:
        seen, change = log.read(), Change()
        for table in (ROWS, SECONDS, REJECTS, COVERED):
            crowded = _crowded(seen, table, small, least)
            if not crowded:
                continue
            old = [piece for pieces in crowded.values() for piece in pieces]
            new = packed(table, old)
            for piece, entry in new.items():
                # counts as old as the newest it holds
                day = day_of(piece) if table in BY_DAY else ""
                entry[1] = max(seen.of(table)[one][0] for one in crowded[day])
            change.remove[table], change.add[table] = old, new
        if change.remove:
            log.commit(seen, change)

    retried(once, attempts)


def sweep(spark: SparkSession, root: str, feed: Feed, seconds: float = SWEEP_SECONDS) -> None:
    """Delete parts no commit holds, if they were begun ``seconds`` ago; readers and jobs of that age must be done."""
    seen = log_of(spark, root, feed).read()
    for table in (ROWS, SECONDS, REJECTS, COVERED):
        sweep_parts(spark, folder(root, feed, table), seen.of(table), seconds)


def sweep_parts(spark: SparkSession, path: str, held: Iterable[str], seconds: float) -> None:
    """The same for one table: of parts some pieces of which are replaced, those pieces."""
    held, before = set(held), time.time_ns() - int(seconds * 1e9)
    kept = {piece.partition("/")[0] for piece in held}
    for part in workdir.folders(spark, path):
        if int(part.removeprefix("part=").partition("-")[0]) >= before:
            continue
        if part not in kept:
            workdir.remove(spark, f"{path}/{part}")
            continue
        for day in workdir.folders(spark, f"{path}/{part}"):
            if day.startswith("day=") and f"{part}/{day}" not in held:
                workdir.remove(spark, f"{path}/{part}/{day}")
