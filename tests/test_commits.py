"""Commits, the ledger of offsets, revisions of bucket values, recounts, folding and packing."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from pulsebar.layout import POSTS, TICKS
from pulsebar.operators import ledger, rollup
from pulsebar.plans import catalogue, jobs
from pulsebar.sources import log, series, tables, workdir
from pulsebar.streaming import landing
from tests.test_jobs import BASE, HOUR, batch, land, landed, post, price_parts, publish, put_file, put_prices, tick
from tests.test_lossless import DAY, junk, prices


class Lost(Exception):
    """The driver is gone."""


def stopped_at_every_step(spark, monkeypatch, job, state):
    """Run a job, lost before its first step that writes or deletes, then before its second, and so on to its end.

    After each loss the state has to be the one before or the one after.
    """
    steps = [(tables, "write_part"), (workdir, "put_new"), (workdir, "remove")]
    before = state()
    for number in itertools.count():
        left = iter(range(number))
        with monkeypatch.context() as patch:
            for module, name in steps:
                def step(*given, real=getattr(module, name), **more):
                    if next(left, None) is None:
                        raise Lost
                    return real(*given, **more)

                patch.setattr(module, name, step)
            try:
                job()
                break
            except Lost:
                pass
        now = state()
        if now != before:  # committed; what is left to do is tidying up
            job()
            assert state() == now
            break
    assert number > 1 and state() != before
    return state()


# -- log ------------------------------------------------------------------------


def test_log_goes_on_from_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 4)
    book, pieces = log.Log(spark, str(tmp_path / "log")), {}
    for k in range(19):
        change = log.Change(add={"t": {f"part={k}": [10 + k, None]}}, runs={"r": k}, facts={"last": k})
        if k % 3 == 2:
            change.remove = {"t": [f"part={k - 1}"]}
            del pieces[f"part={k - 1}"]
        pieces[f"part={k}"] = [k + 1, 10 + k]
        state = book.read()
        state.facts.pop("last", None)
        book.commit(state, change)
    state = book.read()
    assert (state.version, state.of("t"), state.runs, state.facts) == (19, pieces, {"r": 18}, {"last": 18})
    assert len(workdir.files(spark, str(tmp_path / "log"))) < 12


def test_log_refuses_what_no_longer_fits(spark, tmp_path):
    book = log.Log(spark, str(tmp_path / "log"))
    book.commit(book.read(), log.Change(add={"t": {"a/day=2024-01-01": [1, None], "b/day=2024-01-02": [1, None]}}))
    seen = book.read()
    book.commit(seen, log.Change(remove={"t": ["a/day=2024-01-01"]}, add={"s": {"c/day=2024-01-05": [1, None]}}, exclusive=["s"], runs={"r": 3}))
    assert book.commit(seen, log.Change(remove={"t": ["b/day=2024-01-02"]})) == 3
    for change in (
        log.Change(remove={"t": ["a/day=2024-01-01"]}), log.Change(runs={"r": 3}),
        log.Change(add={"s": {"d/day=2024-01-05": [1, None]}}, exclusive=["s"]),
    ):
        with pytest.raises(log.Conflict):
            book.commit(seen, change)
    assert book.commit(seen, log.Change(add={"s": {"d/day=2024-01-06": [1, None]}}, exclusive=["s"], runs={"r": 4})) == 4


def test_a_commit_held_up_past_the_snapshots_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 2)
    book = log.Log(spark, str(tmp_path / "log"))
    old = book.read()
    for k in range(8):
        book.commit(book.read(), log.Change(runs={"r": k}))
    with pytest.raises(log.Conflict):
        book.commit(old, log.Change(runs={"other": 1}))
    assert book.read().runs == {"r": 7}


# -- ledger -----------------------------------------------------------------------


def test_intervals_are_the_offsets(spark):
    draw = random.Random(3)
    offsets = {(p, draw.randrange(60)) for p in (0, 1) for _ in range(70)} | {(2, k) for k in range(40)}
    rows = [("t", p, k) for p, k in offsets] * 2
    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    for span in (7, 1 << 16):
        found = [tuple(r) for r in ledger.intervals(frame, span).collect()]
        assert {(p, k) for _, p, a, b in found for k in range(a, b + 1)} == offsets
        assert len(found) == sum((p, k - 1) not in offsets for p, k in offsets)
    halves = ledger.intervals(frame.where("offset < 30"), 5).unionByName(ledger.intervals(frame.where("offset > 20"), 9))
    assert sorted(ledger.merged(halves).collect()) == sorted(ledger.intervals(frame).collect())
    marked = ledger.marked(frame, ledger.intervals(frame.where("offset % 3 = 0 AND partition < 2"))).distinct().collect()
    assert {(r.partition, r.offset) for r in marked if r.again} == {(p, k) for p, k in offsets if k % 3 == 0 and p < 2}


def test_a_message_meets_few_of_many_ranges(spark):
    """Every other offset: as many ranges as messages. Held against all of them, this takes minutes."""
    ids = spark.range(-60_000, 60_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    ranges = ledger.merged(ledger.intervals(ids.where("offset % 2 = 0")))
    assert ranges.count() == 60_000
    began = time.monotonic()
    found = ledger.marked(ids, ranges).groupBy((F.col("offset") % 2 == 0).alias("even")).agg(F.count_if("again").alias("n")).collect()
    assert {r.even: r.n for r in found} == {True: 60_000, False: 0}
    assert time.monotonic() - began < 40


def test_ranges_are_merged_over_the_edges_of_chunks(spark):
    draw = random.Random(5)
    rows = [("t", p, start, start + draw.randrange(25)) for p in (0, None) for start in (draw.randrange(-300, 300) for _ in range(40))]
    frame = spark.createDataFrame([*rows, ("t", 0, None, None)], "topic string, partition int, start bigint, stop bigint")
    for span in (4, 16, 1 << 16):
        found = [tuple(r)[1:] for r in ledger.merged(frame, span).collect()]
        assert (0, None, None) in found
        for p in (0, None):
            held = {k for _, q, a, b in rows if q == p for k in range(a, b + 1)}
            own = [(a, b) for q, a, b in found if q == p and a is not None]
            assert sorted(k for a, b in own for k in range(a, b + 1)) == sorted(held)
            assert len(own) == sum(k - 1 not in held for k in held)


def test_a_stream_in_two_batches_is_written_by_many_tasks(spark, tmp_path):
    frame = batch(spark, [tick(k, k) for k in range(200)])
    first = F.col("offset") >= 120
    stream, seen = catalogue._in_two_batches(frame, first, str(tmp_path / "in")), []

    def take(part, number):
        seen.append((sorted(r.offset for r in part.select("offset").collect()), len(part.inputFiles())))

    stream.writeStream.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).foreachBatch(take).start().awaitTermination()
    assert [offsets for offsets, _ in seen] == [[*range(120, 200)], [*range(120)]]
    assert len(workdir.files(spark, str(tmp_path / "in" / "part-0"))) > 2 and len(workdir.files(spark, str(tmp_path / "in" / "part-1"))) > 2


def test_corrections_alone_number_nothing(spark, tmp_path, monkeypatch):
    """Messages that have all landed before are compared once, and not brought to the numbering at all."""
    root = str(tmp_path)
    jobs.backfill(batch(spark, [tick(k, 10 * k, last="1.5") for k in range(20)]), TICKS, root)
    before = {r.offset: r.row_key for r in tables.read_rows(spark, root, TICKS).collect()}
    with monkeypatch.context() as patch:
        patch.setattr(tables.sequence, "number_in_second", None)
        jobs.backfill(batch(spark, [tick(k, 10 * k, last="2.5") for k in range(5, 20)]), TICKS, root)
        jobs.backfill(batch(spark, [tick(k, 10 * k, last="2.5") for k in range(5, 20)]), TICKS, root)
    rows = tables.read_rows(spark, root, TICKS).collect()
    assert {r.offset: r.row_key for r in rows} == before and len(rows) == 20
    assert {r.offset: r.last for r in rows} == {k: 1.5 if k < 5 else 2.5 for k in range(20)}
    jobs.backfill(batch(spark, [tick(19, 190, last="9.5"), tick(20, 190)]), TICKS, root)
    assert len(landed(spark, root)) == 21


def test_resume_lands_what_a_range_left_out(spark, tmp_path):
    root = str(tmp_path)
    rows = [tick(1, 10), tick(2, 100), tick(3, 20), junk("bad", offset=4)]
    jobs.backfill(batch(spark, rows), TICKS, root, stop=BASE + 50)
    assert [tuple(r)[2:] for r in tables.read_covered(spark, root, TICKS).orderBy("start").collect()] == [(1, 1), (3, 4)]
    jobs.backfill(batch(spark, rows), TICKS, root, resume=True)
    assert sorted(landed(spark, root)) == [1, 2, 3]
    assert [tuple(r)[2:] for r in tables.read_covered(spark, root, TICKS).collect()] == [(1, 4)]


def test_resume_fills_in_what_lies_before_a_stream(spark, tmp_path):
    root, folder = str(tmp_path / "root"), str(tmp_path / "in")
    put_file(spark, folder, [tick(10, 100)], "a")
    land(spark, folder, root)
    jobs.backfill(batch(spark, [tick(k, 10 * k) for k in range(1, 11)]), TICKS, root, resume=True)
    assert sorted(landed(spark, root)) == list(range(1, 11))
    # any mix of starts, stops, repeats and live landing leaves no gap and no double
    put_file(spark, folder, [tick(k, 10 * k) for k in (14, 15)], "b")
    for start, stop in ((110, 130), (120, 140), (90, 110)):
        jobs.backfill(batch(spark, [tick(k, 10 * k) for k in range(1, 21)]), TICKS, root, BASE + start, BASE + stop, resume=True)
    land(spark, folder, root)
    jobs.backfill(batch(spark, [tick(k, 10 * k) for k in range(1, 21)]), TICKS, root, resume=True)
    assert tables.read_rows(spark, root, TICKS).count() == 20 and sorted(landed(spark, root)) == list(range(1, 21))
    assert [tuple(r)[2:] for r in tables.read_covered(spark, root, TICKS).collect()] == [(1, 20)]
    tables.compact(spark, root, TICKS)
    assert len(tables.log_of(spark, root, TICKS).read().of(tables.COVERED)) == 1
    assert tables.read_table(spark, root, TICKS, tables.COVERED).count() == 1


def test_a_topic_made_anew_is_landed(spark, tmp_path):
    """Offsets that start again belong to other messages, on other days."""
    root = str(tmp_path)
    for number in range(2):
        landing.write_batch(batch(spark, [tick(0, 5 + number * DAY), tick(1, 6 + number * DAY)]), number, TICKS, root)
    assert tables.read_rows(spark, root, TICKS).count() == 4


# -- one commit ---------------------------------------------------------------------


def test_backfill_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    """New, changed and refused messages, seconds and ledger change at once."""
    root = str(tmp_path)
    jobs.backfill(batch(spark, [tick(0, 5), tick(1, DAY), junk("one", offset=2)]), TICKS, root)
    sent = batch(spark, [tick(0, 5, last="9"), tick(1, DAY), tick(3, 5), junk("two", offset=4)])

    def state():
        read = [tables.read_table(spark, root, TICKS, name) for name in (tables.ROWS, tables.SECONDS, tables.REJECTS, tables.COVERED)]
        return [sorted(map(str, frame.drop("part").collect())) for frame in read]

    rows, seconds, refused, _ = stopped_at_every_step(spark, monkeypatch, lambda: jobs.backfill(sent, TICKS, root), state)
    assert len(rows) == 3 and len(refused) == 2 and sorted(landed(spark, root)) == [0, 1, 3]
    assert {r.offset: r.last for r in tables.read_rows(spark, root, TICKS).collect()}[0] == 9.0
    tables.sweep(spark, root, TICKS, 0)
    assert state()[0] == rows and set(seconds) <= set(state()[1])


def test_compaction_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for number in range(3):
        landing.write_batch(batch(spark, [tick(2 * number, 5), tick(2 * number + 1, DAY)]), number, TICKS, root)
    keys = landed(spark, root)

    def state():
        assert landed(spark, root) == keys
        return {table: len(pieces) for table, pieces in tables.log_of(spark, root, TICKS).read().pieces.items()}

    after = stopped_at_every_step(spark, monkeypatch, lambda: tables.compact(spark, root, TICKS), state)
    assert after[tables.ROWS] == after[tables.SECONDS] == 2 and after[tables.COVERED] == 1


def test_fold_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for value in (1.0, 2.0):
        put_prices(spark, root, [(0, value), (DAY, value)])

    def state():
        assert prices(spark, root) == {0: 2.0, DAY: 2.0}
        return len(price_parts(spark, root))

    assert stopped_at_every_step(spark, monkeypatch, lambda: series.fold(spark, root, series.price()), state) == 2


def test_two_jobs_numbering_a_second_give_no_key_twice(spark, tmp_path, monkeypatch):
    root, real, calls = str(tmp_path), log.Log.commit, []

    def late(self, seen, change):
        if not calls:
            calls.append(self)
            jobs.backfill(batch(spark, [tick(k, 5) for k in range(3)]), TICKS, root)
        return real(self, seen, change)

    monkeypatch.setattr(log.Log, "commit", late)
    jobs.backfill(batch(spark, [tick(k, 5) for k in range(2, 7)]), TICKS, root)
    assert sorted(landed(spark, root)) == list(range(7))
    assert sorted(landed(spark, root).values()) == [(BASE + 5) * 1000 + k for k in range(7)]


def test_many_batches_pack_into_few_files(spark, tmp_path):
    root, batches = str(tmp_path), 20
    for number in range(batches):
        landing.write_batch(batch(spark, [tick(2 * number, 5 + number % 3), junk("x", offset=2 * number + 1)]), number, TICKS, root)
    keys = landed(spark, root)
    tables.compact(spark, root, TICKS)
    state = tables.log_of(spark, root, TICKS).read()
    assert all(len(state.of(table)) == 1 for table in (tables.ROWS, tables.SECONDS, tables.REJECTS, tables.COVERED))
    assert len(tables.read_rows(spark, root, TICKS).inputFiles()) <= 2
    tables.sweep(spark, root, TICKS, 0)
    assert len(workdir.folders(spark, tables.folder(root, TICKS, tables.ROWS))) == 1
    assert landed(spark, root) == keys and tables.read_rejects(spark, root).count() == batches
    landing.write_batch(batch(spark, [tick(1000, 5), tick(0, 5)]), batches, TICKS, root)
    first = sum(k % 3 == 0 for k in range(batches))
    assert landed(spark, root) == keys | {1000: (BASE + 5) * 1000 + first}


def test_a_stream_packs_what_it_leaves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TIDY", 4)
    root = str(tmp_path)
    for number in range(9):
        landing.write_batch(batch(spark, [tick(3 * number, 5), tick(3 * number + 1, number * DAY)]), number, TICKS, root)
        state = tables.log_of(spark, root, TICKS).read()
        assert len(state.of(tables.COVERED)) < 4 and len(state.on(tables.ROWS, state.days(tables.ROWS))) < 4 + number
    series.recount(spark, root, series.price())
    assert len(landed(spark, root)) == 18 == len(set(landed(spark, root).values())) and len(prices(spark, root)) == 9


def test_a_scan_of_an_hour_leaves_most_of_a_packed_day_unread(spark, tmp_path):
    """Packed rows lie in the order of their keys, so each file covers a span of the day and says so in its footer."""
    root, name = str(tmp_path), "spark.sql.adaptive.coalescePartitions.enabled"
    for number in range(2):
        landing.write_batch(batch(spark, [tick(2 * k + number, 100 * k) for k in range(800)]), number, TICKS, root)

    def scanned():
        hour = tables.scan(spark, root, TICKS, BASE + 7 * HOUR, BASE + 8 * HOUR)
        assert len(hour.collect()) == 72
        nodes = [hour._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            if "Scan" in node.nodeName():
                return node.metrics().get("numOutputRows").get().value()
            nodes += [node.children().apply(k) for k in range(node.children().size())]

    assert scanned() == 1600
    spark.conf.set(name, "false")
    try:
        tables.compact(spark, root, TICKS)
    finally:
        spark.conf.unset(name)
    assert scanned() <= 800
    for path in tables.read_rows(spark, root, TICKS).inputFiles():
        keys = [r.row_key for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys)


# -- identity and revisions ---------------------------------------------------------


def test_a_corrected_bucket_is_counted_anew(spark, tmp_path):
    root = str(tmp_path)
    jobs.backfill(batch(spark, [tick(0, 10, last="100"), tick(1, 20, last="900"), tick(2, 310, last="7")]), TICKS, root)
    jobs.roll_up_price(spark, root, BASE, BASE + HOUR)
    assert prices(spark, root) == {BASE: 500.0, BASE + 300: 7.0}
    jobs.backfill(batch(spark, [tick(1, 20, pair="USDT_ETH", last="900"), tick(2, 310, pair="USDT_ETH", last="7")]), TICKS, root)
    jobs.roll_up_price(spark, root, BASE, BASE + HOUR)
    # the first has one tick less, the second none: its value is gone
    assert prices(spark, root) == {BASE: 100.0}
    # a live value does not hide it, however many rows it was counted from, nor does it come back by a fold
    put_prices(spark, root, [(BASE, 500.0, 9), (BASE + 300, 7.0, 9), (BASE + 600, 1.0)], live=True)
    assert prices(spark, root) == {BASE: 100.0, BASE + 600: 1.0}
    series.fold(spark, root, series.price())
    put_prices(spark, root, [(BASE + 300, 7.0, 10)], live=True)
    assert prices(spark, root) == {BASE: 100.0, BASE + 600: 1.0}


def test_series_are_kept_apart(spark, tmp_path):
    root = str(tmp_path)
    jobs.backfill(batch(spark, [tick(k, 10 * k, last="101") for k in range(3)] + [tick(3, 310, "USDT_ETH", "8")]), TICKS, root)
    jobs.roll_up_price(spark, root, BASE, BASE + HOUR)
    assert prices(spark, root) == {BASE: 101.0}
    jobs.roll_up_price(spark, root, BASE, BASE + HOUR, pair="USDT_ETH")
    jobs.roll_up_price(spark, root, BASE, BASE + HOUR, pair="USDT_ETH", width=60)
    with pytest.raises(ValueError, match="which price"):
        series.read_calc(spark, root)
    found = {}
    for of in (series.price(), series.price("USDT_ETH"), series.price("USDT_ETH", 60)):
        found[of] = [(r.key - BASE, r.last) for r in series.read_calc(spark, root, prices=of).collect()]
    assert list(found.values()) == [[(0, 101.0)], [(300, 8.0)], [(300, 8.0)]]
    assert sorted(series.stored(spark, root, series.PRICE), key=repr) == sorted(found, key=repr)
    odd = series.price("a/b,c=%", 7)
    put = spark.createDataFrame([(0, 1.0, 1, 1)], "key bigint, total double, n bigint, counted bigint")
    series.put_live(put, root, odd)
    assert odd in series.stored(spark, root, series.PRICE)


def test_values_that_come_during_a_fold_are_not_hidden(spark, tmp_path, monkeypatch):
    """A slow write to one day, begun before the newest of another day."""
    root = str(tmp_path)
    put_prices(spark, root, [(0, 1.0)])
    put_prices(spark, root, [(0, 2.0)])
    real = tables.write_part
    put_prices(spark, root, [(DAY, 8.0)])
    put_prices(spark, root, [(DAY, 9.0)])

    def slow(*given, **more):
        monkeypatch.setattr(tables, "write_part", real)
        put_prices(spark, root, [(0, 5.0)])
        return real(*given, **more)

    monkeypatch.setattr(tables, "write_part", slow)
    series.fold(spark, root, series.price())
    assert prices(spark, root) == {0: 5.0, DAY: 9.0}


# -- recounts and folding -------------------------------------------------------------


def test_recount_reads_only_touched_days(spark, tmp_path, monkeypatch):
    root, folder = str(tmp_path / "root"), str(tmp_path / "in")
    put_file(spark, folder, [post(0, 10), post(1, 5 * HOUR)], "a")
    put_file(spark, folder, [post(2, 5 * HOUR + 1)], "b")
    put_file(spark, folder, [post(3, 20, "BTC")], "c")  # behind the watermark
    publish(spark, folder, root, series.social())
    land(spark, folder, root, POSTS)
    jobs.backfill(batch(spark, [(post(k, 0)[0].replace("2024-01-01", f"2024-01-{k:02}"), "posts", 0, k, None) for k in range(10, 20)]), POSTS, root)
    read = lambda: sorted(tuple(r)[:4] for r in series.read_calc(spark, root, keep="all").collect())
    assert read() == [(BASE, 1, 1, 1), (BASE + 5 * HOUR, 2, 2, 2)]
    series.recount(spark, root, series.social())
    rest = [(BASE + k * DAY, 1, 1, 1) for k in range(9, 19)]
    assert read() == [(BASE, 2, 2, 1), (BASE + 5 * HOUR, 2, 2, 2), *rest]
    # nothing new: nothing is counted
    version = series.log_of(spark, root, series.social()).read().version
    series.recount(spark, root, series.social())
    assert series.log_of(spark, root, series.social()).read().version == version
    # one late row, one day
    jobs.backfill(batch(spark, [post(50, 30, "none")]), POSTS, root)
    days = []
    real = tables.read_table

    def watched(spark, root, feed, table, pieces=None):
        if table == tables.ROWS:
            days.extend(log.day_of(piece) for piece in pieces)
        return real(spark, root, feed, table, pieces)

    monkeypatch.setattr(tables, "read_table", watched)
    series.recount(spark, root, series.social())
    assert set(days) == {"2024-01-01"} and read()[0] == (BASE, 3, 2, 1)


def test_recount_after_replaced_rows_and_packing(spark, tmp_path):
    root = str(tmp_path)
    for number in range(3):
        landing.write_batch(batch(spark, [tick(number, 10 + 300 * number, last="4")]), number, TICKS, root)
    series.recount(spark, root, series.price())
    assert len(prices(spark, root)) == 3
    tables.compact(spark, root, TICKS)
    # the second has moved to another bucket, the third is another pair's
    jobs.backfill(batch(spark, [tick(1, 1000, last="4"), tick(2, 610, "USDT_ETH", "4")]), TICKS, root)
    series.recount(spark, root, series.price())
    assert prices(spark, root) == {BASE: 4.0, BASE + 900: 4.0}


@pytest.mark.parametrize("width", [600, 3600, 2 * DAY])
def test_buckets_fold_into_larger_ones(spark, tmp_path, width):
    root, draw = str(tmp_path), random.Random(4)
    rows = [tick(k, draw.randrange(3 * DAY), last=draw.choice(["1.5", "x", "", "7", "0.25"])) for k in range(300)]
    jobs.backfill(batch(spark, rows), TICKS, root)
    jobs.roll_up_price(spark, root, BASE, BASE + 3 * DAY)
    want = {r.key: r.last for r in rollup.price(tables.read_rows(spark, root, TICKS), width=width).collect()}
    folded = series.read_calc(spark, root, width=width)
    assert {r.key: r.last for r in folded.collect()} == want
    assert not [path for path in folded.inputFiles() if "/ticks/" in path]
    with pytest.raises(ValueError):
        series.read_calc(spark, root, width=450)


def test_counts_fold_before_the_match(spark, tmp_path):
    """Two buckets with one word each match as one."""
    root = str(tmp_path)
    jobs.backfill(batch(spark, [post(0, 10, "BTC"), post(1, 310, "Bitcoin"), post(2, HOUR, "BTC")]), POSTS, root)
    jobs.roll_up_social(spark, root, BASE, BASE + DAY)
    assert series.read_calc(spark, root).isEmpty()
    assert [tuple(r)[:4] for r in series.read_calc(spark, root, width=HOUR).collect()] == [(BASE, 2, 1, 1)]
    assert series.read_calc(spark, root, keep="all").count() == 3
