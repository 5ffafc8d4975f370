"""Nothing that was landed is lost, doubled or hidden, whatever runs in which order."""

from __future__ import annotations

import os
import shutil
import time

import pytest

from pulsebar.layout import CHATS, POSTS, TICKS
from pulsebar.operators import cells, parse, produce
from pulsebar.plans import jobs
from pulsebar.sources import messages as sources
from pulsebar.sources import series, tables, workdir
from pulsebar.streaming import landing
from tests.test_jobs import BASE, batch, land, landed, post, price_parts, put_file, put_prices, tick

DAY = 86_400


def junk(value, topic="ticks", offset=0):
    return (value, topic, 0, offset, None)


def test_refused_messages_of_every_backfill_stay(spark, tmp_path):
    root = str(tmp_path)
    jobs.backfill(batch(spark, [junk("one"), junk("two", offset=1)]), TICKS, root)
    jobs.backfill(batch(spark, [junk("three", "other"), junk("two", offset=1)]), TICKS, root)
    assert sorted(r.value for r in tables.read_rejects(spark, root).collect()) == ["one", "three", "two"]


@pytest.mark.parametrize("order", ["fill fill", "fill live", "live fill"])
def test_no_key_twice(spark, tmp_path, order):
    root, offset = str(tmp_path / "root"), 0
    for place, kind in enumerate(order.split()):
        rows = [tick(offset + k, 5) for k in range(3)]
        offset += 3
        if kind == "fill":
            jobs.backfill(batch(spark, rows), TICKS, root)
        else:
            put_file(spark, str(tmp_path / "in"), rows, str(place))
            land(spark, str(tmp_path / "in"), root)
    assert sorted(landed(spark, root).values()) == [(BASE + 5) * 1000 + k for k in range(6)]


def test_resume_lands_every_offset(spark, tmp_path):
    root = str(tmp_path)
    rows = [tick(0, 5), tick(1, 6), junk("bad", offset=2)]
    jobs.backfill(batch(spark, rows), TICKS, root)
    more = [tick(3, 6), tick(4, 2), tick(5, 7)]  # the rest of a second, and a late row
    jobs.backfill(batch(spark, rows + more), TICKS, root, resume=True)
    assert sorted(landed(spark, root)) == [0, 1, 3, 4, 5]
    assert [tuple(r) for r in tables.read_covered(spark, root, TICKS).collect()] == [("ticks", 0, 0, 5)]


def test_a_new_checkpoint_replaces_and_doubles_nothing(spark, tmp_path):
    root, folder = str(tmp_path / "root"), str(tmp_path / "in")
    put_file(spark, folder, [tick(0, 5), tick(1, 5)], "a")
    land(spark, folder, root)
    first = landed(spark, root)
    shutil.rmtree(f"{root}/checkpoints")
    os.makedirs(tmp_path / "other")
    put_file(spark, folder, [tick(2, 5)], "b")
    land(spark, folder, root)
    got = landed(spark, root)
    assert first.items() <= got.items() and sorted(got) == [0, 1, 2] and len(set(got.values())) == 3
    assert tables.read_rows(spark, root, TICKS).count() == 3


def test_another_zone_is_refused(spark, tmp_path):
    jobs.backfill(batch(spark, [tick(0, 5)]), TICKS, str(tmp_path))
    with pytest.raises(ValueError, match="Zurich"):
        jobs.backfill(batch(spark, [tick(0, 5)]), TICKS, str(tmp_path), zone="Europe/Zurich")
    assert tables.read_rows(spark, str(tmp_path), TICKS).count() == 1


def test_an_upsert_leaves_other_days_alone(spark, tmp_path):
    root = str(tmp_path)
    jobs.backfill(batch(spark, [tick(k, k * DAY + 3) for k in range(20)]), TICKS, root)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in tables.read_rows(spark, root, TICKS)._jdf.inputFiles() for f in [f.removeprefix("file://")]}
    before = files()
    jobs.backfill(batch(spark, [tick(0, 3, last="7"), tick(19, 19 * DAY + 3), tick(50, 19 * DAY + 4)]), TICKS, root)
    after = files()
    assert len(before.items() & after.items()) == 19
    rows = {r.offset: (r.last, r.row_key) for r in tables.read_rows(spark, root, TICKS).collect()}
    assert len(rows) == 21 and rows[0] == (7.0, (BASE + 3) * 1000)


def test_stages_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workdir, "shared_folder", lambda session: str(tmp_path / "shared"))
    jobs.backfill(batch(spark, [tick(0, 5)]), TICKS, str(tmp_path / "root"))
    assert workdir.exists(spark, str(tmp_path / "shared")) and workdir.folders(spark, str(tmp_path / "shared" / "pulsebar")) == []


def test_empty_batches_and_writes_leave_no_folder(spark, tmp_path):
    root = str(tmp_path)
    landing.write_batch(batch(spark, []), 0, TICKS, root)
    assert os.listdir(root) == []
    put_prices(spark, root, [], live=True)
    assert price_parts(spark, root) == [] and series.log_of(spark, root, series.price()).read().version == 0


def prices(spark, root):
    return {r.key: r.last for r in series.read_calc(spark, root).collect()}


def test_a_fold_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for value in (1.0, 2.0):
        put_prices(spark, root, [(0, value)])
    real = tables.write_part

    def slow(*given, **more):
        monkeypatch.setattr(tables, "write_part", real)
        put_prices(spark, root, [(0, 3.0), (DAY, 4.0)])
        return real(*given, **more)

    monkeypatch.setattr(tables, "write_part", slow)
    series.fold(spark, root, series.price())
    assert prices(spark, root) == {0: 3.0, DAY: 4.0}
    series.fold(spark, root, series.price())
    assert prices(spark, root) == {0: 3.0, DAY: 4.0}
    assert len([p for p in price_parts(spark, root) if p.endswith("day=1970-01-01")]) == 1


def test_a_live_value_counted_from_more_rows_holds(spark, tmp_path):
    root = str(tmp_path)
    for value, counted in ((1.0, 4), (5.0, 5), (4.0, 4)):
        put_prices(spark, root, [(0, value, counted)], live=True)
    assert prices(spark, root) == {0: 5.0}
    series.fold(spark, root, series.price())
    assert prices(spark, root) == {0: 5.0}


def test_history_reads_only_its_days(spark, tmp_path):
    root = str(tmp_path)
    put_prices(spark, root, [(k * DAY, 1.0) for k in range(30)])
    frame = series.read_calc(spark, root, 3 * DAY, 5 * DAY)
    assert {path.split("day=")[1][:10] for path in frame.inputFiles()} == {"1970-01-04", "1970-01-05"}


def test_number_texts_stay(spark, tmp_path):
    root = str(tmp_path)
    value = "('A', '0.00000002', 'x1', '1.50', '', '0.00277130', '1e3', 0, 'NaN', 'Infinity', '2024-01-01 00:00:05')"
    jobs.backfill(batch(spark, [(value, "ticks", 0, 0, None), tick(1, 5)]), TICKS, root)
    got = {(r.row, r.qualifier): r.value for r in cells.melt(tables.read_rows(spark, root, TICKS), TICKS, "offset").collect()}
    assert [got["0", name] for name in ("last", "lowestask", "highestbid", "basevolume", "quotevolume", "24high", "24low")] == [
        "0.00000002", "x1", "1.50", "0.00277130", "1e3", "NaN", "Infinity",
    ]
    assert got["1", "last"] == "1.0"
    row = next(r for r in tables.read_rows(spark, root, TICKS).collect() if r.offset == 0)
    assert row.last == 2e-8 and row.lowest_ask is None and row.high_24h is None and row.low_24h is None
    sent = post(0, 5)[0].replace("1,2,3,", "x1,2,007,")
    (one,) = parse.accepted(parse.parse(batch(spark, [(sent, "posts", 0, 0, None)]), POSTS)).collect()
    assert one.followers is None and one.statuses == 7 and one.texts == ["x1", "2", "007"]


def test_produced_messages_land_as_they_were(spark, tmp_path):
    chats = spark.createDataFrame([("t", 1, "ann", "it's \U000e0067 \"so\"\t\\", 3)], "kind string, number int, user string, message string, reputation int")
    posts = spark.createDataFrame(
        [(1, 2, 3, f"{w}, x", "n", "en", "a, b", "2024-01-01 00:00:09") for w in ("BTC", "none", "bitcoin")],
        "followers int, friends int, statuses int, text string, screen_name string, language string, location string, created string",
    )
    for feed, rows in ((CHATS, chats), (POSTS, posts)):
        for _ in range(2):
            sources.keep(produce.messages(rows, feed), str(tmp_path / feed.name))
        sent = sources.read_messages(spark, "parquet", path=str(tmp_path / feed.name))
        assert sent.select("offset").distinct().count() == sent.count()
        jobs.backfill(sent, feed, str(tmp_path / "root"))
    got = tables.read_rows(spark, str(tmp_path / "root"), CHATS).collect()
    assert [(r.user, r.message) for r in got] == [("ann", "it's \U000e0067 \"so\"\t\\")] * 2
    got = tables.read_rows(spark, str(tmp_path / "root"), POSTS).collect()
    assert sorted(r.text for r in got) == ["BTC, x"] * 2 + ["bitcoin, x"] * 2


def test_time_text_is_not_cut(spark):
    row = post(0, 5)[0]
    frame = spark.createDataFrame([(1, "BTC", "2024-01-01 00:00:09+02:00")], "n int, t string, created string")
    made = frame.selectExpr("n followers", "n friends", "n statuses", "t text", "t screen_name", "t language", "t location", "created")
    (sent,) = produce.messages(made, POSTS).collect()
    assert sent.value.endswith("00:00:09+02:00") and row.endswith("00:00:05")


def test_ticks_are_stamped_with_the_time_they_arrive(spark, tmp_path):
    rows = spark.createDataFrame([("A", *["1"] * 6, 0, "1", "1")], "pair string, last string, lowest_ask string, highest_bid string, percent_change string, "
                                 "base_volume string, quote_volume string, is_frozen int, high_24h string, low_24h string")
    before = int(time.time())
    for zone in ("UTC", "Europe/Zurich"):
        (sent,) = produce.messages(rows, TICKS, zone).collect()
        (row,) = parse.accepted(parse.parse(batch(spark, [(sent.value, "ticks", 0, 0, None)]), TICKS, zone)).collect()
        assert before <= row.epoch_s <= time.time()


def test_live_jobs_run_every_five_minutes(spark, tmp_path):
    """The interval the live jobs ask for reaches the query, and a batch after the first waits for it."""
    assert landing.LIVE == {"processingTime": "5 minutes"}
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    left = 300 - time.time() % 300
    if left < 45:  # triggers fall on multiples of the interval
        time.sleep(left + 1)
    put_file(spark, folder, [tick(0, 5)], "a")
    query = landing.land(sources.stream_messages(spark, "parquet", path=folder), TICKS, root)
    try:
        for _ in range(600):
            if query.lastProgress is not None:
                break
            time.sleep(0.1)
        put_file(spark, folder, [tick(1, 6)], "b")
        time.sleep(3)
        assert sorted(landed(spark, root)) == [0]
        assert query.status["message"].startswith("Waiting for next trigger")
    finally:
        query.stop()
