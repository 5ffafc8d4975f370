"""Operators against brute force and against the plans they stand in for."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsebar.functions import clock
from pulsebar.layout import KEYWORDS, TICKS
from pulsebar.operators import calc, cells, rollup, sequence
from pulsebar.plans import feeds


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


# -- time ---------------------------------------------------------------------


def test_civil_seconds_in_every_session_zone(spark):
    times = ["2024-03-31 02:30:00", "2024-11-03 01:30:00", "1969-12-31 23:59:59", "1900-01-01 00:00:01", "2016-12-20 00:00:00.9"]
    want = [
        int((datetime.fromisoformat(t).replace(microsecond=0) - datetime(1970, 1, 1)).total_seconds())
        for t in times
    ]
    frame = spark.createDataFrame(list(enumerate(times)), "i int, t string")
    ts = F.col("t").cast("timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Europe/Zurich"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = frame.select(
                "i",
                clock.civil_seconds(ts).alias("s"),
                clock.civil_time(clock.civil_seconds(ts)).cast("string").alias("back"),
                clock.civil_text(ts).alias("text"),
                clock.day_of(clock.civil_seconds(ts)).cast("string").alias("day"),
            )
            for row in got.collect():
                assert row.s == want[row.i], (zone, times[row.i])
                assert row.back == row.text == times[row.i][:19]
                assert row.day == times[row.i][:10]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bucket_edges(spark):
    frame = spark.createDataFrame([(0,), (299,), (300,), (-1,), (1482192000,)], "s bigint")
    got = [row[0] for row in frame.select(clock.bucket_start(F.col("s"))).collect()]
    assert got == [0, 0, 300, -300, 1482192000]


def test_bucket_equals_window(spark, sf_dir):
    events = feeds.event_posts(feeds.table(spark, sf_dir, "events"))
    by_window = (
        events.groupBy(F.window(F.timestamp_seconds("epoch_s"), "5 minutes"))
        .count()
        .select(F.unix_seconds("window.start").alias("key"), F.col("count").alias("messages"))
    )
    assert rows_of(rollup.message_count(events)) == rows_of(by_window)


# -- roll-ups -----------------------------------------------------------------


def test_one_pass_equals_joined_counts(spark, sf_dir):
    posts = feeds.event_posts(feeds.table(spark, sf_dir, "events"))
    words = feeds.EVENT_WORDS
    key = clock.bucket_start(F.col("epoch_s")).alias("key")
    joined = posts.groupBy(key).agg(F.count("*").alias("messages"))
    for name, word in words.items():
        one = posts.where(F.col("text").like(f"%{word}%")).groupBy(key).agg(F.count("*").alias(name))
        joined = joined.join(one, ["key"])
    got = rollup.social(posts, words)
    assert rows_of(got) == rows_of(joined)
    assert got.columns == joined.columns


def test_keep_all_has_every_bucket(spark):
    posts = spark.createDataFrame(
        [(0, "BTC and Bitcoin"), (10, "btc"), (400, "BTC"), (900, None)], "epoch_s bigint, text string"
    )
    assert rows_of(rollup.social(posts)) == [(0, 2, 1, 1)]
    assert rows_of(rollup.social(posts, keep="all")) == [(0, 2, 1, 1), (300, 1, 1, 0), (900, 1, 0, 0)]
    assert rows_of(rollup.keyword_count(posts, KEYWORDS)) == [(0, 1, 1), (300, 1, 0), (900, 0, 0)]


def test_price_leaves_out_what_is_no_number(spark):
    ticks = spark.createDataFrame(
        [(0, "USDT_BTC", 1.0), (299, "USDT_BTC", 2.0), (299, "USDT_BTC", None), (300, "BTC_ETH", 9.0),
         (600, "USDT_BTC", None)],
        "epoch_s bigint, pair string, last double",
    )
    assert rows_of(rollup.price(ticks)) == [(0, 1.5), (600, None)]


def test_price_from_cells_equals_price_and_self_join(spark):
    ticks = spark.createDataFrame(
        [(1000, "USDT_BTC", "1.0"), (1001, "BTC_ETH", "7.0"), (299_000, "USDT_BTC", "2.0"),
         (300_000, "USDT_BTC", "5.0"), (600_000, "USDT_BTC", "n/a"), (900_000, "USDT_BTC", None),
         (1_200_000, None, "3.0")],
        "row_key bigint, pair string, last string",
    )
    keyed = ticks.where("last IS NOT NULL").select(
        "pair", F.col("last").try_cast("double").alias("last"),
        clock.key_second(F.col("row_key")).alias("epoch_s"),
    )
    melted = cells.melt(ticks, TICKS)
    named = melted.where("value = 'USDT_BTC'").select("row")
    joined = (
        melted.join(named, ["row"])
        .where("columnFamily = 'CurrencyRate' AND qualifier = 'last'")
        .selectExpr("cast(row / 300000 AS bigint) * 300 AS key", "try_cast(value AS double) AS last")
        .groupBy("key")
        .agg(F.avg("last").alias("last"))
    )
    got = rows_of(rollup.price_from_cells(melted))
    assert got == rows_of(rollup.price(keyed)) == rows_of(joined)
    assert got == [(0, 1.5), (300, 5.0), (600, None)]


def test_one_scan_one_shuffle(spark, sf_dir):
    posts = feeds.event_posts(feeds.table(spark, sf_dir, "events"))
    frame = rollup.social(posts, feeds.EVENT_WORDS)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2


def test_combine_adds_no_shuffle(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events")
    frame = calc.combine(
        rollup.social(feeds.event_posts(events), feeds.EVENT_WORDS),
        rollup.price(feeds.event_ticks(events), feeds.EVENT_PAIR),
    )
    assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2


def test_range_reaches_the_scan(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events")
    frame = feeds.event_ticks(events.where(clock.between_seconds(F.col("ts"), feeds.BASE, feeds.BASE + 600)))
    plan = frame.select("last")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


# -- numbering ----------------------------------------------------------------


def brute_force(rows):
    """(topic, second, partition, offset) -> place in arrival order of its second."""
    seen = defaultdict(int)
    places = {}
    for topic, second, partition, offset in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        places[topic, partition, offset] = seen[topic, second]
        seen[topic, second] += 1
    return places


@pytest.mark.parametrize("span", [1, 7, 1 << 16])
def test_numbering_equals_brute_force(spark, span):
    rng = random.Random(3)
    rows = [
        # one second of topic a holds a third of all rows
        (topic, 50 if rng.random() < 0.33 else rng.randint(0, 40), partition, offset)
        for topic in "ab"
        for partition in range(3)
        for offset in range(200)
    ]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "topic string, epoch_s bigint, partition int, offset bigint")
    got = sequence.number_in_second(frame, span=span).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    for row in got:
        assert row.seq == want[row.topic, row.partition, row.offset]


def test_numbering_goes_on_from_earlier_rows(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0, 5), ("a", 1, 0, 6), ("a", 2, 0, 7), ("b", 1, 0, 5)],
        "topic string, epoch_s bigint, partition int, offset bigint",
    )
    prior = spark.createDataFrame([("a", 1, 10), ("a", 9, 3)], "topic string, epoch_s bigint, n bigint")
    got = sequence.with_row_key(sequence.number_in_second(frame, prior=prior))
    assert sorted((r.topic, r.offset, r.row_key) for r in got.collect()) == [
        ("a", 5, 1010), ("a", 6, 1011), ("a", 7, 2000), ("b", 5, 1000),
    ]


def test_seconds_out_of_order_get_no_key_twice(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0, 0), ("a", 2, 0, 1), ("a", 1, 0, 2)],
        "topic string, epoch_s bigint, partition int, offset bigint",
    )
    keys = [r.row_key for r in sequence.with_row_key(sequence.number_in_second(frame)).collect()]
    assert sorted(keys) == [1000, 1001, 2000]


def test_more_than_a_thousand_rows_in_a_second(spark):
    frame = spark.range(2500).select(
        F.lit("a").alias("topic"), F.lit(1).cast("bigint").alias("epoch_s"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    keyed = sequence.with_row_key(sequence.number_in_second(frame, span=100))
    assert [r.row_key for r in keyed.orderBy("offset").collect()] == list(range(1000, 3500))
    # the bucket goes by the second, not by the key
    assert rows_of(rollup.message_count(keyed)) == [(0, 2500)]


def test_rows_are_shuffled_once_by_chunk(spark, sf_dir):
    ticks = feeds.event_ticks(feeds.table(spark, sf_dir, "events"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sequence.number_in_second(ticks)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # rows once; counts, running sums and bases once each
    assert plan.count("Exchange") == 4
    assert plan.count("SortMergeJoin") == 1


# -- cells --------------------------------------------------------------------


def test_melt_and_back(spark):
    ticks = spark.createDataFrame(
        [(1, "P", "1.5", None), (2, "Q", None, 1)], "row_key bigint, pair string, last string, is_frozen int"
    )
    melted = cells.melt(ticks, TICKS)
    assert rows_of(melted) == [
        ("1", "CurrencyRate", "currencypair", "P"),
        ("1", "CurrencyRate", "last", "1.5"),
        ("2", "CurrencyRate", "currencypair", "Q"),
        ("2", "CurrencyRate", "isfrozen", "1"),
    ]
    assert rows_of(cells.explode_lines(cells.cell_lines(ticks, TICKS))) == rows_of(melted)
    wide = cells.widen(melted, ["currencypair", "last", "isfrozen"])
    assert {tuple(r) for r in wide.collect()} == {("1", "P", "1.5", None), ("2", "Q", None, "1")}


def test_cell_text_with_newline_stays_one_cell(spark):
    chats = spark.createDataFrame([(1, "u", 'a\nb "c" \\')], "row_key bigint, user string, message string")
    from pulsebar.layout import CHATS

    got = cells.explode_lines(cells.cell_lines(chats, CHATS))
    assert ("1", "Trollbox", "trollmessage", 'a\nb "c" \\') in rows_of(got)
    assert rows_of(cells.family_profile(got)) == [("Trollbox", 2)]


# -- calculated table ---------------------------------------------------------


def test_latest_value_of_each_cell(spark):
    updates = spark.createDataFrame(
        [(0, 1, 5, 1, None, None), (0, 2, 6, None, None, 1.5), (0, 3, None, None, None, 2.5), (300, 1, 1, 1, 1, None)],
        "key bigint, version bigint, messages bigint, btc bigint, bitcoin bigint, last double",
    )
    got = {tuple(r) for r in calc.latest(updates).collect()}
    assert got == {(0, 6, 1, None, 2.5), (300, 1, 1, 1, None)}
    plan = calc.latest(updates)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_history_is_half_open_filled_and_ordered(spark):
    table = spark.createDataFrame(
        [(900, 1, 1, 1, None), (0, 2, 1, 1, 5.0), (600, None, None, None, 7.0), (300, 3, 1, 1, 6.0)],
        "key bigint, messages bigint, btc bigint, bitcoin bigint, last double",
    )
    got = calc.history(table, 300, 900, "Europe/Zurich").collect()
    assert [tuple(r) for r in got] == [
        (300, 3, 1, 1, 6.0, datetime(1970, 1, 1, 1, 5)),
        (600, 0, 0, 0, 7.0, datetime(1970, 1, 1, 1, 10)),
    ]


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([(0, 1)], "key bigint, messages bigint")
    b = spark.createDataFrame([(300, 1.5)], "key bigint, last double")
    assert {tuple(r) for r in calc.append(a, b).collect()} == {(0, 1, None), (300, None, 1.5)}
