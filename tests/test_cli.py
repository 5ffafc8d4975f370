"""The command line, over files of messages."""

from __future__ import annotations

import pytest

from pulsebar.__main__ import main
from pulsebar.layout import POSTS, TICKS
from pulsebar.sources import series, tables
from tests.test_jobs import BASE, HOUR, post, put_file, put_prices, tick


def test_jobs_from_the_command_line(spark, tmp_path, capfd):
    root, ticks, posts = str(tmp_path / "root"), str(tmp_path / "ticks"), str(tmp_path / "posts")
    put_file(spark, ticks, [tick(0, 10, last="2"), tick(1, 20, last="4")], "a")
    put_file(spark, posts, [post(0, 10), post(1, 400)], "b")
    span = ["--start", str(BASE), "--stop", str(BASE + HOUR)]
    main(["land", "posts", "--path", posts, "--root", root, "--once"], spark)
    main(["backfill", "ticks", "--path", ticks, "--root", root, "--start", str(BASE)], spark)
    main(["rollup", "social", "--root", root, *span], spark)
    main(["rollup", "price", "--root", root, *span], spark)
    main(["history", "--root", root, *span], spark)
    shown = capfd.readouterr().out
    assert f"|{BASE}|1       |1  |1      |3.0 |2024-01-01 00:00:00|" in shown
    assert tables.read_rows(spark, root, POSTS).count() == 2

    live = str(tmp_path / "live")
    main(["live", "social", "--path", posts, "--root", live, "--once"], spark)
    main(["live", "price", "--path", ticks, "--root", live, "--once"], spark)
    assert series.read_calc(spark, live).count() == 2


def test_a_source_is_needed(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["land", "posts", "--root", str(tmp_path)], spark)


def test_produce_resume_and_write_history(spark, tmp_path):
    rows, sent, root, out = (str(tmp_path / name) for name in ("rows", "sent", "root", "out"))
    spark.createDataFrame(
        [(str(k), str(k), "1", "1", "0", "1", "1", 0, "1", "1") for k in range(40)],
        "pair string, last string, lowest_ask string, highest_bid string, percent_change string, base_volume string, "
        "quote_volume string, is_frozen int, high_24h string, low_24h string",
    ).write.parquet(rows)
    main(["produce", "ticks", "--rows", rows, "--out", sent, "--checkpoint", str(tmp_path / "progress"), "--once"], spark)
    for _ in range(2):
        main(["backfill", "ticks", "--path", sent, "--root", root, "--resume"], spark)
    landed = tables.read_rows(spark, root, TICKS)
    assert landed.count() == 40 == landed.select("row_key").distinct().count()
    now = landed.first().epoch_s
    span = ["--start", str(now - HOUR), "--stop", str(now + HOUR)]
    main(["rollup", "price", "--root", root, *span, "--pair", "7", "--width", "60"], spark)
    main(["fold", "price", "--root", root], spark)
    main(["history", "--root", root, *span, "--out", out], spark)
    assert [r["last"] for r in spark.read.option("header", True).csv(out).collect()] == ["7.0"]


def test_history_writes_every_bucket(spark, tmp_path):
    root, out = str(tmp_path / "root"), str(tmp_path / "out")
    put_prices(spark, root, [(300 * k, float(k)) for k in range(50)])
    main(["history", "--root", root, "--start", "0", "--stop", "15000", "--out", out], spark)
    assert spark.read.option("header", True).csv(out).count() == 50


def test_words_of_a_rollup(spark, tmp_path):
    root, posts = str(tmp_path / "root"), str(tmp_path / "posts")
    put_file(spark, posts, [post(0, 10, "alpha"), post(1, 11, "beta alpha")], "a")
    main(["backfill", "posts", "--path", posts, "--root", root], spark)
    span = ["--start", str(BASE), "--stop", str(BASE + HOUR)]
    main(["rollup", "social", "--root", root, *span, "--word", "btc=alpha", "--word", "bitcoin=beta"], spark)
    assert [tuple(r)[:4] for r in series.read_calc(spark, root).collect()] == [(BASE, 2, 2, 1)]
    with pytest.raises(SystemExit):
        main(["rollup", "social", "--root", root, *span, "--word", "other=x"], spark)
