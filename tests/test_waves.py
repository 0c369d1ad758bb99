"""State that leaves: windows, sessions, prices; restarts; intake bounds."""

import os
import threading
import time

import pytest

from habita.sources.wire import COMPAT_INTAKE, KAFKA_INTAKE, kafka_options, wire_stream
from habita.streaming.job import clean_stream, run_until_any_stops, start_lake, watermark_dedup
from habita.streaming.prices import price_changes
from habita.streaming.windows import arrivals_per_window, crawl_sessions, open_windows, rocksdb_state, window_accounts

from .test_streaming import DRAIN, msg, stage


def drain(spark, d, table):
    clean = clean_stream(spark, source="files", path=f"{d}/in")
    with rocksdb_state(spark):
        q = start_lake(table(clean), f"{d}/lake", f"{d}/ckpt", trigger=DRAIN)
    q.awaitTermination()
    return spark.read.parquet(f"{d}/lake")


def wave(d, name, lines):
    with open(f"{d}/draft", "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(f"{d}/draft", f"{d}/in/{name}")


def day(n, hour=12):
    return f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}T{hour:02d}:00:00"


def test_closed_open_and_late_account_for_every_row(spark):
    d = stage([])
    table = lambda c: arrivals_per_window(c, "2 days", "1 day")      # noqa: E731
    wave(d, "w1", [msg(k, f"u{k}", at=day(k // 2)) for k in range(10)])                   # days 0 to 4
    drain(spark, d, table)
    state = open_windows(spark, f"{d}/ckpt")
    assert sorted(r["start"].day for r in state.collect()) == [3, 4, 5]                   # older than 2 days behind have left
    wave(d, "w2", [msg(50, "u50", at=day(1)), msg(51, "u51", at=day(4)), msg(52, "u52", at=day(9))])
    closed = drain(spark, d, table)
    read = spark.createDataFrame([("s", 13)], "source string, n_listings long")
    got = {(r["status"], r["start"].day if r["start"] else None): r["n_listings"] for r in window_accounts(closed, open_windows(spark, f"{d}/ckpt"), read).collect()}
    assert got == {("closed", 1): 2, ("closed", 2): 2, ("closed", 3): 2, ("closed", 4): 2, ("closed", 5): 3, ("open", 10): 1, ("late", None): 1}
    before = closed.count()
    assert drain(spark, d, table).count() == before                                       # a run without news emits nothing


def test_sessions_close_once(spark):
    d = stage([])
    table = lambda c: crawl_sessions(c, "1 day", "3 days")      # noqa: E731
    wave(d, "w1", [msg(1, "a", at=day(0)), msg(2, "a", at=day(2)), msg(3, "b", at=day(2)), msg(4, "a", at=day(10))])
    drain(spark, d, table)
    wave(d, "w2", [msg(5, "a", at=day(12)), msg(6, "c", at=day(27))])
    got = sorted((r["listing_url"], r["first_seen"].day, r["closed_at"].day, r["n_seen"]) for r in drain(spark, d, table).collect())
    assert got == [("a", 1, 6, 2), ("a", 11, 16, 2), ("b", 3, 6, 1)]


def test_price_changes_over_restarts(spark):
    """The state outlives a run, a restart repeats nothing, old messages and expired URLs are told apart."""
    d = stage([])
    table = lambda c: price_changes(c, "1 day", 10)      # noqa: E731
    ordered = lambda rows: sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))     # noqa: E731
    rows = lambda: ordered((r["listing_url"], r["seen_at"].strftime("%m-%d"), r["old_price"], r["new_price"]) for r in drain(spark, d, table).collect())     # noqa: E731
    wave(d, "w1", [msg(1, "a", 100, at=day(0)), msg(2, "a", 100, at=day(1)), msg(3, "a", 120, at=day(2)), msg(4, "b", 7, at=day(2)), msg(5, "b", 9, at=day(2))])
    first = [("a", "01-01", None, 100), ("a", "01-03", 100, 120), ("b", "01-03", None, 7), ("b", "01-03", 7, 9)]
    assert rows() == first
    assert rows() == first                                     # a run without news
    wave(d, "w2", [msg(6, "a", 120, at=day(5)), msg(7, "a", 90, at=day(6)), msg(8, "c", 1, at=day(6))])
    second = ordered(first + [("a", "01-07", 120, 90), ("c", "01-07", None, 1)])
    assert rows() == second
    wave(d, "w3", [msg(9, "b", 9, at=day(20)), msg(10, "a", 95, at=day(15))])     # b was gone for over ten days, a was not
    assert rows() == ordered(second + [("b", "01-21", None, 9), ("a", "01-16", 90, 95)])
    wave(d, "w4", [msg(11, "z", 5, at="2024-06-01T00:00:00")])
    drain(spark, d, table)
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{d}/ckpt")
    assert [r["key"][0] for r in held.collect()] == ["z"]      # timers have dropped the others


def test_a_url_counts_again_after_its_state_has_left(spark):
    d = stage([])
    table = lambda c: watermark_dedup(c, "2 days")      # noqa: E731
    for k, at in enumerate((0, 1, 20, 21)):
        wave(d, f"w{k}", [msg(k, "u", at=day(at)), msg(100 + k, "late", at=day(0))])
        lake = drain(spark, d, table)
    # state goes when the watermark, 2 days behind, passes it: after the wave of day 20, whose own "u" still met it
    assert sorted(r["listing_id"] for r in lake.collect()) == ["id0", "id100", "id3"]


def test_run_until_any_stops(spark):
    d = stage([[msg(1, "u1")]])
    clean = clean_stream(spark, source="files", path=f"{d}/in")
    stays = start_lake(clean, f"{d}/lake-a", f"{d}/ckpt-a", trigger={"processingTime": "1 second"})
    ends = start_lake(clean, f"{d}/lake-b", f"{d}/ckpt-b", trigger={"processingTime": "1 second"})
    try:
        spark.streams.resetTerminated()
        ended = []
        waiting = threading.Thread(target=lambda: (run_until_any_stops(spark), ended.append(time.time())))
        waiting.start()
        ends.processAllAvailable()
        assert not ended and stays.isActive
        ends.stop()
        waiting.join(30)
        assert ended and stays.isActive
    finally:
        stays.stop()


def test_intake_of_a_topic_is_bounded(spark):
    plain = kafka_options("broker:9092", "listings")
    assert plain == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "listings", "startingOffsets": "earliest", "failOnDataLoss": "false",
                     "maxOffsetsPerTrigger": str(KAFKA_INTAKE)}
    assert kafka_options("b", "t", COMPAT_INTAKE)["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in kafka_options("b", "t", 0)
    assert kafka_options("b", "t", starting="latest", fail_on_data_loss=True).items() >= {("startingOffsets", "latest"), ("failOnDataLoss", "true")}
    with pytest.raises(ValueError):
        wire_stream(spark, source="kafka", bootstrap="b", topic="t", max_bytes=1 << 20)
