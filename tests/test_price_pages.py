"""Price state by page: few calls to the state store, the same rows as one state per URL."""

from datetime import datetime, timedelta

from pyspark.sql import Row

from habita.streaming.prices import LatestPrices, price_changes

from .test_larger_tables import DAY, _At, _Held
from .test_streaming import msg, stage
from .test_waves import day, drain, wave

TTL, DELAY = 10, 1


def expected(waves):
    """Rows of ``(day, url, price)`` by wave, one state per URL; rows at or before the watermark of earlier waves are late."""
    held, out, mark = {}, [], None
    for rows in waves:
        for n, url, price in sorted(r for r in rows if mark is None or r[0] > mark):
            was = held.get(url)
            if was is not None and n < was[0]:
                continue
            gone = was is None or n - was[0] > TTL
            if gone or was[1] != price:
                out.append((url, n, None if gone else was[1], price))
            held[url] = (n, price)
        mark = max([mark or 0, *(r[0] - DELAY for r in rows)])
        held = {u: h for u, h in held.items() if h[0] + TTL > mark}
    return sorted(out, key=str), held


def drained(spark, waves, pages):
    """Rows of the changes, and the state's rows after the last wave."""
    d = stage([])
    for i, rows in enumerate(waves):
        wave(d, f"w{i}", [msg(100 * i + k, u, price, at=day(n)) for k, (n, u, price) in enumerate(rows)])
        lake = drain(spark, d, lambda c: price_changes(c, f"{DELAY} day", TTL, pages=pages))
    got = [(r["listing_url"], (r["seen_at"] - datetime(2024, 1, 1, 12)) // timedelta(days=1), r["old_price"], r["new_price"]) for r in lake.collect()]
    return sorted(got, key=str), spark.read.format("statestore").option("stateVarName", "held").load(f"{d}/ckpt").collect()


def test_pages_of_urls(spark):
    """URLs of a site share pages; each goes when it is due, whatever the others of its page do."""
    urls = [f"https://site{k % 2}.example/annonce/{k}" for k in range(40)]
    waves = [[(k % 4, u, 100 + k) for k, u in enumerate(urls)],
             [(7, u, 100 + k + k % 3) for k, u in enumerate(urls) if k % 2] + [(6, "https://site0.example/annonce/new", 5)],
             [(13, u, 500) for u in urls[::5]],
             [(16, u, 500 + k % 2) for k, u in enumerate(urls) if k % 7 == 0]]
    rows, held = expected(waves)
    got, state = drained(spark, waves, 3)
    assert got == rows
    assert 1 < len(state) <= 2 * 3                              # pages of two sites, not URLs
    assert sorted(u for r in state for u in r["value"]["urls"]) == sorted(held)
    assert 0 < len(held) < len(urls)
    got, state = drained(spark, waves, None)
    assert got == rows and sorted(r["key"][0] for r in state) == sorted(held)


def test_a_page_costs_one_read_and_one_write_of_its_state():
    """As many calls for a thousand URLs as for one; the timer is the first due, moves to an earlier one and on when it fires."""
    held, p = _Held(), LatestPrices(10 * DAY)
    p.init(held)
    rows = [Row(listing_url=f"u{k}", event_ms=(2 + k % 3) * DAY, price=k) for k in range(1000)]
    out = list(p.handleInputRows(("s", 1), iter(rows), _At(0)))
    assert len(out) == 1000 and held.calls == 3 and held.timers == [12 * DAY]
    held.calls = 0
    out = [tuple(r) for r in p.handleInputRows(("s", 1), iter([Row(listing_url="u0", event_ms=5 * DAY, price=7), Row(listing_url="early", event_ms=DAY, price=1)]), _At(0))]
    assert [(r[0], *r[2:]) for r in out] == [("early", None, 1), ("u0", 0, 7)]
    assert held.calls == 3 and held.timers == [12 * DAY, 11 * DAY]
    list(p.handleExpiredTimer(("s", 1), _At(12 * DAY), _At(11 * DAY)))
    assert len(held.value[0]) == 1000 - 333 and held.timers[-1] == 13 * DAY        # all seen on day 2 have left but u0
    list(p.handleExpiredTimer(("s", 1), _At(14 * DAY), _At(13 * DAY)))
    assert held.value[0] == ["u0"] and held.timers[-1] == 15 * DAY
    list(p.handleExpiredTimer(("s", 1), _At(15 * DAY), _At(15 * DAY)))
    assert held.value is None
