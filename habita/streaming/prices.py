"""Price changes across micro-batches: keyed state with a time to live (A1 in the stream).

For every URL the state holds the latest price and when it was seen. A message
that is newer than the state and brings another price is a change; the first
message of a URL, or of one not seen for longer than the time to live, is a
listing. A timer in event time drops the state of URLs that are not seen again.

State may be kept by URL or by page: the URLs of one site are dealt to pages by
hash, and a page is read, written and given its timer as a whole, as each of
these is a call from the worker to the state store and costs far more than the
comparison of two prices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from itertools import groupby

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .windows import with_event_time

EPOCH = datetime(1970, 1, 1)
CHANGES = "listing_url string, seen_at timestamp, old_price long, new_price long"
PAGES = 2048            # pages per site; a page of some hundred URLs is best, one of many thousand is slow to write


def _instant(ms: int) -> datetime:
    """As Arrow takes it: without a zone, in UTC."""
    return EPOCH + timedelta(milliseconds=ms)


def _changes(url: str, held: tuple | None, seen: Iterable[tuple], ttl_ms: int) -> Iterator[Row]:
    """Changes of one URL from ``(event_ms, price)`` in order; returns what is to be held of it."""
    for at, price in seen:
        if held is not None and at < held[0]:
            continue                                    # older than what is known
        gone = held is None or at - held[0] > ttl_ms
        if gone or price != held[1]:
            yield Row(listing_url=url, seen_at=_instant(at), old_price=None if gone else held[1], new_price=price)
        held = (at, price)
    return held


class LatestPrice(StatefulProcessor):
    """State by URL: its rows of one batch cost one read and one write of its state. Its timer is set when the URL gets
    its state and moves on only when it fires, not with every message."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "seen_ms long, price long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.held.get()
        held = yield from _changes(key[0], before, sorted((r["event_ms"], r["price"]) for r in rows), self.ttl_ms)
        if held != before:
            self.held.update(held)
            if before is None:
                self.handle.registerTimer(held[0] + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.held.get()
        if held is not None:
            due = held[0] + self.ttl_ms
            if due <= timerValues.getCurrentWatermarkInMs():
                self.held.clear()
            else:
                self.handle.registerTimer(due)              # seen again since the timer was set
        return iter([])

    def close(self) -> None:
        pass


class LatestPrices(StatefulProcessor):
    """State by page: the rows of all its URLs cost one read and one write. The timer stands at or before the first
    instant at which one of the URLs may go; when it fires, all that are due go and it moves on."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "urls array<string>, seen_ms array<long>, prices array<long>, timer_ms long")

    def _read(self) -> tuple[dict[str, tuple], int | None]:
        """When and at which price each URL of the page was seen last, and its timer."""
        held = self.held.get()
        return (dict(zip(held[0], zip(held[1], held[2]))), held[3]) if held is not None else ({}, None)

    def _write(self, page: dict[str, tuple], timer: int | None) -> None:
        due = min(at for at, _ in page.values()) + self.ttl_ms
        if timer is None or due < timer:
            self.handle.registerTimer(due)
            timer = due
        self.held.update(([*page], [at for at, _ in page.values()], [price for _, price in page.values()], timer))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        page, timer = self._read()
        touched = False
        for url, seen in groupby(sorted((r["listing_url"], r["event_ms"], r["price"]) for r in rows), lambda r: r[0]):
            before = page.get(url)
            held = yield from _changes(url, before, (r[1:] for r in seen), self.ttl_ms)
            if held != before:
                page[url] = held
                touched = True
        if touched:
            self._write(page, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        page = {url: held for url, held in self._read()[0].items() if held[0] + self.ttl_ms > watermark}
        if page:
            self._write(page, None)
        else:
            self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def price_changes(clean: DataFrame, delay: str, ttl_days: int, pages: int | None = PAGES) -> DataFrame:
    """``listing_url, seen_at, old_price, new_price`` of every listing and price change (old price null: a listing).

    Rows without a URL or a crawl instant are left out. The messages of a URL in
    one micro-batch are taken in the order of crawl instant, then price. The
    rows of one batch that meet in a task at a time are those of a page: of the
    URLs of one site (scheme and host) that share a hash modulo ``pages``. With
    ``pages`` None each URL is a state of its own. A checkpoint keeps the
    ``pages`` it began with.
    """
    keys = {"listing_url": F.col("listing_url")} if pages is None else {
        "site": F.regexp_extract("listing_url", "^[^/]*(?://[^/]*)?", 0),
        "page": F.pmod(F.xxhash64("listing_url"), F.lit(pages)).cast("int"),
        "listing_url": F.col("listing_url")}
    rows = (with_event_time(clean).where("listing_url is not null and event_time is not null").withWatermark("event_time", delay)
            .select(*[c.alias(k) for k, c in keys.items()], "event_time", F.unix_millis("event_time").alias("event_ms"), "price"))
    by, latest = (["listing_url"], LatestPrice) if pages is None else (["site", "page"], LatestPrices)
    return rows.groupBy(*by).transformWithState(latest(ttl_days * 86_400_000), CHANGES, outputMode="Append", timeMode="EventTime")
