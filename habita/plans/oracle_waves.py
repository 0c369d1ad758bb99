"""DuckDB SQL for the crawl-wave queries.

After each wave the watermark stands ``DELAY`` behind the newest crawl instant
so far; a row of the next wave whose window (or whose own instant) lies at or
before it is late.
"""

from __future__ import annotations

from .oracle import with_listings
from .wave_queries import DELAY, IS_LATE, LATE_WAVES, PRICE_TTL_DAYS, SESSION_GAP, WINDOW

DAY = 86400


def _seconds(days: str) -> int:
    return int(days.split()[0]) * DAY


def _waves(event: str, late: bool) -> str:
    """Cleaned rows with wave and event second, and the watermark before each wave and after the last."""
    wave = f"year(o_orderdate) + CASE WHEN {IS_LATE} THEN {LATE_WAVES} ELSE 0 END" if late else "year(o_orderdate)"
    return (f"rows_in AS (SELECT c.*, CAST(epoch({event}) AS BIGINT) AS ev, {wave} AS wave "
            f"FROM clean c JOIN orders ON o_orderkey = msg_id), "
            f"marks AS (SELECT wave, max(max(ev)) OVER (ORDER BY wave) - {_seconds(DELAY)} AS after FROM rows_in GROUP BY wave), "
            f"waves AS (SELECT wave, coalesce(lag(after) OVER (ORDER BY wave), -1e18) AS before FROM marks)")


def _stamp(seconds: str) -> str:
    return f"strftime(make_timestamp(CAST({seconds} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _with(waves: str, select: str, recursive: str = "") -> str:
    sql = with_listings("@", False)
    head = sql[:sql.rindex("@")].rstrip()
    if recursive:
        head = head.replace("WITH ", "WITH RECURSIVE ", 1)
    return f"{head}, {waves}{', ' + recursive if recursive else ''} {select}"


def wave_oracles() -> dict[str, str]:
    instant = "TRY_CAST(scraped_at AS TIMESTAMP)"
    width, gap = _seconds(WINDOW), _seconds(SESSION_GAP)
    windowed = (f"placed AS (SELECT source, ev // {width} * {width} AS start, before FROM rows_in JOIN waves USING (wave)), "
                f"judged AS (SELECT source, start, CASE WHEN start + {width} <= before THEN 'late' "
                f"WHEN start + {width} <= (SELECT max(after) FROM marks) THEN 'closed' ELSE 'open' END AS status FROM placed)")
    out = {"stream_window_arrivals": _with(
        f"{_waves(instant, True)}, {windowed}",
        f"SELECT source, {_stamp('start')} AS start, count(*) AS n_listings, status FROM judged WHERE status <> 'late' GROUP BY source, judged.start, status "
        "UNION ALL SELECT source, NULL, count(*), 'late' FROM judged WHERE status = 'late' GROUP BY source")}
    spells = (f"steps AS (SELECT listing_url, ev, CASE WHEN ev - lag(ev) OVER (PARTITION BY listing_url ORDER BY ev) <= {gap} THEN 0 ELSE 1 END AS fresh FROM rows_in), "
              "numbered AS (SELECT listing_url, ev, sum(fresh) OVER (PARTITION BY listing_url ORDER BY ev ROWS UNBOUNDED PRECEDING) AS spell FROM steps)")
    out["stream_crawl_sessions"] = _with(
        f"{_waves(instant, False)}, {spells}",
        f"SELECT listing_url, {_stamp('min(ev)')} AS first_seen, {_stamp(f'max(ev) + {gap}')} AS closed_at, count(*) AS n_seen FROM numbered "
        f"GROUP BY listing_url, spell HAVING max(ev) + {gap} <= (SELECT max(after) FROM marks)")
    seen = "seen AS (SELECT listing_url, wave, before, max(ev) AS e FROM rows_in JOIN waves USING (wave) WHERE ev > before GROUP BY ALL)"
    counted = ("counted(listing_url, wave, e) AS (SELECT listing_url, min(wave), min_by(e, wave) FROM seen GROUP BY listing_url UNION ALL "
               "SELECT listing_url, wave, e FROM (SELECT s.listing_url, s.wave, s.e, row_number() OVER (PARTITION BY s.listing_url ORDER BY s.wave) AS rn "
               f"FROM counted c JOIN seen s ON s.listing_url = c.listing_url AND s.wave > c.wave AND s.before >= c.e + {_seconds(DELAY)}) n WHERE rn = 1)")
    out["stream_dedup_evicting"] = _with(
        _waves(f"date_trunc('year', {instant})", True),
        "SELECT listing_url, count(*) AS n_counted, CAST(year(make_timestamp(min(e) * 1000000)) AS INTEGER) AS first_year FROM counted GROUP BY listing_url",
        f"{seen}, {counted}")
    out["price_changes"] = _with(
        _waves(instant, False),
        f"SELECT listing_url, {_stamp('ev')} AS seen_at, CASE WHEN ev - ev0 <= {PRICE_TTL_DAYS * DAY} THEN price0 END AS old_price, price AS new_price FROM ("
        "SELECT listing_url, ev, price, lag(ev) OVER w AS ev0, lag(price) OVER w AS price0 FROM rows_in WINDOW w AS (PARTITION BY listing_url ORDER BY ev, price)) x "
        f"WHERE ev0 IS NULL OR ev - ev0 > {PRICE_TTL_DAYS * DAY} OR price <> price0")
    return out
