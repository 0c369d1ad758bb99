"""What a step costs must not depend on how much it is given: calls per key, rows held at a time, passes over the input."""

from __future__ import annotations

import datetime
import gc

import pandas as pd
from pyspark.sql import Row, functions as F

from habita.functions import dom
from habita.operators.sites import cards
from habita.plans import store_queries, wave_queries
from habita.schemas import LISTING_CLEAN
from habita.sinks import files
from habita.sinks.lake import compact
from habita.sinks.warehouse import ParquetTarget, load_batch
from habita.streaming.job import clean_stream
from habita.streaming.prices import LatestPrice

DAY = 86_400_000


class _Held:
    """A value state and its timers, counting the calls (each goes to the JVM and back)."""

    def __init__(self, value=None):
        self.value, self.timers, self.calls = value, [], 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_a_known_url_costs_one_read_and_one_write_of_its_state():
    held = _Held((2 * DAY, 100))
    held.timers.append(12 * DAY)
    p = LatestPrice(10 * DAY)
    p.init(held)
    out = [tuple(r)[2:] for r in p.handleInputRows(("u",), iter([Row(event_ms=5 * DAY, price=90), Row(event_ms=4 * DAY, price=95)]), _At(0))]
    assert out == [(100, 95), (95, 90)] and held.value == (5 * DAY, 90)
    assert held.calls == 2
    # the timer fires where it was set, stays with a URL that was seen since, and then drops it
    list(p.handleExpiredTimer(("u",), _At(13 * DAY), _At(12 * DAY)))
    assert held.value == (5 * DAY, 90) and held.timers[-1] == 15 * DAY
    list(p.handleExpiredTimer(("u",), _At(15 * DAY), _At(15 * DAY)))
    assert held.value is None


def _card_rows(spark, monkeypatch):
    """The function that reads cards from batches of pages."""
    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", lambda self, f, schema: f)
    return cards(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"), "coinafrique")


def _batch(pages: int, cards_a_page: int):
    card = '<div class="ad__card"><a class="ad__card-image" href="/a"><img class="ad__card-img" src="i"></a><p class="title"><a href="/a">t<br>u</a></p></div>'
    return pd.DataFrame({"page_id": range(pages), "url": ["https://x.example/"] * pages, "__html": [card * cards_a_page] * pages})


def test_rows_of_pages_are_handed_on_in_bounded_pieces(spark, monkeypatch):
    run, parsed = _card_rows(spark, monkeypatch), []
    parse = dom.parse
    monkeypatch.setattr(dom, "parse", lambda html: parsed.append(1) or parse(html))
    sizes, ids = [], []
    for piece in run(iter([_batch(1000, 5)])):
        sizes.append((len(piece), len(parsed)))
        ids += piece["page_id"].tolist()
    assert sum(n for n, _ in sizes) == 5000 and max(n for n, _ in sizes) <= dom.ROWS_AT_ONCE
    assert sizes[0][1] <= dom.PAGES_AT_ONCE                 # the first rows go before the next pages are read
    assert ids == [k for k in range(1000) for _ in range(5)]
    assert [len(p) for p in run(iter([_batch(1, 5000)]))] == [2048, 2048, 904]       # one long page
    assert [tuple(r) for p in run(iter([_batch(1, 1)])) for r in p.astype(object).values.tolist()] == [
        (0, "https://x.example/", 0, "https://x.example/a", None, "t", None, None, ["i"])]


def test_pages_that_are_done_with_do_not_wait_for_a_collection(spark, monkeypatch):
    run = _card_rows(spark, monkeypatch)
    gc.collect()
    gc.disable()
    try:
        for _ in run(iter([_batch(50, 20)])):
            pass
        assert gc.collect() < 500
    finally:
        gc.enable()


def _data_files(spark, folder):
    return [n for n in files.names_in(spark, folder) if n.startswith("part-")]


def test_a_task_of_a_compaction_writes_one_file(spark, tmp_path):
    lake = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("listing_url"), F.when(F.col("id") % 2 == 0, "a").alias("source"))
    lake.write.parquet(f"{tmp_path}/lake")
    compact(spark, f"{tmp_path}/lake", f"{tmp_path}/large", rows_per_file=25, partition_cols=("source",))
    folders = {n: len(_data_files(spark, f"{tmp_path}/large/{n}")) for n in files.names_in(spark, f"{tmp_path}/large") if n.startswith("source=")}
    assert folders == {"source=a": 40, "source=__HIVE_DEFAULT_PARTITION__": 40}      # two files in one task would become one
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/large").select(*lake.columns).collect()), key=str) == sorted(map(tuple, lake.collect()), key=str)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_load_adds_few_files_to_a_bucket(spark, tmp_path):
    target = ParquetTarget(f"{tmp_path}/dw", key_buckets=4)
    for k in range(2):
        url = F.concat(F.lit("u"), (F.col("id") + 1000 * k).cast("string"))
        rows = spark.range(2000).select(*[(url if f.name == "listing_url" else F.lit(None).cast(f.dataType)).alias(f.name) for f in LISTING_CLEAN.fields])
        assert load_batch(rows, target)["written"] == (2000, 1000)[k]
    assert target.read(spark).select("listing_url").distinct().count() == target.read(spark).count() == 3000
    assert max(len(_data_files(spark, f"{tmp_path}/dw/key_bucket={b}")) for b in range(4)) <= 2


def test_crawls_are_parsed_once(spark, tmp_path, monkeypatch):
    rows = [(k, k % 5, 1000.0 * (k + 1), datetime.date(1993 + k % 5, 1, 1), "1-URGENT") for k in range(60)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    plans, append = [], store_queries.append_lake
    monkeypatch.setattr(store_queries, "append_lake", lambda df, path: plans.append(df._jdf.queryExecution().toString()) or append(df, path))
    zone = store_queries.curated_refresh_batches(spark, str(tmp_path)).collect()
    assert len(plans) == 3 and not any("from_json" in p for p in plans)
    clean = store_queries.common.clean(spark, str(tmp_path), keep=())
    latest = {r[0]: r[1] for r in clean.groupBy("listing_url").agg(F.max("scraped_at")).collect()}
    assert {r["listing_url"]: r["scraped_at"] for r in zone} == latest and len(zone) == len(latest) > 5


def test_waves_are_not_sorted_and_parsed_for_what_is_counted(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    clean = clean_stream(spark, source="files", path=f"{tmp_path}/in", fields=wave_queries.WAVE_FIELDS)
    assert sorted(clean.columns) == sorted([*wave_queries.WAVE_FIELDS, "processed_at"])
    rows = [(k, k % 5, 1000.0, datetime.date(1993 + k % 5, 1, 1), "1-URGENT") for k in range(50)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string").write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    open_at_once = []
    monkeypatch.setattr(files, "unsorted_writes", lambda s, n, u=files.unsorted_writes: open_at_once.append(n) or u(s, n))
    bases = list(wave_queries._waves(spark, str(tmp_path), "waves-test", late=False, years=1))
    assert len(bases) == 5 and open_at_once[-1] == wave_queries.WAVES_AT_ONCE
    assert spark.read.text(f"{bases[0]}/in/*").count() == 50
