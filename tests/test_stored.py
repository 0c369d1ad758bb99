"""Stored upserts, inserts by filter, incremental refresh, sketches per batch, observed loads."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from habita.operators.clean import clean_listings, to_serving_rows
from habita.operators.sketches import COUNT_ERROR, RANK_ERROR, batch_sketches, mart_errors, merged_mart
from habita.schemas import LISTING_DW
from habita.sinks.buckets import BucketedStore
from habita.sinks.lake import refresh_curated_batches, taken_batches
from habita.sinks.observed import load_observed, observe_stream, watch
from habita.sinks.warehouse import load_batch
from habita.sources.wire import parse_wire, wire_stream
from habita.streaming.job import clean_stream, start_warehouse

from .test_streaming import DRAIN, msg, stage


def serving(spark, rows):
    """(url, scraped_at, price) as serving rows."""
    names = LISTING_DW.fieldNames()
    full = [tuple({"listing_id": f"id-{u}", "listing_url": u, "scraped_at": at, "price": p, "source": "s"}.get(n) for n in names) for u, at, p in rows]
    return spark.createDataFrame(full, LISTING_DW)


def held(store, spark):
    return sorted((r["listing_url"], r["scraped_at"], r["price"]) for r in store.read(spark).collect())


def data_files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    store = BucketedStore(str(tmp_path / "t"), 8)
    assert held(store, spark) == []
    store.upsert(serving(spark, [(f"u{i}", "2024-01-01", i) for i in range(60)] + [(None, "2024-01-01", 1)]))
    before, state = data_files(store.path), store._state(spark)[1]
    said = store.upsert(serving(spark, [("u3", "2024-02-01", 300), ("u4", "2023-01-01", 400), ("new", "2024-01-01", 5), ("new", "2024-01-02", 6)]))
    want = {f"u{i}": ("2024-01-01", i) for i in range(60)} | {"u3": ("2024-02-01", 300), "new": ("2024-01-02", 6)}
    assert held(store, spark) == sorted((u, *v) for u, v in want.items())
    assert 1 <= said["touched"] <= 3 and said["rows"] == 3
    assert all(data_files(store.path)[p] == t for p, t in before.items())                 # nothing that was there is touched
    now = store._state(spark)[1]
    assert sum(now[b] != state[b] for b in state) == said["touched"]
    assert store.vacuum(spark) == 0 and held(store, spark) == sorted((u, *v) for u, v in want.items())


def test_a_failure_before_publication_leaves_the_old_table(spark, tmp_path):
    store = BucketedStore(str(tmp_path / "t"), 4)
    store.upsert(serving(spark, [("a", "2024-01-01", 1), ("b", "2024-01-01", 2)]))
    old = held(store, spark)

    def crash():
        raise RuntimeError("lost the driver")
    for load in (store.upsert, store.insert):
        with pytest.raises(RuntimeError):
            load(serving(spark, [("a", "2025-01-01", 9), ("c", "2025-01-01", 9)]), before_publish=crash)
        assert held(store, spark) == old
    assert store.vacuum(spark) > 0 and held(store, spark) == old
    # a load that another one has overtaken is refused
    def overtake():
        store.upsert(serving(spark, [("z", "2024-01-01", 1)]))
    with pytest.raises(FileExistsError):
        store.upsert(serving(spark, [("y", "2024-01-01", 1)]), before_publish=overtake)
    assert [u for u, _, _ in held(store, spark)] == ["a", "b", "z"]


def test_insert_equals_the_anti_join_and_the_filter_rarely_errs(spark, tmp_path):
    store = BucketedStore(str(tmp_path / "t"), 8)
    first = serving(spark, [(f"u{i}", "2024-01-01", i) for i in range(3000)])
    assert store.insert(first)["written"] == 3000
    assert store.insert(first) == {"keys": 3000, "possible": 3000, "written": 0}
    more = serving(spark, [(f"u{i}", "2024-02-01", -i) for i in range(2000, 22000)])
    said = store.insert(more)                                # filters are outgrown and built anew
    assert said["keys"] == 20000 and said["written"] == 19000
    assert said["possible"] - 1000 < 0.02 * 19000
    want = {f"u{i}": ("2024-01-01", i) for i in range(3000)} | {f"u{i}": ("2024-02-01", -i) for i in range(3000, 22000)}
    assert held(store, spark) == sorted((u, *v) for u, v in want.items())
    rows = store._batch(serving(spark, [(f"v{i}", "2024-01-01", 0) for i in range(20000)] + [("u5", "2024-01-01", 0)]), "scraped_at")
    possible = store.possible_hits(rows).where("possible")
    rate = (possible.count() - 1) / 20000
    assert rate < 0.02 and possible.where("listing_url = 'u5'").count() == 1          # 12 bits a key: under 1 % expected
    assert store.insert(serving(spark, [(None, "2024-01-01", 0)])) == {"keys": 0, "possible": 0, "written": 0}
    # upserts and inserts share the table
    store.upsert(serving(spark, [("u5", "2025-01-01", 55)]))
    assert store.insert(serving(spark, [("u5", "2026-01-01", 66)]))["written"] == 0
    assert ("u5", "2025-01-01", 55) in held(store, spark)


def test_the_stream_loads_a_bucketed_store(spark, tmp_path):
    """K4 with the filter: every URL once over micro-batches, a replayed batch adds nothing."""
    d = stage([[msg(1, "u1"), msg(2, "u2")], [msg(3, "u1", at="2024-02-01"), msg(4, "u3")]])
    store, metrics = BucketedStore(str(tmp_path / "t"), 4), []
    clean = clean_stream(spark, source="files", path=f"{d}/in", max_per_trigger=1)
    start_warehouse(clean, store, f"{d}/ckpt", trigger=DRAIN, metrics_sink=metrics.append).awaitTermination()
    assert [u for u, _, _ in held(store, spark)] == ["u1", "u2", "u3"]
    assert sorted((m["read"], m["written"]) for m in metrics) == [(2, 1), (2, 2)]
    again = clean_listings(parse_wire(spark.read.text(f"{d}/in")))
    assert load_batch(again, store)["written"] == 0


def lake_batch(spark, path, batch, rows):
    lines = [(msg(k, u, price=p, at=at).replace('"source":"s"', f'"source":"{s}"'),) for k, (u, at, p, s) in enumerate(rows)]
    clean_listings(parse_wire(spark.createDataFrame(lines, "value string"))).write.parquet(f"{path}/batch_id={batch}")


def test_refresh_takes_new_batches_and_leaves_other_partitions(spark, tmp_path):
    lake, zone = str(tmp_path / "lake"), str(tmp_path / "zone")
    lake_batch(spark, lake, 0, [("a", "2024-01-01", 1, "s1"), ("b", "2024-01-01", 2, "s2"), ("c", "2024-01-01", 3, "s3")])
    assert refresh_curated_batches(spark, lake, zone) == {"batches": [0], "sources": ["s1", "s2", "s3"]}
    before = data_files(zone)
    lake_batch(spark, lake, 1, [("a", "2024-02-01", 10, "s1"), ("d", "2024-02-01", 4, "s1"), ("a", "2023-01-01", 9, "s1")])
    assert refresh_curated_batches(spark, lake, zone) == {"batches": [1], "sources": ["s1"]}
    after = data_files(zone)
    assert {p for p in before if "source=s1" not in p} <= set(after) and all(after[p] == t for p, t in before.items() if p in after)
    got = lambda: sorted((r["listing_url"], r["price"], r["source"]) for r in spark.read.parquet(zone).collect())     # noqa: E731
    assert got() == [("a", 10, "s1"), ("b", 2, "s2"), ("c", 3, "s3"), ("d", 4, "s1")]
    assert refresh_curated_batches(spark, lake, zone) == {"batches": [], "sources": []}
    # a URL moves to another source, whose old one has no other row; the run fails before the batch is noted and is repeated
    lake_batch(spark, lake, 2, [("c", "2024-03-01", 30, "s1")])

    def crash():
        raise RuntimeError("lost the driver")
    with pytest.raises(RuntimeError):
        refresh_curated_batches(spark, lake, zone, before_note=crash)
    assert taken_batches(spark, zone) == {0, 1}
    for _ in range(2):
        refresh_curated_batches(spark, lake, zone)
        assert got() == [("a", 10, "s1"), ("b", 2, "s2"), ("c", 30, "s1"), ("d", 4, "s1")]
    assert taken_batches(spark, zone) == {0, 1, 2} and not glob.glob(f"{zone}/source=s3")


def test_sketches_of_batches_merge_within_their_bounds(spark):
    rows = spark.range(60000).select(F.concat(F.lit("u"), F.col("id") % 20000).alias("listing_url"), (F.xxhash64("id") % 1000000).alias("price"),
                                     F.when(F.col("id") % 3 == 0, "x").alias("city"), F.lit("Villa").alias("property_type"))
    parts = [batch_sketches(rows.where(F.pmod("price", F.lit(7)) == k)) for k in range(7)]
    sketches = parts[0]
    for p in parts[1:]:
        sketches = sketches.unionByName(p)
    got = mart_errors(merged_mart(sketches), rows).collect()
    assert sorted((str(r["city"]), r["n_messages"]) for r in got) == [("None", 40000), ("x", 20000)]
    for r in got:
        assert max(r["rank_error_q25"], r["rank_error_q50"], r["rank_error_q75"]) <= RANK_ERROR and r["count_error"] <= COUNT_ERROR


def test_a_load_counts_itself(spark, tmp_path):
    lines = [(msg(1, "u1"),), ("garbage",), (msg(2, "u2", price=0),), ('{"price":5,"city":"x"}',), ('{"listing_id":"a","city":"x"}',), ('{"listing_id":"a","price":4}',)]
    parsed = parse_wire(spark.createDataFrame(lines, "value string"), keep=["value"])
    got = load_observed(parsed, lambda kept: kept.write.parquet(str(tmp_path / "lake")))
    assert got == {"unparseable": 1, "missing_listing_id": 1, "missing_price": 1, "price_not_positive": 1, "missing_city": 1, "kept": 1}
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 1


def test_batches_of_a_stream_report_their_counts(spark):
    d = stage([[msg(1, "u1"), "garbage"], [msg(2, "u2", price=0), msg(3, "u3")]])
    seen = []
    listener = watch(spark, "intake", lambda name, batch, figures: seen.append((batch, figures["kept"], figures["unparseable"], figures["price_not_positive"])))
    try:
        raw = wire_stream(spark, source="files", path=f"{d}/in", max_per_trigger=1)
        watched = clean_listings(observe_stream(parse_wire(raw, keep=["value"]), "intake"))
        watched.writeStream.format("parquet").option("path", f"{d}/lake").option("checkpointLocation", f"{d}/ckpt").trigger(**DRAIN).start().awaitTermination()
        for _ in range(100):
            if len(seen) == 2:
                break
            import time
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sorted(seen) == [(0, 1, 1, 0), (1, 1, 0, 1)]
    assert to_serving_rows(spark.read.parquet(f"{d}/lake")).count() == 2
