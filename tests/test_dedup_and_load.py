"""A1/A5/D1 against brute force; a hot key holding a third of the rows."""

import pandas as pd
from pyspark.sql import functions as F

from habita.operators.dedup import first_per_crawl, insert_if_absent, insert_if_absent_marked, latest_per_url, upsert_latest


def test_latest_per_url_brute_force(spark):
    data = [(f"u{i % 7}", f"2024-01-{1 + i % 28:02d}T00:00:{i % 60:02d}", i) for i in range(300)]
    data += [(None, "2024-02-01", 999), (None, "2024-03-01", 1000)]
    df = spark.createDataFrame(data, "listing_url string, scraped_at string, v int")
    got = sorted(map(tuple, latest_per_url(df).collect()), key=repr)
    pdf = pd.DataFrame(data, columns=["listing_url", "scraped_at", "v"])
    exp = (pdf.sort_values(["scraped_at", "v"]).groupby("listing_url", dropna=False).tail(1))
    assert got == sorted(map(tuple, exp.itertuples(index=False)), key=repr)


def test_hot_key_is_combined_map_side(spark):
    """One URL holds a third of all rows: the plan aggregates partially before
    the exchange, so the hot key reaches the reducer as one row per map task."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("listing_url"),
        F.col("id").cast("string").alias("scraped_at"), F.col("id"))
    out = latest_per_url(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert out.count() == 1 + (n - n // 3)
    assert out.where("listing_url = 'hot'").first()["scraped_at"] == "9999"


def test_first_per_crawl(spark):
    data = [("h1", "u", 2, 0, "b"), ("h1", "u", 1, 5, "a"), ("h2", "u", 9, 0, "c")]
    df = spark.createDataFrame(data, "crawl string, listing_url string, page_id int, pos int, title string")
    got = sorted(tuple(r) for r in first_per_crawl(df, "crawl").select("crawl", "title").collect())
    assert got == [("h1", "a"), ("h2", "c")]


def test_insert_if_absent_and_upsert(spark):
    store = spark.createDataFrame([("a", "2020"), ("b", "2020"), (None, "2020")], "listing_url string, scraped_at string")
    batch = spark.createDataFrame([("b", "2021"), ("c", "2021"), ("c", "2022"), (None, "2023")],
                                  "listing_url string, scraped_at string")
    assert [tuple(r) for r in insert_if_absent(batch, store.select("listing_url")).collect()] == [("c", "2022")]
    both = store.withColumn("stored", F.lit(True)).unionByName(batch.withColumn("stored", F.lit(False)))
    assert [tuple(r) for r in insert_if_absent_marked(both, F.col("stored")).drop("stored").collect()] == [("c", "2022")]
    keyed = [x.where("listing_url is not null") for x in (store, batch)]
    up = sorted(tuple(r) for r in upsert_latest(*keyed).collect())
    assert up == [("a", "2020"), ("b", "2021"), ("c", "2022")]


def test_a_row_without_a_key_is_rejected_and_counted(spark, tmp_path):
    from habita.schemas import LISTING_DW
    from habita.sinks.warehouse import ParquetTarget, load_batch
    rows = [{"listing_id": str(k), "listing_url": u, "scraped_at": "2024-01-01"} for k, u in enumerate(["u1", None, "u2", "u1"])]
    for buckets in (None, 4):
        target = ParquetTarget(str(tmp_path / f"dw{buckets}"), key_buckets=buckets)
        batch = spark.createDataFrame([[r.get(f) for f in LISTING_DW.fieldNames()] for r in rows], LISTING_DW)
        first, again = load_batch(batch, target), load_batch(batch, target)
        assert (first["read"], first["no_key"], first["written"], again["written"]) == (4, 1, 2, 0)
        assert sorted(r["listing_url"] for r in target.read(spark).collect()) == ["u1", "u2"]
