"""Host lists of any size, drift of the wire schema, clustering of the lake."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from habita.functions.html import host_allowed
from habita.operators.hosts import keep_listed
from habita.sinks.lake import cluster
from habita.sources.drift import unknown_fields


def test_a_million_domains_without_a_nested_loop(spark):
    domains = spark.range(1_000_000).select(F.concat(F.lit("d"), "id", F.lit(".Example")).alias("domain"))
    urls = ["https://d5.example/x", "http://a.b.d999999.example", "https://xd5.example/", "https://example/", "no url", None, "https://D7.EXAMPLE:80/p", "https://d1000000.example"]
    rows = spark.createDataFrame(list(enumerate(urls)), "domain int, url string")       # a column named like the list's
    kept = keep_listed(rows, "url", domains)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert kept.columns == ["domain", "url"] and sorted(r["domain"] for r in kept.collect()) == [0, 1, 6]


def test_the_list_join_equals_the_short_condition(spark):
    short = ["example.org", "a.net", "co"]
    hosts = ["example.org", "www.example.org", "badexample.org", "a.net", "b.a.net", "net", "x.co", "co", "", "org"]
    rows = spark.createDataFrame([(f"https://{h}/p",) for h in hosts] * 3, "url string")
    want = sorted(r[0] for r in rows.where(host_allowed("url", short)).collect())
    got = sorted(r[0] for r in keep_listed(rows, "url", spark.createDataFrame([(d,) for d in short + short], "domain string")).collect())
    assert got == want and len(got) == 18


def test_unknown_fields_and_their_types(spark):
    messages = ['{"source":"a","price":1,"etage":2}', '{"source":"a","etage":"deux","geo":{"lat":1}}', '{"etage":null}', '[{"etage":1}]', "etage", "", None,
                '{"source":"b","listing_id":"x"}']
    got = {(r["source"], r["field"]): (r["n_rows"], r["merged_type"]) for r in unknown_fields(spark.createDataFrame([(m,) for m in messages], "value string")).collect()}
    assert {k: v[0] for k, v in got.items()} == {("a", "etage"): 2, ("a", "geo"): 1, (None, "etage"): 1}
    assert "lat" in got["a", "geo"][1] and got["a", "etage"][1] == "VARIANT"


def read_bytes(path, city, low, high):
    """Bytes of the row groups that a reader cannot skip for city = ... and price between ..."""
    total = read = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stat = {n: group.column(names.index(n)).statistics for n in ("city", "price")}
            total += group.total_byte_size
            if stat["city"].min <= city <= stat["city"].max and stat["price"].min <= high and stat["price"].max >= low:
                read += group.total_byte_size
    return read, total


def test_clustering_lets_filters_skip_files(spark, tmp_path):
    rows = spark.range(60000).select(
        F.concat(F.lit("city"), F.pmod(F.xxhash64("id"), F.lit(8))).alias("city"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1_000_000)).alias("price"),
        F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("listing_url"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, "n"), ("", -5, "m")], rows.schema))
    plain, curved = str(tmp_path / "plain"), str(tmp_path / "curved")
    rows.repartition(64).write.parquet(plain)
    cluster(spark, plain, curved, ("city", "price"), rows_per_file=1000)
    back = spark.read.parquet(curved)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    before, after = read_bytes(plain, "city3", 200_000, 300_000), read_bytes(curved, "city3", 200_000, 300_000)
    assert before[0] == before[1]               # every file holds every city and price
    assert after[0] < 0.15 * after[1]           # 1/80 of the rows; a few files at the edges
