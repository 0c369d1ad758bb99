"""Serving marts and lake maintenance (A3, A4, D2, D3, D5 and the flagship)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def market_summary(latest: DataFrame) -> DataFrame:
    """Flagship mart: per source / property type / offer type."""
    return (latest.groupBy("source", "property_type", "offer_type")
            .agg(F.count(F.lit(1)).alias("n_listings"),
                 F.sum("price").alias("sum_price"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price"),
                 F.sum("bedrooms").alias("sum_bedrooms"),
                 F.round(F.sum(F.col("square_footage").cast("double")), 2).alias("sum_surface")))


def count_listings(df: DataFrame) -> DataFrame:
    """A3: SELECT count(*)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_sources(df: DataFrame) -> DataFrame:
    """A4: SELECT DISTINCT source."""
    return df.select("source").distinct()


def location_marts(latest: DataFrame) -> DataFrame:
    """D3: exact price statistics per location and type (count/min/max/avg)."""
    return (latest.groupBy("city", "neighborhood", "property_type", "offer_type")
            .agg(F.count(F.lit(1)).alias("n_listings"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price"),
                 F.round(F.avg("price"), 2).alias("avg_price")))


def price_quantiles(latest: DataFrame, accuracy: int = 10000) -> DataFrame:
    """D3: approximate price quartiles per city and type.

    ``percentile_approx`` keeps a bounded sketch per group, so a group holding a
    third of all rows costs the same memory as a small one (exact percentiles
    would buffer every distinct value of the group in one task).
    """
    return (latest.groupBy("city", "property_type")
            .agg(F.count(F.lit(1)).alias("n_listings"),
                 F.percentile_approx("price", [0.25, 0.5, 0.75], accuracy).alias("price_quartiles")))


def price_quartiles(latest: DataFrame, group=("city", "property_type")) -> DataFrame:
    """D3: exact quartiles (the smallest price with at least k/4 of the group at or below it).

    Rows are counted per price, prices per bucket of their logarithm. The few
    thousand buckets a group can have are ranked first; only the buckets that
    hold a quartile are then ranked price by price, so no task sorts a group.
    """
    keys = list(group)
    counts = latest.groupBy(*keys, "price").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", F.when(F.col("price") > 0, F.floor(F.log2("price") * 64)).otherwise(F.lit(-1)))
    buckets = counts.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys)
    ranked = buckets.select(*keys, "bucket", F.sum("n").over(whole).alias("total"),
                            (F.sum("n").over(whole.orderBy("bucket")) - F.col("n")).alias("before"), F.col("n").alias("inside"))
    wanted = (ranked.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
              .withColumn("rank", F.floor((F.col("k") * F.col("total") + 3) / 4))
              .where("rank > before and rank <= before + inside"))
    same = F.lit(True)
    for c in [*keys, "bucket"]:
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"c.{c}"))
    near = wanted.alias("w").join(counts.alias("c"), same).select(*[F.col(f"w.{c}") for c in keys], "total", "k", "rank", "before", "price", F.col("c.n").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*keys, "k").orderBy("price"))
    found = near.withColumn("upto", upto).where("upto >= rank")
    return found.groupBy(*keys).agg(F.max("total").alias("n_listings"), *[F.min(F.when(F.col("k") == k, F.col("price"))).alias(f"q{25 * k}") for k in (1, 2, 3)])


def price_per_m2(latest: DataFrame) -> DataFrame:
    """D3: price per square metre over listings with a positive surface."""
    return (latest.where(F.col("square_footage") > 0)
            .groupBy("city", "property_type")
            .agg(F.count(F.lit(1)).alias("n_listings"),
                 F.round(F.avg(F.col("price") / F.col("square_footage").cast("double")), 2)
                  .alias("avg_price_m2")))
