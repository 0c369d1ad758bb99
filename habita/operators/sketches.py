"""Marts kept up to date from sketches per batch (D3).

A batch leaves one row per group: its size, a quantile sketch (KLL) of its
prices and a distinct-count sketch (HyperLogLog) of its URLs. Sketches merge, so
a mart is read by merging the rows of all batches, a few kilobytes per group and
batch, and a new batch costs one pass over itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

GROUP = ("city", "property_type")
KLL_K = 400             # keeps the rank error of one quantile below 1 % with near certainty
HLL_LOG_K = 14
QUANTILES = (0.25, 0.5, 0.75)
RANK_ERROR = 0.02       # what a rank may be off, of the group's size
COUNT_ERROR = 0.05      # what a distinct count may be off, of itself


def batch_sketches(clean: DataFrame, group=GROUP) -> DataFrame:
    """One row per group of a batch of cleaned listings."""
    return clean.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("price", F.lit(KLL_K)).alias("prices"),
                                     F.hll_sketch_agg("listing_url", F.lit(HLL_LOG_K)).alias("urls"))


def merged_mart(sketches: DataFrame, group=GROUP) -> DataFrame:
    """``<group>, n_messages, n_urls, q25, q50, q75`` from the sketches of any number of batches."""
    merged = sketches.groupBy(*group).agg(F.sum("n").alias("n_messages"), F.kll_merge_agg_bigint("prices").alias("prices"), F.hll_union_agg("urls").alias("urls"))
    return merged.select(*group, "n_messages", F.hll_sketch_estimate("urls").alias("n_urls"),
                         *[F.kll_sketch_get_quantile_bigint("prices", F.lit(q)).alias(f"q{round(100 * q)}") for q in QUANTILES])


def mart_errors(mart: DataFrame, clean: DataFrame, group=GROUP) -> DataFrame:
    """The mart with the exact error of each figure: ``rank_error_q25`` ... (of the group's size) and ``count_error``.

    The rank of an estimate lies between the rows below it and the rows up to it;
    its error is the distance of the wanted rank from that span. Both ends are
    counts, so the check is one aggregation of the listings joined with the
    mart (one row per group).
    """
    on = [F.col(f"m.{g}").eqNullSafe(F.col(f"c.{g}")) for g in group]
    both = clean.alias("c").join(mart.alias("m"), on)
    keys = [F.col(f"m.{g}").alias(g) for g in group]
    names = [f"q{round(100 * q)}" for q in QUANTILES]
    ranks = both.groupBy(*keys, *[F.col(f"m.{c}").alias(c) for c in ("n_messages", "n_urls", *names)]).agg(
        F.count("c.price").alias("n_prices"), F.count_distinct("c.listing_url").alias("urls"),
        *[F.count_if(F.col("c.price") < F.col(f"m.{q}")).alias(f"below_{q}") for q in names],
        *[F.count_if(F.col("c.price") <= F.col(f"m.{q}")).alias(f"upto_{q}") for q in names])
    error = lambda q, share: F.greatest(F.col(f"below_{q}") - share * F.col("n_prices"), share * F.col("n_prices") - F.col(f"upto_{q}"), F.lit(0.0)) / F.col("n_prices")     # noqa: E731
    return ranks.select(*group, "n_messages", "n_urls", *names, *[error(q, s).alias(f"rank_error_{q}") for q, s in zip(names, QUANTILES)],
                        (F.abs(F.col("n_urls") - F.col("urls")) / F.col("urls")).alias("count_error"))
