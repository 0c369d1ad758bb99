"""Deduplication and keyed loads.

All "pick one row per key" operators are aggregations, not windows: the
aggregate is computed partially on each map task before the shuffle, so a key
that holds a third of all rows is collapsed to one row per task instead of
being shuffled whole into one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pick_per_key(df: DataFrame, keys, order_cols, *, largest: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the largest (or smallest) ``order_cols``;
    the remaining columns break ties, so the survivor is deterministic."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    agg = F.max(packed) if largest else F.min(packed)
    return (df.groupBy(*keys).agg(agg.alias("__row"))
              .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in order_cols + rest])
              .select(*df.columns))


def latest_per_url(df: DataFrame, key: str = "listing_url", order: str = "scraped_at") -> DataFrame:
    """A1, deterministic: keep the latest message per URL (NULL URLs form one group)."""
    return pick_per_key(df, key, order, largest=True)


def first_per_crawl(df: DataFrame, crawl_col: str, key: str = "listing_url",
                    order=("page_id", "pos")) -> DataFrame:
    """A5: one item per URL per crawl, the first seen (page order, then position)."""
    return pick_per_key(df, [crawl_col, key], list(order), largest=False)


def insert_if_absent(batch: DataFrame, existing_keys: DataFrame, key: str = "listing_url",
                     *, order: str = "scraped_at", bucket_col: str | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet, one row per key.

    A row without a key can match nothing that is stored, so it is rejected
    (``load_batch`` counts it). The batch is reduced to one row per key (A1)
    and anti-joined with the key column of the store; Spark picks the join from
    the sizes it measures. With ``bucket_col`` (a store partitioned by key
    bucket) the join includes the bucket.
    """
    keyed = batch.where(F.col(key).isNotNull())
    deduped = latest_per_url(keyed, key, order) if order in batch.columns else keyed.dropDuplicates([key])
    cols = [bucket_col, key] if bucket_col else [key]
    return deduped.join(existing_keys.select(*cols), cols, "left_anti")


def insert_if_absent_marked(rows: DataFrame, stored: Column, key: str = "listing_url", order: str = "scraped_at") -> DataFrame:
    """D1 where stored and new rows are in one table: the latest new row of each key that has no
    stored row. One aggregation, whatever the sizes; rows without a key are rejected."""
    rest = [c for c in rows.columns if c not in (key, order)]
    new = F.when(~stored, F.struct(order, *rest))
    return (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(stored.cast("int")).alias("__stored"), F.max(new).alias("__row"))
            .where("__stored = 0").select(*[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in rows.columns]))


def upsert_latest(existing: DataFrame, batch: DataFrame, key: str = "listing_url",
                  order: str = "scraped_at") -> DataFrame:
    """D1 upsert variant: union of store and batch, latest row per key wins."""
    return latest_per_url(existing.unionByName(batch, allowMissingColumns=True), key, order)
