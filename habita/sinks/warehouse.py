"""Keyed serving table.

The serving table has ``listing_url`` as its key. Loads are idempotent by key
(insert-if-absent), so a micro-batch that is retried after a failure -- even
one that was partly committed -- inserts each listing at most once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import to_serving_rows
from ..operators.dedup import insert_if_absent
from ..schemas import DW_KEY, LISTING_DW, LISTING_DW_DDL


@dataclass
class JdbcTarget:
    """A table reached through JDBC (needs the driver jar on the classpath)."""
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    num_partitions: int = 8
    batch_size: int = 1000

    def ddl(self) -> str:
        """K6: CREATE TABLE IF NOT EXISTS with the 18 columns and the key."""
        return LISTING_DW_DDL.format(table=self.table)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.jdbc(self.url, self.table, properties=self.properties)

    def existing_keys(self, spark: SparkSession) -> DataFrame:
        q = f"(SELECT {DW_KEY} FROM {self.table}) k"
        return spark.read.jdbc(self.url, q, properties=self.properties)

    def append(self, df: DataFrame) -> None:
        props = dict(self.properties, batchsize=str(self.batch_size),
                     numPartitions=str(self.num_partitions))
        df.write.jdbc(self.url, self.table, mode="append", properties=props)


BUCKET_COL = "key_bucket"


def key_bucket(n: int):
    """Deterministic bucket of the key (stable across runs and retries)."""
    return F.pmod(F.xxhash64(F.col(DW_KEY)), F.lit(n)).cast("int")


@dataclass
class ParquetTarget:
    """The serving table kept as a Parquet directory.

    With ``key_buckets`` the table is partitioned by a hash bucket of the key:
    a batch's conflict check then joins on (bucket, key) and dynamic partition
    pruning reads only the buckets the batch touches instead of every stored
    key -- the store can grow without making each micro-batch slower.
    """
    path: str
    key_buckets: int | None = None

    def _raw(self, spark: SparkSession) -> DataFrame | None:
        try:
            if self.key_buckets:
                return spark.read.parquet(self.path)
            return spark.read.schema(LISTING_DW).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows; a table that was never written reads as empty."""
        raw = self._raw(spark)
        if raw is None:
            return spark.createDataFrame([], LISTING_DW)
        return raw.select(*LISTING_DW.fieldNames())

    def existing_keys(self, spark: SparkSession) -> DataFrame:
        raw = self._raw(spark)
        if raw is None:
            schema = f"{BUCKET_COL} int, {DW_KEY} string" if self.key_buckets else f"{DW_KEY} string"
            return spark.createDataFrame([], schema)
        return raw.select(BUCKET_COL, DW_KEY) if self.key_buckets else raw.select(DW_KEY)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET_COL, key_bucket(self.key_buckets)) if self.key_buckets else df

    def append(self, df: DataFrame) -> None:
        if self.key_buckets:
            # rows meet by bucket first, in tasks as large as Spark sees fit: a load adds a few files to a bucket, not one from every task
            self.with_bucket(df).hint("rebalance", BUCKET_COL).write.mode("append").partitionBy(BUCKET_COL).parquet(self.path)
        else:
            df.write.mode("append").parquet(self.path)


def stored_keys_of(keyed_rows: DataFrame, target, used: list[int] | None = None) -> DataFrame:
    """Key column of the store's buckets that a batch has rows for: the bucket numbers (at most
    ``key_buckets``) are read first unless the caller has them, so the scan of the store skips all other partitions."""
    if used is None:
        used = [r[0] for r in keyed_rows.select(BUCKET_COL).distinct().collect()]
    return target.existing_keys(keyed_rows.sparkSession).where(F.col(BUCKET_COL).isin(used))


def load_batch(batch: DataFrame, target, *, batch_id: int | None = None,
               on_error: str = "fail") -> dict:
    """K4 + D1: load one batch of cleaned listings into the serving table.

    The batch is persisted while it is counted and written (T11) and always
    unpersisted. Counts of rows read, without a key (rejected) and written are reported separately (A2 logged
    the pre-dedup count as "inserted"). ``on_error='fail'`` re-raises so the
    streaming batch is retried from its checkpoint; ``'skip'`` reproduces the
    reference, which logged and dropped the batch.
    """
    spark = batch.sparkSession
    metrics = {"batch_id": batch_id, "read": 0, "no_key": 0, "written": 0, "error": None}
    batch.persist()
    new = None
    try:
        bucketed = getattr(target, "key_buckets", None) if not hasattr(target, "insert") else None
        n, keyed, *used = batch.agg(F.count("*"), F.count(DW_KEY), *([F.collect_set(key_bucket(bucketed))] if bucketed else [])).first()
        metrics["read"], metrics["no_key"] = n, n - keyed
        if n > 0:
            rows = to_serving_rows(batch)
            if hasattr(target, "insert"):       # a store that checks conflicts itself (sinks.buckets)
                metrics["written"] = target.insert(rows)["written"]
                return metrics
            if bucketed:
                keyed_rows = target.with_bucket(rows)
                new = insert_if_absent(keyed_rows, stored_keys_of(keyed_rows, target, *used), DW_KEY,
                                       bucket_col=BUCKET_COL).drop(BUCKET_COL).persist()
            else:
                new = insert_if_absent(rows, target.existing_keys(spark), DW_KEY).persist()
            metrics["written"] = new.count()
            if metrics["written"]:
                target.append(new)
    except Exception as e:  # noqa: BLE001
        metrics["error"] = f"{type(e).__name__}: {e}"
        if on_error != "skip":
            raise
    finally:
        if new is not None:
            new.unpersist()
        batch.unpersist()
    return metrics


def register_view(spark: SparkSession, target, name: str = "proprietes") -> DataFrame:
    """Expose the serving table to ad-hoc SQL (``SELECT count(*) FROM proprietes``)."""
    df = target.read(spark)
    df.createOrReplaceTempView(name)
    return df
