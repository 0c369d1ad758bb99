"""A keyed table in hash buckets: stored upserts, inserts checked by a Bloom filter.

Rows lie in ``rows/<version>/key_bucket=K``; beside them, in
``filter/<version>/key_bucket=K``, a blocked Bloom filter of each bucket's keys:
one row of four 64-bit words per block, every key's bits in one block. A numbered
file under ``tables/`` names the folders that make up one state of the table;
the highest number counts. A load writes new folders and then that one file, so
readers see a load whole or not at all, what fails in between leaves the table
as it was, and of two loads at a time one fails and is retried.

An upsert rewrites only the buckets that the batch has keys of. An insert adds a
folder to them; the filter tells which of the batch's keys may be stored, and
only those meet the stored keys.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_per_url
from ..schemas import DW_KEY, LISTING_DW
from . import files
from .warehouse import BUCKET_COL, key_bucket

BITS = 256              # of a block
WORDS = 4
PROBES = 8              # bits that a key sets in its block
BITS_PER_KEY = 12
OUTGROWN = 2            # times as many keys as planned, before a bucket's filter is built anew
FILTER = f"{BUCKET_COL} int, block int, " + ", ".join(f"w{i} long" for i in range(WORDS))


def _block_of(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), DW_KEY), blocks).cast("int")


def _mask() -> list[Column]:
    """The bits of a key in its block, as ``WORDS`` words; a probe is one byte of a hash."""
    h = f"xxhash64(2, {DW_KEY})"
    probes = [f"cast(shiftrightunsigned({h}, {8 * i}) & 255 as int)" for i in range(PROBES)]
    return [reduce(lambda a, b: a.bitwiseOR(b), [F.expr(f"if(shiftright({p}, 6) = {w}, shiftleft(1L, {p} & 63), 0L)") for p in probes]).alias(f"w{w}")
            for w in range(WORDS)]


def _filter_rows(keyed: DataFrame) -> DataFrame:
    """Blocks of keyed rows (``key_bucket, blocks``, key)."""
    return (keyed.select(BUCKET_COL, _block_of(F.col("blocks")).alias("block"), *_mask())
            .groupBy(BUCKET_COL, "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]))


@dataclass
class BucketedStore:
    """``path``: the table's folder; ``buckets``: fixed when the table is made (sized to about a gigabyte of rows each)."""
    path: str
    buckets: int = 64
    schema: T.StructType = None

    def __post_init__(self):
        self.schema = self.schema or LISTING_DW

    # the state of the table: bucket -> {"rows": folders, "filter": folder, "blocks": number, "keys": number}
    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        numbers = [n for n in files.names_in(spark, f"{self.path}/tables") if n.endswith(".json")]
        if not numbers:
            return 0, {}
        return int(numbers[-1][:-5]), json.loads(files.read_text(spark, f"{self.path}/tables/{numbers[-1]}"))

    def _publish(self, spark: SparkSession, number: int, state: dict) -> None:
        files.publish_text(spark, f"{self.path}/tables/{number + 1:012d}.json", json.dumps(state, sort_keys=True))

    def _rows(self, spark: SparkSession, state: dict, buckets=None) -> DataFrame:
        """Stored rows with their bucket, of the given buckets only."""
        chosen = state if buckets is None else {b: state[b] for b in map(str, buckets) if b in state}
        folders = [f"{self.path}/rows/{v}/{BUCKET_COL}={b}" for b, s in chosen.items() for v in s["rows"]]
        if not folders:
            return spark.createDataFrame([], self.schema).withColumn(BUCKET_COL, F.lit(0))
        return spark.read.schema(self.schema).parquet(*folders).withColumn(BUCKET_COL, key_bucket(self.buckets))

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, self._state(spark)[1]).select(*self.schema.fieldNames())

    def _write(self, rows: DataFrame, version: str) -> None:
        (rows.repartition(BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(f"{self.path}/rows/{version}"))

    def _sizes(self, spark: SparkSession, sizes: dict[int, int]) -> DataFrame:
        """``key_bucket, blocks``: at most one row per bucket."""
        return F.broadcast(spark.createDataFrame(list(sizes.items()) or [(-1, 1)], f"{BUCKET_COL} int, blocks int"))

    def _write_filter(self, spark: SparkSession, rows: DataFrame, sizes: dict[int, int], version: str, old: DataFrame | None = None) -> None:
        built = _filter_rows(rows.select(BUCKET_COL, DW_KEY).join(self._sizes(spark, sizes), BUCKET_COL))
        if old is not None:
            built = built.unionByName(old).groupBy(BUCKET_COL, "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
        built.repartition(BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(f"{self.path}/filter/{version}")

    def _filter(self, spark: SparkSession, state: dict, buckets) -> DataFrame:
        folders = {f"{self.path}/filter/{state[str(b)]['filter']}/{BUCKET_COL}={b}": b for b in buckets if str(b) in state}
        if not folders:
            return spark.createDataFrame([], FILTER)
        words = ", ".join(f.strip() for f in FILTER.split(",")[1:])
        parts: dict[str, list[str]] = {}
        for f in folders:                       # the bucket is a folder's name: one read per version
            parts.setdefault(f.rsplit("/", 1)[0], []).append(f)
        reads = [spark.read.option("basePath", base).schema(f"{words}, {BUCKET_COL} int").parquet(*some) for base, some in parts.items()]
        return reduce(DataFrame.unionByName, reads).select(*[f.split()[0] for f in FILTER.split(", ")])

    def _planned(self, keys: int) -> int:
        return max(1, math.ceil(keys * BITS_PER_KEY / BITS))

    def _counts(self, rows: DataFrame) -> dict[int, int]:
        return {r[0]: r[1] for r in rows.groupBy(BUCKET_COL).agg(F.count(F.lit(1))).collect()}      # at most one row per bucket

    def _batch(self, batch: DataFrame, order: str) -> DataFrame:
        keyed = batch.where(F.col(DW_KEY).isNotNull()).select(*self.schema.fieldNames())
        return latest_per_url(keyed, DW_KEY, order).withColumn(BUCKET_COL, key_bucket(self.buckets))

    def upsert(self, batch: DataFrame, order: str = "scraped_at", before_publish: Callable | None = None) -> dict:
        """Store the latest row per key of table and batch; rows without a key are rejected.

        Only buckets that the batch has keys of are read and rewritten.
        ``before_publish`` is a test hook between writing and publishing.
        """
        spark = batch.sparkSession
        number, state = self._state(spark)
        version = uuid.uuid4().hex
        rows = self._batch(batch, order).persist()
        try:
            touched = self._counts(rows)
            if not touched:
                return {"touched": 0, "rows": 0}
            merged = latest_per_url(self._rows(spark, state, touched).unionByName(rows), DW_KEY, order)
            self._write(merged, version)
        finally:
            rows.unpersist()
        kept = spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{version}/{BUCKET_COL}={b}" for b in touched]).withColumn(BUCKET_COL, key_bucket(self.buckets))
        counts = self._counts(kept.select(BUCKET_COL))
        sizes = {b: self._planned(n) for b, n in counts.items()}
        self._write_filter(spark, kept, sizes, version)
        if before_publish is not None:
            before_publish()
        self._publish(spark, number, state | {str(b): {"rows": [version], "filter": version, "blocks": sizes[b], "keys": n} for b, n in counts.items()})
        return {"touched": len(touched), "rows": sum(touched.values())}

    def possible_hits(self, rows: DataFrame, state: dict | None = None) -> DataFrame:
        """``rows`` (with bucket) and a column ``possible``: false where the key is not stored for sure."""
        spark = rows.sparkSession
        if state is None:
            state = self._state(spark)[1]
        sizes = {int(b): s["blocks"] for b, s in state.items()}
        words = self._filter(spark, state, sizes)
        probe = (rows.join(self._sizes(spark, sizes), BUCKET_COL, "left")
                 .withColumn("block", _block_of(F.col("blocks"))).select(*rows.columns, "block", *[m.alias(f"m{i}") for i, m in enumerate(_mask())]))
        hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)])
        return probe.join(words, [BUCKET_COL, "block"], "left").select(*[F.col(c) for c in rows.columns], F.coalesce(hit, F.lit(False)).alias("possible"))

    def insert(self, batch: DataFrame, order: str = "scraped_at", before_publish: Callable | None = None) -> dict:
        """Insert the keys of the batch that the table does not have (the latest row of each); rows without a key are rejected."""
        spark = batch.sparkSession
        number, state = self._state(spark)
        version = uuid.uuid4().hex
        rows = self.possible_hits(self._batch(batch, order), state).persist()
        try:
            seen = rows.agg(F.count(F.lit(1)).alias("keys"), F.count_if("possible").alias("possible"),
                            F.collect_set(F.when(F.col("possible"), F.col(BUCKET_COL))).alias("buckets")).first()     # at most one number per bucket
            stored = self._rows(spark, state, seen["buckets"]).select(BUCKET_COL, DW_KEY)
            fresh = (rows.where(~F.col("possible")).drop("possible")
                     .unionByName(rows.where("possible").drop("possible").join(stored, [BUCKET_COL, DW_KEY], "left_anti")))
            self._write(fresh.select(*self.schema.fieldNames(), BUCKET_COL), version)
        finally:
            rows.unpersist()
        grown = [n.split("=")[1] for n in files.names_in(spark, f"{self.path}/rows/{version}") if n.startswith(f"{BUCKET_COL}=")]
        if not grown:
            files.delete(spark, f"{self.path}/rows/{version}")
            return {"keys": seen["keys"], "possible": seen["possible"], "written": 0}
        added = self._rows(spark, {b: {"rows": [version]} for b in grown}).select(BUCKET_COL, DW_KEY)
        counts = self._counts(added)
        after, build, keep = {}, [], []
        for b, n in counts.items():
            s = state.get(str(b), {"rows": [], "keys": 0, "blocks": 0})
            total = s["keys"] + n
            outgrown = total > OUTGROWN * s["blocks"] * BITS / BITS_PER_KEY
            (build if outgrown else keep).append(b)
            after[str(b)] = {"rows": [*s["rows"], version], "filter": version, "keys": total, "blocks": self._planned(total) if outgrown else s["blocks"]}
        sizes = {b: after[str(b)]["blocks"] for b in counts}
        # buckets that have outgrown their filter get one from all their keys, the others add the new keys to theirs
        old_keys = self._rows(spark, state, build).select(BUCKET_COL, DW_KEY)
        self._write_filter(spark, added.unionByName(old_keys), sizes, version, self._filter(spark, state, keep))
        if before_publish is not None:
            before_publish()
        self._publish(spark, number, state | after)
        return {"keys": seen["keys"], "possible": seen["possible"], "written": sum(counts.values())}

    def vacuum(self, spark: SparkSession) -> int:
        """Delete folders that the newest state does not name (failed loads, replaced rows); their number."""
        _, state = self._state(spark)
        named = {"rows": {v for s in state.values() for v in s["rows"]}, "filter": {s["filter"] for s in state.values()}}
        gone = [f"{self.path}/{kind}/{v}" for kind in named for v in files.names_in(spark, f"{self.path}/{kind}") if v not in named[kind]]
        for folder in gone:
            files.delete(spark, folder)
        return len(gone)
