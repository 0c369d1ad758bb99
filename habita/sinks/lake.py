"""Parquet lake: append, curated zone, compaction and reset."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_per_url
from . import files


def append_lake(df: DataFrame, path: str, partition_by=()) -> None:
    """Batch append of cleaned listings (the streaming form is in habita.streaming)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_curated(latest: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The curated zone (one row per URL), partitioned by source so that
    per-source reads prune whole directories."""
    latest.write.mode(mode).partitionBy("source").parquet(path)


def compact(spark: SparkSession, src_path: str, dst_path: str, rows_per_file: int = 2_000_000,
            partition_cols=(), spread_col: str = "listing_url") -> None:
    """Rewrite the small files of a streaming lake into few large ones.

    Each partition value gets as many writers as its own rows need, however much
    of the lake it holds: its rows are dealt by the hash of ``spread_col`` among
    tasks of its own. So a task writes one file as the rows arrive, holds none of
    them for a sort, and never gets the rows of two files. The hash is
    deterministic, so a retried task rebuilds exactly the same file.
    """
    df = spark.read.parquet(src_path)
    cols = list(partition_cols)
    counts = df.groupBy(*cols).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("__files"))
    spread = F.pmod(F.xxhash64(F.col(spread_col)), F.col("__files"))
    if cols:
        folders = counts.collect()              # one row per folder that is written
        total, first = 0, []
        for r in folders:
            first.append((*r, total))
            total += r["__files"]
        total = total or 1
        named = spark.createDataFrame(first, T.StructType([T.StructField(f"__{c}", df.schema[c].dataType) for c in cols]
                                                          + [T.StructField("__files", T.IntegerType()), T.StructField("__first", T.IntegerType())]))
        joined = df.join(F.broadcast(named), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols], "left").select(*df.columns, "__files", "__first")
        with files.unsorted_writes(spark, 1):
            (joined.repartitionById(total, F.col("__first") + spread.cast("int")).drop("__files", "__first")
             .write.mode("overwrite").partitionBy(*cols).parquet(dst_path))
    else:
        total = counts.agg(F.sum("__files")).first()[0] or 1
        df.repartition(total, F.pmod(F.xxhash64(F.col(spread_col)), F.lit(total))).write.mode("overwrite").parquet(dst_path)


def reset(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """K7: empty a lake path (overwrite with no rows). A stream restarted after
    a reset must use a *new* checkpoint location."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def refresh_curated(spark: SparkSession, lake_path: str, curated_path: str) -> DataFrame:
    """D2 as a batch job: the raw lake (every message ever appended) -> one
    latest row per URL -> the curated zone, partitioned by source. Returns
    the written table read back (partition-pruned reads by source)."""
    lake = spark.read.parquet(lake_path)
    cols = [c for c in lake.columns if c not in ("processed_at", "batch_id")]
    write_curated(latest_per_url(lake.select(*cols)), curated_path)
    return spark.read.parquet(curated_path)


TAKEN = "_taken"            # readers of the zone skip names that begin with an underscore
EMPTY_SOURCE = "__HIVE_DEFAULT_PARTITION__"     # fixed value: how a null partition value is written


def _ids(spans: list[list[int]]) -> set[int]:
    return {i for a, b in spans for i in range(a, b + 1)}


def _spans(ids: set[int]) -> list[list[int]]:
    """Batch numbers as spans of consecutive ones: numbers count upwards, so there are few."""
    out: list[list[int]] = []
    for i in sorted(ids):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return out


def taken_batches(spark: SparkSession, curated_path: str) -> set[int]:
    """Lake batches that the curated zone already holds."""
    lists = [n for n in files.names_in(spark, f"{curated_path}/{TAKEN}") if n.endswith(".json")]
    return reduce(set.union, (_ids(json.loads(files.read_text(spark, f"{curated_path}/{TAKEN}/{n}"))) for n in lists), set())


def _note_taken(spark: SparkSession, curated_path: str, taken: set[int]) -> None:
    folder = f"{curated_path}/{TAKEN}"
    before = [n for n in files.names_in(spark, folder) if n.endswith(".json")]
    files.publish_text(spark, f"{folder}/{uuid.uuid4().hex}.json", json.dumps(_spans(taken)))
    for n in before:            # the new list holds theirs
        files.delete(spark, f"{folder}/{n}")


def refresh_curated_batches(spark: SparkSession, lake_path: str, curated_path: str, before_note=None) -> dict:
    """D2, only what changed: batches of the lake (``batch_id=N`` folders) that the zone does not hold yet.

    The new batches' latest row per URL meets the partitions (sources) that
    hold a row of one of these URLs or get one; only those are rewritten, by
    dynamic partition overwrite, and a source that has lost all its rows to
    others goes. The batches are noted as taken last, so a run that failed
    before is simply repeated: the latest row per URL stays the same.
    ``before_note`` is a test hook.
    """
    present = {int(n.split("=")[1]) for n in files.names_in(spark, lake_path) if n.startswith("batch_id=")}
    taken = taken_batches(spark, curated_path)
    new = sorted(present - taken)
    if not new:
        return {"batches": [], "sources": []}
    lake = spark.read.parquet(*[f"{lake_path}/batch_id={b}" for b in new])
    cols = [c for c in lake.columns if c not in ("processed_at", "batch_id")]
    fresh = latest_per_url(lake.select(*cols)).persist()
    try:
        sources = {r[0] for r in fresh.select("source").distinct().collect()}       # partitions of the zone
        merged = fresh
        if any(n.startswith("source=") for n in files.names_in(spark, curated_path)):
            zone = spark.read.schema(fresh.schema).parquet(curated_path).select(*cols)
            moved = zone.select("source", "listing_url").join(fresh.select("listing_url"), "listing_url", "left_semi")
            sources |= {r[0] for r in moved.select("source").distinct().collect()}
            chosen = F.col("source").isin([s for s in sources if s is not None])
            merged = latest_per_url(zone.where(chosen | F.col("source").isNull() if None in sources else chosen).unionByName(fresh))
        files_before = set(files.names_in(spark, curated_path))
        draft = f"{curated_path}/_draft-{uuid.uuid4().hex}"
        merged.write.partitionBy("source").parquet(draft)       # the zone is read while this is written
    finally:
        fresh.unpersist()
    written = {n for n in files.names_in(spark, draft) if n.startswith("source=")}
    spark.read.schema(T.StructType([f for f in fresh.schema if f.name != "source"] + [fresh.schema["source"]])).parquet(draft).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(curated_path)
    names = {f"source={EMPTY_SOURCE if s is None else s}" for s in sources}
    for gone in (names & files_before) - written:
        files.delete(spark, f"{curated_path}/{gone}")
    files.delete(spark, draft)
    if before_note is not None:
        before_note()
    _note_taken(spark, curated_path, taken | set(new))
    return {"batches": new, "sources": sorted(sources, key=str)}


CURVE_BITS = 8          # of each clustering column


def _as_number(df: DataFrame, c: str):
    """A column's order as a double: numbers and times as they are, texts by their first six bytes."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.col(c).cast("double")


def curve_key(df: DataFrame, cols, error: float = 0.002):
    """``df`` with ``__curve``: the interleaved bits of the columns' ranks (a Z-order key), and nulls first.

    A rank is the place among 255 quantiles, which are all that reaches the
    driver; it is looked up by binary search.
    """
    from pyspark.ml.feature import Bucketizer

    numbered = df.select("*", *[F.coalesce(_as_number(df, c), F.lit(float("-inf"))).alias(f"__n{i}") for i, c in enumerate(cols)])
    finite = numbered.select(*[F.when(F.col(f"__n{i}") > float("-inf"), F.col(f"__n{i}")).alias(f"__n{i}") for i in range(len(cols))])
    shares = [k / 2 ** CURVE_BITS for k in range(1, 2 ** CURVE_BITS)]
    cuts = finite.approxQuantile([f"__n{i}" for i in range(len(cols))], shares, error)
    splits = [[float("-inf"), *sorted(set(q)), float("inf")] if q else [float("-inf"), 0.0, float("inf")] for q in cuts]
    ranked = Bucketizer(splitsArray=splits, inputCols=[f"__n{i}" for i in range(len(cols))], outputCols=[f"__r{i}" for i in range(len(cols))]).transform(numbered)
    key = F.lit(0).cast("long")
    for bit in range(CURVE_BITS):
        for i in range(len(cols)):
            one = F.shiftright(F.col(f"__r{i}").cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(cols) + i))
    return ranked.select(*df.columns, key.alias("__curve"))


def cluster(spark: SparkSession, src_path: str, dst_path: str, cols, rows_per_file: int = 2_000_000) -> None:
    """D5 with clustering: rows that are near in all of ``cols`` lie in one file, so a filter on any of them skips files.

    Files are ranges of a space-filling curve of about equal size; equal
    keys are dealt by a hash of the row, so one place on the curve may fill
    many files.
    """
    df = spark.read.parquet(src_path)
    n = df.count()
    files_wanted = max(1, -(-n // rows_per_file))
    rest = F.xxhash64(*df.columns)
    (curve_key(df, cols).withColumn("__rest", rest).repartitionByRange(files_wanted, "__curve", "__rest")
     .sortWithinPartitions("__curve", "__rest").drop("__curve", "__rest").write.mode("overwrite").parquet(dst_path))
