"""The streaming job.

Batch and streaming share one code path: ``clean_stream`` applies the same
``parse_wire`` and ``clean_listings`` as the batch queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_listings
from ..sinks.warehouse import load_batch
from ..sources.wire import lenient_schema, parse_wire, wire_stream
from .windows import with_event_time

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


def clean_stream(spark: SparkSession, *, mode: str = "compat", fields=None, **source_opts) -> DataFrame:
    """S1 -> S2/S3 -> P*/F*: an unbounded table of cleaned listings (with ``fields``: of those the parser is asked for, see ``parse_wire``)."""
    raw = wire_stream(spark, **source_opts)
    schema = lenient_schema() if mode == "lenient" else None
    parsed = parse_wire(raw, schema=schema, fields=fields) if schema is not None else parse_wire(raw, fields=fields)
    return clean_listings(parsed, mode=mode)


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def start_lake(clean: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None,
               partition_by=(), query_name: str | None = None) -> StreamingQuery:
    """K3 + T1/T2/T7: append Parquet files; the file-sink log plus the
    checkpoint make the lake exactly-once across restarts."""
    w = (clean.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def start_warehouse(clean: DataFrame, target, checkpoint: str, *, trigger: dict | None = None,
                    on_error: str = "fail", metrics_sink=None) -> StreamingQuery:
    """K4 + T6/T10/T11: one keyed, idempotent load per micro-batch."""
    def _batch(df: DataFrame, batch_id: int) -> None:
        m = load_batch(df, target, batch_id=batch_id, on_error=on_error)
        if metrics_sink is not None:
            metrics_sink(m)

    w = clean.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_fanout(clean: DataFrame, lake_path: str, target, checkpoint: str, *,
                 trigger: dict | None = None, on_error: str = "fail",
                 fail_after_lake=None) -> StreamingQuery:
    """T9, recommended form: one query reads and parses each batch once and
    writes both sinks, so both get the same rows and the same processed_at.

    Replays are harmless: each micro-batch overwrites its own ``batch_id=N``
    directory of the lake (the batch id is stable across restarts), and the
    serving table is loaded insert-if-absent by key. ``fail_after_lake`` is a
    test hook that raises between the two writes.
    """
    def _batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            df.write.mode("overwrite").parquet(f"{lake_path}/batch_id={batch_id}")
            if fail_after_lake is not None:
                fail_after_lake(batch_id)
            load_batch(df, target, batch_id=batch_id, on_error=on_error)
        finally:
            df.unpersist()

    w = clean.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def watermark_dedup(clean: DataFrame, delay: str, key: str = "listing_url", event: str | Column = "scraped_at") -> DataFrame:
    """X3 with bounded state: a URL seen again within ``delay`` of event time
    is dropped; state for a URL expires once the watermark passes it."""
    return (with_event_time(clean, event).withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark([key]))


def run_until_any_stops(spark: SparkSession) -> None:
    """Block until any of the session's queries terminates."""
    spark.streams.awaitAnyTermination()


def start_listing_job(spark: SparkSession, *, lake_path: str, target, checkpoint_root: str,
                      fanout: bool = True, echo: bool = False, mode: str = "compat",
                      trigger: dict | None = None, on_error: str = "fail",
                      **source_opts) -> list[StreamingQuery]:
    """The whole streaming job: wire source -> clean -> lake + serving table.

    ``fanout=True`` runs one query writing both sinks from one read (same rows,
    same processed_at); ``fanout=False`` runs the two sinks as independent
    queries with their own checkpoints, as the reference did. ``echo`` adds the
    raw-payload console query (K5). Pair with ``run_until_any_stops`` (T8).
    """
    from ..sinks.feeds import console_echo

    queries = []
    if echo:
        queries.append(console_echo(wire_stream(spark, **source_opts)))
    if fanout:
        queries.append(start_fanout(clean_stream(spark, mode=mode, **source_opts), lake_path, target,
                                    f"{checkpoint_root}/fanout", trigger=trigger, on_error=on_error))
    else:
        queries.append(start_lake(clean_stream(spark, mode=mode, **source_opts), lake_path,
                                  f"{checkpoint_root}/lake", trigger=trigger))
        queries.append(start_warehouse(clean_stream(spark, mode=mode, **source_opts), target,
                                       f"{checkpoint_root}/warehouse", trigger=trigger, on_error=on_error))
    return queries
