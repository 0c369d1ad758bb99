"""Loads that count themselves (D4, A2): the figures come out of the write job, without a job of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.clean import REASONS, clean_listings, reject_reason
from ..sources.wire import is_json_object


def reason_counts(valid_json: Column) -> list[Column]:
    """One count per reason of ``reject_reason`` ('kept' among them)."""
    reason = reject_reason(valid_json)
    return [F.count_if(reason == r).alias(r) for r in REASONS]


def flagged(parsed: DataFrame) -> Column:
    """Whether the message was an object: a parsed ``listing_id`` proves it, other messages are looked at again."""
    return F.when(F.col("listing_id").isNotNull(), F.lit(True)).otherwise(is_json_object(F.col("value")))


def load_observed(parsed: DataFrame, write: Callable[[DataFrame], None], mode: str = "compat") -> dict[str, int]:
    """Clean ``parsed`` (with the raw ``value``), hand the kept rows to ``write``, and return the number of messages per reason.

    The messages are observed on their way, so reading, cleaning, counting and
    writing are one pass. ``write`` has to run exactly one action over all rows.
    """
    seen = Observation()
    watched = parsed.observe(seen, *reason_counts(flagged(parsed)))
    write(clean_listings(watched, mode))
    return {r: int(n or 0) for r, n in seen.get.items()}


class BatchMetrics(StreamingQueryListener):
    """Hands the observed figures of every micro-batch to ``sink(name, batch_id, figures)``."""

    def __init__(self, name: str, sink: Callable[[str, int, dict], None]):
        self.name, self.sink = name, sink

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.sink(self.name, event.progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observe_stream(parsed: DataFrame, name: str) -> DataFrame:
    """The streaming form: per-batch counts under ``name`` reach listeners (``BatchMetrics``) with the query's progress."""
    return parsed.observe(name, *reason_counts(flagged(parsed)))


def watch(spark: SparkSession, name: str, sink: Callable[[str, int, dict], None]) -> BatchMetrics:
    """Register a listener for ``name``; remove it with ``spark.streams.removeListener``."""
    listener = BatchMetrics(name, sink)
    spark.streams.addListener(listener)
    return listener
