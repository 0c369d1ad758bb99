"""Wire messages: one UTF-8 JSON object per listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import LISTING_RAW, RAW_FIELDS


def lenient_schema() -> T.StructType:
    """Wire schema with ``price`` read as text, for the opt-in price repair."""
    return T.StructType([f if f.name != "price" else T.StructField("price", T.StringType())
                         for f in LISTING_RAW.fields])


def parse_wire(df: DataFrame, value_col: str = "value", *, keep=(),
               schema: T.StructType = LISTING_RAW, fields=None) -> DataFrame:
    """S2+S3+P1: decode and parse permissively; flatten to the wire fields.

    Malformed text, a top-level array or an empty string gives an all-NULL row;
    a field of the wrong type is NULL on its own (a quoted or decimal price).

    ``inline(array(from_json(...)))`` makes the parse a Generate node: filters
    written later are not pushed below it, so each message is parsed exactly
    once (a plain ``select("data.*")`` lets Catalyst copy ``from_json`` into
    every pushed-down predicate). Because the Generate also hides the parse
    from Catalyst's JSON schema pruning, callers that need only some fields
    pass ``fields``: the parser then materialises just those.
    """
    if fields is not None:
        wanted = set(fields)
        schema = T.StructType([f for f in schema.fields if f.name in wanted])
    value = F.col(value_col).cast("string")
    parsed = F.inline(F.array(F.from_json(value, schema)))
    return df.select(*keep, parsed)


# Fixed value: messages per micro-batch of the original job.
COMPAT_INTAKE = 500
# Messages per micro-batch of a topic unless the caller says otherwise: a first run does not take the whole backlog at once.
KAFKA_INTAKE = 1_000_000


def kafka_options(bootstrap: str, topic: str, max_per_trigger: int | None = None, starting: str = "earliest", fail_on_data_loss: bool = False) -> dict[str, str]:
    """Reader options of one topic (T3-T5): the bound on a micro-batch, where to start, and going on when offsets are gone.

    ``max_per_trigger``: messages per micro-batch; none: ``KAFKA_INTAKE``; 0: no bound.
    """
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    bound = KAFKA_INTAKE if max_per_trigger is None else max_per_trigger
    if bound:
        options["maxOffsetsPerTrigger"] = str(bound)
    return options


def wire_stream(spark: SparkSession, *, source: str = "files", path: str | None = None,
                bootstrap: str | None = None, topic: str | None = None,
                max_per_trigger: int | None = None, max_bytes: int | None = None, starting: str = "earliest",
                fail_on_data_loss: bool = False, extra_options: dict | None = None) -> DataFrame:
    """S1 + T3-T5: a streaming DataFrame with one string column ``value``.

    source='kafka' subscribes one topic (needs the Kafka connector on the
    classpath); source='files' reads newline-delimited messages from ``path``.
    From files a micro-batch takes all there is unless ``max_per_trigger``
    (files) or ``max_bytes`` (so batches do not shrink with the files) bounds
    it; from a topic it takes ``max_per_trigger`` messages, ``KAFKA_INTAKE`` by
    default (``COMPAT_INTAKE`` is the original job's).
    """
    if source == "kafka":
        if max_bytes:
            raise ValueError("a topic's micro-batch is bounded by messages (max_per_trigger), not by bytes")
        options = kafka_options(bootstrap, topic, max_per_trigger, starting, fail_on_data_loss) | (extra_options or {})
        return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))
    if source == "files":
        reader = spark.readStream.format("text")
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        elif max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        for k, v in (extra_options or {}).items():
            reader = reader.option(k, v)
        return reader.load(path)
    raise ValueError(f"unknown wire source {source!r}")


def to_wire(df: DataFrame, *, drop_nulls: bool = False, fields=RAW_FIELDS) -> DataFrame:
    """K1: serialise each listing as one JSON text (non-ASCII kept as is).

    ``drop_nulls=True`` omits NULL fields (an absent key); otherwise NULL is
    written as ``null``.
    """
    present = [f for f in fields if f in df.columns]
    opts = {"ignoreNullFields": "true" if drop_nulls else "false"}
    return df.select(F.to_json(F.struct(*present), opts).alias("value"))


def write_wire_files(df: DataFrame, path: str, mode: str = "append") -> None:
    """K1 offline: messages as text files (one message per line)."""
    to_wire(df).write.mode(mode).text(path)


def write_wire_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    """K1 when the Kafka connector is deployed: no key, value = JSON text."""
    (to_wire(df).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def is_json_object(value: Column) -> Column:
    """True when the text is a valid JSON object (not an array, not garbage)."""
    return F.json_object_keys(value).isNotNull()
