"""CSV backup feed (K2) and console echo (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import RAW_FIELDS


FILE_BYTES = 128 << 20


def write_csv_feed(items: DataFrame, path: str, mode: str = "append", file_bytes: int = FILE_BYTES) -> bool:
    """K2: UTF-8 CSV with a header in item column order; lists joined with ','.
    Quotes inside a value are doubled. The number of files follows the measured size, so
    none holds a header only; nothing is written for an empty input (returns False)."""
    cols = [F.array_join(F.col(c), ",").alias(c) if c == "image_urls" else F.col(c)
            for c in RAW_FIELDS if c in items.columns]
    out = items.select(*cols)
    size = out.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_csv(F.struct(*out.columns)))).alias("bytes")).first()
    if not size["n"]:
        return False
    # round robin deals every file some rows where there are a few times as many rows as files
    files = max(1, min(size["bytes"] // file_bytes, size["n"] // 1000))
    (out.repartition(files).write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return True


def console_echo(raw_stream: DataFrame, truncate: bool = False):
    """K5: echo raw payloads of a stream (debugging only; off by default)."""
    return (raw_stream.select(F.col("value").cast("string").alias("value"))
            .writeStream.format("console").option("truncate", str(truncate).lower())
            .outputMode("append").start())
