"""Schema drift of the wire (S3): fields that messages carry and the wire schema does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import RAW_FIELDS


def unknown_fields(raw: DataFrame, known=RAW_FIELDS, value_col: str = "value") -> DataFrame:
    """``source, field, n_rows, merged_type`` of every field outside ``known``, per source.

    Messages are parsed as variants, so no schema is assumed; ``merged_type`` is
    the one type that holds all values seen under the field. Messages that are
    no JSON object have no fields. Two aggregations with partial sums: a source
    that sends a third of all messages is one row per task.
    """
    message = F.try_parse_json(F.col(value_col).cast("string"))
    parsed = raw.select(message.alias("message")).where("message is not null")
    fields = (parsed.select("message", F.try_variant_get("message", "$.source", "string").alias("source"))
              .lateralJoin(raw.sparkSession.tvf.variant_explode(F.col("message").outer())))
    extra = fields.where(F.col("key").isNotNull() & ~F.col("key").isin(*known))
    return (extra.groupBy("source", F.col("key").alias("field"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.schema_of_variant_agg("value").alias("merged_type")))
