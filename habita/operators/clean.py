"""Cleaning of parsed wire rows (P1-P7, F1-F4, X1-X2) and reject accounting.

``mode="compat"`` reproduces the stream job exactly; ``mode="lenient"`` adds the
three documented repairs: quoted integer prices are accepted, the word
"Location" is read as an offer, titles lose all Unicode whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import (digits_only_float, digits_only_int, legacy_float,
                               legacy_int, legacy_long, lenient_price)
from ..functions.normalise import stream_offer_type, stream_property_type
from ..functions.text import py_strip
from ..schemas import CLEAN_FIELDS

MODES = ("compat", "lenient")


def typed_columns(df: DataFrame, mode: str = "compat", processed_at: Column | None = None,
                  keep=()) -> list[Column]:
    """The projection of P2-P6 (one select, no intermediate withColumn chain)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    lenient = mode == "lenient"
    price = lenient_price("price") if lenient else legacy_long("price")
    rules = {
        "listing_id": F.col("listing_id"),
        "title": py_strip("title") if lenient else F.trim("title"),
        "property_type": stream_property_type("property_type"),
        "offer_type": stream_offer_type("offer_type", lenient=lenient),
        "bedrooms": legacy_int("bedrooms"),
        "square_footage": legacy_float("square_footage"),
        "wc_interne": legacy_int("wc_interne"),
        "price": price,
    }
    present = set(df.columns)
    out = [F.col(k) for k in keep]
    # fields the caller did not parse are skipped (see parse_wire(fields=...))
    for name in CLEAN_FIELDS[:-1]:
        if name in present:
            out.append(rules.get(name, F.col(name)).alias(name))
    out.append((processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"))
    return out


def keep_condition() -> Column:
    """F1-F4 as one predicate (Catalyst would merge them anyway)."""
    return (F.col("listing_id").isNotNull() & F.col("price").isNotNull()
            & (F.col("price") > 0) & F.col("city").isNotNull())


def clean_listings(parsed: DataFrame, mode: str = "compat", processed_at: Column | None = None,
                   keep=()) -> DataFrame:
    """Parsed wire rows -> cleaned listings (LISTING_CLEAN column order).

    In lenient mode the input must have been parsed with the text-price schema
    (``habita.sources.wire.lenient_schema``).
    """
    return (parsed.select(*typed_columns(parsed, mode, processed_at, keep))
            .where(keep_condition()))


def image_urls_text(col: str = "image_urls") -> Column:
    """Array -> display text, NULL elements printed as 'null'."""
    return F.col(col).cast("string")


def to_serving_rows(clean: DataFrame) -> DataFrame:
    """Serving-table shape: the image list becomes text."""
    return clean.select(*[image_urls_text().alias("image_urls") if c == "image_urls" else F.col(c)
                          for c in CLEAN_FIELDS])


# ---- disabled stream rules kept as options (X1, X2) ------------------------

def digits_only_cleanup(parsed: DataFrame) -> DataFrame:
    """Digits-only numerics ('45.5' -> 455)."""
    return parsed.select(
        "listing_url", "bedrooms", "square_footage", "wc_interne",
        digits_only_int("bedrooms").alias("bedrooms_digits"),
        digits_only_float("square_footage").alias("surface_digits"),
        digits_only_int("wc_interne").alias("wc_digits"))


def bedroom_outliers(bedrooms: Column, limit: int = 15) -> Column:
    """NULL or more than ``limit`` bedrooms -> NULL."""
    return F.when(bedrooms.isNull() | (bedrooms > limit), F.lit(None).cast("int")).otherwise(bedrooms)


# ---- reject accounting (D4) -------------------------------------------------
# Reason labels, in the order the rules are applied.
REASONS = ("unparseable", "missing_listing_id", "missing_price", "price_not_positive",
           "missing_city", "kept")


def reject_reason(valid_json: Column) -> Column:
    """First failing rule of parse + F1-F4 (a single pass, no extra job)."""
    return (F.when(~valid_json, F.lit("unparseable"))
             .when(F.col("listing_id").isNull(), F.lit("missing_listing_id"))
             .when(F.col("price").isNull(), F.lit("missing_price"))
             .when(F.col("price") <= 0, F.lit("price_not_positive"))
             .when(F.col("city").isNull(), F.lit("missing_city"))
             .otherwise(F.lit("kept")))


def reject_counts(parsed_with_flag: DataFrame, flag_col: str = "valid_json") -> DataFrame:
    """groupBy(reason, source).count() -- partial aggregation map-side."""
    return (parsed_with_flag
            .select(reject_reason(F.col(flag_col)).alias("reason"), "source")
            .groupBy("reason", "source").agg(F.count(F.lit(1)).alias("n_rows")))
