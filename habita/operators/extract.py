"""Listing extraction jobs: card + detail page (J1), fill-if-empty merges
(E21, E23) and the per-site card/detail field rules (E1-E26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import pick_per_key


def image_merge(card: Column, gallery: Column) -> Column:
    """Gallery images alone when the card has none; set union when both
    exist (deterministic order: card first, then new gallery images)."""
    has_card = F.coalesce(F.size(card) > 0, F.lit(False))
    has_gallery = F.coalesce(F.size(gallery) > 0, F.lit(False))
    return (F.when(has_gallery & has_card, F.array_union(card, gallery))
             .when(has_gallery, gallery)
             .otherwise(card))


def fill_if_empty(card: Column, detail: Column) -> Column:
    """The card's value unless it is NULL or '' (then the detail's)."""
    return F.coalesce(F.nullif(card, F.lit("")), detail)


def join_card_detail(cards: DataFrame, details: DataFrame, key: str = "listing_url",
                     how: str = "inner") -> DataFrame:
    """A card is emitted only when its detail page arrived (inner join).

    Both sides are first reduced to one row per URL (A5 for cards: first page
    and position; one response per URL for details), so a URL repeated many
    times never multiplies into all pairs.
    """
    c = pick_per_key(cards, key, ["page_id", "pos"], largest=False).drop("pos")
    d = pick_per_key(details, key, ["page_id"], largest=False).drop("page_id")
    j = c.join(d, key, how)
    out = j
    if "square_footage" in c.columns and "detail_surface" in d.columns:
        out = out.withColumn("square_footage", fill_if_empty(F.col("square_footage"),
                                                             F.col("detail_surface")))
    return out
