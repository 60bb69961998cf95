"""User and item tables derived from clean events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.schemas import ITEM_BRAND, ITEM_DESCRIPTION_PREFIX, ITEM_TITLE_PREFIX


def silver_users(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("ts").alias("first_seen_ts"),
            F.max("ts").alias("last_seen_ts"),
            F.count("*").alias("total_events"),
        )
    )


def silver_items(events: DataFrame) -> DataFrame:
    """Item attributes; the category path is the earliest non-null one.

    Events are first added up by item and path, in a hash aggregate of plain
    numbers; only those few rows meet in the choice of the earliest path.
    """
    by_path = (
        events.filter(F.col("item_id").isNotNull())
        .groupBy("item_id", "category_path")
        .agg(F.min("ts").alias("_first"), F.sum("price").alias("_sum"), F.count("price").alias("_priced"))
    )
    earliest = F.min(F.when(F.col("category_path").isNotNull(), F.struct(F.col("_first").alias("ts"), "category_path")))
    return (
        by_path.groupBy("item_id")
        .agg(
            earliest.alias("_earliest"),
            F.try_divide(F.sum("_sum"), F.sum("_priced")).alias("base_price"),
            F.min("_first").alias("created_ts"),
        )
        .select(
            "item_id",
            F.concat(F.lit(ITEM_TITLE_PREFIX), "item_id").alias("title"),
            F.concat(F.lit(ITEM_DESCRIPTION_PREFIX), "item_id").alias("description"),
            F.col("_earliest.category_path").alias("category_path"),
            F.lit(ITEM_BRAND).alias("brand"),
            "base_price",
            "created_ts",
        )
    )


def silver_items_with_catalog(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Items whose title and brand come from a catalogue (item_id, title, brand) where it has them."""
    listed = catalog.select("item_id", F.col("title").alias("_title"), F.col("brand").alias("_brand"))
    return (
        items.join(listed, "item_id", "left")
        .withColumns({"title": F.coalesce("_title", "title"), "brand": F.coalesce("_brand", "brand")})
        .drop("_title", "_brand")
    )
