"""Item features, by item_id.

Distinct viewers and buyers come from an (item, user) roll-up: a popular item's
users are counted by many tasks, and no row is expanded once per distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import (
    first_category,
    hour_in,
    is_type,
    last_time,
    price_stats,
    ratio_or_zero,
    seconds_between,
    share_of,
)
from cartwheel.functions.windows import EventClock
from cartwheel.schemas import EVENING, ITEM_NUM_ATTRIBUTES, ITEM_NUM_IMAGES, MORNING, WINDOW_DAYS
from cartwheel.scratch import write_table

ITEM = "item_id"
ROUNDING = 1e-9


def _known(events: DataFrame) -> DataFrame:
    return events.filter(F.col(ITEM).isNotNull())


def _volume() -> list[Column]:
    return [
        F.count_if(is_type("view")).alias("item_views_30d"),
        F.count_if(is_type("add_to_cart")).alias("item_carts_30d"),
        F.count_if(is_type("purchase")).alias("item_purchases_30d"),
        F.count("*").alias("total_events_30d"),
    ]


def _day_parts(views_only: bool) -> list[Column]:
    bands = {"morning": MORNING, "evening": EVENING}
    if not views_only:
        return [share_of(hour_in(band)).alias(f"item_{name}_view_share_30d") for name, band in bands.items()]
    views = F.count_if(is_type("view"))
    return [
        ratio_or_zero(F.count_if(is_type("view") & hour_in(band)), views).alias(f"item_{name}_view_share_30d")
        for name, band in bands.items()
    ]


def item_volume(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(ITEM).agg(*_volume())


def item_rates(volume: DataFrame) -> DataFrame:
    return volume.withColumns(
        {
            "item_ctr_30d": ratio_or_zero(F.col("item_purchases_30d"), F.col("item_views_30d")),
            "item_cart_to_purchase_rate_30d": ratio_or_zero(F.col("item_purchases_30d"), F.col("item_carts_30d")),
        }
    )


def item_log_popularity(volume: DataFrame) -> DataFrame:
    interactions = F.col("item_views_30d") + F.col("item_carts_30d") + F.col("item_purchases_30d")
    return volume.withColumn("item_log_popularity_score_30d", F.log1p(interactions))


def item_monetary(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(ITEM).agg(*price_stats("item"))


def item_distinct_users(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    per_user = (
        _known(clock.recent(events, days))
        .groupBy(ITEM, "user_id")
        .agg(F.count_if(is_type("view")).alias("views"), F.count_if(is_type("purchase")).alias("purchases"))
    )
    return distinct_users(per_user)


def distinct_users(per_user: DataFrame) -> DataFrame:
    """Viewers and buyers from views and purchases per (item, user)."""
    named = F.col("user_id").isNotNull()
    return per_user.filter(F.col(ITEM).isNotNull()).groupBy(ITEM).agg(
        F.count_if(named & (F.col("views") > 0)).alias("item_distinct_users_viewed_30d"),
        F.count_if(named & (F.col("purchases") > 0)).alias("item_distinct_users_purchased_30d"),
    )


def item_recency(events: DataFrame, clock: EventClock) -> DataFrame:
    seen = (
        _known(clock.history(events))
        .groupBy(ITEM)
        .agg(
            F.max("ts").alias("last_ts"),
            last_time("view").alias("last_view_ts"),
            last_time("purchase").alias("last_purchase_ts"),
        )
    )
    return with_recency(seen, clock)


def with_recency(seen: DataFrame, clock: EventClock) -> DataFrame:
    return seen.withColumns(
        {
            "item_time_since_last_event_sec": seconds_between("last_ts", clock.as_of),
            "item_time_since_last_view_sec": seconds_between("last_view_ts", clock.as_of),
            "item_time_since_last_purchase_sec": seconds_between("last_purchase_ts", clock.as_of),
        }
    )


def item_content(items: DataFrame) -> DataFrame:
    """Category depth, text lengths and placeholder content counts from the item table."""
    return (
        items.select(ITEM, "category_path", "brand", "base_price", "title", "description")
        .filter(F.col(ITEM).isNotNull())
        .withColumns(
            {
                "item_category_depth": F.size("category_path"),
                "item_is_discounted_flag": F.when(F.col("base_price") > 0, 1).otherwise(0),
                "item_title_length_chars": F.length("title"),
                "item_description_length_chars": F.length("description"),
                "item_num_images": F.lit(ITEM_NUM_IMAGES),
                "item_num_attributes": F.lit(ITEM_NUM_ATTRIBUTES),
            }
        )
    )


def item_discount_flag_spec(
    events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS
) -> DataFrame:
    """1 where the base price lies above the average price seen in the window.

    Both sides may be averages of the same prices summed in another order, so
    differences of rounding size do not count.
    """
    seen = item_monetary(events, clock, days).select(ITEM, "item_avg_price_30d")
    above = F.col("base_price") - F.col("item_avg_price_30d") > F.col("base_price") * ROUNDING
    return items.join(seen, ITEM, "left").select(
        ITEM, F.when(above, 1).otherwise(0).alias("item_is_discounted_flag")
    )


def item_temporal(
    events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS, views_only: bool = False
) -> DataFrame:
    """Morning and evening share of an item's events, or of its views alone."""
    return _known(clock.recent(events, days)).groupBy(ITEM).agg(*_day_parts(views_only))


def item_category_popularity(
    events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS
) -> DataFrame:
    return _category_popularity(_event_counts(events, clock, days), items)


def item_brand_popularity(
    events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS
) -> DataFrame:
    return _brand_popularity(_event_counts(events, clock, days), items)


def _event_counts(events: DataFrame, clock: EventClock, days: int) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(ITEM).agg(F.count("*").alias("n"))


def _category_popularity(per_item: DataFrame, items: DataFrame) -> DataFrame:
    return _popularity(per_item, items.select(ITEM, first_category().alias("label")), "item_category_popularity_30d")


def _brand_popularity(per_item: DataFrame, items: DataFrame) -> DataFrame:
    return _popularity(per_item, items.select(ITEM, F.col("brand").alias("label")), "item_brand_popularity_30d")


def _popularity(per_item: DataFrame, labelled: DataFrame, out: str) -> DataFrame:
    """Window events (`n` per item) of the item's label over those of the busiest label.

    Events are counted per item before they meet the labels, and per label before
    labels meet items again.
    """
    per_label = (
        per_item.join(labelled, ITEM)
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.sum("n").alias("n"))
    )
    busiest = per_label.agg(F.max("n")).scalar()
    scaled = per_label.select("label", (F.col("n") / busiest).alias(out))
    return labelled.join(scaled, "label", "left").select(ITEM, F.coalesce(out, F.lit(0.0)).alias(out))


def item_discount_rate(events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    """Mean of (base_price - price) / base_price over the window.

    The base price is one number per item, so the mean needs only the item's
    average price, and events are aggregated before the join.
    """
    return _discount_rate(item_monetary(events, clock, days).select(ITEM, "item_avg_price_30d"), items)


def _discount_rate(seen: DataFrame, items: DataFrame) -> DataFrame:
    base = F.col("base_price")
    rate = F.when(base > 0, (base - F.col("item_avg_price_30d")) / base)
    return items.join(seen, ITEM).select(ITEM, rate.alias("item_discount_rate_avg_30d"))


def item_features(
    events: DataFrame,
    items: DataFrame,
    clock: EventClock,
    embeddings: DataFrame | None = None,
    days: int = WINDOW_DAYS,
    declared_only: bool = False,
) -> DataFrame:
    """All item features, for items with an event in the window.

    `declared_only=True` adds the popularity and discount features that the
    catalogue declares beyond the computed set.
    """
    window = (
        _known(clock.recent(events, days))
        .groupBy(ITEM)
        .agg(*_volume(), *price_stats("item"), *_day_parts(views_only=False))
        .transform(item_rates)
        .transform(item_log_popularity)
    )
    return assemble(window, item_distinct_users(events, clock, days), item_recency(events, clock), items, embeddings, declared_only)


def assemble(
    window: DataFrame, distinct: DataFrame, recency: DataFrame, items: DataFrame, embeddings: DataFrame | None = None, declared_only: bool = False
) -> DataFrame:
    """The pieces of the item features by item; the declared extras come from the window's totals."""
    if declared_only:  # read once for the features and once per extra: written, so that events are not read as often
        window = write_table(window, "item-window")
    features = window.join(distinct, ITEM, "left").join(recency, ITEM, "left").join(item_content(items), ITEM, "left")
    if declared_only:
        counted = window.select(ITEM, F.col("total_events_30d").alias("n"))
        priced = window.select(ITEM, "item_avg_price_30d")
        for extra in (_category_popularity(counted, items), _brand_popularity(counted, items), _discount_rate(priced, items)):
            features = features.join(extra, ITEM, "left")
    return features if embeddings is None else features.join(embeddings, ITEM, "left")
