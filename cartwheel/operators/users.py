"""User features. Each operator stands alone; `user_features` fuses them by grain.

The fused plan reads events three times, each time with few columns:
the window by user, all history by (user, session), the window by (user, category).
Every shuffle carries partial aggregates, so one very active user is not one very
large task, and the three results are all hashed by user_id when they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import (
    hour_in,
    is_type,
    last_time,
    price_stats,
    ratio_or_zero,
    seconds_between,
    share_of,
)
from cartwheel.functions.windows import EventClock
from cartwheel.schemas import DEVICES, EVENING, MORNING, NIGHT, SHORT_WINDOW_DAYS, WINDOW_DAYS

USER = "user_id"


def _known(events: DataFrame) -> DataFrame:
    return events.filter(F.col(USER).isNotNull())


def _volume() -> list[Column]:
    return [
        F.count("*").alias("user_total_events_30d"),
        F.count_if(is_type("view")).alias("user_views_30d"),
        F.count_if(is_type("add_to_cart")).alias("user_add_to_cart_30d"),
        F.count_if(is_type("purchase")).alias("user_purchases_30d"),
    ]


def _devices() -> list[Column]:
    return [share_of(F.col("device") == d).alias(f"user_{d}_events_share_30d") for d in DEVICES]


def _day_parts() -> list[Column]:
    bands = {"morning": MORNING, "evening": EVENING, "night": NIGHT}
    return [share_of(hour_in(band)).alias(f"user_{name}_event_share_30d") for name, band in bands.items()]


def user_volume(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(USER).agg(*_volume())


def user_conversion(volume: DataFrame) -> DataFrame:
    """Adds the two conversion rates to a volume table."""
    return volume.withColumns(
        {
            "user_view_to_cart_rate_30d": ratio_or_zero(F.col("user_add_to_cart_30d"), F.col("user_views_30d")),
            "user_cart_to_purchase_rate_30d": ratio_or_zero(
                F.col("user_purchases_30d"), F.col("user_add_to_cart_30d")
            ),
        }
    )


def user_category_counts(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    """(user, category, n): the one shuffle behind diversity, top categories and documents."""
    return (
        _known(clock.recent(events, days))
        .select(USER, F.explode("category_path").alias("category"))
        .groupBy(USER, "category")
        .agg(F.count("*").alias("n"))
    )


def user_diversity(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    """Distinct items over all event types, and distinct categories."""
    items = (
        _known(clock.recent(events, days))
        .groupBy(USER)
        .agg(F.count_distinct("item_id").alias("user_distinct_items_viewed_30d"))
    )
    return items.join(distinct_categories(user_category_counts(events, clock, days)), USER, "left").fillna(
        0, ["user_distinct_categories_viewed_30d"]
    )


def distinct_categories(counts: DataFrame) -> DataFrame:
    """Rows of `counts` are distinct categories. Reading `n` keeps this input identical to the one that ranks
    categories, so both share one shuffle."""
    seen = F.col("category").isNotNull() & (F.col("n") > 0)
    return counts.groupBy(USER).agg(F.count_if(seen).alias("user_distinct_categories_viewed_30d"))


def user_monetary(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(USER).agg(*price_stats("user"))


def user_recency(events: DataFrame, clock: EventClock) -> DataFrame:
    seen = (
        _known(clock.history(events))
        .groupBy(USER)
        .agg(
            F.max("ts").alias("last_ts"),
            F.min("ts").alias("first_ts"),
            last_time("view").alias("last_view_ts"),
            last_time("add_to_cart").alias("last_cart_ts"),
            last_time("purchase").alias("last_purchase_ts"),
        )
    )
    return with_recency(seen, clock)


def with_recency(seen: DataFrame, clock: EventClock) -> DataFrame:
    return seen.withColumns(
        {
            "user_time_since_last_event_sec": seconds_between("last_ts", clock.as_of),
            "user_time_since_last_view_sec": seconds_between("last_view_ts", clock.as_of),
            "user_time_since_last_cart_sec": seconds_between("last_cart_ts", clock.as_of),
            "user_time_since_last_purchase_sec": seconds_between("last_purchase_ts", clock.as_of),
            "user_days_since_first_event": seconds_between("first_ts", clock.as_of) / F.lit(86400.0),
        }
    )


def _session_lengths(events: DataFrame) -> DataFrame:
    return _known(events).groupBy(USER, "session_id").agg(F.count("*").alias("length"), F.max("ts").alias("ended"))


def length_stats(length: Column) -> list[Column]:
    return [
        F.avg(length).alias("user_avg_session_length_events_30d"),
        F.percentile(length, F.lit(0.5)).alias("user_median_session_length_events_30d"),
    ]


def _length_of_last() -> Column:
    # sessions that end together: the greatest session_id counts as the last
    return F.max_by("length", F.struct("ended", "session_id")).alias("user_events_last_session")


def user_sessions(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _session_lengths(clock.recent(events, days)).groupBy(USER).agg(*length_stats(F.col("length")))


def user_last_session(events: DataFrame, clock: EventClock) -> DataFrame:
    return _session_lengths(clock.history(events)).groupBy(USER).agg(_length_of_last())


def user_sessions_7d(events: DataFrame, clock: EventClock, days: int = SHORT_WINDOW_DAYS) -> DataFrame:
    return (
        _known(clock.recent(events, days)).groupBy(USER).agg(F.count_distinct("session_id").alias("user_sessions_7d"))
    )


def user_device_mix(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(USER).agg(*_devices())


def user_temporal_mix(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return _known(clock.recent(events, days)).groupBy(USER).agg(*_day_parts())


def user_top_categories(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return top_three(user_category_counts(events, clock, days))


def top_three(counts: DataFrame) -> DataFrame:
    """The three most frequent categories, ties by name; `rank <= 3` is cut on the map side as well."""
    by_frequency = Window.partitionBy(USER).orderBy(F.desc("n"), "category")
    top = counts.withColumn("rank", F.row_number().over(by_frequency)).filter(F.col("rank") <= 3)
    return top.groupBy(USER).agg(
        *[F.max(F.when(F.col("rank") == i, F.col("category"))).alias(f"user_top_category_{i}") for i in (1, 2, 3)]
    )


def user_category_docs(events: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    """Each user's category document in long form: one row per (user_id, text) with its number of repeats.

    The document itself would hold one word per event in a single cell; the
    long form says the same and stays distributed however active the user.
    """
    return user_category_counts(events, clock, days).filter(F.col("category").isNotNull()).withColumnRenamed("category", "text")


def user_features(
    events: DataFrame,
    clock: EventClock,
    embeddings: DataFrame | None = None,
    days: int = WINDOW_DAYS,
    short_days: int = SHORT_WINDOW_DAYS,
) -> DataFrame:
    """All user features, for users with an event in the window."""
    window = (
        _known(clock.recent(events, days))
        .groupBy(USER)
        .agg(
            *_volume(),
            F.count_distinct("item_id").alias("user_distinct_items_viewed_30d"),
            *price_stats("user"),
            *_devices(),
            *_day_parts(),
        )
    )
    counts = user_category_counts(events, clock, days)
    features = (
        user_conversion(window)
        .join(_history(events, clock, days, short_days), USER, "left")
        .join(distinct_categories(counts), USER, "left")
        .join(top_three(counts), USER, "left")
        .fillna(0, ["user_distinct_categories_viewed_30d"])
    )
    return features if embeddings is None else features.join(embeddings, USER, "left")


def _history(events: DataFrame, clock: EventClock, days: int, short_days: int) -> DataFrame:
    """Recency and session features from one pass over all history: sessions first, then users."""
    in_window, in_short = clock.within(days), clock.within(short_days)
    sessions = (
        _known(clock.history(events))
        .groupBy(USER, "session_id")
        .agg(
            F.count("*").alias("length"),
            F.max("ts").alias("ended"),
            F.min("ts").alias("began"),
            F.count_if(in_window).alias("in_window"),
            F.count_if(in_short).alias("in_short"),
            last_time("view").alias("viewed"),
            last_time("add_to_cart").alias("carted"),
            last_time("purchase").alias("purchased"),
        )
    )
    seen = sessions.groupBy(USER).agg(
        F.max("ended").alias("last_ts"),
        F.min("began").alias("first_ts"),
        F.max("viewed").alias("last_view_ts"),
        F.max("carted").alias("last_cart_ts"),
        F.max("purchased").alias("last_purchase_ts"),
        *length_stats(F.when(F.col("in_window") > 0, F.col("in_window"))),
        F.nullif(F.count_if(F.col("in_short") > 0), F.lit(0)).alias("user_sessions_7d"),
        _length_of_last(),
    )
    return with_recency(seen, clock)
