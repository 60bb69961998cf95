"""Five-minute features per user and per item, for streams and for tables alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import first_category, is_type
from cartwheel.schemas import EVENT_IDENTITY, EVENT_TYPES, PANE, SESSION_GAP, STREAM_WINDOW, STREAM_WINDOW_MINUTES, WATERMARK_DELAY, WINDOW_DAYS


def watermark(events: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Events whose window closed more than `delay` before the newest event are dropped by the aggregates below."""
    return events.withWatermark("ts", delay)


def dedupe_stream(events: DataFrame) -> DataFrame:
    """The first arrival of every event; copies that come within the watermark's delay after it are dropped.

    Needs `watermark` before it. A key leaves the state once the watermark passes
    its event's time plus the delay, so the state holds the keys of one delay.
    """
    return events.dropDuplicatesWithinWatermark(EVENT_IDENTITY)


def windowed_counts(events: DataFrame, window: str = STREAM_WINDOW) -> DataFrame:
    """Events per window and type: what a watermark lets through, made visible."""
    return (
        events.groupBy(F.window("ts", window), "event_type")
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "events")
    )


def _rolling_counts(prefix: str) -> list[Column]:
    names = {"view": "view", "add_to_cart": "cart", "purchase": "purchase"}
    return [F.count_if(is_type(kind)).alias(f"{prefix}_rolling_{name}_count_5m") for kind, name in names.items()]


def _since(last_ms: str, as_of: Column | None) -> Column:
    now = F.current_timestamp() if as_of is None else as_of
    return F.unix_timestamp(now) - (F.col(last_ms) / 1000).cast("bigint")


def _windows(events: DataFrame, key: str, sums: list[Column], maxima: list[Column], rolling: bool) -> DataFrame:
    """Aggregates per `key` and window of the stream's length.

    Rolling windows begin every minute. An event is counted once, in its
    minute's pane; panes, kept as partial aggregates, are summed over the windows they lie in.
    """
    if not rolling:
        return events.groupBy(F.window("ts", STREAM_WINDOW), key).agg(*sums, *maxima)
    panes = events.groupBy(F.window("ts", PANE).alias("pane"), key).agg(*sums, *maxima)
    names = [c for c in panes.columns if c not in ("pane", key)]
    added, greatest = names[: len(sums)], names[len(sums) :]
    windows = F.window(F.window_time("pane"), STREAM_WINDOW, PANE).alias("window")
    return panes.groupBy(windows, key).agg(*[F.sum(c).alias(c) for c in added], *[F.max(c).alias(c) for c in greatest])


def rt_user_features(events: DataFrame, as_of: Column | None = None, rolling: bool = False) -> DataFrame:
    """Per user and window, tumbling or `rolling` by the minute. `as_of` (default: now) may refer to window_start and window_end.

    The last device, page, item and price belong to one event: the newest, ties
    by the greatest (item, device, page, price).
    """
    sums = [
        *_rolling_counts("rt_user"),
        F.count("*").alias("rt_user_current_session_length"),
        F.count_if(F.col("event_type").isin(EVENT_TYPES)).alias("rt_user_interaction_streak"),
    ]
    last = F.max(F.struct("ts", "item_id", "device", "page", "price")).alias("last")
    windows = _windows(events, "user_id", sums, [last], rolling)
    return (
        windows.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        .withColumn("rt_user_last_event_ts_ms", F.unix_timestamp("last.ts") * 1000)
        .select(
            "user_id",
            "window_start",
            "window_end",
            "rt_user_last_event_ts_ms",
            _since("rt_user_last_event_ts_ms", as_of).alias("rt_user_time_since_last_event_sec"),
            "rt_user_rolling_view_count_5m",
            "rt_user_rolling_cart_count_5m",
            "rt_user_rolling_purchase_count_5m",
            (F.col("rt_user_current_session_length") / float(STREAM_WINDOW_MINUTES)).alias(
                "rt_user_event_rate_per_min_5m"
            ),
            F.col("last.device").alias("rt_user_last_device"),
            F.col("last.page").alias("rt_user_last_page_type"),
            F.col("last.item_id").alias("rt_user_last_item_id"),
            F.col("last.price").alias("rt_user_last_price"),
            "rt_user_current_session_length",
            "rt_user_interaction_streak",
        )
    )


def user_feature_update(rt_users: DataFrame) -> DataFrame:
    """The user update record: events, clicks (views and carts) and the last event time of a window."""
    return rt_users.select(
        "user_id",
        F.col("rt_user_current_session_length").cast("int").alias("session_len"),
        (F.col("rt_user_rolling_view_count_5m") + F.col("rt_user_rolling_cart_count_5m"))
        .cast("int")
        .alias("clicks_in_session"),
        F.col("rt_user_last_event_ts_ms").alias("last_event_ts"),
    )


def session_updates(events: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """The user update record of whole sessions: events of one user less than `gap` apart.

    A late event may join two sessions that were apart so far; a session leaves the
    state, and is written, once the watermark has passed its end.
    """
    sessions = events.groupBy(F.session_window("ts", gap).alias("session"), "user_id").agg(
        F.count("*").cast("int").alias("session_len"),
        F.count_if(F.col("event_type").isin("view", "add_to_cart")).cast("int").alias("clicks_in_session"),
        F.max("ts").alias("last"),
    )
    return sessions.select(
        "user_id",
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "session_len",
        "clicks_in_session",
        (F.unix_timestamp("last") * 1000).alias("last_event_ts"),
    )


def _item_windows(events: DataFrame, rolling: bool = False) -> DataFrame:
    sums = [*_rolling_counts("rt_item"), F.count("*").alias("events"), F.count("price").alias("priced"), F.sum("price").alias("price_sum")]
    maxima = [F.max("ts").alias("last_ts"), F.max(F.struct("ts", first_category().alias("category"))).alias("last")]
    return _windows(events, "item_id", sums, maxima, rolling).withColumns(
        {
            "rt_item_recent_price_avg_5m": F.try_divide("price_sum", "priced"),
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
        }
    )


def rt_item_features(events: DataFrame, as_of: Column | None = None, rolling: bool = False) -> DataFrame:
    """Per item and window, as for users; the popularity delta is a constant until `with_popularity_delta` fills it."""
    return (
        _item_windows(events, rolling)
        .withColumn("rt_item_last_event_ts_ms", F.unix_timestamp("last_ts") * 1000)
        .select(
            "item_id",
            "window_start",
            "window_end",
            "rt_item_last_event_ts_ms",
            _since("rt_item_last_event_ts_ms", as_of).alias("rt_item_time_since_last_event_sec"),
            "rt_item_rolling_view_count_5m",
            "rt_item_rolling_cart_count_5m",
            "rt_item_rolling_purchase_count_5m",
            (F.col("events") / float(STREAM_WINDOW_MINUTES)).alias("rt_item_event_rate_per_min_5m"),
            "rt_item_recent_price_avg_5m",
            F.lit(0.0).alias("rt_item_popularity_delta_vs_30d"),
        )
    )


def with_popularity_delta(rt_items: DataFrame, gold_items: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Events per minute now, less the item's mean rate over the last `days` (a stream-static left join)."""
    usual = F.coalesce(F.col("total_events_30d"), F.lit(0)) / float(days * 24 * 60)
    return (
        rt_items.join(gold_items.select("item_id", "total_events_30d"), "item_id", "left")
        .withColumn("rt_item_popularity_delta_vs_30d", F.col("rt_item_event_rate_per_min_5m") - usual)
        .drop("total_events_30d")
    )


def item_feature_update(events: DataFrame) -> DataFrame:
    """The item update record; the hint is the first category of the window's last event."""
    return _item_windows(events).select(
        "item_id",
        F.col("rt_item_rolling_view_count_5m").cast("int").alias("views_5m"),
        F.col("rt_item_rolling_cart_count_5m").cast("int").alias("cart_5m"),
        F.col("rt_item_rolling_purchase_count_5m").cast("int").alias("purchases_5m"),
        F.col("rt_item_recent_price_avg_5m").alias("avg_price_5m"),
        F.unix_millis("window_end").alias("ts"),
        F.col("last.category").alias("category_hint"),
    )
