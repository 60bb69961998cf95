"""Contracts: event fields, permitted values, stream records and the feature catalogue."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# ---- fixed values: permitted categories of an event ----
EVENT_TYPES = ["view", "add_to_cart", "purchase"]
DEVICES = ["web", "ios", "android"]
PAGES = ["home", "plp", "pdp", "cart"]

# ---- fixed values: the ten event columns, typed as in the clean table ----
EVENT_FIELDS = {
    "user_id": "string",
    "session_id": "string",
    "item_id": "string",
    "event_type": "string",
    "price": "double",
    "category_path": "array<string>",
    "device": "string",
    "page": "string",
    "referrer": "string",
    "ts": "timestamp",
}
REQUIRED_FIELDS = ["user_id", "session_id", "item_id", "event_type", "ts"]
EVENT_IDENTITY = ["user_id", "session_id", "item_id", "event_type", "ts", "price", "device", "page"]

# the same event on the wire: float price, epoch milliseconds
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("category_path", T.ArrayType(T.StringType())),
        T.StructField("device", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

# ---- fixed values: hours of day, both ends included ----
MORNING = (6, 11)
EVENING = (18, 23)
NIGHT = (0, 5)

# ---- fixed values: window lengths in days ----
WINDOW_DAYS = 30
SHORT_WINDOW_DAYS = 7

# ---- fixed values: item text and content stand-ins ----
ITEM_TITLE_PREFIX = "Item "
ITEM_DESCRIPTION_PREFIX = "Synthetic description for item "
ITEM_BRAND = "generic_brand"
ITEM_NUM_IMAGES = 3
ITEM_NUM_ATTRIBUTES = 8

# ---- fixed values: text embedding ----
HASH_BUCKETS = 512
EMBEDDING_DIMS = 10

# ---- fixed values: recency buckets, upper bounds in seconds (then the last bucket) ----
RECENCY_BUCKETS = [(3600, 0), (21600, 1), (86400, 2)]
OLDEST_RECENCY_BUCKET = 3

# ---- fixed values: stream windows and online records ----
STREAM_WINDOW = "5 minutes"
STREAM_WINDOW_MINUTES = 5
PANE = "1 minute"
SESSION_GAP = "30 minutes"
WATERMARK_DELAY = "10 seconds"
ONLINE_TTL_SEC = 3600
USER_KEY_PREFIX = "user_features_rt:"
ITEM_KEY_PREFIX = "item_features_rt:"
UPDATED_AT = "rt_updated_at_ms"


class Feature(NamedTuple):
    name: str
    dtype: str
    family: str
    window: str


def _embedding(prefix: str) -> list[Feature]:
    return [Feature(f"{prefix}_{i}", "float", "embedding", "") for i in range(1, EMBEDDING_DIMS + 1)]


# ---- fixed values: declared features, with Spark type names ----
USER_CATALOG = [
    Feature("user_total_events_30d", "bigint", "volume", "30d"),
    Feature("user_views_30d", "bigint", "volume", "30d"),
    Feature("user_add_to_cart_30d", "bigint", "volume", "30d"),
    Feature("user_purchases_30d", "bigint", "volume", "30d"),
    Feature("user_view_to_cart_rate_30d", "float", "conversion", "30d"),
    Feature("user_cart_to_purchase_rate_30d", "float", "conversion", "30d"),
    Feature("user_distinct_items_viewed_30d", "int", "diversity", "30d"),
    Feature("user_distinct_categories_viewed_30d", "int", "diversity", "30d"),
    Feature("user_avg_price_30d", "float", "monetary", "30d"),
    Feature("user_price_std_30d", "float", "monetary", "30d"),
    Feature("user_max_price_30d", "float", "monetary", "30d"),
    Feature("user_min_price_30d", "float", "monetary", "30d"),
    Feature("user_time_since_last_event_sec", "float", "recency", "all"),
    Feature("user_time_since_last_view_sec", "float", "recency", "all"),
    Feature("user_time_since_last_cart_sec", "float", "recency", "all"),
    Feature("user_time_since_last_purchase_sec", "float", "recency", "all"),
    Feature("user_days_since_first_event", "float", "lifetime", "all"),
    Feature("user_avg_session_length_events_30d", "float", "session", "30d"),
    Feature("user_median_session_length_events_30d", "float", "session", "30d"),
    Feature("user_sessions_7d", "int", "session", "7d"),
    Feature("user_events_last_session", "int", "session", "last_session"),
    Feature("user_web_events_share_30d", "float", "device", "30d"),
    Feature("user_ios_events_share_30d", "float", "device", "30d"),
    Feature("user_android_events_share_30d", "float", "device", "30d"),
    Feature("user_morning_event_share_30d", "float", "temporal", "30d"),
    Feature("user_evening_event_share_30d", "float", "temporal", "30d"),
    Feature("user_night_event_share_30d", "float", "temporal", "30d"),
    Feature("user_top_category_1", "string", "category_pref", "30d"),
    Feature("user_top_category_2", "string", "category_pref", "30d"),
    Feature("user_top_category_3", "string", "category_pref", "30d"),
    *_embedding("user_behavior_emb"),
]
ITEM_CATALOG = [
    Feature("item_views_30d", "bigint", "volume", "30d"),
    Feature("item_carts_30d", "bigint", "volume", "30d"),
    Feature("item_purchases_30d", "bigint", "volume", "30d"),
    Feature("item_ctr_30d", "float", "conversion", "30d"),
    Feature("item_cart_to_purchase_rate_30d", "float", "conversion", "30d"),
    Feature("item_avg_price_30d", "float", "monetary", "30d"),
    Feature("item_price_std_30d", "float", "monetary", "30d"),
    Feature("item_max_price_30d", "float", "monetary", "30d"),
    Feature("item_min_price_30d", "float", "monetary", "30d"),
    Feature("item_distinct_users_viewed_30d", "int", "diversity", "30d"),
    Feature("item_distinct_users_purchased_30d", "int", "diversity", "30d"),
    Feature("item_time_since_last_event_sec", "float", "recency", "all"),
    Feature("item_time_since_last_view_sec", "float", "recency", "all"),
    Feature("item_time_since_last_purchase_sec", "float", "recency", "all"),
    Feature("item_category_popularity_30d", "float", "category", "30d"),
    Feature("item_brand_popularity_30d", "float", "brand", "30d"),
    Feature("item_category_depth", "int", "category", "all"),
    Feature("item_is_discounted_flag", "int", "price", "30d"),
    Feature("item_discount_rate_avg_30d", "float", "price", "30d"),
    Feature("item_log_popularity_score_30d", "float", "popularity", "30d"),
    Feature("item_title_length_chars", "int", "text_stats", "all"),
    Feature("item_description_length_chars", "int", "text_stats", "all"),
    Feature("item_num_images", "int", "content", "all"),
    Feature("item_num_attributes", "int", "content", "all"),
    Feature("item_morning_view_share_30d", "float", "temporal", "30d"),
    Feature("item_evening_view_share_30d", "float", "temporal", "30d"),
    *_embedding("item_behavior_emb"),
]
CROSS_CATALOG = [
    Feature("ui_price_diff_from_user_avg", "float", "price_alignment", ""),
    Feature("ui_price_zscore_for_user", "float", "price_alignment", ""),
    Feature("ui_same_category_flag", "int", "category_match", ""),
    Feature("ui_same_top_category_flag", "int", "category_match", ""),
    Feature("ui_category_affinity_score", "float", "affinity", ""),
    Feature("ui_brand_affinity_score", "float", "affinity", ""),
    Feature("ui_user_item_co_views_30d", "int", "cooccurrence", "30d"),
    Feature("ui_user_item_co_carts_30d", "int", "cooccurrence", "30d"),
    Feature("ui_user_item_co_purchases_30d", "int", "cooccurrence", "30d"),
    Feature("ui_time_since_user_last_interaction_with_item_sec", "float", "recency", ""),
    Feature("ui_position_in_session", "int", "session_context", ""),
    Feature("ui_session_event_count", "int", "session_context", ""),
    Feature("ui_recency_bucket", "int", "recency", ""),
    Feature("ui_user_item_similarity_emb", "float", "similarity", ""),
    Feature("ui_user_item_exploration_score", "float", "exploration", ""),
]


class FeatureView(NamedTuple):
    name: str
    join_keys: tuple[str, ...]
    ttl_days: int
    fields: tuple[Feature, ...]


# ---- fixed values: entities, and what each view leaves out of the catalogue ----
ENTITIES = {
    "user": ("user_id",),
    "item": ("item_id",),
    "user_item": ("user_id", "item_id"),
}
_NOT_IN_ITEM_VIEW = {
    "item_category_popularity_30d",
    "item_brand_popularity_30d",
    "item_discount_rate_avg_30d",
    "item_title_length_chars",
    "item_description_length_chars",
    "item_num_images",
    "item_num_attributes",
}
_NOT_IN_CROSS_VIEW = {"ui_category_affinity_score", "ui_brand_affinity_score"}

USER_VIEW = FeatureView("user_features", ENTITIES["user"], 30, tuple(USER_CATALOG))
ITEM_VIEW = FeatureView(
    "item_features",
    ENTITIES["item"],
    30,
    tuple(f for f in ITEM_CATALOG if f.name not in _NOT_IN_ITEM_VIEW),
)
CROSS_VIEW = FeatureView(
    "cross_features",
    ENTITIES["user_item"],
    7,
    tuple(f for f in CROSS_CATALOG if f.name not in _NOT_IN_CROSS_VIEW),
)
