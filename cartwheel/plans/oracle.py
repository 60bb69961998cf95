"""SQL twins of the registered queries, for an independent engine over the same tables."""

from __future__ import annotations

import re

from cartwheel.plans.queries import SNAPSHOT_AGES
from cartwheel.schemas import (
    CROSS_CATALOG,
    CROSS_VIEW,
    DEVICES,
    EVENT_TYPES,
    ITEM_CATALOG,
    ITEM_VIEW,
    PAGES,
    USER_CATALOG,
    USER_VIEW,
    Feature,
    FeatureView,
)

DAYS = "{days}"  # window length, filled in by `_sql`


def _snapshot(age: int) -> str:
    """Midnight of the snapshot that lies so many days before the newest day."""
    return f"(SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) - INTERVAL {age} DAY FROM silver)"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 8) + 0.0::DOUBLE AS {n}" for n in names)


def _since(column: str, moment: str = "anchor") -> str:
    return f"(epoch_us({moment}) // 1000000 - epoch_us({column}) // 1000000)"


def _share(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) / count(*)"


def _n(event_type: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{event_type}')"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0::DOUBLE END"


PATH = "array_to_string(category_path, ' > ') AS category_path"
EVENT = f"user_id, session_id, item_id, event_type, price, {PATH}, device, page, referrer, ts"
IDENTITY = "user_id, session_id, item_id, event_type, ts, price, device, page"

# named subqueries; `_sql` takes the ones a query mentions, directly or through others
PARTS: dict[str, str] = {
    "arrived": """
        SELECT concat('u_', e.user_id) AS user_id,
               concat('s_', e.user_id, '_', strftime(e.ts, '%Y%m%d')) AS session_id,
               concat('i_', json_extract_string(e.props, '$.k')) AS item_id,
               CASE e.event_type WHEN 'view' THEN 'View' WHEN 'click' THEN 'view'
                    WHEN 'signup' THEN 'add_to_cart' ELSE e.event_type END AS event_type,
               CASE WHEN e.event_id % 97 = 0 THEN 0.0::DOUBLE ELSE e.value END AS price,
               CASE WHEN p.p_partkey IS NOT NULL THEN [p.p_type, split_part(p.p_name, ' ', 2)] END AS category_path,
               CASE e.event_id % 3 WHEN 0 THEN 'Web' WHEN 1 THEN 'ios' ELSE 'android' END AS device,
               CASE e.event_id % 4 WHEN 0 THEN 'home' WHEN 1 THEN 'plp' WHEN 2 THEN 'PDP' ELSE 'cart' END AS page,
               CASE e.event_id % 3 WHEN 0 THEN 'campaign_1' WHEN 1 THEN 'campaign_2' END AS referrer,
               epoch_us(e.ts) // 1000 AS ts, e.event_id
        FROM events e LEFT JOIN part p ON concat('', p.p_partkey) = json_extract_string(e.props, '$.k')""",
    "numbered": "SELECT * FROM arrived UNION ALL SELECT * FROM arrived WHERE event_id % 50 = 0",
    "raw": "SELECT * EXCLUDE (event_id) FROM numbered",
    "timed": "SELECT * REPLACE (make_timestamp(ts * 1000) AS ts) FROM raw",
    "lowered": "SELECT * REPLACE (lower(event_type) AS event_type, lower(device) AS device, lower(page) AS page) FROM timed",
    "permitted": f"""
        SELECT * FROM lowered WHERE event_type IN {_in(EVENT_TYPES)} AND device IN {_in(DEVICES)} AND page IN {_in(PAGES)}""",
    "keyed": """
        SELECT * FROM permitted WHERE user_id IS NOT NULL AND session_id IS NOT NULL AND item_id IS NOT NULL
        AND event_type IS NOT NULL AND ts IS NOT NULL AND price > 0""",
    "silver": f"""
        SELECT * EXCLUDE (copy), CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
        FROM (SELECT *, row_number() OVER (PARTITION BY {IDENTITY}
              ORDER BY referrer NULLS FIRST, category_path NULLS FIRST) AS copy FROM keyed) WHERE copy = 1""",
    "clock": "SELECT max(ts) AS anchor FROM silver",
    "recent": f"SELECT s.* FROM silver s, clock WHERE s.ts >= anchor - INTERVAL {DAYS} DAY",
    "base": """
        SELECT * EXCLUDE (copy) FROM (
          SELECT user_id, item_id, ts, event_type, session_id,
                 row_number() OVER (PARTITION BY user_id, item_id, ts ORDER BY event_type, session_id) AS copy
          FROM silver) WHERE copy = 1""",
    "base_recent": f"SELECT b.* FROM base b, clock WHERE b.ts >= anchor - INTERVAL {DAYS} DAY",
    # entities
    "silver_users": """
        SELECT user_id, min(ts) AS first_seen_ts, max(ts) AS last_seen_ts, count(*) AS total_events
        FROM silver GROUP BY user_id""",
    "silver_items": """
        SELECT item_id, concat('Item ', item_id) AS title,
               concat('Synthetic description for item ', item_id) AS description,
               first(category_path ORDER BY ts, category_path) FILTER (WHERE category_path IS NOT NULL) AS category_path,
               'generic_brand' AS brand, avg(price) AS base_price, min(ts) AS created_ts
        FROM silver GROUP BY item_id""",
    "listed_items": """
        SELECT s.* REPLACE (coalesce(p.p_name, s.title) AS title, coalesce(p.p_brand, s.brand) AS brand)
        FROM silver_items s LEFT JOIN part p ON concat('i_', p.p_partkey) = s.item_id""",
    # users
    "user_volume": f"""
        SELECT user_id, count(*) AS user_total_events_30d, {_n('view')} AS user_views_30d,
               {_n('add_to_cart')} AS user_add_to_cart_30d, {_n('purchase')} AS user_purchases_30d
        FROM recent GROUP BY user_id""",
    "user_category": """
        SELECT user_id, category, count(*) AS n
        FROM (SELECT user_id, unnest(category_path) AS category FROM recent) GROUP BY user_id, category""",
    "user_diversity": """
        SELECT r.user_id, count(DISTINCT r.item_id) AS user_distinct_items_viewed_30d,
               coalesce(any_value(c.n), 0) AS user_distinct_categories_viewed_30d
        FROM recent r LEFT JOIN (SELECT user_id, count(DISTINCT category) AS n FROM user_category GROUP BY user_id) c
        ON c.user_id = r.user_id GROUP BY r.user_id""",
    "user_conversion": f"""
        SELECT *, {_ratio('user_add_to_cart_30d', 'user_views_30d')} AS user_view_to_cart_rate_30d,
               {_ratio('user_purchases_30d', 'user_add_to_cart_30d')} AS user_cart_to_purchase_rate_30d
        FROM user_volume""",
    "user_monetary": """
        SELECT user_id, avg(price) AS user_avg_price_30d, stddev_samp(price) AS user_price_std_30d,
               max(price) AS user_max_price_30d, min(price) AS user_min_price_30d
        FROM recent GROUP BY user_id""",
    "user_recency": f"""
        SELECT *, {_since('last_ts')} AS user_time_since_last_event_sec,
               {_since('last_view_ts')} AS user_time_since_last_view_sec,
               {_since('last_cart_ts')} AS user_time_since_last_cart_sec,
               {_since('last_purchase_ts')} AS user_time_since_last_purchase_sec,
               {_since('first_ts')} / 86400.0::DOUBLE AS user_days_since_first_event
        FROM (SELECT user_id, max(ts) AS last_ts, min(ts) AS first_ts,
                     max(ts) FILTER (WHERE event_type = 'view') AS last_view_ts,
                     max(ts) FILTER (WHERE event_type = 'add_to_cart') AS last_cart_ts,
                     max(ts) FILTER (WHERE event_type = 'purchase') AS last_purchase_ts
              FROM silver GROUP BY user_id), clock""",
    "user_sessions": """
        SELECT user_id, avg(n) AS user_avg_session_length_events_30d,
               quantile_cont(n, 0.5) AS user_median_session_length_events_30d
        FROM (SELECT user_id, session_id, count(*) AS n FROM recent GROUP BY ALL) GROUP BY user_id""",
    "user_last_session": """
        SELECT user_id, n AS user_events_last_session FROM (
          SELECT user_id, n, row_number() OVER (PARTITION BY user_id ORDER BY ended DESC, session_id DESC) AS rn
          FROM (SELECT user_id, session_id, count(*) AS n, max(ts) AS ended FROM silver GROUP BY user_id, session_id))
        WHERE rn = 1""",
    "user_sessions_7d": """
        SELECT user_id, count(DISTINCT session_id) AS user_sessions_7d
        FROM silver, clock WHERE ts >= anchor - INTERVAL 7 DAY GROUP BY user_id""",
    "user_device_mix": "SELECT user_id, "
    + ", ".join(f"{_share(f'device = {d!r}')} AS user_{d}_events_share_30d" for d in DEVICES)
    + " FROM recent GROUP BY user_id",
    "user_temporal_mix": f"""
        SELECT user_id, {_share('hour(ts) BETWEEN 6 AND 11')} AS user_morning_event_share_30d,
               {_share('hour(ts) BETWEEN 18 AND 23')} AS user_evening_event_share_30d,
               {_share('hour(ts) BETWEEN 0 AND 5')} AS user_night_event_share_30d
        FROM recent GROUP BY user_id""",
    "user_top_categories": """
        SELECT user_id, max(category) FILTER (WHERE rn = 1) AS user_top_category_1,
               max(category) FILTER (WHERE rn = 2) AS user_top_category_2,
               max(category) FILTER (WHERE rn = 3) AS user_top_category_3
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) AS rn FROM user_category)
        GROUP BY user_id""",
    "user_features": """
        SELECT * FROM user_conversion JOIN user_diversity USING (user_id) JOIN user_monetary USING (user_id)
        LEFT JOIN user_recency USING (user_id) LEFT JOIN user_sessions USING (user_id)
        LEFT JOIN user_last_session USING (user_id) LEFT JOIN user_sessions_7d USING (user_id)
        JOIN user_device_mix USING (user_id) JOIN user_temporal_mix USING (user_id)
        LEFT JOIN user_top_categories USING (user_id)""",
    # items
    "item_volume": f"""
        SELECT item_id, {_n('view')} AS item_views_30d, {_n('add_to_cart')} AS item_carts_30d,
               {_n('purchase')} AS item_purchases_30d, count(*) AS total_events_30d
        FROM recent GROUP BY item_id""",
    "item_rates": f"""
        SELECT *, {_ratio('item_purchases_30d', 'item_views_30d')} AS item_ctr_30d,
               {_ratio('item_purchases_30d', 'item_carts_30d')} AS item_cart_to_purchase_rate_30d FROM item_volume""",
    "item_popularity": """
        SELECT *, ln(1 + item_views_30d + item_carts_30d + item_purchases_30d) AS item_log_popularity_score_30d
        FROM item_volume""",
    "item_monetary": """
        SELECT item_id, avg(price) AS item_avg_price_30d, stddev_samp(price) AS item_price_std_30d,
               max(price) AS item_max_price_30d, min(price) AS item_min_price_30d
        FROM recent GROUP BY item_id""",
    "item_distinct_users": """
        SELECT item_id, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS item_distinct_users_viewed_30d,
               count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS item_distinct_users_purchased_30d
        FROM recent GROUP BY item_id""",
    "item_recency": f"""
        SELECT *, {_since('last_ts')} AS item_time_since_last_event_sec,
               {_since('last_view_ts')} AS item_time_since_last_view_sec,
               {_since('last_purchase_ts')} AS item_time_since_last_purchase_sec
        FROM (SELECT item_id, max(ts) AS last_ts, max(ts) FILTER (WHERE event_type = 'view') AS last_view_ts,
                     max(ts) FILTER (WHERE event_type = 'purchase') AS last_purchase_ts
              FROM silver GROUP BY item_id), clock""",
    "item_content": """
        SELECT item_id, category_path, brand, base_price, title, description,
               CAST(len(category_path) AS INTEGER) AS item_category_depth,
               CASE WHEN base_price > 0 THEN 1 ELSE 0 END AS item_is_discounted_flag,
               CAST(length(title) AS INTEGER) AS item_title_length_chars,
               CAST(length(description) AS INTEGER) AS item_description_length_chars,
               3 AS item_num_images, 8 AS item_num_attributes FROM listed_items""",
    "item_temporal": f"""
        SELECT item_id, {_share('hour(ts) BETWEEN 6 AND 11')} AS item_morning_view_share_30d,
               {_share('hour(ts) BETWEEN 18 AND 23')} AS item_evening_view_share_30d FROM recent GROUP BY item_id""",
    "item_category_popularity": """
        SELECT i.item_id, coalesce(n / max(n) OVER (), 0) AS item_category_popularity_30d FROM listed_items i
        LEFT JOIN (SELECT category_path[1] AS label, count(*) AS n FROM recent GROUP BY 1) c ON c.label = i.category_path[1]""",
    "item_brand_popularity": """
        SELECT i.item_id, coalesce(n / max(n) OVER (), 0) AS item_brand_popularity_30d FROM listed_items i
        LEFT JOIN (SELECT brand, count(*) AS n FROM recent JOIN listed_items USING (item_id) GROUP BY brand) b
        ON b.brand = i.brand""",
    "item_discount_rate": """
        SELECT item_id, avg((base_price - price) / base_price) AS item_discount_rate_avg_30d
        FROM recent JOIN listed_items USING (item_id) GROUP BY item_id""",
    "item_features": """
        SELECT * FROM item_rates
        JOIN (SELECT item_id, item_log_popularity_score_30d FROM item_popularity) USING (item_id)
        JOIN item_monetary USING (item_id) JOIN item_distinct_users USING (item_id)
        LEFT JOIN item_recency USING (item_id) LEFT JOIN item_content USING (item_id)
        LEFT JOIN item_temporal USING (item_id)""",
    "item_features_declared": """
        SELECT * FROM item_features LEFT JOIN item_category_popularity USING (item_id)
        LEFT JOIN item_brand_popularity USING (item_id) LEFT JOIN item_discount_rate USING (item_id)""",
    # pairs
    "requested": "SELECT DISTINCT user_id, item_id FROM raw WHERE event_type = 'error'",
    "observed": "SELECT DISTINCT user_id, item_id FROM silver",
    "candidates": "SELECT * FROM observed UNION SELECT * FROM requested",
    "busiest": """
        SELECT category, item_id FROM (
          SELECT category, item_id, row_number() OVER (PARTITION BY category ORDER BY n DESC, item_id) AS rn
          FROM (SELECT DISTINCT item_id, unnest(category_path) AS category FROM silver_items)
          JOIN (SELECT item_id, count(*) AS n FROM recent GROUP BY item_id) USING (item_id) WHERE category IS NOT NULL) WHERE rn <= 5""",
    "ui_recency": f"""
        SELECT *, {_since('last_ui_ts')} AS ui_time_since_user_last_interaction_with_item_sec
        FROM (SELECT user_id, item_id, max(ts) AS last_ui_ts FROM base GROUP BY user_id, item_id), clock""",
    "ui_cooccurrence": f"""
        SELECT user_id, item_id, {_n('view')} AS ui_user_item_co_views_30d,
               {_n('add_to_cart')} AS ui_user_item_co_carts_30d,
               {_n('purchase')} AS ui_user_item_co_purchases_30d
        FROM base_recent GROUP BY user_id, item_id""",
    "pair_sessions": """
        SELECT user_id, item_id, session_id, CAST(max(pos) AS INTEGER) AS position, count(*) AS n, max(ts) AS ended,
               any_value(total) AS total
        FROM (SELECT *, count(*) OVER (PARTITION BY session_id) AS total,
                     row_number() OVER (PARTITION BY session_id ORDER BY ts, item_id, event_type, user_id) AS pos FROM base)
        GROUP BY user_id, item_id, session_id""",
    "ui_session_context": """
        SELECT user_id, item_id, position AS ui_position_in_session, n AS ui_session_event_count FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY n DESC, session_id DESC) AS rn
          FROM pair_sessions) WHERE rn = 1""",
    "ui_session_context_spec": """
        SELECT user_id, item_id, position AS ui_position_in_session, total AS ui_session_event_count FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ended DESC, session_id DESC) AS rn
          FROM pair_sessions) WHERE rn = 1""",
    "cross_features": """
        SELECT p.user_id, p.item_id,
               item_avg_price_30d - user_avg_price_30d AS ui_price_diff_from_user_avg,
               CASE WHEN user_price_std_30d > 0 THEN (item_avg_price_30d - user_avg_price_30d) / user_price_std_30d
                    ELSE 0.0::DOUBLE END AS ui_price_zscore_for_user,
               CASE WHEN list_contains(i.category_path, user_top_category_1) THEN 1 ELSE 0 END AS ui_same_category_flag,
               CASE WHEN i.category_path[1] = user_top_category_1 THEN 1 ELSE 0 END AS ui_same_top_category_flag,
               ui_user_item_co_views_30d, ui_user_item_co_carts_30d, ui_user_item_co_purchases_30d,
               last_ui_ts, ui_time_since_user_last_interaction_with_item_sec,
               ui_position_in_session, ui_session_event_count,
               CASE WHEN ui_user_item_co_views_30d IS NULL THEN 1.0::DOUBLE
                    ELSE 1.0::DOUBLE / (1.0::DOUBLE + ln(1.0::DOUBLE + ui_user_item_co_views_30d))
                    END AS ui_user_item_exploration_score,
               CASE WHEN ui_time_since_user_last_interaction_with_item_sec < 3600 THEN 0
                    WHEN ui_time_since_user_last_interaction_with_item_sec < 21600 THEN 1
                    WHEN ui_time_since_user_last_interaction_with_item_sec < 86400 THEN 2 ELSE 3 END AS ui_recency_bucket
        FROM {pairs} p JOIN user_features u USING (user_id) JOIN item_features i USING (item_id)
        LEFT JOIN ui_cooccurrence USING (user_id, item_id) LEFT JOIN ui_recency USING (user_id, item_id)
        LEFT JOIN ui_session_context USING (user_id, item_id)""",
    # text
    "user_tokens": """
        SELECT user_id, token, CAST(sum(n) AS BIGINT) AS tf
        FROM (SELECT user_id, n, unnest(string_split(lower(category), ' ')) AS token FROM user_category
              WHERE category IS NOT NULL) GROUP BY user_id, token""",
    "item_tokens": """
        SELECT item_id, token, count(*) AS tf FROM (
          SELECT item_id, unnest(string_split(lower(concat_ws(' ', array_to_string(category_path, ' '), brand, title)), ' '))
                 AS token FROM listed_items) GROUP BY item_id, token""",
    # streams
    "windows": """
        SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end FROM timed""",
    "closed": "SELECT max(ts) - INTERVAL 10 SECOND AS watermark FROM timed",
    "rt_all_users": f"""
        SELECT user_id, window_start, window_end, epoch_us(max(ts)) // 1000000 * 1000 AS rt_user_last_event_ts_ms,
               {_since('max(ts)', 'window_end')} AS rt_user_time_since_last_event_sec,
               {_n('view')} AS rt_user_rolling_view_count_5m, {_n('add_to_cart')} AS rt_user_rolling_cart_count_5m,
               {_n('purchase')} AS rt_user_rolling_purchase_count_5m,
               count(*) / 5.0::DOUBLE AS rt_user_event_rate_per_min_5m,
               last(device ORDER BY ts, item_id, device, page, price) AS rt_user_last_device,
               last(page ORDER BY ts, item_id, device, page, price) AS rt_user_last_page_type,
               last(item_id ORDER BY ts, item_id, device, page, price) AS rt_user_last_item_id,
               last(price ORDER BY ts, item_id, device, page, price) AS rt_user_last_price,
               count(*) AS rt_user_current_session_length,
               count(*) FILTER (WHERE event_type IN {_in(EVENT_TYPES)}) AS rt_user_interaction_streak
        FROM windows GROUP BY user_id, window_start, window_end""",
    "rt_users": "SELECT r.* FROM rt_all_users r, closed WHERE window_end <= watermark",
    "rt_items": f"""
        SELECT item_id, window_start, window_end, epoch_us(max(ts)) // 1000000 * 1000 AS rt_item_last_event_ts_ms,
               {_since('max(ts)', 'window_end')} AS rt_item_time_since_last_event_sec,
               {_n('view')} AS rt_item_rolling_view_count_5m, {_n('add_to_cart')} AS rt_item_rolling_cart_count_5m,
               {_n('purchase')} AS rt_item_rolling_purchase_count_5m,
               count(*) / 5.0::DOUBLE AS rt_item_event_rate_per_min_5m, avg(price) AS rt_item_recent_price_avg_5m,
               last(category_path[1] ORDER BY ts, category_path[1]) AS category_hint
        FROM windows, closed WHERE window_end <= watermark GROUP BY item_id, window_start, window_end""",
    "online": """
        SELECT concat('user_features_rt:', user_id) AS key,
               to_json({{'rt_user_last_event_ts_ms': rt_user_last_event_ts_ms,
                 'rt_user_time_since_last_event_sec': rt_user_time_since_last_event_sec,
                 'rt_user_rolling_view_count_5m': rt_user_rolling_view_count_5m,
                 'rt_user_rolling_cart_count_5m': rt_user_rolling_cart_count_5m,
                 'rt_user_rolling_purchase_count_5m': rt_user_rolling_purchase_count_5m,
                 'rt_user_event_rate_per_min_5m': rt_user_event_rate_per_min_5m,
                 'rt_user_last_device': rt_user_last_device, 'rt_user_last_page_type': rt_user_last_page_type,
                 'rt_user_last_item_id': rt_user_last_item_id, 'rt_user_last_price': rt_user_last_price,
                 'rt_user_current_session_length': rt_user_current_session_length,
                 'rt_user_interaction_streak': rt_user_interaction_streak,
                 'rt_updated_at_ms': epoch_ms(window_end)}})::VARCHAR AS value,
               epoch_ms(window_end) AS updated_at_ms, window_end FROM rt_all_users""",
    # snapshots: user volume as known at each date
    "snapshots": " UNION ALL ".join(
        f"""SELECT user_id, count(*) AS user_total_events_30d, {_n('view')} AS user_views_30d,
        {_n('add_to_cart')} AS user_add_to_cart_30d, {_n('purchase')} AS user_purchases_30d, CAST(any_value(midnight) AS DATE) AS date
        FROM silver, (SELECT {_snapshot(age)} AS midnight) WHERE ts <= midnight AND ts >= midnight - INTERVAL 30 DAY GROUP BY user_id"""
        for age in SNAPSHOT_AGES
    ),
    "rebuilt_snapshots": f"""
        SELECT * FROM snapshots WHERE date <> {_snapshot(SNAPSHOT_AGES[0])} UNION ALL
        SELECT user_id, count(*), {_n('view')}, {_n('add_to_cart')}, {_n('purchase')}, CAST(any_value(midnight) AS DATE)
        FROM silver, (SELECT {_snapshot(SNAPSHOT_AGES[0])} AS midnight)
        WHERE ts <= midnight - INTERVAL 5 DAY AND ts >= midnight - INTERVAL 35 DAY GROUP BY user_id""",
}


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        new = (words & PARTS.keys()) - found
        found |= new
        queue += [PARTS[name] for name in new]
    return [name for name in PARTS if name in found]


def _sql(select: str, days: int = 30, pairs: str = "observed") -> str:
    """`select` behind the subqueries it mentions."""
    needed = set(_needed(f"{select} {pairs}"))
    parts = ", ".join(f"{name} AS ({body})" for name, body in PARTS.items() if name in needed)
    text = f"WITH {parts} {select}"
    return text.replace("{days}", str(days)).replace("{pairs}", pairs).replace("{{", "{").replace("}}", "}")


def _rounded(table: str, doubles: list[str], path: bool = False) -> str:
    shown = [_r(*doubles), PATH] if path else [_r(*doubles)]
    return f"SELECT * REPLACE ({', '.join(shown)}) FROM {table}"


USER_DOUBLES = [
    "user_view_to_cart_rate_30d",
    "user_cart_to_purchase_rate_30d",
    "user_avg_price_30d",
    "user_price_std_30d",
    "user_max_price_30d",
    "user_min_price_30d",
    "user_days_since_first_event",
    "user_avg_session_length_events_30d",
    "user_median_session_length_events_30d",
    "user_web_events_share_30d",
    "user_ios_events_share_30d",
    "user_android_events_share_30d",
    "user_morning_event_share_30d",
    "user_evening_event_share_30d",
    "user_night_event_share_30d",
]
ITEM_DOUBLES = [
    "item_ctr_30d",
    "item_cart_to_purchase_rate_30d",
    "item_log_popularity_score_30d",
    "item_avg_price_30d",
    "item_price_std_30d",
    "item_max_price_30d",
    "item_min_price_30d",
    "base_price",
    "item_morning_view_share_30d",
    "item_evening_view_share_30d",
]
DECLARED_DOUBLES = ["item_category_popularity_30d", "item_brand_popularity_30d", "item_discount_rate_avg_30d"]
AFFINITIES = ["ui_category_affinity_score", "ui_brand_affinity_score"]
CROSS_DOUBLES = ["ui_price_diff_from_user_avg", "ui_price_zscore_for_user", "ui_user_item_exploration_score"]

_JSON_EVENT = f"user_id, session_id, item_id, event_type, round(price::FLOAT::DOUBLE, 8) AS price, {PATH}, device, page, referrer"

_FLOAT_TYPES = {"float": "FLOAT", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}


def _view(view: FeatureView, table: str) -> str:
    fields = [f"CAST({f.name} AS {_FLOAT_TYPES[f.dtype]}) AS {f.name}" for f in view.fields if f.family != "embedding"]
    fields = [f for f in fields if "similarity" not in f]
    return f"SELECT {', '.join([*view.join_keys, *fields])} FROM {table}"


# types of the computed tables, before a view casts them
_COMPUTED = {"float": "double", "bigint": "bigint", "int": "bigint", "string": "string"}
_COMPUTED_INTS = {
    "item_category_depth",
    "item_is_discounted_flag",
    "item_title_length_chars",
    "item_description_length_chars",
    "item_num_images",
    "item_num_attributes",
    "ui_same_category_flag",
    "ui_same_top_category_flag",
    "ui_position_in_session",
    "ui_recency_bucket",
}


def _profile(catalog: list[Feature], table: str) -> str:
    rows = []
    for f in catalog:
        start = f"SELECT '{f.name}' AS feature, '{f.family}' AS family, '{f.dtype}' AS declared_dtype, count(*) AS row_count"
        if f.family in ("embedding", "similarity"):
            rows.append(
                f"{start}, false AS present, false AS dtype_matches, NULL::BIGINT AS null_count, "
                f"NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value FROM {table}"
            )
            continue
        computed = "int" if f.name in _COMPUTED_INTS else _COMPUTED[f.dtype]
        if f.name.endswith("_sec"):
            computed = "bigint"
        number = "NULL" if f.dtype == "string" else f.name
        rows.append(
            f"{start}, true AS present, {str(computed == f.dtype).lower()} AS dtype_matches, "
            f"count(*) FILTER (WHERE {f.name} IS NULL) AS null_count, "
            f"round(CAST(min({number}) AS DOUBLE), 8) + 0.0::DOUBLE AS min_value, round(CAST(max({number}) AS DOUBLE), 8) + 0.0::DOUBLE AS max_value "
            f"FROM {table}"
        )
    return " UNION ALL ".join(rows)


_CONTRACT = {
    "user_id_present": "user_id IS NULL",
    "session_id_present": "session_id IS NULL",
    "item_id_present": "item_id IS NULL",
    "event_type_known": f"coalesce(event_type NOT IN {_in(EVENT_TYPES)}, true)",
    "price_positive": "coalesce(NOT price > 0, true)",
    "category_path_present": "category_path IS NULL",
    "device_known": f"coalesce(device NOT IN {_in(DEVICES)}, true)",
    "page_known": f"coalesce(page NOT IN {_in(PAGES)}, true)",
    "ts_present": "ts IS NULL",
}
_BROKEN = "concat_ws(' > ', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _CONTRACT.items()) + ")"

_RT_USERS = "rt_user_event_rate_per_min_5m", "rt_user_last_price"
_RT_ITEMS = "rt_item_event_rate_per_min_5m", "rt_item_recent_price_avg_5m"
_WINDOWS_SEEN = " UNION ALL ".join(
    f"SELECT event_type, count(*) AS events, min(ts) AS first_ts, '{name}' AS \"window\" FROM silver, clock {where} GROUP BY 1"
    for name, where in {
        "all": "",
        **{f"{d}d": f"WHERE ts >= anchor - INTERVAL {d} DAY" for d in (30, 10, 7)},
    }.items()
)
_TFIDF = """
    SELECT {entity}, token, tf, df, round(tf * ln((m + 1) / (df + 1)), 8) AS tfidf FROM {tokens}
    JOIN (SELECT token, count(*) AS df FROM {tokens} GROUP BY token) USING (token),
         (SELECT count(DISTINCT {entity}) AS m FROM {tokens})"""


def _tfidf(entity: str, tokens: str) -> str:
    return _sql(_TFIDF.replace("{entity}", entity).replace("{tokens}", tokens))


_AFFINITY = """
    SELECT c.user_id, c.item_id, round(coalesce(n / total, 0), 8) AS {out} FROM candidates c
    LEFT JOIN (SELECT item_id, {label} AS label FROM listed_items) i USING (item_id)
    LEFT JOIN (SELECT user_id, {label} AS label, count(*) AS n FROM (SELECT user_id, item_id FROM recent)
               JOIN listed_items USING (item_id) GROUP BY 1, 2) l USING (user_id, label)
    LEFT JOIN (SELECT user_id, count(*) AS total FROM recent GROUP BY user_id) t USING (user_id)"""


PARTS["lettered"] = f"""
    SELECT *, CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'parses'
              ELSE concat_ws(',', {', '.join(f"CASE WHEN {broken} THEN '{rule}' END" for rule, broken in _CONTRACT.items())}) END AS rules
    FROM (SELECT * REPLACE (make_timestamp(ts * 1000) AS ts) FROM numbered)"""
_AFFINITY_LABELS = {"ui_category_affinity_score": "category_path[1]", "ui_brand_affinity_score": "brand"}
PARTS["cross_features_declared"] = "SELECT * FROM cross_features " + " ".join(
    f"JOIN ({_AFFINITY.replace('{out}', out).replace('{label}', label)}) USING (user_id, item_id)" for out, label in _AFFINITY_LABELS.items()
)


def _affinity(out: str, label: str) -> str:
    return _sql(_AFFINITY.replace("{out}", out).replace("{label}", label))


_SCORED_REQUESTS = """
    SELECT user_id, item_id, {columns} FROM (SELECT user_id, item_id FROM requested UNION SELECT user_id, item_id FROM {table})
    LEFT JOIN {table} USING (user_id, item_id)"""

ORACLES: dict[str, str] = {
    "s1_bronze_scan": _sql(f"SELECT {EVENT} FROM raw"),
    "s2_table_scan": _sql(f"SELECT {EVENT}, event_date, event_hour FROM silver"),
    "s3_event_stream_source": _sql(f"SELECT {_JSON_EVENT}, ts FROM timed"),
    "s4_decode_events": _sql(f"SELECT {_JSON_EVENT}, ts FROM timed"),
    "s5_feature_source": _sql("SELECT *, CAST(date AS TIMESTAMP) AS event_timestamp FROM snapshots"),
    "s6_write_silver_events": _sql(
        f"""SELECT {EVENT}, event_date, event_hour FROM silver
        WHERE event_date < (SELECT max(event_date) FROM silver) OR event_type <> 'view' OR event_hour > 1
        OR event_hour NOT IN (SELECT event_hour FROM silver WHERE event_type <> 'view'
                              AND event_date = (SELECT max(event_date) FROM silver))"""
    ),
    "s7_write_entity_table": _sql(_rounded("silver_items", ["base_price"], path=True)),
    "s8_write_gold_snapshot": _sql("SELECT * FROM rebuilt_snapshots"),
    "s9_raw_archive_sink": _sql(
        f"""SELECT {EVENT}, CAST(year(make_timestamp(ts * 1000)) AS INTEGER) AS year,
        CAST(month(make_timestamp(ts * 1000)) AS INTEGER) AS month, CAST(day(make_timestamp(ts * 1000)) AS INTEGER) AS day,
        CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour
        FROM (SELECT * REPLACE (CASE WHEN device <> 'ios' OR page <> 'cart' THEN user_id END AS user_id,
              CASE WHEN device <> 'android' OR page <> 'home' THEN ts END AS ts) FROM raw)"""
    ),
    "s10_online_upsert": _sql(
        """SELECT key, value, updated_at_ms, 3600::BIGINT AS ttl_sec, writer, 7::BIGINT AS batch_id
        FROM online, (SELECT unnest(['first', 'second']) AS writer)"""
    ),
    "s11_online_read": _sql(
        """SELECT key, value, updated_at_ms, 86400::BIGINT AS ttl_sec
        FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated_at_ms DESC) AS rn,
                     max(updated_at_ms) OVER () AS newest FROM online)
        WHERE rn = 1 AND updated_at_ms + 86400000 > newest"""
    ),
    "c1_drop_broken": _sql(f"SELECT {EVENT} FROM raw WHERE user_id IS NOT NULL"),
    "c2_normalize_ts": _sql(f"SELECT {EVENT} FROM timed"),
    "c3_typed_projection": _sql(f"SELECT {EVENT} FROM timed"),
    "c4_drop_null_keys_price": _sql(
        f"""SELECT {EVENT} FROM timed WHERE user_id IS NOT NULL AND session_id IS NOT NULL AND item_id IS NOT NULL
        AND event_type IS NOT NULL AND ts IS NOT NULL AND price > 0"""
    ),
    "c5_sanitize_categoricals": _sql(f"SELECT {EVENT} FROM permitted"),
    "c6_date_hour": _sql(
        f"SELECT {EVENT}, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour FROM timed"
    ),
    "c7_dedupe_events": _sql(
        f"""SELECT {EVENT} FROM (SELECT *, row_number() OVER (PARTITION BY {IDENTITY}
        ORDER BY referrer NULLS FIRST, category_path NULLS FIRST) AS copy FROM timed) WHERE copy = 1"""
    ),
    "c8_silver_events": _sql(f"SELECT {EVENT}, event_date, event_hour FROM silver"),
    "c9_event_contract_report": _sql(
        " UNION ALL ".join(
            f"SELECT count(*) AS checked, '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations FROM raw"
            for n, c in _CONTRACT.items()
        )
    ),
    "c9_contract_quarantine": _sql(f"SELECT {EVENT}, {_BROKEN} AS broken_rules FROM raw WHERE {_BROKEN} <> ''"),
    "c10_base_pairs": _sql("SELECT * FROM base"),
    "c11_window_anchor": _sql(
        """SELECT anchor AS max_ts, anchor - INTERVAL 30 DAY AS cutoff_long, anchor - INTERVAL 7 DAY AS cutoff_short
        FROM clock"""
    ),
    "c12_split_windows": _sql(_WINDOWS_SEEN),
    "e1_silver_users": _sql("SELECT * FROM silver_users"),
    "e2_silver_items": _sql(_rounded("silver_items", ["base_price"], path=True)),
    "e3_silver_items_catalog": _sql(_rounded("listed_items", ["base_price"], path=True)),
    "u1_user_volume": _sql("SELECT * FROM user_volume"),
    "u2_user_diversity": _sql("SELECT * FROM user_diversity"),
    "u3_user_conversion": _sql(_rounded("user_conversion", USER_DOUBLES[:2])),
    "u4_user_monetary": _sql(_rounded("user_monetary", USER_DOUBLES[2:6])),
    "u5_user_recency": _sql(
        f"SELECT * EXCLUDE (anchor) REPLACE ({_r('user_days_since_first_event')}) FROM user_recency"
    ),
    "u6_user_sessions": _sql(_rounded("user_sessions", USER_DOUBLES[7:9])),
    "u7_user_last_session": _sql("SELECT * FROM user_last_session"),
    "u8_user_sessions_7d": _sql("SELECT * FROM user_sessions_7d"),
    "u9_user_device_mix": _sql(_rounded("user_device_mix", USER_DOUBLES[9:12])),
    "u10_user_temporal_mix": _sql(_rounded("user_temporal_mix", USER_DOUBLES[12:15])),
    "u11_user_top_categories": _sql("SELECT * FROM user_top_categories"),
    "u12_user_category_docs": _sql("SELECT user_id, category AS text, n FROM user_category WHERE category IS NOT NULL"),
    "i1_item_volume": _sql("SELECT * FROM item_volume"),
    "i2_item_rates": _sql(_rounded("item_rates", ITEM_DOUBLES[:2])),
    "i3_item_log_popularity": _sql(_rounded("item_popularity", ITEM_DOUBLES[2:3])),
    "i4_item_monetary": _sql(_rounded("item_monetary", ITEM_DOUBLES[3:7])),
    "i5_item_distinct_users": _sql("SELECT * FROM item_distinct_users"),
    "i6_item_recency": _sql("SELECT * EXCLUDE (anchor) FROM item_recency"),
    "i7_item_content": _sql(_rounded("item_content", ["base_price"], path=True)),
    "i8_item_temporal": _sql(_rounded("item_temporal", ITEM_DOUBLES[8:])),
    "i8_item_temporal_views_only": _sql(
        f"""SELECT item_id, round({_ratio("count(*) FILTER (WHERE event_type = 'view' AND hour(ts) BETWEEN 6 AND 11)", _n('view'))}, 8)
        AS item_morning_view_share_30d,
        round({_ratio("count(*) FILTER (WHERE event_type = 'view' AND hour(ts) BETWEEN 18 AND 23)", _n('view'))}, 8)
        AS item_evening_view_share_30d FROM recent GROUP BY item_id"""
    ),
    "i11_item_brand_popularity": _sql(_rounded("item_brand_popularity", DECLARED_DOUBLES[1:2])),
    "t1_tfidf_terms": _tfidf("user_id", "user_tokens"),
    "t1_tfidf_item_terms": _tfidf("item_id", "item_tokens"),
    "x1_ui_recency": _sql("SELECT * EXCLUDE (anchor) FROM ui_recency"),
    "x2_ui_cooccurrence": _sql("SELECT * FROM ui_cooccurrence"),
    "x2_ui_cooccurrence_10d_window": _sql("SELECT * FROM ui_cooccurrence", days=10),
    "x3_ui_session_context": _sql("SELECT * FROM ui_session_context"),
    "x3_ui_session_context_split_sessions": _sql("SELECT * FROM ui_session_context"),
    "x3_ui_session_context_one_session": _sql(
        """SELECT user_id, item_id, CAST(max(pos) AS INTEGER) AS ui_position_in_session, count(*) AS ui_session_event_count
        FROM (SELECT *, row_number() OVER (ORDER BY ts, item_id, event_type, user_id) AS pos FROM base) GROUP BY user_id, item_id"""
    ),
    "x3b_ui_session_context_spec": _sql("SELECT * FROM ui_session_context_spec"),
    "x4_ui_category_match": _sql(
        """SELECT user_id, item_id,
        CASE WHEN list_contains(category_path, user_top_category_1) THEN 1 ELSE 0 END AS ui_same_category_flag,
        CASE WHEN category_path[1] = user_top_category_1 THEN 1 ELSE 0 END AS ui_same_top_category_flag
        FROM candidates JOIN user_top_categories USING (user_id) JOIN silver_items USING (item_id)"""
    ),
    "x4b_ui_category_match_top3": _sql(
        """SELECT user_id, item_id, CASE WHEN list_has_any(category_path,
        [user_top_category_1, user_top_category_2, user_top_category_3]) THEN 1 ELSE 0 END AS ui_same_category_flag
        FROM candidates JOIN user_top_categories USING (user_id) JOIN silver_items USING (item_id)"""
    ),
    "x5_ui_price_alignment": _sql(
        """SELECT user_id, item_id, round(item_avg_price_30d - user_avg_price_30d, 8) + 0.0::DOUBLE AS ui_price_diff_from_user_avg,
        round(CASE WHEN user_price_std_30d > 0 THEN (item_avg_price_30d - user_avg_price_30d) / user_price_std_30d
        ELSE 0.0::DOUBLE END, 8) + 0.0::DOUBLE AS ui_price_zscore_for_user
        FROM candidates JOIN user_monetary USING (user_id) JOIN item_monetary USING (item_id)"""
    ),
    "x6_ui_similarity": _sql(
        """SELECT user_id, item_id,
        round(list_inner_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[]), 8) AS ui_user_item_similarity_emb FROM observed
        JOIN embeddings u ON concat('u_', u.vec_id) = user_id JOIN embeddings i ON concat('i_', i.vec_id) = item_id"""
    ),
    "x7_ui_recency_bucket": _sql(
        _SCORED_REQUESTS.replace("{table}", "ui_recency").replace(
            "{columns}",
            """last_ui_ts, ui_time_since_user_last_interaction_with_item_sec,
            CASE WHEN ui_time_since_user_last_interaction_with_item_sec < 3600 THEN 0
                 WHEN ui_time_since_user_last_interaction_with_item_sec < 21600 THEN 1
                 WHEN ui_time_since_user_last_interaction_with_item_sec < 86400 THEN 2 ELSE 3 END AS ui_recency_bucket""",
        )
    ),
    "x8_ui_exploration": _sql(
        _SCORED_REQUESTS.replace("{table}", "ui_cooccurrence").replace(
            "{columns}",
            """ui_user_item_co_views_30d, ui_user_item_co_carts_30d, ui_user_item_co_purchases_30d,
            round(CASE WHEN ui_user_item_co_views_30d IS NULL THEN 1.0::DOUBLE
                  ELSE 1.0::DOUBLE / (1.0::DOUBLE + ln(1.0::DOUBLE + ui_user_item_co_views_30d)) END, 8)
                  AS ui_user_item_exploration_score""",
        )
    ),
    "x9_ui_category_affinity": _affinity("ui_category_affinity_score", "category_path[1]"),
    "x10_ui_brand_affinity": _affinity("ui_brand_affinity_score", "brand"),
    "x11_cross_features": _sql(_rounded("cross_features", CROSS_DOUBLES)),
    "x11_cross_features_declared": _sql(_rounded("cross_features_declared", [*CROSS_DOUBLES, *AFFINITIES]), pairs="candidates"),
    "x11_cross_features_requested_pairs": _sql(_rounded("cross_features", CROSS_DOUBLES), pairs="candidates"),
    "x11_cross_features_10d_window": _sql(_rounded("cross_features", CROSS_DOUBLES), days=10, pairs="candidates"),
    "x12_candidate_pairs": _sql("SELECT * FROM candidates"),
    "x12_candidate_pairs_by_category": _sql(
        """SELECT * FROM candidates UNION SELECT user_id, item_id FROM
        (SELECT user_id, unnest([user_top_category_1, user_top_category_2, user_top_category_3]) AS category FROM user_top_categories)
        JOIN busiest USING (category)"""
    ),
    "x12_busiest_items_10d_window": _sql("SELECT * FROM busiest", days=10),
    "r1_watermark": _sql(
        """, timed_ids AS (
          SELECT make_timestamp(ts * 1000) AS ts, event_type,
                 (CAST(make_timestamp(ts * 1000) AS DATE) - first) * 3 // (last - first + 1)
                 + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS arrival
          FROM numbered, (SELECT min(CAST(make_timestamp(ts * 1000) AS DATE)) AS first,
                                 max(CAST(make_timestamp(ts * 1000) AS DATE)) AS last FROM numbered)),
        marks AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival) - INTERVAL 10 SECOND AS mark
                  FROM timed_ids GROUP BY arrival),
        bucketed AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM timed_ids)
        SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS events
        FROM bucketed b LEFT JOIN marks m ON m.arrival = b.arrival - 1
        WHERE (m.mark IS NULL OR window_start + INTERVAL 5 MINUTE > m.mark)
          AND window_start + INTERVAL 5 MINUTE <= (SELECT max(mark) FROM marks)
        GROUP BY 1, 2, 3"""
    ).replace(") , timed_ids", "), timed_ids"),
    "f6_as_of_join": _sql(
        f"""SELECT l.user_id, item_id, label_ts, w.* EXCLUDE (user_id, window_start, window_end) REPLACE ({_r(*_RT_USERS)}), window_end AS feature_ts
        FROM (SELECT user_id, item_id, ts AS label_ts FROM silver WHERE event_type = 'purchase') l
        LEFT JOIN rt_all_users w ON w.user_id = l.user_id AND w.window_end <= l.label_ts AND w.window_end >= l.label_ts - INTERVAL 3 HOUR
        QUALIFY row_number() OVER (PARTITION BY l.user_id, item_id, label_ts ORDER BY window_end DESC) = 1"""
    ),
    "u13_user_hashed_tokens": _sql("SELECT user_id, CAST(sum(tf) AS BIGINT) AS tokens FROM user_tokens GROUP BY user_id"),
    "i9_item_hashed_tokens": _sql("SELECT item_id, CAST(sum(tf) AS BIGINT) AS tokens FROM item_tokens GROUP BY item_id"),
    "c7_dedupe_stream": _sql(f"SELECT {EVENT} FROM silver"),
    "r3_session_updates": _sql(
        """, gaps AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 12 HOUR, true) AS opens FROM keyed),
        numbered_sessions AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM gaps)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, CAST(count(*) AS INTEGER) AS session_len,
               CAST(count(*) FILTER (WHERE event_type IN ('view', 'add_to_cart')) AS INTEGER) AS clicks_in_session,
               epoch_us(max(ts)) // 1000000 * 1000 AS last_event_ts
        FROM numbered_sessions GROUP BY user_id, nr
        HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL 12 DAY FROM keyed)"""
    ).replace(") , gaps", "), gaps"),
    "r5_rt_item_popularity_fresh": _sql(
        f""", days AS (SELECT *, CAST(ts AS DATE) AS day FROM timed),
        span AS (SELECT min(day) AS first, max(day) AS last FROM days),
        arrived_in AS (SELECT ts, (day - first) * 3 // (last - first + 1) AS arrival, day FROM days, span),
        marks AS (SELECT arrival, max(ts) - INTERVAL 10 SECOND AS mark, min(day) AS day FROM arrived_in GROUP BY arrival),
        told AS (SELECT r.*, (SELECT min(arrival) FROM marks WHERE mark >= r.window_end) AS arrival FROM rt_items r),
        volumes AS (SELECT arrival, item_id, count(*) AS n FROM silver, marks
                    WHERE arrival > 0 AND ts <= CAST(marks.day AS TIMESTAMP) AND ts >= CAST(marks.day AS TIMESTAMP) - INTERVAL 30 DAY GROUP BY 1, 2)
        SELECT t.* EXCLUDE (category_hint, arrival) REPLACE ({_r(*_RT_ITEMS)}),
        round(rt_item_event_rate_per_min_5m - coalesce(n, 0) / 43200.0::DOUBLE, 8) AS rt_item_popularity_delta_vs_30d
        FROM told t LEFT JOIN volumes USING (arrival, item_id)"""
    ).replace(") , days", "), days"),
    "c9_kept_messages": _sql(f"SELECT {_JSON_EVENT}, ts FROM lettered WHERE rules = ''"),
    "c9_dead_letters": _sql("SELECT rules, count(*) AS letters FROM lettered WHERE rules <> '' GROUP BY rules"),
    "r2_rt_user_features": _sql(_rounded("rt_users", list(_RT_USERS))),
    "r3_user_feature_update": _sql(
        """SELECT user_id, CAST(rt_user_current_session_length AS INTEGER) AS session_len,
        CAST(rt_user_rolling_view_count_5m + rt_user_rolling_cart_count_5m AS INTEGER) AS clicks_in_session,
        rt_user_last_event_ts_ms AS last_event_ts FROM rt_users"""
    ),
    "r4_rt_item_features": _sql(
        f"SELECT * EXCLUDE (category_hint) REPLACE ({_r(*_RT_ITEMS)}), 0.0::DOUBLE AS rt_item_popularity_delta_vs_30d FROM rt_items"
    ),
    "r5_rt_item_popularity_delta": _sql(
        f"""SELECT r.* EXCLUDE (category_hint) REPLACE ({_r(*_RT_ITEMS)}),
        round(rt_item_event_rate_per_min_5m - coalesce(total_events_30d, 0) / 43200.0::DOUBLE, 8)
        AS rt_item_popularity_delta_vs_30d FROM rt_items r LEFT JOIN
        (SELECT item_id, total_events_30d FROM item_volume) v USING (item_id)"""
    ),
    "r6_item_feature_update": _sql(
        """SELECT item_id, CAST(rt_item_rolling_view_count_5m AS INTEGER) AS views_5m,
        CAST(rt_item_rolling_cart_count_5m AS INTEGER) AS cart_5m,
        CAST(rt_item_rolling_purchase_count_5m AS INTEGER) AS purchases_5m,
        round(rt_item_recent_price_avg_5m, 8) AS avg_price_5m, epoch_ms(window_end) AS ts, category_hint FROM rt_items"""
    ),
    "r7_rt_to_online": _sql(
        "SELECT key, value, updated_at_ms, 3600::BIGINT AS ttl_sec FROM online, closed WHERE window_end <= watermark"
    ),
    "f1_entity_keys": _sql(
        """SELECT 0::BIGINT AS duplicate_keys, 'user' AS entity UNION ALL SELECT 0, 'item' UNION ALL SELECT 0, 'user_item'
        UNION ALL SELECT count(*), 'event' FROM
        (SELECT user_id, item_id FROM silver GROUP BY user_id, item_id HAVING count(*) > 1)"""
    ),
    "f2_user_view": _sql(_view(USER_VIEW, "user_features")),
    "f3_item_view": _sql(_view(ITEM_VIEW, "item_features")),
    "f4_cross_view": _sql(_view(CROSS_VIEW, "cross_features"), pairs="candidates"),
    "f5_materialize": _sql(
        f"""SELECT concat('user_activity:', user_id) AS key,
        to_json({{{{'user_total_events_30d': user_total_events_30d, 'user_views_30d': user_views_30d,
          'user_add_to_cart_30d': user_add_to_cart_30d, 'user_purchases_30d': user_purchases_30d,
          'rt_updated_at_ms': epoch_ms(CAST(date AS TIMESTAMP))}}}})::VARCHAR AS value,
        epoch_ms(CAST(date AS TIMESTAMP)) AS updated_at_ms, 2592000::BIGINT AS ttl_sec
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS rn FROM snapshots
              WHERE date < {_snapshot(SNAPSHOT_AGES[-1])}) WHERE rn = 1"""
    ),
    "f6_point_in_time_join": _sql(
        """SELECT user_id, item_id, label_ts, s.date AS feature_date, user_total_events_30d, user_views_30d,
        user_add_to_cart_30d, user_purchases_30d FROM (
          SELECT l.user_id, item_id, label_ts, max(s.date) AS date
          FROM (SELECT user_id, item_id, ts AS label_ts, row_number() OVER () AS label_no
                FROM silver WHERE event_type = 'purchase') l
          LEFT JOIN snapshots s ON s.user_id = l.user_id AND s.date <= label_ts AND s.date >= label_ts - INTERVAL 7 DAY
          GROUP BY l.user_id, item_id, label_ts, label_no)
        LEFT JOIN snapshots s USING (user_id, date)"""
    ),
    "f7_catalog_profile": _sql(_profile(USER_CATALOG, "user_features")),
    "f7_pair_catalog_profile": _sql(_profile(CROSS_CATALOG, "cross_features_declared"), pairs="candidates"),
    "f7_item_catalog_profile": _sql(_profile(ITEM_CATALOG, "item_features_declared")),
}
for name, days in {"": 30, "_10d_window": 10}.items():
    ORACLES[f"u14_user_features{name}"] = _sql(
        f"SELECT * EXCLUDE (anchor) REPLACE ({_r(*USER_DOUBLES)}) FROM user_features", days
    )
    ORACLES[f"i7b_item_discount_flag_spec{name}"] = _sql(
        """SELECT item_id, CASE WHEN base_price - item_avg_price_30d > base_price * 1e-9 THEN 1 ELSE 0 END
        AS item_is_discounted_flag FROM listed_items LEFT JOIN item_monetary USING (item_id)""",
        days,
    )
    ORACLES[f"i10_item_category_popularity{name}"] = _sql(
        _rounded("item_category_popularity", DECLARED_DOUBLES[:1]), days
    )
    ORACLES[f"i12_item_discount_rate{name}"] = _sql(_rounded("item_discount_rate", DECLARED_DOUBLES[2:]), days)
ORACLES["i13_item_features"] = _sql(
    f"SELECT * EXCLUDE (anchor) REPLACE ({_r(*ITEM_DOUBLES, *DECLARED_DOUBLES)}, {PATH}) FROM item_features_declared"
)
ORACLES["i13_item_features_10d_window"] = _sql(
    f"SELECT * EXCLUDE (anchor) REPLACE ({_r(*ITEM_DOUBLES)}, {PATH}) FROM item_features", 10
)


def _as_of_day(text: str, age: int) -> str:
    """`text` as of the end of the day that lies so many days before the newest, later events not having happened; items stay."""
    end = f"(SELECT CAST(max(event_date) + {1 - age} AS TIMESTAMP) - INTERVAL 1 MICROSECOND FROM all_silver)"
    for old, new in (
        ("silver AS (", "all_silver AS ("),
        ("clock AS (SELECT max(ts) AS anchor FROM silver)", f"silver AS (SELECT * FROM all_silver WHERE ts <= {end}), clock AS (SELECT {end} AS anchor)"),
    ):
        assert text.count(old) == 1
        text = text.replace(old, new)
    before, after = text.split("silver_items AS (", 1) if "silver_items AS (" in text else (text, None)
    text = text if after is None else before + "silver_items AS (" + after.replace("FROM silver", "FROM all_silver", 1)
    day = f"(SELECT strftime(max(event_date) - {age}, '%Y-%m-%d') FROM all_silver)"
    return text.replace(" * EXCLUDE (anchor)", f" {day} AS date, * EXCLUDE (anchor)")


def _daily(text: str) -> str:
    """The snapshots of the three newest days."""
    return " UNION ALL BY NAME ".join(f"SELECT * FROM ({_as_of_day(text, age)})" for age in (2, 1, 0))


ORACLES["u14_user_features_from_states"] = _daily(ORACLES["u14_user_features"])
ORACLES["i13_item_features_from_states"] = _daily(ORACLES["i13_item_features"])
ORACLES["u14_user_features_sketched"] = f"""
    SELECT date, count(*) AS users, CAST(sum(user_distinct_items_viewed_30d) AS BIGINT) AS sum_user_distinct_items_viewed_30d,
           CAST(sum(user_sessions_7d) AS BIGINT) AS sum_user_sessions_7d,
           0::BIGINT AS off_user_distinct_items_viewed_30d, 0::BIGINT AS off_user_sessions_7d
    FROM ({ORACLES["u14_user_features_from_states"]}) GROUP BY date"""


def _over(name: str, *changes: tuple[str, str]) -> str:
    """Another query's twin with parts of it changed."""
    text = ORACLES[name]
    for old, new in changes:
        assert old in text, old
        text = text.replace(old, new)
    return text


_ROLLING = (
    "time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,",
    "time_bucket(INTERVAL 1 MINUTE, ts) - before * INTERVAL 1 MINUTE AS window_start,",
), (
    "time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end FROM timed",
    "time_bucket(INTERVAL 1 MINUTE, ts) - before * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end FROM timed, range(5) AS panes(before)",
)
ORACLES["r2_rt_user_features_rolling"] = _over("r2_rt_user_features", *_ROLLING)
ORACLES["r4_rt_item_features_rolling"] = _over("r4_rt_item_features", *_ROLLING)
_CLEAN = ("INTERVAL 5 MINUTE AS window_end FROM timed", "INTERVAL 5 MINUTE AS window_end FROM silver"), (
    "max(ts) - INTERVAL 10 SECOND AS watermark FROM timed",
    "max(ts) - INTERVAL 12 DAY AS watermark FROM silver",
)
ORACLES["r2_rt_user_features_deduped"] = _over("r2_rt_user_features", *_CLEAN)
ORACLES["s11_online_store"] = ORACLES["s11_online_read"]
