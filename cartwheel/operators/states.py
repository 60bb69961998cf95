"""Daily partial states: what a window needs of one day, kept so that windows are merged and never recounted.

A state row sums one day's events of a session, of a user's category, of a (user,
item) pair or of an item. Thirty days of states are merged into a snapshot; the run
of a day reads that day's events alone. What reaches back further than the window
(first and last times) is carried in one row per user or item from snapshot to
snapshot. Windows from states hold whole days: the day of the snapshot and
the `days - 1` before it.

Distinct counts and medians do not add up over days. The exact form merges the pairs
and sessions themselves; with `sketches` the states also hold mergeable sketches of a
fixed size, and `approximate` windows merge those instead.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import hour_in, is_type, last_time
from cartwheel.functions.windows import EventClock
from cartwheel.operators import items as item_side
from cartwheel.operators import users as user_side
from cartwheel.schemas import DEVICES, EVENING, MORNING, NIGHT, SHORT_WINDOW_DAYS, WINDOW_DAYS

DAY = "event_date"
USER, ITEM = "user_id", "item_id"
BANDS = {"morning": MORNING, "evening": EVENING, "night": NIGHT}
# distinct counts: relative standard error 1.04 / sqrt(2 ** HLL_BITS), at most 2 ** HLL_BITS bytes
HLL_BITS = 12
# medians: rank error below 1.7 % with 99 % confidence
KLL_SIZE = 200
ROUNDING = 1e-13


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count_if(is_type("view")).alias("views"),
        F.count_if(is_type("add_to_cart")).alias("carts"),
        F.count_if(is_type("purchase")).alias("purchases"),
        F.sum("price").alias("price_sum"),
        (F.var_pop("price") * F.count("price")).alias("price_m2"),
        F.max("price").alias("price_max"),
        F.min("price").alias("price_min"),
        F.max("ts").alias("ended"),
        F.min("ts").alias("began"),
        last_time("view").alias("viewed"),
        last_time("add_to_cart").alias("carted"),
        last_time("purchase").alias("purchased"),
        *[F.count_if(F.col("device") == d).alias(f"on_{d}") for d in DEVICES],
        *[F.count_if(hour_in(band)).alias(f"at_{name}") for name, band in BANDS.items()],
    ]


_ADD = ["n", "views", "carts", "purchases", "price_sum", *[f"on_{d}" for d in DEVICES], *[f"at_{b}" for b in BANDS]]
_LATEST = ["price_max", "ended", "viewed", "carted", "purchased"]


def _merged() -> list[Column]:
    """One state from several; squared deviations are those within the parts and those of the parts' means."""
    total, n = F.sum("price_sum"), F.sum("n")
    squares = F.sum(F.col("price_sum") * F.col("price_sum") / F.col("n"))
    between = squares - total * total / n
    # of equal means only rounding is left
    between = F.when(between > squares * ROUNDING, between).otherwise(0.0)
    return [
        *[F.sum(c).alias(c) for c in _ADD],
        *[F.max(c).alias(c) for c in _LATEST],
        (F.sum("price_m2") + between).alias("price_m2"),
        F.min("price_min").alias("price_min"),
        F.min("began").alias("began"),
    ]


def _price_columns(prefix: str) -> dict[str, Column]:
    deviation = F.sqrt(F.col("price_m2") / (F.col("n") - 1))
    return {
        f"{prefix}_avg_price_30d": F.col("price_sum") / F.col("n"),
        f"{prefix}_price_std_30d": F.when(F.col("n") > 1, deviation),
        f"{prefix}_max_price_30d": F.col("price_max"),
        f"{prefix}_min_price_30d": F.col("price_min"),
    }


def session_states(events: DataFrame) -> DataFrame:
    """(day, user, session): the sums of a session's events on one day."""
    return events.filter(F.col(USER).isNotNull()).groupBy(DAY, USER, "session_id").agg(*_sums())


def with_earlier_days(sessions: DataFrame, known: DataFrame | None) -> DataFrame:
    """Adds `before`: events of the session on earlier days, those of `known` states included.

    Only the sessions of the new days are looked up in `known`, which should hold as
    many days as a session may pause.
    """
    by = [USER, "session_id"]
    earlier = Window.partitionBy(*by).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    counted = sessions.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    if known is None:
        return counted
    last = known.groupBy(*by).agg(F.max_by(F.col("before") + F.col("n"), DAY).alias("_known"))
    return counted.join(last, by, "left").withColumn("before", F.col("before") + F.coalesce("_known", F.lit(0))).drop("_known")


def category_states(events: DataFrame) -> DataFrame:
    """(day, user, category, n)."""
    each = events.filter(F.col(USER).isNotNull()).select(DAY, USER, F.explode("category_path").alias("category"))
    return each.groupBy(DAY, USER, "category").agg(F.count("*").alias("n"))


def pair_states(events: DataFrame) -> DataFrame:
    """(day, user, item): events, views and purchases."""
    return events.groupBy(DAY, USER, ITEM).agg(
        F.count("*").alias("n"), F.count_if(is_type("view")).alias("views"), F.count_if(is_type("purchase")).alias("purchases")
    )


def item_states(events: DataFrame) -> DataFrame:
    """(day, item): the sums of an item's events on one day."""
    return events.filter(F.col(ITEM).isNotNull()).groupBy(DAY, ITEM).agg(*_sums())


def _hll(value: Column) -> Column:
    return F.hll_sketch_agg(value, HLL_BITS)


def user_sketches(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """(day, user): sketches of the day's items, sessions and session lengths. A session counts on each of its days."""
    held = pairs.filter(F.col(USER).isNotNull()).groupBy(DAY, USER).agg(_hll(F.col(ITEM)).alias("items"))
    met = sessions.groupBy(DAY, USER).agg(_hll(F.col("session_id")).alias("sessions"), F.kll_sketch_agg_bigint("n", KLL_SIZE).alias("lengths"))
    return held.join(met, [DAY, USER])


def item_sketches(pairs: DataFrame) -> DataFrame:
    """(day, item): sketches of the day's viewers and buyers."""
    named = F.col(USER).isNotNull()
    return pairs.filter(F.col(ITEM).isNotNull()).groupBy(DAY, ITEM).agg(
        _hll(F.when(named & (F.col("views") > 0), F.col(USER))).alias("viewers"),
        _hll(F.when(named & (F.col("purchases") > 0), F.col(USER))).alias("buyers"),
    )


def user_lives(sessions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per user: first and last times up to the newest day of `sessions`, carried on from `known`."""
    columns = {"ended": "last_ts", "began": "first_ts", "viewed": "last_view_ts", "carted": "last_cart_ts", "purchased": "last_purchase_ts"}
    return _lives(sessions, USER, columns, known)


def item_lives(states: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _lives(states, ITEM, {"ended": "last_ts", "viewed": "last_view_ts", "purchased": "last_purchase_ts"}, known)


def _lives(states: DataFrame, key: str, columns: dict[str, str], known: DataFrame | None) -> DataFrame:
    now = states.select(key, *[F.col(c).alias(n) for c, n in columns.items()])
    both = now if known is None else now.unionByName(known.select(*now.columns))
    return both.groupBy(key).agg(*[(F.min if n == "first_ts" else F.max)(n).alias(n) for n in columns.values()])


def in_days(states: DataFrame, last: Date, days: int) -> DataFrame:
    """The partitions of `days` days up to `last`."""
    day = F.lit(last)
    return states.filter(F.col(DAY).between(F.date_sub(day, days - 1), day))


def end_of(day: Date) -> Column:
    """The last moment of a day."""
    return F.date_add(F.lit(day), 1).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")


def day_clock(day: Date, as_of: Column | None = None) -> EventClock:
    """The clock under which a full rebuild gives the same windows."""
    return EventClock(end_of(day), end_of(day) if as_of is None else as_of, explicit=True)


def user_features_from_states(
    states: dict[str, DataFrame],
    lives: DataFrame,
    day: Date,
    as_of: Column | None = None,
    embeddings: DataFrame | None = None,
    days: int = WINDOW_DAYS,
    short_days: int = SHORT_WINDOW_DAYS,
    approximate: bool = False,
) -> DataFrame:
    """All user features of the `days` days up to `day`, with the columns of `user_features`.

    `states` holds sessions, categories and pairs, or user_sketches in place of pairs if `approximate`.
    """
    sessions = in_days(states["sessions"], day, days)
    in_short = F.when(F.col(DAY) > F.date_sub(F.lit(day), short_days), F.col("n"))
    latest = F.max(F.struct("ended", "session_id", (F.col("before") + F.col("n")).alias("length"))).alias("latest")
    whole = sessions.groupBy(USER, "session_id").agg(*_merged(), F.sum(in_short).alias("in_short"), latest)
    shares = [(F.sum(f"on_{d}") / F.sum("n")).alias(f"user_{d}_events_share_30d") for d in DEVICES]
    shares += [(F.sum(f"at_{b}") / F.sum("n")).alias(f"user_{b}_event_share_30d") for b in BANDS]
    window = whole.groupBy(USER).agg(
        *_merged(),
        *shares,
        *([F.avg("n").alias("user_avg_session_length_events_30d")] if approximate else user_side.length_stats(F.col("n"))),
        F.nullif(F.count_if(F.col("in_short") > 0), F.lit(0)).alias("user_sessions_7d"),
        F.max("latest").alias("latest"),
    )
    window = window.withColumns(
        {
            "user_total_events_30d": F.col("n"),
            "user_views_30d": F.col("views"),
            "user_add_to_cart_30d": F.col("carts"),
            "user_purchases_30d": F.col("purchases"),
            "user_events_last_session": F.col("latest.length"),
            **_price_columns("user"),
        }
    )
    kept = [c for c in window.columns if c == USER or c.startswith("user_")]
    counts = in_days(states["categories"], day, days).groupBy(USER, "category").agg(F.sum("n").alias("n"))
    features = user_side.user_conversion(window.select(*kept)).join(user_side.with_recency(lives, day_clock(day, as_of)), USER, "left")
    if approximate:
        features = features.drop("user_sessions_7d").join(_sketched_users(states["user_sketches"], day, days, short_days), USER, "left")
    else:
        held = in_days(states["pairs"], day, days).filter(F.col(USER).isNotNull()).groupBy(USER, ITEM).agg(F.sum("n").alias("n"))
        held = held.groupBy(USER).agg(F.count(ITEM).alias("user_distinct_items_viewed_30d"))
        features = features.join(held, USER, "left")
    features = (
        features.join(user_side.distinct_categories(counts), USER, "left")
        .join(user_side.top_three(counts), USER, "left")
        .fillna(0, ["user_distinct_categories_viewed_30d", "user_distinct_items_viewed_30d"])
    )
    return features if embeddings is None else features.join(embeddings, USER, "left")


def _sketched_users(sketches: DataFrame, day: Date, days: int, short_days: int) -> DataFrame:
    recent = F.col(DAY) > F.date_sub(F.lit(day), short_days)
    merged = in_days(sketches, day, days).groupBy(USER).agg(
        F.hll_union_agg("items").alias("items"),
        F.hll_union_agg(F.when(recent, F.col("sessions"))).alias("sessions"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
    )
    return merged.select(
        USER,
        F.hll_sketch_estimate("items").alias("user_distinct_items_viewed_30d"),
        F.nullif(F.hll_sketch_estimate("sessions"), F.lit(0)).alias("user_sessions_7d"),
        F.kll_sketch_get_quantile_bigint("lengths", F.lit(0.5)).cast("double").alias("user_median_session_length_events_30d"),
    )


def item_features_from_states(
    states: dict[str, DataFrame],
    lives: DataFrame,
    items: DataFrame,
    day: Date,
    as_of: Column | None = None,
    embeddings: DataFrame | None = None,
    days: int = WINDOW_DAYS,
    declared_only: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """All item features of the `days` days up to `day`, with the columns of `item_features`.

    `states` holds items and pairs, or item_sketches in place of pairs if `approximate`.
    """
    window = in_days(states["items"], day, days).groupBy(ITEM).agg(*_merged())
    window = window.withColumns(
        {
            "item_views_30d": F.col("views"),
            "item_carts_30d": F.col("carts"),
            "item_purchases_30d": F.col("purchases"),
            "total_events_30d": F.col("n"),
            "item_morning_view_share_30d": F.col("at_morning") / F.col("n"),
            "item_evening_view_share_30d": F.col("at_evening") / F.col("n"),
            **_price_columns("item"),
        }
    )
    window = window.select(*[c for c in window.columns if c.startswith("item_") or c == "total_events_30d"])
    window = window.transform(item_side.item_rates).transform(item_side.item_log_popularity)
    names = ("item_distinct_users_viewed_30d", "item_distinct_users_purchased_30d")
    if approximate:
        merged = in_days(states["item_sketches"], day, days).groupBy(ITEM)
        distinct = merged.agg(
            *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(n) for c, n in zip(("viewers", "buyers"), names, strict=True)]
        )
    else:
        per_user = in_days(states["pairs"], day, days).groupBy(ITEM, USER).agg(F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))
        distinct = item_side.distinct_users(per_user)
    return item_side.assemble(window, distinct, item_side.with_recency(lives, day_clock(day, as_of)), items, embeddings, declared_only)


def day_states(events: DataFrame, known_sessions: DataFrame | None = None, sketches: bool = False) -> dict[str, DataFrame]:
    """The states of every day in `events` by name. Days must be whole, and after those of `known_sessions`."""
    pairs, sessions = pair_states(events), session_states(events)
    states = {
        "sessions": with_earlier_days(sessions, known_sessions),
        "categories": category_states(events),
        "pairs": pairs,
        "items": item_states(events),
    }
    if sketches:
        states |= {"user_sketches": user_sketches(pairs, sessions), "item_sketches": item_sketches(pairs)}
    return states
