"""User-item features.

Every operator works on a list of pairs and looks users and items up by key. The
default list is the observed pairs; callers may ask for any other pairs. A pair
that was never seen gets what it would get in a full user-by-item product, which
is therefore never built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import first_category, is_type
from cartwheel.functions.skew import SLICE, number_within, range_slices, spread
from cartwheel.functions.windows import EventClock
from cartwheel.schemas import EMBEDDING_DIMS, OLDEST_RECENCY_BUCKET, RECENCY_BUCKETS, WINDOW_DAYS
from cartwheel.scratch import write_table

PAIR = ["user_id", "item_id"]
LAST_SEEN = "ui_time_since_user_last_interaction_with_item_sec"
CO_VIEWS = "ui_user_item_co_views_30d"
TOP_CATEGORIES = ["user_top_category_1", "user_top_category_2", "user_top_category_3"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())


def base_pairs(events: DataFrame) -> DataFrame:
    """One row per (user, item, ts); of several the smallest (event_type, session_id) stays."""
    return (
        _keyed(events)
        .groupBy(*PAIR, "ts")
        .agg(F.min(F.struct("event_type", "session_id")).alias("kept"))
        .select(*PAIR, "ts", "kept.event_type", "kept.session_id")
    )


def observed_pairs(events: DataFrame) -> DataFrame:
    return _keyed(events).select(*PAIR).distinct()


def candidate_pairs(events: DataFrame, requested: DataFrame, *more: DataFrame) -> DataFrame:
    """Observed pairs and the pairs a caller asks for, each once."""
    found = observed_pairs(events)
    for pairs in (requested, *more):
        found = found.union(_keyed(pairs).select(*PAIR))
    return found.distinct()


def busiest_items(events: DataFrame, items: DataFrame, clock: EventClock, per_category: int, days: int = WINDOW_DAYS) -> DataFrame:
    """(category, item_id): the items with most window events among those whose path holds the category, ties by id.

    The rank is cut in every task before the shuffle, so a category that a third of
    all items belong to brings `per_category` rows per task to where it is ranked.
    """
    counts = _keyed(clock.recent(events, days)).groupBy("item_id").agg(F.count("*").alias("n"))
    filed = items.select("item_id", F.explode(F.array_distinct("category_path")).alias("category")).filter("category IS NOT NULL")
    by_events = Window.partitionBy("category").orderBy(F.desc("n"), "item_id")
    ranked = filed.join(counts, "item_id").withColumn("rank", F.row_number().over(by_events))
    return ranked.filter(F.col("rank") <= per_category).select("category", "item_id")


def category_pairs(
    events: DataFrame, users: DataFrame, items: DataFrame, clock: EventClock, per_category: int = 20, days: int = WINDOW_DAYS, salts: int = 16
) -> DataFrame:
    """Each user with the busiest items of their top three categories: at most three times `per_category` pairs a user.

    The items of a category travel as one short list, in `salts` copies, so that
    the users of a category that everyone prefers are dealt over as many tasks.
    """
    busiest = busiest_items(events, items, clock, per_category, days).groupBy("category").agg(F.collect_list("item_id").alias("listed"))
    busiest = busiest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    wanted = users.filter(F.col("user_id").isNotNull()).select("user_id", F.explode(F.array_compact(F.array(*TOP_CATEGORIES))).alias("category"))
    wanted = wanted.withColumn("salt", spread([F.col("user_id")], salts).cast("int"))
    met = wanted.join(busiest, ["category", "salt"]).select("user_id", F.explode("listed").alias("item_id"))
    return met.distinct()


def ui_recency(base: DataFrame, clock: EventClock) -> DataFrame:
    return _with_last_seen(base.groupBy(*PAIR).agg(F.max("ts").alias("last_ui_ts")), clock)


def _with_last_seen(seen: DataFrame, clock: EventClock) -> DataFrame:
    return seen.withColumn(LAST_SEEN, F.unix_timestamp(clock.as_of) - F.unix_timestamp("last_ui_ts"))


def _co_counts(where: Column | None = None) -> list[Column]:
    names = {"view": CO_VIEWS, "add_to_cart": "ui_user_item_co_carts_30d", "purchase": "ui_user_item_co_purchases_30d"}
    return [
        F.count_if(is_type(kind) if where is None else is_type(kind) & where).alias(name)
        for kind, name in names.items()
    ]


def ui_cooccurrence(base: DataFrame, clock: EventClock, days: int = WINDOW_DAYS) -> DataFrame:
    return base.filter(clock.within(days)).groupBy(*PAIR).agg(*_co_counts())


def _pair_history(base: DataFrame, clock: EventClock, days: int) -> DataFrame:
    """Recency and co-occurrence in one aggregate; counts are NULL for pairs without an event in the window."""
    in_window = clock.within(days)
    counts = _co_counts(in_window)
    totals = base.groupBy(*PAIR).agg(F.max("ts").alias("last_ui_ts"), *counts)
    # a pair has window events exactly if its newest event lies in the window
    recent = F.col("last_ui_ts") >= clock.cutoff(days)
    names = [c for c in totals.columns if c not in (*PAIR, "last_ui_ts")]
    return _with_last_seen(totals.withColumns({c: F.when(recent, F.col(c)) for c in names}), clock)


SESSION_ORDER = ["ts", "item_id", "event_type", "user_id"]


def session_slices(base: DataFrame) -> DataFrame:
    """`base` written in the order of sessions: a session of any size spreads over as many slices as it has rows for."""
    return range_slices(base, ["session_id"], SESSION_ORDER, "session-slices")


def session_positions(slices: DataFrame) -> DataFrame:
    """Adds `pos`, the 1-based index of each row in its session, to what `session_slices` returned."""
    return number_within(slices, ["session_id"], SESSION_ORDER, "pos")


def _pair_sessions(positions: DataFrame) -> DataFrame:
    return positions.groupBy(*PAIR, "session_id").agg(
        F.max("pos").alias("position"), F.count("*").alias("events"), F.max("ts").alias("ended")
    )


def ui_session_context(slices: DataFrame) -> DataFrame:
    """From the session in which the pair met most often: last position and number of meetings."""
    best = F.max(F.struct("events", "session_id", "position")).alias("best")
    return (
        _pair_sessions(session_positions(slices))
        .groupBy(*PAIR)
        .agg(best)
        .select(
            *PAIR,
            F.col("best.position").alias("ui_position_in_session"),
            F.col("best.events").alias("ui_session_event_count"),
        )
    )


def ui_session_context_spec(slices: DataFrame) -> DataFrame:
    """From the pair's latest session: last position, and the number of all events in that session."""
    latest = F.max(F.struct("ended", "session_id", "position")).alias("latest")
    totals = slices.groupBy("session_id").agg(F.count("*").alias("ui_session_event_count"))
    return (
        _pair_sessions(session_positions(slices))
        .groupBy(*PAIR)
        .agg(latest)
        .select(*PAIR, "latest.session_id", F.col("latest.position").alias("ui_position_in_session"))
        .join(totals.withColumnRenamed("session_id", "_session"), F.col("session_id").eqNullSafe(F.col("_session")))
        .select(*PAIR, "ui_position_in_session", "ui_session_event_count")
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def with_users(pairs: DataFrame, users: DataFrame, *columns: str) -> DataFrame:
    return pairs.join(users.select("user_id", *columns), "user_id")


def with_items(pairs: DataFrame, items: DataFrame, *columns: str) -> DataFrame:
    return pairs.join(items.select("item_id", *columns), "item_id")


def _match_flags() -> dict[str, Column]:
    top = F.col("user_top_category_1")
    return {
        "ui_same_category_flag": _flag(F.array_contains("category_path", top)),
        "ui_same_top_category_flag": _flag(first_category() == top),
    }


def ui_category_match(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Does the item's path hold the user's top category, and does it start with it?"""
    joined = with_items(with_users(pairs, users, "user_top_category_1"), items, "category_path")
    return joined.select(*PAIR, *[c.alias(name) for name, c in _match_flags().items()])


def ui_category_match_top3(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Does the item's path hold any of the user's top three categories?"""
    joined = with_items(with_users(pairs, users, *TOP_CATEGORIES), items, "category_path")
    top = F.array_compact(F.array(*TOP_CATEGORIES))
    return joined.select(*PAIR, _flag(F.arrays_overlap("category_path", top)).alias("ui_same_category_flag"))


def _price_columns() -> dict[str, Column]:
    difference = F.col("item_avg_price_30d") - F.col("user_avg_price_30d")
    deviation = F.col("user_price_std_30d")
    return {
        "ui_price_diff_from_user_avg": difference,
        "ui_price_zscore_for_user": F.when(deviation > 0, difference / deviation).otherwise(F.lit(0.0)),
    }


def ui_price_alignment(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    joined = with_items(
        with_users(pairs, users, "user_avg_price_30d", "user_price_std_30d"), items, "item_avg_price_30d"
    )
    return joined.select(*PAIR, *[c.alias(name) for name, c in _price_columns().items()])


def dot(left: Column, right: Column) -> Column:
    """Dot product of two arrays, summed from the left; NULL if either is NULL."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def embedding_array(prefix: str) -> Column:
    """The ten embedding columns as one array; NULL for an entity without an embedding."""
    columns = [F.col(f"{prefix}_{i}") for i in range(1, EMBEDDING_DIMS + 1)]
    return F.when(columns[0].isNotNull(), F.array(*columns))


def ui_similarity(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Dot product of the arrays `user_emb` and `item_emb` of each pair."""
    joined = with_items(with_users(pairs, users, "user_emb"), items, "item_emb")
    return joined.select(*PAIR, dot(F.col("user_emb"), F.col("item_emb")).alias("ui_user_item_similarity_emb"))


def recency_bucket() -> Column:
    buckets = reduce(
        lambda so_far, bound: so_far.when(F.col(LAST_SEEN) < bound[0], bound[1]),
        RECENCY_BUCKETS[1:],
        F.when(F.col(LAST_SEEN) < RECENCY_BUCKETS[0][0], RECENCY_BUCKETS[0][1]),
    )
    return buckets.otherwise(OLDEST_RECENCY_BUCKET)


def ui_recency_bucket(recency: DataFrame) -> DataFrame:
    return recency.withColumn("ui_recency_bucket", recency_bucket())


def exploration_score() -> Column:
    seen = 1.0 / (1.0 + F.log1p(F.col(CO_VIEWS).cast("double")))
    return F.when(F.col(CO_VIEWS).isNotNull(), seen).otherwise(F.lit(1.0))


def ui_exploration(cooccurrence: DataFrame) -> DataFrame:
    return cooccurrence.withColumn("ui_user_item_exploration_score", exploration_score())


def _affinity(
    pairs: DataFrame, events: DataFrame, labelled: DataFrame, clock: EventClock, days: int, out: str
) -> DataFrame:
    """Share of the user's window events that fall on items with the pair's item label."""
    return _share_of_label(pairs, _met(events, clock, days), labelled, out)


def _met(events: DataFrame, clock: EventClock, days: int) -> DataFrame:
    return _keyed(clock.recent(events, days)).groupBy(*PAIR).agg(F.count("*").alias("n"))


def _share_of_label(pairs: DataFrame, met: DataFrame, labelled: DataFrame, out: str) -> DataFrame:
    by_label = met.join(labelled, "item_id").groupBy("user_id", "label").agg(F.sum("n").alias("on_label"))
    by_user = met.groupBy("user_id").agg(F.sum("n").alias("total"))
    scores = by_label.join(by_user, "user_id").select(
        "user_id", "label", (F.col("on_label") / F.col("total")).alias(out)
    )
    return (
        pairs.join(labelled, "item_id", "left")
        .join(scores, ["user_id", "label"], "left")
        .select(*PAIR, F.coalesce(out, F.lit(0.0)).alias(out))
    )


def ui_category_affinity(
    pairs: DataFrame, events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS
) -> DataFrame:
    labelled = items.select("item_id", first_category().alias("label"))
    return _affinity(pairs, events, labelled, clock, days, "ui_category_affinity_score")


def ui_brand_affinity(
    pairs: DataFrame, events: DataFrame, items: DataFrame, clock: EventClock, days: int = WINDOW_DAYS
) -> DataFrame:
    labelled = items.select("item_id", F.col("brand").alias("label"))
    return _affinity(pairs, events, labelled, clock, days, "ui_brand_affinity_score")


def cross_features(
    events: DataFrame,
    users: DataFrame,
    items: DataFrame,
    clock: EventClock,
    pairs: DataFrame | None = None,
    days: int = WINDOW_DAYS,
    declared_only: bool = False,
) -> DataFrame:
    """All user-item features of `pairs` (default: observed pairs) whose user and item have features.

    `declared_only=True` adds the two affinities that the catalogue declares beyond the computed set. `users` and `items` are the two feature tables; similarity is added where both carry embeddings.
    Everything keyed by pair is joined first, on one partitioning; the user and item lookups follow.
    """
    events = clock.history(events)
    slices = session_slices(base_pairs(events))
    facts = _pair_history(slices.drop(SLICE), clock, days)
    if pairs is not None:
        facts = pairs.select(*PAIR).distinct().join(facts, PAIR, "left")
    facts = facts.join(ui_session_context(slices), PAIR, "left")
    derived = {**_price_columns(), **_match_flags()}

    user_columns = [F.col(c) for c in ("user_id", "user_avg_price_30d", "user_price_std_30d", "user_top_category_1")]
    item_columns = [F.col(c) for c in ("item_id", "item_avg_price_30d", "category_path")]
    if "user_behavior_emb_1" in users.columns and "item_behavior_emb_1" in items.columns:
        user_columns.append(embedding_array("user_behavior_emb").alias("user_emb"))
        item_columns.append(embedding_array("item_behavior_emb").alias("item_emb"))
        derived["ui_user_item_similarity_emb"] = dot(F.col("user_emb"), F.col("item_emb"))
    derived |= {"ui_user_item_exploration_score": exploration_score(), "ui_recency_bucket": recency_bucket()}

    features = (
        facts.join(users.select(*user_columns), "user_id")
        .join(items.select(*item_columns), "item_id")
        .select(*PAIR, *[c for c in facts.columns if c not in PAIR], *[c.alias(name) for name, c in derived.items()])
    )
    if not declared_only:
        return features
    features = write_table(features, "pair-features")  # read for the pairs of each affinity and for the features
    met = write_table(_met(events, clock, days), "pair-events")
    for label, out in ((first_category(), "ui_category_affinity_score"), (F.col("brand"), "ui_brand_affinity_score")):
        scores = _share_of_label(features.select(*PAIR), met, items.select("item_id", label.alias("label")), out)
        features = features.join(scores, PAIR)
    return features
