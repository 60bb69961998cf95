"""One registered query per operator, over the retail events derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.windows import EventClock, event_clock, window_bounds
from cartwheel.operators import cleaning, entities, items, pairs, text, users, views
from cartwheel.plans.daily import DailyJobs
from cartwheel.plans.retail_tables import catalog, numbered_events, raw_event_stream, raw_events, raw_events_without_paths, table
from cartwheel.schemas import (
    CROSS_CATALOG,
    CROSS_VIEW,
    ITEM_CATALOG,
    ITEM_VIEW,
    USER_CATALOG,
    USER_KEY_PREFIX,
    USER_VIEW,
    FeatureView,
)
from cartwheel.scratch import new_path, write_table
from cartwheel.session import prepare
from cartwheel.sources import online, streams, tables
from cartwheel.streaming import features as rt
from cartwheel.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# dated snapshots used below: so many days before the newest day of the clean events
SNAPSHOT_AGES = (20, 10, 0)
SNAPSHOT_VIEW = FeatureView("user_activity", ("user_id",), 30, USER_VIEW.fields[:4])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: presentable(build(prepare(spark), sf_dir))
        return build

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Values two engines print alike: doubles to 8 places (and no -0.0), zone-free times, paths as text."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return (F.round(column, 8) + F.lit(0.0)).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.when(column.isNotNull(), F.concat_ws(" > ", column)).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


# ---- shared inputs ----


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_events(raw_events(spark, sf_dir))


def silver_clock(spark: SparkSession, sf_dir: str) -> EventClock:
    """The clean table's clock. Neither copies nor categories move the newest time, so both are left out."""
    return event_clock(cleaning.clean_rows(raw_events_without_paths(spark, sf_dir)))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events written once, for queries that read them several times."""
    return write_table(silver(spark, sf_dir), "silver-events")


def catalogued_items(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    listed = catalog(spark, sf_dir).select("item_id", "title", "brand")
    return entities.silver_items_with_catalog(entities.silver_items(events), listed)


def finished(start: Callable[[str, str], object], spark: SparkSession, name: str) -> str:
    """Run a stream over everything available and return the folder it wrote."""
    path, checkpoint = new_path(spark, name), new_path(spark, f"{name}-checkpoint")
    start(path, checkpoint).awaitTermination()
    return path


def streamed(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = finished(lambda p, c: sinks.table_sink(rows, p, c), spark, name)
    return spark.read.schema(rows.schema).parquet(path)


# ---- sources and sinks ----


@query("s1_bronze_scan")
def _(spark, sf_dir):
    raw, path = raw_events(spark, sf_dir), new_path(spark, "bronze")
    by_day = raw.withColumn("day", F.to_date(F.timestamp_millis("ts")))
    by_day.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return tables.bronze_scan(spark, path, raw.schema)


@query("s2_table_scan")
def _(spark, sf_dir):
    path = new_path(spark, "silver")
    tables.write_entity_table(silver(spark, sf_dir), path)
    return tables.table_scan(spark, path)


def json_messages(raw: DataFrame, ts) -> DataFrame:
    fields = ["user_id", "session_id", "item_id", "event_type", F.col("price").cast("float").alias("price")]
    fields += ["category_path", "device", "page", "referrer", ts.alias("ts")]
    return raw.select(F.to_json(F.struct(*fields)).alias("value"))


@query("s3_event_stream_source")
def _(spark, sf_dir):
    iso = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return streamed(streams.decode_json_events(json_messages(raw_event_stream(spark, sf_dir), iso)), "decoded")


@query("s4_decode_events")
def _(spark, sf_dir):
    return streams.decode_json_events(json_messages(raw_events(spark, sf_dir), F.col("ts")))


@query("s5_feature_source")
def _(spark, sf_dir):
    return tables.feature_source(spark, snapshot_table(spark, sf_dir)[0])


@query("s6_write_silver_events")
def _(spark, sf_dir):
    """All days, then the newest one again without its views: the other days stay."""
    path, events = new_path(spark, "silver"), stored_silver(spark, sf_dir)
    tables.write_silver_events(events, path, replace_all=True)
    newest = events.filter(F.col("event_date") == events.agg(F.max("event_date")).scalar())
    tables.write_silver_events(newest.filter("event_type <> 'view' OR event_hour > 1"), path)
    return tables.table_scan(spark, path)


@query("s7_write_entity_table")
def _(spark, sf_dir):
    path = new_path(spark, "items")
    tables.write_entity_table(entities.silver_items(silver(spark, sf_dir)), path)
    return tables.table_scan(spark, path)


@query("s8_write_gold_snapshot")
def _(spark, sf_dir):
    """Three dates, then the first one again with another anchor: only that date changes."""
    path, events, dates = snapshot_table(spark, sf_dir)
    rebuilt = users.user_volume(events, event_clock(events, anchor=dates[0] - timedelta(days=5)))
    tables.write_gold_snapshot(rebuilt, path, f"{dates[0]:%Y-%m-%d}")
    return tables.table_scan(spark, path)


def snapshot_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, list[datetime]]:
    """Folder of the snapshots, the events they come from, and their dates; a snapshot knows the events up to its midnight."""
    path = new_path(spark, "gold-users")
    events = stored_silver(spark, sf_dir)
    newest = events.agg(F.max(F.to_date("ts")).cast("string")).first()[0]
    dates = [datetime.fromisoformat(newest) - timedelta(days=age) for age in SNAPSHOT_AGES]
    for date in dates:
        tables.write_gold_snapshot(users.user_volume(events, event_clock(events, anchor=date)), path, f"{date:%Y-%m-%d}")
    return path, events, dates


@query("s9_raw_archive_sink")
def _(spark, sf_dir):
    """Also events that lack a user or a time: the archive keeps what came."""
    raw = raw_event_stream(spark, sf_dir).withColumns(
        {
            "user_id": F.when((F.col("device") != "ios") | (F.col("page") != "cart"), F.col("user_id")),
            "ts": F.when((F.col("device") != "android") | (F.col("page") != "home"), F.col("ts")),
        }
    )
    path = finished(lambda p, c: sinks.raw_archive_sink(raw, p, c, every=None), spark, "raw-archive")
    return spark.read.parquet(path)


def batch_online_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cleaning.normalize_ts(raw_events(spark, sf_dir))
    recent = rt.rt_user_features(raw, as_of=F.col("window_end")).withColumn(
        "rt_updated_at_ms", F.unix_millis("window_end")
    )
    return online.online_rows(recent.drop("window_start", "window_end"), ["user_id"], USER_KEY_PREFIX)


@query("s10_online_upsert")
def _(spark, sf_dir):
    """Two writers that use the same batch number, and a batch that is written twice."""
    path = new_path(spark, "online")
    rows = write_table(batch_online_rows(spark, sf_dir), "online-rows")
    online.online_upsert(rows, path, 7, "first")
    online.online_upsert(rows, path, 7, "second")
    online.online_upsert(rows, path, 7, "first")
    return online.online_log(spark, path)


@query("s11_online_read")
def _(spark, sf_dir):
    """Two batches, read three days after the newest: only keys written within their day-long TTL are live."""
    rows = write_table(batch_online_rows(spark, sf_dir).withColumn("ttl_sec", F.lit(86400).cast("bigint")), "online-rows")
    path = new_path(spark, "online")
    middle = rows.agg(((F.min("updated_at_ms") + F.max("updated_at_ms")) / 2).cast("bigint")).scalar()
    online.online_upsert(rows.filter(F.col("updated_at_ms") < middle), path, 0)
    online.online_upsert(rows.filter(F.col("updated_at_ms") >= middle), path, 1)
    newest = rows.agg(F.max("updated_at_ms")).scalar()
    return online.online_read(online.online_log(spark, path), newest)


@query("s11_online_store")
def _(spark, sf_dir):
    """Four batches of two writers with two compactions between them, the older batches removed; read as in s11_online_read."""
    rows = write_table(batch_online_rows(spark, sf_dir).withColumn("ttl_sec", F.lit(86400).cast("bigint")), "online-rows")
    store = online.OnlineStore(spark, new_path(spark, "online-store"), buckets=4)
    first, last = rows.agg(F.min("updated_at_ms"), F.max("updated_at_ms")).first()
    part = F.floor((F.col("updated_at_ms") - first) * 4 / (last - first + 1))
    for number in (1, 0, 2, 3):
        store.upsert(rows.filter(part == number), number // 2, f"writer-{number % 2}")
        if number in (0, 2):
            store.compact(as_of_ms=last)
    store.vacuum()
    return store.read(last)


# ---- cleaning ----


@query("c1_drop_broken")
def _(spark, sf_dir):
    return cleaning.drop_broken(raw_events(spark, sf_dir))


@query("c2_normalize_ts")
def _(spark, sf_dir):
    return cleaning.normalize_ts(raw_events(spark, sf_dir))


@query("c3_typed_projection")
def _(spark, sf_dir):
    return cleaning.typed_projection(cleaning.normalize_ts(raw_events(spark, sf_dir)))


@query("c4_drop_null_keys_price")
def _(spark, sf_dir):
    return cleaning.drop_null_keys_price(cleaning.normalize_ts(raw_events(spark, sf_dir)))


@query("c5_sanitize_categoricals")
def _(spark, sf_dir):
    return cleaning.sanitize_categoricals(cleaning.normalize_ts(raw_events(spark, sf_dir)))


@query("c6_date_hour")
def _(spark, sf_dir):
    return cleaning.date_hour(cleaning.normalize_ts(raw_events(spark, sf_dir)))


@query("c7_dedupe_events")
def _(spark, sf_dir):
    return cleaning.dedupe_events(cleaning.normalize_ts(raw_events(spark, sf_dir)))


@query("c8_silver_events")
def _(spark, sf_dir):
    return silver(spark, sf_dir)


@query("c9_event_contract_report")
def _(spark, sf_dir):
    return cleaning.event_contract_report(raw_events(spark, sf_dir))


@query("c9_contract_quarantine")
def _(spark, sf_dir):
    return cleaning.split_by_contract(raw_events(spark, sf_dir))[1]


@query("c10_base_pairs")
def _(spark, sf_dir):
    return pairs.base_pairs(silver(spark, sf_dir))


@query("c11_window_anchor")
def _(spark, sf_dir):
    return window_bounds(cleaning.clean_rows(raw_events(spark, sf_dir)))


@query("c12_split_windows")
def _(spark, sf_dir):
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    windows = {"all": clock.history(events)}
    windows |= {f"{days}d": clock.recent(events, days) for days in (30, 10, 7)}
    counted = [
        rows.groupBy("event_type").agg(F.count("*").alias("events"), F.min("ts").alias("first_ts")).withColumn(
            "window", F.lit(name)
        )
        for name, rows in windows.items()
    ]
    return counted[0].union(counted[1]).union(counted[2]).union(counted[3])


# ---- entities ----


@query("e1_silver_users")
def _(spark, sf_dir):
    return entities.silver_users(silver(spark, sf_dir))


@query("e2_silver_items")
def _(spark, sf_dir):
    return entities.silver_items(silver(spark, sf_dir))


@query("e3_silver_items_catalog")
def _(spark, sf_dir):
    return catalogued_items(spark, sf_dir, silver(spark, sf_dir))


# ---- users ----


def _on_users(name: str, build: Callable[[DataFrame, EventClock], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: build(silver(spark, sf_dir), silver_clock(spark, sf_dir)))


_on_users("u1_user_volume", users.user_volume)
_on_users("u2_user_diversity", users.user_diversity)
_on_users("u3_user_conversion", lambda events, clock: users.user_conversion(users.user_volume(events, clock)))
_on_users("u4_user_monetary", users.user_monetary)
_on_users("u5_user_recency", users.user_recency)
_on_users("u6_user_sessions", users.user_sessions)
_on_users("u7_user_last_session", users.user_last_session)
_on_users("u8_user_sessions_7d", users.user_sessions_7d)
_on_users("u9_user_device_mix", users.user_device_mix)
_on_users("u10_user_temporal_mix", users.user_temporal_mix)
_on_users("u11_user_top_categories", users.user_top_categories)
_on_users("u12_user_category_docs", users.user_category_docs)


@query("u13_user_embedding")
def _(spark, sf_dir):
    docs = users.user_category_docs(silver(spark, sf_dir), silver_clock(spark, sf_dir))
    return text.embed(docs, "user_id", "user_behavior_emb")


@query("u13_user_hashed_tokens")
def _(spark, sf_dir):
    """What the vectors are made of: hashing keeps every token of a user."""
    docs = users.user_category_docs(silver(spark, sf_dir), silver_clock(spark, sf_dir))
    return text.hashed_counts(docs, "user_id").groupBy("user_id").agg(F.sum("tf").alias("tokens"))


@query("i9_item_hashed_tokens")
def _(spark, sf_dir):
    docs = text.item_documents(catalogued_items(spark, sf_dir, silver(spark, sf_dir)))
    return text.hashed_counts(docs, "item_id").groupBy("item_id").agg(F.sum("tf").alias("tokens"))


def gold_users(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    return users.user_features(stored_silver(spark, sf_dir), silver_clock(spark, sf_dir), days=days)


@query("u14_user_features")
def _(spark, sf_dir):
    return gold_users(spark, sf_dir)


@query("u14_user_features_10d_window")
def _(spark, sf_dir):
    return gold_users(spark, sf_dir, days=10)


USER_STATES = ("sessions", "categories", "pairs")


def increments(spark: SparkSession, sf_dir: str, build: Callable[[DailyJobs], None], only: tuple[str, ...], *names: str, sketches: bool = False) -> list[DataFrame]:
    """Tables of three snapshots, from states that were filled up to the fourth newest day at once and then three times by a day."""
    root, events = new_path(spark, "lake"), silver(spark, sf_dir)
    tables.write_silver_events(events, f"{root}/silver/events")
    events = tables.table_scan(spark, f"{root}/silver/events")
    tables.write_entity_table(catalogued_items(spark, sf_dir, events), f"{root}/silver/items")
    first, newest = (datetime.fromisoformat(x) for x in events.agg(F.min("event_date").cast("string"), F.max("event_date").cast("string")).first())
    DailyJobs(spark, root, f"{newest - timedelta(days=3):%Y-%m-%d}").day_states(first=f"{first:%Y-%m-%d}", sketches=sketches, only=only)
    for age in (2, 1, 0):
        jobs = DailyJobs(spark, root, f"{newest - timedelta(days=age):%Y-%m-%d}")
        jobs.day_states(sketches=sketches, only=only)
        build(jobs)
    return [tables.table_scan(spark, f"{root}/{name}").withColumn("date", F.col("date").cast("string")) for name in names]


@query("u14_user_features_from_states")
def _(spark, sf_dir):
    return increments(spark, sf_dir, lambda jobs: jobs.gold_users_from_states(), USER_STATES, "gold/user_features")[0]


@query("u14_user_features_sketched")
def _(spark, sf_dir):
    """Estimates from merged sketches: those off by over five standard errors and one."""

    def both_forms(jobs: DailyJobs) -> None:
        jobs.gold_users_from_states()
        jobs.gold_users_from_states(approximate=True, name="gold/user_features_sketched")

    exact, found = increments(spark, sf_dir, both_forms, USER_STATES, "gold/user_features", "gold/user_features_sketched", sketches=True)
    names = ["user_distinct_items_viewed_30d", "user_sessions_7d"]
    both = exact.select("user_id", "date", *names).join(found.select("user_id", "date", *[F.col(n).alias(f"est_{n}") for n in names]), ["user_id", "date"])
    off = [F.count_if(~(F.abs(F.col(f"est_{n}") - F.col(n)) <= 1 + 0.0813 * F.col(n))).alias(f"off_{n}") for n in names]
    return both.groupBy("date").agg(F.count("*").alias("users"), *[F.sum(n).alias(f"sum_{n}") for n in names], *off)


@query("i13_item_features_from_states")
def _(spark, sf_dir):
    return increments(spark, sf_dir, lambda jobs: jobs.gold_items_from_states(declared_only=True), ("items", "pairs"), "gold/item_features")[0]


# ---- items ----


def _on_items(name: str, build: Callable[[DataFrame, EventClock], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: build(silver(spark, sf_dir), silver_clock(spark, sf_dir)))


_on_items("i1_item_volume", items.item_volume)
_on_items("i2_item_rates", lambda events, clock: items.item_rates(items.item_volume(events, clock)))
_on_items("i3_item_log_popularity", lambda events, clock: items.item_log_popularity(items.item_volume(events, clock)))
_on_items("i4_item_monetary", items.item_monetary)
_on_items("i5_item_distinct_users", items.item_distinct_users)
_on_items("i6_item_recency", items.item_recency)
_on_items("i8_item_temporal", items.item_temporal)
_on_items("i8_item_temporal_views_only", lambda events, clock: items.item_temporal(events, clock, views_only=True))


@query("i7_item_content")
def _(spark, sf_dir):
    return items.item_content(catalogued_items(spark, sf_dir, silver(spark, sf_dir)))


def _with_catalog(name: str, build: Callable[..., DataFrame]) -> None:
    @query(name)
    def _(spark, sf_dir):
        events = stored_silver(spark, sf_dir)
        return build(events, catalogued_items(spark, sf_dir, events), silver_clock(spark, sf_dir))


_with_catalog("i7b_item_discount_flag_spec", items.item_discount_flag_spec)
_with_catalog("i10_item_category_popularity", items.item_category_popularity)
_with_catalog("i11_item_brand_popularity", items.item_brand_popularity)
_with_catalog("i12_item_discount_rate", items.item_discount_rate)
_with_catalog("i7b_item_discount_flag_spec_10d_window", partial(items.item_discount_flag_spec, days=10))
_with_catalog("i10_item_category_popularity_10d_window", partial(items.item_category_popularity, days=10))
_with_catalog("i12_item_discount_rate_10d_window", partial(items.item_discount_rate, days=10))


@query("i9_item_embedding")
def _(spark, sf_dir):
    docs = text.item_documents(catalogued_items(spark, sf_dir, silver(spark, sf_dir)))
    return text.embed(docs, "item_id", "item_behavior_emb")


def gold_items(spark: SparkSession, sf_dir: str, days: int = 30, declared_only: bool = False) -> DataFrame:
    events = stored_silver(spark, sf_dir)
    catalogued = catalogued_items(spark, sf_dir, events)
    return items.item_features(
        events, catalogued, silver_clock(spark, sf_dir), days=days, declared_only=declared_only
    )


@query("i13_item_features")
def _(spark, sf_dir):
    return gold_items(spark, sf_dir, declared_only=True)


@query("i13_item_features_10d_window")
def _(spark, sf_dir):
    return gold_items(spark, sf_dir, days=10)


@query("t1_tfidf_terms")
def _(spark, sf_dir):
    docs = users.user_category_docs(silver(spark, sf_dir), silver_clock(spark, sf_dir))
    return text.tfidf_terms(docs, "user_id")


@query("t1_tfidf_item_terms")
def _(spark, sf_dir):
    return text.tfidf_terms(text.item_documents(catalogued_items(spark, sf_dir, silver(spark, sf_dir))), "item_id")


# ---- pairs ----


@query("x1_ui_recency")
def _(spark, sf_dir):
    return pairs.ui_recency(pairs.base_pairs(silver(spark, sf_dir)), silver_clock(spark, sf_dir))


@query("x2_ui_cooccurrence")
def _(spark, sf_dir):
    return pairs.ui_cooccurrence(pairs.base_pairs(silver(spark, sf_dir)), silver_clock(spark, sf_dir))


@query("x2_ui_cooccurrence_10d_window")
def _(spark, sf_dir):
    return pairs.ui_cooccurrence(pairs.base_pairs(silver(spark, sf_dir)), silver_clock(spark, sf_dir), days=10)


def _sessions(name: str, build: Callable[[DataFrame], DataFrame], merged: bool = False) -> None:
    @query(name)
    def _(spark, sf_dir):
        base = pairs.base_pairs(silver(spark, sf_dir))
        # one session for all users is longer than any slice
        return build(pairs.session_slices(base.withColumn("session_id", F.lit("s_all")) if merged else base))


_sessions("x3_ui_session_context", pairs.ui_session_context)
_sessions("x3_ui_session_context_split_sessions", pairs.ui_session_context)
_sessions("x3_ui_session_context_one_session", pairs.ui_session_context, merged=True)
_sessions("x3b_ui_session_context_spec", pairs.ui_session_context_spec)


def requested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of failed page loads: the user asked for the item, but no clean event may exist."""
    return raw_events(spark, sf_dir).filter(F.col("event_type") == "error").select("user_id", "item_id")


@query("x12_candidate_pairs")
def _(spark, sf_dir):
    return pairs.candidate_pairs(silver(spark, sf_dir), requested_pairs(spark, sf_dir))


@query("x12_candidate_pairs_by_category")
def _(spark, sf_dir):
    """Observed and requested pairs, and each user's top categories' five busiest items."""
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    by_category = pairs.category_pairs(events, users.user_top_categories(events, clock), entities.silver_items(events), clock, per_category=5)
    return pairs.candidate_pairs(events, requested_pairs(spark, sf_dir), by_category)


@query("x12_busiest_items_10d_window")
def _(spark, sf_dir):
    events = stored_silver(spark, sf_dir)
    return pairs.busiest_items(events, entities.silver_items(events), silver_clock(spark, sf_dir), per_category=5, days=10)


def _match(name: str, build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> None:
    @query(name)
    def _(spark, sf_dir):
        events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
        wanted = pairs.candidate_pairs(events, requested_pairs(spark, sf_dir))
        top = users.user_top_categories(events, clock)
        return build(wanted, top, entities.silver_items(events))


_match("x4_ui_category_match", pairs.ui_category_match)
_match("x4b_ui_category_match_top3", pairs.ui_category_match_top3)


@query("x5_ui_price_alignment")
def _(spark, sf_dir):
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    wanted = pairs.candidate_pairs(events, requested_pairs(spark, sf_dir))
    return pairs.ui_price_alignment(wanted, users.user_monetary(events, clock), items.item_monetary(events, clock))


@query("x6_ui_similarity")
def _(spark, sf_dir):
    """Dot product of given vectors: users and items take the vector of their number."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("emb"))
    user_side = vectors.select(F.concat(F.lit("u_"), "vec_id").alias("user_id"), F.col("emb").alias("user_emb"))
    item_side = vectors.select(F.concat(F.lit("i_"), "vec_id").alias("item_id"), F.col("emb").alias("item_emb"))
    return pairs.ui_similarity(pairs.observed_pairs(silver(spark, sf_dir)), user_side, item_side)


@query("x6_ui_similarity_fitted")
def _(spark, sf_dir):
    """Dot product of the fitted user and item embeddings."""
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    user_side = text.embed(users.user_category_docs(events, clock), "user_id", "user_behavior_emb")
    docs = text.item_documents(catalogued_items(spark, sf_dir, events))
    item_side = text.embed(docs, "item_id", "item_behavior_emb")
    return pairs.ui_similarity(
        pairs.observed_pairs(events),
        user_side.withColumn("user_emb", pairs.embedding_array("user_behavior_emb")),
        item_side.withColumn("item_emb", pairs.embedding_array("item_behavior_emb")),
    )


@query("x6_ui_similarity_shared_fit")
def _(spark, sf_dir):
    """Dot product of embeddings that share one fitted basis."""
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    sides = text.embed_together(
        {
            "user_behavior_emb": (users.user_category_docs(events, clock), "user_id"),
            "item_behavior_emb": (text.item_documents(catalogued_items(spark, sf_dir, events)), "item_id"),
        }
    )
    return pairs.ui_similarity(
        pairs.observed_pairs(events),
        sides["user_behavior_emb"].withColumn("user_emb", pairs.embedding_array("user_behavior_emb")),
        sides["item_behavior_emb"].withColumn("item_emb", pairs.embedding_array("item_behavior_emb")),
    )


@query("x7_ui_recency_bucket")
def _(spark, sf_dir):
    recency = pairs.ui_recency(pairs.base_pairs(silver(spark, sf_dir)), silver_clock(spark, sf_dir))
    wanted = requested_pairs(spark, sf_dir).distinct()
    return pairs.ui_recency_bucket(wanted.join(recency, pairs.PAIR, "full"))


@query("x8_ui_exploration")
def _(spark, sf_dir):
    counts = pairs.ui_cooccurrence(pairs.base_pairs(silver(spark, sf_dir)), silver_clock(spark, sf_dir))
    wanted = requested_pairs(spark, sf_dir).distinct()
    return pairs.ui_exploration(wanted.join(counts, pairs.PAIR, "full"))


def _affinity(name: str, build: Callable[..., DataFrame]) -> None:
    @query(name)
    def _(spark, sf_dir):
        events = stored_silver(spark, sf_dir)
        wanted = pairs.candidate_pairs(events, requested_pairs(spark, sf_dir))
        return build(wanted, events, catalogued_items(spark, sf_dir, events), silver_clock(spark, sf_dir))


_affinity("x9_ui_category_affinity", pairs.ui_category_affinity)
_affinity("x10_ui_brand_affinity", pairs.ui_brand_affinity)


def gold_pairs(spark: SparkSession, sf_dir: str, requested: bool, days: int = 30, declared_only: bool = False) -> DataFrame:
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    user_side = write_table(users.user_features(events, clock, days=days), "user-features")
    item_side = write_table(
        items.item_features(events, catalogued_items(spark, sf_dir, events), clock, days=days), "item-features"
    )
    wanted = pairs.candidate_pairs(events, requested_pairs(spark, sf_dir)) if requested else None
    return pairs.cross_features(events, user_side, item_side, clock, wanted, days, declared_only)


@query("x11_cross_features")
def _(spark, sf_dir):
    return gold_pairs(spark, sf_dir, requested=False)


@query("x11_cross_features_requested_pairs")
def _(spark, sf_dir):
    return gold_pairs(spark, sf_dir, requested=True)


@query("x11_cross_features_declared")
def _(spark, sf_dir):
    return gold_pairs(spark, sf_dir, requested=True, declared_only=True)


@query("x11_cross_features_10d_window")
def _(spark, sf_dir):
    return gold_pairs(spark, sf_dir, requested=True, days=10)


# ---- streams: every one runs from the source file to a table ----


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.watermark(cleaning.normalize_ts(raw_event_stream(spark, sf_dir)))


def by_thirds(spark: SparkSession, sf_dir: str, late: Column) -> DataFrame:
    """Raw events with the number of their arrival: the third of all days they lie in, and one more where they are `late`."""
    events = cleaning.normalize_ts(numbered_events(spark, sf_dir))
    first, last = (events.agg(end(F.to_date("ts"))).scalar() for end in (F.min, F.max))
    third = F.floor(F.datediff(F.to_date("ts"), first) * 3 / (F.datediff(last, first) + 1)).cast("int")
    return write_table(events.withColumn("arrival", third + F.when(late, 1).otherwise(0)), "arrivals")


# rows of a landed file: text packs so well that a file of a few megabytes may hold millions, and one task would read them all
LANDED_ROWS = 50_000


def in_arrivals(arrivals: DataFrame, run: Callable[[DataFrame, int], object]) -> None:
    """Files land arrival by arrival; the stream stops after each and resumes from its checkpoint."""
    spark, landing = arrivals.sparkSession, new_path(arrivals.sparkSession, "landing")
    for number in range(4):
        arrivals.filter(F.col("arrival") == number).drop("arrival").write.mode("append").option("maxRecordsPerFile", LANDED_ROWS).parquet(landing)
        run(streams.file_event_stream(spark, landing, arrivals.drop("arrival").schema), number).awaitTermination()


def streamed_in_arrivals(arrivals: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    spark = arrivals.sparkSession
    path, checkpoint, schema = new_path(spark, name), new_path(spark, f"{name}-checkpoint"), []

    def run(stream: DataFrame, number: int):
        rows = build(stream)
        schema.append(rows.schema)
        return sinks.table_sink(rows, path, checkpoint)

    in_arrivals(arrivals, run)
    return spark.read.schema(schema[-1]).parquet(path)


# longer than a third of all days, so that nothing that comes one arrival late is too late
LONG_DELAY = "12 days"


def copies_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second copy of every fiftieth event comes one arrival after the first."""
    copies = Window.partitionBy("event_id").orderBy("ts")
    events = cleaning.normalize_ts(numbered_events(spark, sf_dir)).withColumn("copy", F.row_number().over(copies))
    first, last = (events.agg(end(F.to_date("ts"))).scalar() for end in (F.min, F.max))
    third = F.floor(F.datediff(F.to_date("ts"), first) * 3 / (F.datediff(last, first) + 1)).cast("int")
    return write_table(events.withColumn("arrival", third + F.col("copy") - 1).drop("copy", "event_id"), "arrivals")


def clean_stream(stream: DataFrame, delay: str) -> DataFrame:
    return rt.watermark(cleaning.clean_rows(stream), delay)


@query("r1_watermark")
def _(spark, sf_dir):
    """Four arrivals in order of time; every twentieth event comes one arrival late and meets a closed window."""
    arrivals = by_thirds(spark, sf_dir, F.col("event_id") % 20 == 0).select("event_id", "ts", "event_type", "arrival")
    return streamed_in_arrivals(arrivals, lambda stream: rt.windowed_counts(rt.watermark(stream)), "windows")


@query("c7_dedupe_stream")
def _(spark, sf_dir):
    return streamed_in_arrivals(copies_apart(spark, sf_dir), lambda stream: rt.dedupe_stream(clean_stream(stream, LONG_DELAY)), "deduped")


@query("r2_rt_user_features_deduped")
def _(spark, sf_dir):
    def build(stream):
        return rt.rt_user_features(rt.dedupe_stream(clean_stream(stream, LONG_DELAY)), F.col("window_end"))

    return streamed_in_arrivals(copies_apart(spark, sf_dir), build, "rt-users")


@query("r2_rt_user_features_rolling")
def _(spark, sf_dir):
    arrivals = by_thirds(spark, sf_dir, F.lit(False))
    return streamed_in_arrivals(arrivals, lambda stream: rt.rt_user_features(rt.watermark(stream), F.col("window_end"), rolling=True), "rt-users")


@query("r4_rt_item_features_rolling")
def _(spark, sf_dir):
    arrivals = by_thirds(spark, sf_dir, F.lit(False))
    return streamed_in_arrivals(arrivals, lambda stream: rt.rt_item_features(rt.watermark(stream), F.col("window_end"), rolling=True), "rt-items")


@query("r3_session_updates")
def _(spark, sf_dir):
    """Every twentieth event comes one arrival late and may join two sessions."""
    arrivals = by_thirds(spark, sf_dir, F.col("event_id") % 20 == 0).drop("event_id")
    return streamed_in_arrivals(arrivals, lambda stream: rt.session_updates(clean_stream(stream, LONG_DELAY), "12 hours"), "sessions")


@query("r5_rt_item_popularity_fresh")
def _(spark, sf_dir):
    """Before the second and third arrival comes a new snapshot of the items, of the events before that arrival."""
    arrivals = by_thirds(spark, sf_dir, F.lit(False)).drop("event_id")
    clean = cleaning.silver_events(arrivals.drop("arrival"))
    starts = {r.arrival: r.day for r in arrivals.groupBy("arrival").agg(F.min(F.to_date("ts")).cast("string").alias("day")).collect()}
    snapshots, path, checkpoint = (new_path(spark, n) for n in ("gold-items", "rt-items", "rt-items-checkpoint"))

    def run(stream: DataFrame, number: int):
        if number in (1, 2):
            volume = items.item_volume(clean, event_clock(clean, anchor=starts[number]))
            tables.write_gold_snapshot(volume.select("item_id", "total_events_30d"), snapshots, starts[number])
        return sinks.popularity_sink(rt.rt_item_features(rt.watermark(stream), F.col("window_end")), snapshots, path, checkpoint)

    in_arrivals(arrivals, run)
    return spark.read.parquet(path).drop("writer", "batch_id")


def judged_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(kept events, dead letters) of JSON messages in four arrivals; every 41st is cut short, every 43rd is no event."""
    arrivals = by_thirds(spark, sf_dir, F.col("event_id") % 20 == 0)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = ["user_id", "session_id", "item_id", "event_type", F.col("price").cast("float").alias("price"), "category_path", "device", "page", "referrer"]
    text = F.to_json(F.struct(*fields, iso.alias("ts")))
    text = F.when(F.col("event_id") % 41 == 0, F.substring(text, 1, 60)).when(F.col("event_id") % 43 == 0, F.lit("[1, 2]")).otherwise(text)
    kept, dead, checkpoint = (new_path(spark, n) for n in ("kept", "dead", "contract-checkpoint"))
    in_arrivals(arrivals.select(text.alias("value"), "arrival"), lambda stream, _: sinks.contract_sink(stream, kept, dead, checkpoint))
    return spark.read.parquet(kept), spark.read.parquet(dead)


@query("c9_kept_messages")
def _(spark, sf_dir):
    return judged_messages(spark, sf_dir)[0].drop("writer", "batch_id")


@query("c9_dead_letters")
def _(spark, sf_dir):
    dead = judged_messages(spark, sf_dir)[1]
    return dead.groupBy(F.concat_ws(",", "broken_rules").alias("rules")).agg(F.count("*").alias("letters"))


@query("r2_rt_user_features")
def _(spark, sf_dir):
    return streamed(rt.rt_user_features(event_stream(spark, sf_dir), F.col("window_end")), "rt-users")


@query("r3_user_feature_update")
def _(spark, sf_dir):
    windows = rt.rt_user_features(event_stream(spark, sf_dir), F.col("window_end"))
    return streamed(rt.user_feature_update(windows), "user-updates")


@query("r4_rt_item_features")
def _(spark, sf_dir):
    return streamed(rt.rt_item_features(event_stream(spark, sf_dir), F.col("window_end")), "rt-items")


@query("r5_rt_item_popularity_delta")
def _(spark, sf_dir):
    volume = write_table(items.item_volume(silver(spark, sf_dir), silver_clock(spark, sf_dir)), "item-volume")
    windows = rt.rt_item_features(event_stream(spark, sf_dir), F.col("window_end"))
    return streamed(rt.with_popularity_delta(windows, volume), "rt-items")


@query("r6_item_feature_update")
def _(spark, sf_dir):
    return streamed(rt.item_feature_update(event_stream(spark, sf_dir)), "item-updates")


@query("r7_rt_to_online")
def _(spark, sf_dir):
    windows = rt.rt_user_features(event_stream(spark, sf_dir), F.col("window_end"))
    stamped = windows.withColumn("rt_updated_at_ms", F.unix_millis("window_end")).drop("window_start", "window_end")
    path = finished(lambda p, c: sinks.rt_to_online(stamped, ["user_id"], USER_KEY_PREFIX, p, c), spark, "online")
    return online.online_log(spark, path).drop("batch_id", "writer")


# ---- feature store ----


@query("f1_entity_keys")
def _(spark, sf_dir):
    events, clock = stored_silver(spark, sf_dir), silver_clock(spark, sf_dir)
    feature_tables = {
        "user": (users.user_volume(events, clock), ("user_id",)),
        "item": (items.item_volume(events, clock), ("item_id",)),
        "user_item": (pairs.ui_cooccurrence(pairs.base_pairs(events), clock), ("user_id", "item_id")),
        "event": (events, ("user_id", "item_id")),
    }
    reports = [
        views.duplicate_keys(rows, keys).agg(F.count("*").alias("duplicate_keys")).withColumn("entity", F.lit(name))
        for name, (rows, keys) in feature_tables.items()
    ]
    return reports[0].union(reports[1]).union(reports[2]).union(reports[3])


def without_embedding(view: DataFrame) -> DataFrame:
    return view.drop(*[c for c in view.columns if "_emb" in c])


@query("f2_user_view")
def _(spark, sf_dir):
    return without_embedding(views.feature_view(gold_users(spark, sf_dir), USER_VIEW))


@query("f3_item_view")
def _(spark, sf_dir):
    return without_embedding(views.feature_view(gold_items(spark, sf_dir), ITEM_VIEW))


@query("f4_cross_view")
def _(spark, sf_dir):
    return without_embedding(views.feature_view(gold_pairs(spark, sf_dir, requested=True), CROSS_VIEW))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_scan(spark, snapshot_table(spark, sf_dir)[0])


@query("f5_materialize")
def _(spark, sf_dir):
    """Snapshots of the 30 days before the last one, which lies outside the open end of the range."""
    stored, _, dates = snapshot_table(spark, sf_dir)
    dated = views.feature_view(tables.table_scan(spark, stored), SNAPSHOT_VIEW)
    end = F.lit(dates[-1])
    rows = views.materialize(dated, SNAPSHOT_VIEW, end - F.make_dt_interval(F.lit(30)), end)
    path = new_path(spark, "online")
    online.online_upsert(rows, path, 0)
    return online.online_log(spark, path).drop("batch_id", "writer")


@query("f6_point_in_time_join")
def _(spark, sf_dir):
    purchases = silver(spark, sf_dir).filter(F.col("event_type") == "purchase")
    labels = purchases.select("user_id", "item_id", F.col("ts").alias("label_ts"))
    return views.point_in_time_join(labels, snapshots(spark, sf_dir), ("user_id",), ttl_days=7)


@query("f6_as_of_join")
def _(spark, sf_dir):
    """Each purchase with its user's last finished five-minute window of at most three hours before."""
    raw = cleaning.normalize_ts(raw_events(spark, sf_dir))
    windows = rt.rt_user_features(raw, as_of=F.col("window_end")).drop("window_start").withColumnRenamed("window_end", "feature_ts")
    purchases = silver(spark, sf_dir).filter(F.col("event_type") == "purchase")
    labels = purchases.select("user_id", "item_id", F.col("ts").alias("label_ts"))
    return views.as_of_join(labels, windows, ("user_id",), ttl_sec=3 * 3600)


@query("f7_catalog_profile")
def _(spark, sf_dir):
    return views.catalog_profile(gold_users(spark, sf_dir), USER_CATALOG)


@query("f7_pair_catalog_profile")
def _(spark, sf_dir):
    return views.catalog_profile(gold_pairs(spark, sf_dir, requested=True, declared_only=True), CROSS_CATALOG)


@query("f7_item_catalog_profile")
def _(spark, sf_dir):
    return views.catalog_profile(gold_items(spark, sf_dir, declared_only=True), ITEM_CATALOG)
