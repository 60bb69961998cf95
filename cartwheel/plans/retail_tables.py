"""Raw retail events and an item catalogue derived from the given `events` and `part` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.streams import file_event_stream

# columns of the given tables, stated so that opening a table starts no job
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
EMBEDDINGS_SCHEMA = "vec_id bigint, embedding array<float>, label int"
SCHEMAS = {"events": EVENTS_SCHEMA, "part": PART_SCHEMA, "embeddings": EMBEDDINGS_SCHEMA}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, brand, category_path) of every part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("i_"), "p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.array("p_type", F.try_element_at(F.split("p_name", " "), F.lit(2))).alias("category_path"),
    )


def _pick(index: Column, first: str, *others: str | None) -> Column:
    """One of the values by index from 0; the last also stands for any higher index."""
    picked = F.when(index == 0, first)
    for i, value in enumerate(others[:-1], start=1):
        picked = picked.when(index == i, value)
    return picked.otherwise(F.lit(others[-1]))


def _as_retail(events: DataFrame, paths: DataFrame | None) -> DataFrame:
    event_id, user = F.col("event_id"), F.col("user_id")
    kind = (
        F.when(F.col("event_type") == "view", "View")
        .when(F.col("event_type") == "click", "view")
        .when(F.col("event_type") == "signup", "add_to_cart")
        .otherwise(F.col("event_type"))
    )
    # props holds one number, {"k": 0..99}: a pattern reads it at a third of the cost of a JSON parser
    number = F.nullif(F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1), F.lit(""))
    retail = events.select(
        F.concat(F.lit("u_"), user).alias("user_id"),
        F.concat(F.lit("s_"), user, F.lit("_"), F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit(""))).alias("session_id"),
        F.concat(F.lit("i_"), number).alias("item_id"),
        kind.alias("event_type"),
        F.when(event_id % 97 == 0, 0.0).otherwise(F.col("value")).alias("price"),
        _pick(event_id % 3, "Web", "ios", "android").alias("device"),
        _pick(event_id % 4, "home", "plp", "PDP", "cart").alias("page"),
        _pick(event_id % 3, "campaign_1", "campaign_2", None).alias("referrer"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        # every fiftieth event arrives twice
        F.explode(F.sequence(F.lit(1), F.when(event_id % 50 == 0, 2).otherwise(1))).alias("_copy"),
        "event_id",
    )
    if paths is None:
        retail = retail.withColumn("category_path", F.lit(None).cast("array<string>"))
    else:
        retail = retail.join(paths, "item_id", "left")
    return retail.select(
        "user_id",
        "session_id",
        "item_id",
        "event_type",
        "price",
        "category_path",
        "device",
        "page",
        "referrer",
        "ts",
        "event_id",
    )


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).select("item_id", "category_path")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events that keep the source's event_id."""
    return _as_retail(table(spark, sf_dir, "events"), _paths(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_events(spark, sf_dir).drop("event_id")


def raw_events_without_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with category_path left NULL, for readers that do not need the catalogue."""
    return _as_retail(table(spark, sf_dir, "events"), None).drop("event_id")


def raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same raw events as a stream over the source file."""
    stream = file_event_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet")
    return _as_retail(stream, _paths(spark, sf_dir)).drop("event_id")
