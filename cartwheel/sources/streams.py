"""Event stream sources and wire decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import WIRE_SCHEMA

# the wire schema with times as text, as JSON producers send them
JSON_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "ts" else f for f in WIRE_SCHEMA.fields]
)


def file_event_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Parquet files as an event stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def kafka_event_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    options: dict[str, str] | None = None,
    events_per_trigger: int | None = 5_000_000,
) -> DataFrame:
    """Decoded JSON events of a topic, from the latest offsets on.

    Needs the Kafka source package on the classpath. The consumer group of a job
    is its checkpoint: give every query its own `checkpointLocation`. A backlog is
    taken in batches of `events_per_trigger`.
    """
    limit = {} if events_per_trigger is None else {"maxOffsetsPerTrigger": str(events_per_trigger)}
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**limit, **(options or {}))
        .load()
    )
    return decode_json_events(raw.select(F.col("value").cast("string").alias("value")))


def _instant(text: Column) -> Column:
    """ISO-8601 text or epoch milliseconds, as a timestamp; NULL for anything else."""
    return F.coalesce(F.timestamp_millis(text.try_cast("bigint")), text.try_cast("timestamp"))


def decode_json_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to the ten event columns; `ts` becomes event time and `price` a double."""
    event = F.from_json(F.col(value), JSON_SCHEMA)
    return _event_columns(messages.select(event.alias("event")))


def parse_json_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """The ten event columns, the `raw` text, and whether it `parses`: one JSON object with the declared types.

    The reader stops after the object, so text behind its end is looked for apart.
    """
    corrupt = "_corrupt"
    schema = T.StructType([*JSON_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    event = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": corrupt})
    decoded = messages.select(event.alias("event"), F.col(value).alias("raw"))
    parses = F.col("event").isNotNull() & F.col(f"event.{corrupt}").isNull() & F.col("raw").rlike(r"(?s)^\s*\{.*\}\s*$")
    return _event_columns(decoded.withColumn("parses", F.coalesce(parses, F.lit(False))), "raw", "parses").drop(corrupt)


def _event_columns(decoded: DataFrame, *beside: str) -> DataFrame:
    """The same columns and types whatever the wire format was, and what stands `beside` the event."""
    fields = decoded.select("event.*", *beside)
    return fields.withColumns({"price": F.col("price").cast("double"), "ts": _instant(F.col("ts").cast("string"))})


def decode_avro_events(messages: DataFrame, avro_schema: str, value: str = "value", header_bytes: int = 5) -> DataFrame:
    """Avro bytes behind a registry header to event columns; NULLs where the header's first byte is not zero.

    Needs the Avro package on the classpath.
    """
    from pyspark.sql.avro.functions import from_avro

    start = header_bytes + 1
    framed = F.expr(f"substring({value}, 1, 1) = X'00'")
    body = F.when(framed, F.expr(f"substring({value}, {start}, length({value}) - {header_bytes})"))
    return _event_columns(messages.select(from_avro(body, avro_schema).alias("event")))
