"""Stream sinks: raw archive, feature tables, online rows. Each query keeps its own checkpoint."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.cleaning import broken_rules, normalize_ts
from cartwheel.schemas import ONLINE_TTL_SEC, WINDOW_DAYS
from cartwheel.sources.online import online_rows, online_upsert
from cartwheel.sources.streams import parse_json_events
from cartwheel.sources.tables import newest_snapshot, write_batch
from cartwheel.streaming.features import with_popularity_delta

ARCHIVE_PARTITIONS = ("year", "month", "day", "hour")
_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def raw_archive(events: DataFrame, files_per_hour: int = 8) -> DataFrame:
    """All events with their UTC hour folders; those without a time have NULL folders of their own.

    The archive is the only raw copy, so nothing is left out here. A live batch
    falls into one or two hours. The salt lets `files_per_hour` tasks share an
    hour; it is drawn per row, so one event that comes many times is shared too.
    """
    at = F.timestamp_millis("ts") if dict(events.dtypes)["ts"] == "bigint" else F.col("ts")
    dated = events.withColumns({name: F.date_format(at, pattern) for name, pattern in _PATTERNS.items()})
    salted = dated.withColumn("_salt", F.floor(F.rand(17) * files_per_hour))
    return salted.repartition(*ARCHIVE_PARTITIONS, "_salt").drop("_salt")


def raw_archive_sink(
    events: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds", files_per_hour: int = 8
) -> StreamingQuery:
    return (
        raw_archive(events, files_per_hour)
        .writeStream.format("parquet")
        .partitionBy(*ARCHIVE_PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def table_sink(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append finished rows to a Parquet table, each exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _writer(batch: DataFrame, checkpoint: str) -> str:
    """The stream's id, which its checkpoint holds."""
    stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return stream_id or hashlib.sha256(checkpoint.encode()).hexdigest()


def popularity_sink(
    rt_items: DataFrame, snapshots: str, path: str, checkpoint: str, every: str | None = None, days: int = WINDOW_DAYS
) -> StreamingQuery:
    """Item windows with their popularity delta against the newest item snapshot at the time of each batch.

    The batch's items are gathered first and only their rows of the snapshot are
    joined. A snapshot that is added or rewritten between two batches counts from
    the next batch on; before the first snapshot, items count as never seen.
    A batch that is repeated replaces its own rows.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            gold = newest_snapshot(spark, snapshots, "item_id string, total_events_30d bigint")
            known = gold.join(batch.select("item_id").distinct(), "item_id", "left_semi")
            write_batch(with_popularity_delta(batch, known, days), path, batch_id, _writer(batch, checkpoint))
        finally:
            batch.unpersist()

    return (
        rt_items.writeStream.outputMode("append")
        .foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def contract_sink(messages: DataFrame, kept: str, dead: str, checkpoint: str, every: str | None = None, value: str = "value") -> StreamingQuery:
    """JSON messages, decoded once per batch: events that keep the contract go to `kept`, all others to `dead`.

    A dead letter holds the raw value and every rule it breaks; one that is no JSON
    object of the event's types breaks `parses` alone. Both tables hold one partition per writer and
    batch: a batch that stopped between the two writes is repeated whole and replaces what it had written.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        writer = _writer(batch, checkpoint)
        parsed = parse_json_events(batch, value)
        rules = F.when(F.col("parses"), broken_rules()).otherwise(F.array(F.lit("parses")))
        judged = parsed.withColumn("broken_rules", rules).drop("parses").persist()
        try:
            sound = F.size("broken_rules") == 0
            write_batch(judged.filter(sound).drop("broken_rules", "raw").transform(normalize_ts), kept, batch_id, writer)
            write_batch(judged.filter(~sound).select("raw", "broken_rules"), dead, batch_id, writer)
        finally:
            judged.unpersist()

    return (
        messages.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def rt_to_online(
    features: DataFrame,
    id_columns: list[str],
    prefix: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
    now_ms: Column | None = None,
    ttl_sec: int = ONLINE_TTL_SEC,
) -> StreamingQuery:
    """Deliver stream rows to the online log, one log partition per micro-batch.

    The stream writes under the id that its checkpoint holds: a restart from the
    checkpoint goes on with its own batches, another stream never meets them.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        online_upsert(online_rows(batch, id_columns, prefix, now_ms, ttl_sec), path, batch_id, _writer(batch, checkpoint))

    return (
        features.writeStream.outputMode("append")
        .foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
