"""Table sources and sinks. `fmt` is a Spark source name: parquet here, a lakehouse format where its jar is present."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_PARTITIONS = ("event_date", "event_hour")


def bronze_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All raw Parquet files below `path`; folder names do not become columns."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(path)


def table_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def feature_source(spark: SparkSession, path: str, fmt: str = "parquet", date_column: str = "date") -> DataFrame:
    """A dated feature table with its snapshot date as event time."""
    return table_scan(spark, path, fmt).withColumn("event_timestamp", F.to_timestamp(date_column))


def write_silver_events(events: DataFrame, path: str, fmt: str = "parquet", replace_all: bool = False) -> None:
    """Write clean events, partitioned by date and hour.

    Only the hours that `events` holds are replaced, so a day can be rebuilt
    alone; with `replace_all` every other hour goes too. Rebalancing gathers each hour into few files, and lets AQE split an hour
    that holds far more rows than the others.
    """
    (
        events.hint("rebalance", *EVENT_PARTITIONS)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*EVENT_PARTITIONS)
        .save(path)
    )


def write_day_states(states: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the days that `states` holds and leave the others alone."""
    (
        states.hint("rebalance", EVENT_PARTITIONS[0])
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_PARTITIONS[0])
        .save(path)
    )


def write_entity_table(entities: DataFrame, path: str, fmt: str = "parquet") -> None:
    entities.write.format(fmt).mode("overwrite").save(path)


def write_gold_snapshot(features: DataFrame, path: str, date: str, fmt: str = "parquet") -> None:
    """Replace the snapshot of one date and leave the other dates alone."""
    (
        features.withColumn("date", F.lit(date))
        .hint("rebalance")
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .save(path)
    )


def write_batch(rows: DataFrame, path: str, batch_id: int, writer: str) -> None:
    """Replace one batch of one writer: a batch that is written again leaves the same rows."""
    (
        rows.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "batch_id")
        .parquet(path)
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything, by the file system that Spark itself would use."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all in it; False if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def newest_snapshot(spark: SparkSession, path: str, schema: str, date_column: str = "date") -> DataFrame:
    """The rows of the newest date as the folder stands now; none if there is no folder yet."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    # a fresh listing each time: which files there are is not kept from an earlier read
    spark.catalog.refreshByPath(path)
    table = spark.read.schema(f"{schema}, {date_column} string").parquet(path)
    newest = table.agg(F.max(date_column)).first()[0]
    return table.filter(F.col(date_column) == newest).drop(date_column)
