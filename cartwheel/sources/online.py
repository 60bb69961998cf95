"""Keyed online rows: JSON payloads with a time to live, kept as an append-only change log.

A write never reads the store. A batch replaces its writer's own partition of that
number, so a retried batch leaves the same rows, two writers never touch each
other's, and readers take the newest live row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import ONLINE_TTL_SEC, UPDATED_AT
from cartwheel.sources.tables import remove_folder, table_exists

LOG_SCHEMA = "key string, value string, updated_at_ms bigint, ttl_sec bigint, writer string, batch_id bigint"


def online_rows(
    features: DataFrame,
    id_columns: list[str],
    prefix: str,
    now_ms: Column | None = None,
    ttl_sec: int | Column = ONLINE_TTL_SEC,
) -> DataFrame:
    """(key, value, updated_at_ms, ttl_sec) per feature row.

    The payload carries the freshness stamp; one that is already there is kept.
    """
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    stamp = F.coalesce(F.col(UPDATED_AT), now) if UPDATED_AT in features.columns else now
    payload = [c for c in features.columns if c not in (*id_columns, UPDATED_AT)]
    body = F.to_json(F.struct(*payload, stamp.alias(UPDATED_AT)), {"ignoreNullFields": "false"})
    return features.select(
        F.concat(F.lit(prefix), F.concat_ws("|", *id_columns)).alias("key"),
        body.alias("value"),
        stamp.cast("bigint").alias("updated_at_ms"),
        (F.lit(ttl_sec) if isinstance(ttl_sec, int) else ttl_sec).cast("bigint").alias("ttl_sec"),
    )


def online_upsert(rows: DataFrame, path: str, batch_id: int, writer: str = "batch") -> None:
    """Replace batch `batch_id` of `writer`: the id of a stream, or the name of a job and its run."""
    (
        rows.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "batch_id")
        .parquet(path)
    )


def online_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def online_read(log: DataFrame, as_of_ms: int | Column | None = None) -> DataFrame:
    """The newest row per key, unless it has expired by `as_of_ms` (default: now)."""
    if as_of_ms is None:
        as_of_ms = F.unix_millis(F.current_timestamp())
    as_of = F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    return newest_rows(log).filter(F.col("updated_at_ms") + F.col("ttl_sec") * 1000 > as_of).select("key", "value", "updated_at_ms", "ttl_sec")


def newest_rows(log: DataFrame) -> DataFrame:
    """The newest row per key, ties by the greatest (batch, writer, value).

    The newest time per key comes from two narrow columns, hashed; payloads only
    meet it in a join, and only those of one time per key are compared.
    """
    latest = log.groupBy("key").agg(F.max("updated_at_ms").alias("_latest"))
    # no row lies after the latest one: the comparison keeps the join on the key alone
    held = log.join(latest, "key").filter(F.col("updated_at_ms") >= F.col("_latest"))
    return held.groupBy("key").agg(F.max(F.struct("updated_at_ms", "batch_id", "writer", "value", "ttl_sec")).alias("newest")).select("key", "newest.*")


def compact_online_log(log: DataFrame, path: str, as_of_ms: int | Column | None = None) -> None:
    """Write the live rows alone to a new log, as one batch."""
    online_upsert(online_read(log, as_of_ms), path, 0)


# how long the time of an expired row still hides older rows that come after it
FORGET_MS = 7 * 86_400_000


class OnlineStore:
    """A change log that can be read forever: batches on top of a compacted base.

    `batches` holds one partition per writer and batch. A compaction writes
    the newest row of every key to `base/generation=n`, split by a hash of the key, then
    which batches that covers, and at last a row in `pointer`. Readers take the
    generation that the pointer names and the batches it does not cover. A compaction that stops half-way has
    changed nothing; batches that arrive meanwhile are covered by the next one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _read(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        if not table_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        self.spark.catalog.refreshByPath(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def generation(self) -> int:
        """The newest complete generation, 0 before the first compaction."""
        return self._read("pointer", "generation bigint").agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, batch_id: int, writer: str = "batch") -> None:
        online_upsert(rows, f"{self.path}/batches", batch_id, writer)

    def _base(self, generation: int) -> DataFrame:
        return self._read("base", f"{LOG_SCHEMA}, generation int, bucket int").filter(F.col("generation") == generation).drop("generation")

    def _covered(self, generation: int) -> DataFrame:
        return self._read("covered", "writer string, batch_id bigint, generation int").filter(F.col("generation") == generation).drop("generation")

    def _open(self, batches: DataFrame, generation: int) -> DataFrame:
        return batches.join(self._covered(generation), ["writer", "batch_id"], "left_anti").withColumn("bucket", self._bucket())

    def log(self) -> DataFrame:
        """Base rows, and the rows of batches that the base does not cover."""
        generation = self.generation()
        batches = self._open(self._read("batches", LOG_SCHEMA), generation)
        return self._base(generation).unionByName(batches)

    def read(self, as_of_ms: int | Column | None = None) -> DataFrame:
        """The newest live row per key."""
        return online_read(self.log(), as_of_ms)

    def lookup(self, keys: DataFrame, as_of_ms: int | Column | None = None) -> DataFrame:
        """`read` for the keys in `keys` only; base files are split by bucket, so only those keys' buckets are read."""
        wanted = keys.select("key").distinct().withColumn("bucket", self._bucket())
        return online_read(self.log().join(wanted, ["bucket", "key"], "left_semi"), as_of_ms)

    def compact(self, as_of_ms: int | Column | None = None, forget_ms: int = FORGET_MS) -> int:
        """Write the next generation and return its number.

        Expired rows lose their value; their times go as well once they have been expired for `forget_ms`, the
        longest that a batch may come late.
        """
        now = F.unix_millis(F.current_timestamp()) if as_of_ms is None else F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
        before = self.generation()
        generation = before + 1
        batches = self._read("batches", LOG_SCHEMA)  # the files as they are now: later ones stay open
        newest = newest_rows(self._base(before).unionByName(self._open(batches, before)))
        ends = F.col("updated_at_ms") + F.col("ttl_sec") * 1000
        kept = newest.filter(ends + forget_ms > now).withColumns({"value": F.when(ends > now, F.col("value")), "bucket": self._bucket()})
        kept.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/generation={generation}")
        batches.select("writer", "batch_id").distinct().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/covered/generation={generation}")
        self._point_to(generation)
        return generation

    def _point_to(self, generation: int) -> None:
        self.spark.range(1).select(F.lit(generation).cast("bigint").alias("generation")).write.mode("append").parquet(f"{self.path}/pointer")

    def vacuum(self) -> None:
        """Remove generations before the last but one and the batches that the last but one covers: readers of either complete generation go on."""
        newest = self.generation()
        done = self._covered(newest - 1).collect()  # one small row per batch since the vacuum before
        for row in done:
            remove_folder(self.spark, f"{self.path}/batches/writer={row.writer}/batch_id={row.batch_id}")
        for generation in range(newest - 2, 0, -1):
            folders = [f"{self.path}/{name}/generation={generation}" for name in ("base", "covered")]
            if not any([remove_folder(self.spark, folder) for folder in folders]):
                break
